"""Firm and fund lookups and the flow plans built on them."""

from decimal import Decimal

from flowtide.functions import fixed_values as V
from flowtide.operators import lookups
from flowtide.plans import flows
from pyspark.sql import functions as F

from tests.helpers import rows

NAMES = [
    "UBS Financial and UBS Securities",
    "Wells Fargo via LPL",
    "edward jones trust",
    "Independent",
    None,
]


def named(spark, names=NAMES):
    return spark.createDataFrame([(n,) for n in names], "organization_name string")


def test_firm_lookup_dedupes_fragments_of_one_firm(spark):
    got = rows(lookups.firm_lookup(named(spark, NAMES * 2)))
    assert got == [
        ("UBS Financial and UBS Securities", "ubs"),
        ("Wells Fargo via LPL", "lpl"),
        ("Wells Fargo via LPL", "wells_fargo"),
        ("edward jones trust", "edward_jones"),
    ]


def test_firm_lookup_literal_repeats(spark):
    got = rows(lookups.firm_lookup(named(spark), dedupe=False))
    assert got.count(("UBS Financial and UBS Securities", "ubs")) == 2


def test_attach_equals_join_with_lookup(spark):
    facts = named(spark, NAMES * 3)
    for dedupe in (True, False):
        table = lookups.firm_lookup(facts, dedupe=dedupe)
        joined = lookups.lookup_join(facts, table, "organization_name")
        assert rows(lookups.attach_firm(facts, dedupe=dedupe)) == rows(joined)


def test_fund_lookup(spark):
    listing = spark.createDataFrame(
        [("RGAAX", 1), ("RGAAX", 1), ("RGAAX", 2), ("RICGX", 3), ("RGAZX", 4), (None, 5)],
        "ticker_symbol string, investment_vehicle_id long",
    )
    assert rows(lookups.fund_lookup(listing)) == [
        ("RGAAX", "GFA", 1, "R-1"),
        ("RGAAX", "GFA", 2, "R-1"),
        ("RICGX", "ICA", 3, "R-6"),
    ]


def test_fund_lookup_shared_prefix(spark):
    listing = spark.createDataFrame(
        [("ABAX", 1)], "ticker_symbol string, investment_vehicle_id long"
    )
    got = lookups.fund_lookup(listing, {"ONE": "AB", "TWO": "AB"}, {"AX": "R-1"})
    assert rows(got) == [("ABAX", "ONE", 1, "R-1"), ("ABAX", "TWO", 1, "R-1")]


def raw_rows(spark, data):
    schema = (
        "MonthNumber int, RetirementPlanId string, OrganizationName string, BusinessLine1 string,"
        "ParentFundAcronymGroup string, ParentShareClassName string, SaleAmount decimal(18,2),"
        "RedemptionAmount decimal(18,2), ExchangeInAmount decimal(18,2),"
        "ExchangeOutAmount decimal(18,2)"
    )
    return spark.createDataFrame(data, schema)


def money(*values):
    return tuple(None if v is None else Decimal(v) for v in values)


def fund_table(spark, vehicles):
    data = [("RGAAX", "GFA", v, "R-1") for v in vehicles]
    return spark.createDataFrame(
        data,
        "ticker_symbol string, parent_fund_acronym_group string,"
        "investment_vehicle_id long, parent_share_class_name string",
    )


RAW = [
    (201701, "7", "LPL Financial", "IR", "GFA", "R-1", *money(5, -1, 0, 0)),
    (201701, "7", "LPL", "IR", "GFA", "R-1", *money(6, None, 0, 0)),
    (201701, "7", "LPL", "DCIO", "GFA", "R-1", *money(1, 0, 0, 0)),
    (201701, "#", "LPL", "IR", "GFA", "R-1", *money(100, 0, 0, 0)),
    (201701, "0", "LPL", "IR", "GFA", "R-1", *money(100, 0, 0, 0)),
    (201612, "7", "LPL", "IR", "GFA", "R-1", *money(100, 0, 0, 0)),
    (201701, "7", "Nobody", "IR", "GFA", "R-1", *money(100, 0, 0, 0)),
    (201701, "7", "LPL", "IR", "GFA", "R-2", *money(100, 0, 0, 0)),
]


def test_source_b_filters_line_plan_month_firm_and_fund(spark):
    (got,) = flows.flows_source_b(raw_rows(spark, RAW), fund_table(spark, [1])).collect()
    assert got.asDict() == {
        "month_number": 201701,
        "retirement_plan_id": "7",
        "organization_name_standard": "lpl",
        "business_line_1": "IR",
        "parent_fund_acronym_group": "GFA",
        "parent_share_class_name": "R-1",
        "ticker_symbol": "RGAAX",
        "investment_vehicle_id": 1,
        "sale_amount": Decimal(11),
        "redemption_amount": Decimal(-1),
        "exchange_in_amount": Decimal(0),
        "exchange_out_amount": Decimal(0),
        "data_source": V.SOURCE_B_TAG,
    }


def test_each_vehicle_carries_the_full_amount(spark):
    got = flows.flows_source_a(raw_rows(spark, RAW), fund_table(spark, [1, 2, 3]))
    sums = got.where("business_line_1 = 'IR'").select("investment_vehicle_id", "sale_amount")
    assert rows(sums) == [(1, Decimal(11)), (2, Decimal(11)), (3, Decimal(11))]


def test_vehicle_join_beyond_the_broadcast_limit_gives_the_same(spark, monkeypatch):
    raw, funds = raw_rows(spark, RAW), fund_table(spark, range(50))
    small = rows(flows.flows_source_a(raw, funds))
    monkeypatch.setattr(flows, "fits_broadcast", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = flows.flows_source_a(raw, funds)
        assert rows(large) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_firm_table_with_repeats_counts_amounts_twice(spark):
    data = [(201701, "7", "UBS Financial, UBS Securities", "IR", "GFA", "R-1", *money(5, 0, 0, 0))]
    raw = raw_rows(spark, data)
    names = raw.select(F.col("OrganizationName").alias("organization_name"))
    repeated = lookups.firm_lookup(names, dedupe=False)
    funds = fund_table(spark, [1])
    assert flows.flows_source_a(raw, funds, repeated).first().sale_amount == Decimal(10)
    assert flows.flows_source_a(raw, funds).first().sale_amount == Decimal(5)
