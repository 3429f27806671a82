"""Grouped sums and wide pivots."""

from decimal import Decimal

from flowtide.functions import fixed_values as V
from flowtide.operators import aggregates, combine, pivots
from flowtide.plans import advisor, analysis
from pyspark.sql import functions as F

from tests.helpers import rows

FLOW = (
    "month_number int, parent_fund_acronym_group string, sale_amount decimal(18,2),"
    "redemption_amount decimal(18,2), exchange_in_amount decimal(18,2),"
    "exchange_out_amount decimal(18,2)"
)


def money(*values):
    return tuple(None if v is None else Decimal(v) for v in values)


def flow_rows(spark, *data):
    return spark.createDataFrame([(m, f, *money(*v)) for m, f, *v in data], FLOW)


def test_null_part_counts_differently(spark):
    by = ["month_number"]
    one = flow_rows(spark, (202001, "GFA", None, -5, 0, 0))
    two = one.union(flow_rows(spark, (202001, "GFA", 2, -1, 0, 0)))
    assert aggregates.net_flows(one, by).first().net_cash_flow is None
    assert aggregates.flow_totals(one, by).first().net_flow_amount is None
    assert aggregates.net_flows(two, by).first().net_cash_flow == -4
    assert aggregates.flow_totals(two, by).first().net_flow_amount == 1


def test_absolute_total_is_taken_after_the_sum(spark):
    df = flow_rows(spark, (202001, "GFA", 0, -5, 0, 0), (202001, "GFA", 0, 3, 0, 0))
    by = ["month_number"]
    assert aggregates.period_totals(df, by, "redemption_amount").first().abs_tot_rdmpt_amt == 2
    assert aggregates.flow_totals(df, by).first().abs_redemption_amount == 8


def test_conditional_sums(spark):
    df = spark.createDataFrame(
        [("a", "X", 1), ("a", "Y", 2), ("a", None, 4), ("b", "X", None)], "k string, t string, n long"
    )
    tests = {"x": F.col("t") == "X", "not_x": ~F.col("t").isin("X"), "any": F.lit(True)}
    got = rows(aggregates.conditional_sums(df, ["k"], tests, "n"))
    # An unknown type is neither X nor not X.
    assert got == [("a", 1, 2, 7), ("b", None, 0, None)]


def test_pivot_keeps_groups_without_listed_bucket(spark):
    df = spark.createDataFrame(
        [("a", "F1", "L", 1), ("a", "F1", "L", 2), ("a", "F2", "M", 4), ("b", "F9", "L", 8),
         ("c", None, "L", 16)],
        "k string, b string, l string, n long",
    )
    got = pivots.fund_line_pivot(
        df, ["k"], F.col("b"), F.col("l"), {"n": F.col("n")}, ["F1", "F2"], ["L", "M"]
    )
    assert got.columns == ["k", "n_F1_L", "n_F2_L", "n_F1_M", "n_F2_M"]
    assert rows(got) == [("a", 3, 0, 0, 4), ("b", 0, 0, 0, 0), ("c", 0, 0, 0, 0)]


def test_pivot_cells_add_up_to_the_total(spark):
    df = spark.range(500).select(
        (F.col("id") % 3).alias("k"),
        (F.col("id") % 5).cast("string").alias("b"),
        (F.col("id") % 2).cast("string").alias("l"),
        F.col("id").alias("n"),
    )
    wide = pivots.fund_line_pivot(
        df, ["k"], F.col("b"), F.col("l"), {"n": F.col("n")}, list("01234"), ["0", "1"]
    )
    assert sum(sum(r[1:]) for r in wide.collect()) == sum(range(500))


def facts(spark, data, *amounts):
    schema = (
        "MO_NUM int, FINCL_ITRMY_PRSON_ID long, INV_VEH_ID long, RK_SOLTN_CD string,"
        "FUND_SHARE_CLASS_ID int, INVSR_ACCT_TYP_CD string, TEAM_IND string,"
        + ",".join(f"{a} decimal(18,2)" for a in amounts)
    )
    return spark.createDataFrame(
        [(m, p, veh, "R", 1, "A", team, *money(*v)) for m, p, veh, team, *v in data], schema
    )


def dimensions(spark):
    vehicles = spark.createDataFrame(
        [(1, "AFTD2040"), (2, "GFA"), (3, "NONE")],
        "InvestmentVehicleID long, ParentFundAcronymCode string",
    )
    lines = spark.createDataFrame(
        [(1, "R", 1, "A", "IR", "DCIO", "RKD"), (2, "R", 1, "A", "XX", "Small RP Solutions", "-"),
         (3, "R", 1, "A", "IR", "Retail", "PlanPremier")],
        "INV_VEH_ID long, RK_SOLTN_CD string, FUND_SHARE_CLASS_ID int, INVSR_ACCT_TYP_CD string,"
        "BusinessLine1 string, BusinessLine2 string, BusinessLine3 string",
    )
    return vehicles, lines


def non_zero(row):
    return {k: float(v) for k, v in row.asDict().items() if isinstance(v, Decimal) and v != 0}


def test_advisor_assets(spark):
    data = [
        (201612, 9, 1, "N", 10, 1), (201612, 9, 2, "N", 20, 0), (201612, 9, 3, "N", 40, 0),
        (201612, 9, 4, "N", 80, 0),  # in neither dimension
        (201612, 9, 1, "Y", 1000, 0), (201612, 0, 1, "N", 1000, 0), (201611, 9, 1, "N", 1000, 0),
        (201612, 9, 1, "N", 5, -5), (201612, 9, 1, "N", 5, None), (201612, None, 1, "N", 5, 0),
        (201713, 9, 1, "N", 1000, 0), (201700, 9, 1, "N", 1000, 0),  # no months
        (201701, 9, 4, "N", 1, 1),  # no line at all
    ]
    assets = facts(spark, data, "ASSET_VAL_AMT", "TEAM_ALLOC_ASSET_VAL_AMT")
    wide = advisor.advisor_assets(assets, *dimensions(spark))
    assert len(wide.columns) == 69
    first, second = wide.orderBy("MonthDate").collect()
    assert str(first.MonthDate) == "2017-01-01" and first.FinancialIntermediaryPersonID == 9
    assert non_zero(first) == {
        "Assets_IR": 51, "Assets_DCIO": 11, "Assets_DCProp": 51, "Assets_DCSmallRPSolution": 20,
        "Assets_OtherIR": 40, "FundAssetsTD_DCIO": 11, "FundAssetsGFA_SmallRP": 20,
    }
    assert str(second.MonthDate) == "2017-02-01" and non_zero(second) == {}


def test_advisor_sales(spark):
    data = [
        (201701, 9, 1, "N", 10, 1, 0, 0), (201701, 9, 4, "N", 0, 0, -30, -3),
        (201701, 9, 2, "N", 0, 0, -7, 0), (201701, 9, 2, "N", 5, 0, -5, 0),
        (201701, 9, 2, "N", 5, 0, -4, None),
    ]
    amounts = ["SLS_AMT", "TEAM_ALLOC_SLS_AMT", "RDMPT_AMT", "TEAM_ALLOC_RDMPT_AMT"]
    wide = advisor.advisor_sales(facts(spark, data, *amounts), *dimensions(spark))
    assert len(wide.columns) == 136
    assert wide.columns[2:8] == [
        "Sales_IR", "Sales_DCIO", "Sales_DCProp", "Sales_DCSmallRPSolution", "Sales_OtherIR",
        "FundSalesTD_DCIO",
    ]
    assert wide.columns[-1] == "FundRedemptionsMMF_SmallRP"
    assert non_zero(wide.first()) == {
        "Sales_IR": 11, "Sales_DCIO": 11, "Sales_DCProp": 11, "FundSalesTD_DCIO": 11,
        "Redemptions_IR": 40, "Redemptions_DCSmallRPSolution": 7, "FundRedemptionsGFA_SmallRP": 7,
    }


def test_union_keeps_all_rows(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4), (3, 4)], "y int, x int")
    got = combine.union_sources({"a": a, "b": b})
    assert rows(got) == [(1, 2, "a"), (4, 3, "b"), (4, 3, "b")]


def test_last_known_value_of_the_month(spark):
    df = spark.createDataFrame(
        [(202001, 1, 5.0, 1.0), (202001, 2, None, 2.0), (202002, 1, None, None)],
        "m int, d int, a double, b double",
    )
    got = rows(aggregates.one_row_per_month(df, "m", "d", ["a", "b"]))
    assert got == [(202001, 5.0, 2.0), (202002, None, None)]


def test_fund_detail_and_series(spark):
    data = [(202003, "GFA", 1, -2, 3, -4), (202001, "GFA", 1, -2, 3, -4), (202002, "ICA", 9, 9, 9, 9)]
    df = flow_rows(spark, *data)
    detail = analysis.fund_detail(df, "GFA").collect()
    assert [(r.month_number, r.month_counter, r.abs_redemption_amount) for r in detail] == [
        (202001, 1, 2), (202003, 2, 2),
    ]
    series = analysis.fund_flow_series(df, "GFA").collect()
    assert [r.month_counter for r in series] == [1, 2]
    first = series[0].asDict()
    assert {k: int(first[k]) for k in V.LEGACY_FLOW_COLUMNS if k in first and k.endswith("amount")} == {
        "redemption_amount": -2, "sale_amount": 1, "exchange_in_amount": 3,
        "exchange_out_amount": -4, "abs_redemption_amount": 2, "out_amount": -6,
        "net_flow_amount": -1, "exchange_net_flow_amount": -1, "total_net_flow_amount": -2,
    }
