"""Physical plans: what is pushed down, what is shuffled, what is broadcast."""

from decimal import Decimal

import pytest
from flowtide.functions import fixed_values as V
from flowtide.operators import lookups, windows
from flowtide.plans import advisor, analysis, base, flows
from flowtide.sources import settle
from pyspark.sql import functions as F

from tests.helpers import ancestors, exchanges, plan, rows
from tests.test_pivots import dimensions, facts
from workload import queries as Q


def saved(df, path):
    df.write.mode("overwrite").parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def pushed(text, column):
    (line,) = [x for x in text.splitlines() if "FileScan" in x and column in x]
    return line.split("PushedFilters: ")[1].split("ReadSchema")[0]


def advisor_files(spark, tmp_path):
    data = [(201700 + i % 12, i % 50, i % 3 + 1, "N", i, 1) for i in range(400)]
    return saved(
        facts(spark, data, "ASSET_VAL_AMT", "TEAM_ALLOC_ASSET_VAL_AMT"), tmp_path / "assets"
    )


def test_advisor_filters_reach_the_scan(spark, tmp_path):
    wide = advisor.advisor_assets(advisor_files(spark, tmp_path), *dimensions(spark))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        filters = pushed(plan(wide), "FINCL_ITRMY_PRSON_ID")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    for wanted in (f"GreaterThanOrEqual(MO_NUM,{V.ADVISOR_MONTH_START})", "EqualTo(TEAM_IND,N)"):
        assert wanted in filters


def test_advisor_pivot_moves_narrow_rows_twice(spark, tmp_path):
    wide = advisor.advisor_assets(advisor_files(spark, tmp_path), *dimensions(spark))
    wide.collect()
    (path,) = exchanges(plan(wide), "FINCL_ITRMY_PRSON_ID#")[-1:]
    assert len(path) == 2
    by_key, by_traits = path
    assert "REPARTITION_BY_COL" in by_key and "_bucket" in by_traits
    # Partial sums are made before the first of the two.
    nodes = ancestors(plan(wide), "FileScan parquet [MO_NUM")[0]
    below = nodes[nodes.index(by_traits) + 1]
    assert "partial_sum" in below


def test_dimensions_beyond_the_limit_are_shuffled(spark, tmp_path, monkeypatch):
    assets, dims = advisor_files(spark, tmp_path), dimensions(spark)
    small = advisor.advisor_assets(assets, *dims)
    expected = sorted(map(str, small.collect()))
    assert "BroadcastHashJoin" in plan(small)
    monkeypatch.setattr(settle, "MAX_BROADCAST_BYTES", 1)
    monkeypatch.setattr(settle.fits_broadcast, "__defaults__", (1,))
    monkeypatch.setattr(settle.checked_broadcast, "__defaults__", (1,))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = advisor.advisor_assets(assets, *dims)
        assert sorted(map(str, large.collect())) == expected
        assert "SortMergeJoin" in plan(large) and "BroadcastHashJoin" not in plan(large)
        # The facts were summed before they were settled, and move once for both dimensions.
        moves = exchanges(plan(large), "FileScan parquet [MO_NUM")[0]
        assert sum("hashpartitioning(INV_VEH_ID" in n for n in moves) == 1
        measures = {"Assets": F.col("ASSET_VAL_AMT")}
        monkeypatch.setattr(advisor, "settle", lambda df: df)
        sums = advisor.advisor_rows(assets, *dims, F.col("ASSET_VAL_AMT"), measures=measures)
        nodes = ancestors(plan(sums), "FileScan parquet [MO_NUM")[0]
        lowest = max(i for i, n in enumerate(nodes) if "Exchange" in n)
        assert "partial_sum" in " ".join(nodes[lowest:])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_counter_leaves_facts_in_place(spark, tmp_path):
    ids = spark.range(1000).select((F.col("id") % 30 + 201701).cast("int").alias("m"), "id")
    counted = windows.month_counter(saved(ids, tmp_path / "facts"), "m")
    counted.collect()
    assert exchanges(plan(counted), "FileScan parquet")[0] == []


def test_fill_and_trailing_of_unbounded_groups_leave_facts_in_place(spark, tmp_path):
    hot = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 30 + 201701).cast("int").alias("m"),
        F.when(F.col("id") % 5 == 0, F.col("id")).alias("v"),
    )
    df = saved(hot, tmp_path / "facts")
    for result in (
        windows.fill_gaps(df, ["k"], "m", ["v"]),
        windows.trailing_avg(df, "v", ["k"], "m"),
    ):
        result.collect()
        assert exchanges(plan(result), "FileScan parquet")[0] == []
        # A window sees one row per key and month, never the facts.
        assert not any("Window" in n for n in ancestors(plan(result), "FileScan parquet")[0])


def base_rows(spark):
    """One row per month and vehicle, with gaps; one plan has most of the rows."""
    fixed = [k for k in V.FILL_KEYS if k not in ("retirement_plan_id", "investment_vehicle_id")]
    n = F.col("id")
    return spark.range(240).select(
        *[F.lit("x").alias(k) for k in fixed],
        F.when(n < 192, "hot").otherwise("cold").alias("retirement_plan_id"),
        F.floor(n / 24).alias("investment_vehicle_id"),
        F.lit("T").alias("ticker_symbol"),
        (F.floor(n % 24 / 12) * 100 + n % 12 + 201701).cast("int").alias("month_number"),
        F.when(n % 5 > 1, n).cast("decimal(18,2)").alias("redemption_amount"),
        F.when(n % 7 == 3, n.cast("double")).alias("gdp"),
    )


def test_bounded_base_features_use_one_shuffle(spark, tmp_path):
    features = base.base_features(saved(base_rows(spark), tmp_path / "base"))
    features.collect()
    ((shuffle,),) = exchanges(plan(features), "FileScan parquet")
    assert "REPARTITION_BY_COL" in shuffle


@pytest.mark.parametrize("fill", ["nearest", "first_seen"])
def test_both_base_plans_agree(spark, fill):
    one = base.base_features(base_rows(spark), fill=fill)
    other = base.base_features(base_rows(spark), fill=fill, bounded_groups=False)
    assert one.columns == other.columns
    assert rows(one) == rows(other)


@pytest.mark.parametrize("operator", [windows.forward_fill, windows.back_fill, windows.running_first, windows.fill_gaps])
def test_both_fill_plans_agree_on_peers_in_any_order(spark, operator):
    data = [("a", 1, 9), ("a", 2, None), ("a", 2, 3), ("a", 2, 4), ("a", 3, None), ("b", 1, None), ("b", 2, 5), ("b", 2, None)]
    results = []
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k string, m int, v int").repartition(2)
        results += [rows(operator(df, ["k"], "m", ["v"], bounded_groups=b)) for b in (True, False)]
    assert all(r == results[0] for r in results)


def test_hot_keys_of_large_lookups_are_split(spark, tmp_path, monkeypatch):
    """Beyond the broadcast limit a key with a third of the rows is spread over tasks."""
    keys = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    facts_ = saved(
        spark.range(200_000).select(keys.alias("k"), "id", F.uuid().alias("text")).repartition(16),
        tmp_path / "facts",
    )
    lookup = saved(spark.range(5000).select(F.col("id").alias("k"), "id"), tmp_path / "lookup")
    lookup = lookup.withColumnRenamed("id", "code")
    expected = lookups.lookup_join(facts_, lookup, "k").agg(F.sum("code"), F.count("*")).first()
    monkeypatch.setattr(settle.checked_broadcast, "__defaults__", (1,))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        joined = lookups.lookup_join(facts_, lookup, "k")
        joined.collect()
        assert "SortMergeJoin(skew=true)" in plan(joined)
        assert joined.agg(F.sum("code"), F.count("*")).first() == expected
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_flows_are_summed_before_vehicles_are_joined(spark, tmp_path):
    raw = spark.range(300).select(
        F.lit(201702).alias("monthnumber"),
        (F.col("id") % 3 + 1).cast("string").alias("retirementplanid"),
        F.lit("LPL Financial").alias("organizationname"),
        F.lit("IR").alias("businessline1"),
        F.lit("GFA").alias("parentfundacronymgroup"),
        F.lit("R-1").alias("parentshareclassname"),
        *[
            F.lit(Decimal("1.00")).alias(c)
            for c in ("saleamount", "redemptionamount", "exchangeinamount", "exchangeoutamount")
        ],
    )
    funds = spark.createDataFrame(
        [("RGAAX", "GFA", v, "R-1") for v in range(4)],
        "ticker_symbol string, parent_fund_acronym_group string, investment_vehicle_id long,"
        "parent_share_class_name string",
    )
    result = flows.flows_source_a(saved(raw, tmp_path / "raw"), funds)
    assert sum(r.sale_amount for r in result.collect()) == 4 * 300
    text = plan(result)
    (path,) = exchanges(text, "FileScan parquet")
    assert len(path) == 1 and "hashpartitioning(month_number" in path[0]
    above = ancestors(text, "FileScan parquet")[0]
    assert "Inner" in next(n for n in above if "BroadcastHashJoin" in n)
    assert "GreaterThan(monthnumber,201700)" in pushed(text, "monthnumber")


def test_registered_queries_scan_facts_without_single_partition(spark, sf_dir):
    for query in (Q.fund_redemptions, Q.redemption_moving_avg, Q.fund_detail, Q.trailing_avg):
        text = plan(query(spark, sf_dir))
        for path in exchanges(text, "FileScan parquet [l_"):
            assert not any("SinglePartition" in n for n in path)


def test_fund_detail_is_sorted_unless_told_not_to(spark, sf_dir):
    rows_ = Q.A.fund_flows(spark, sf_dir)
    assert "rangepartitioning" not in plan(analysis.fund_detail(rows_, "GFA", ordered=False))
    months = [r.month_number for r in analysis.fund_detail(rows_, "GFA").collect()]
    assert months == sorted(months)


def test_legacy_names_are_these():
    assert V.LEGACY_SERIES_COLUMNS == {
        "month_number": "mo_num",
        "parent_fund_acronym_group": "fund_acrnm_cd",
        "redemption_amount": "_rdmpt_amt",
        "sale_amount": "sls_amt",
        "exchange_in_amount": "exchg_in_amt",
        "exchange_out_amount": "exchg_out_amt",
        "abs_redemption_amount": "_abs_rdmpt_amt",
        "out_amount": "out_amt",
        "net_flow_amount": "net_flow_amt",
        "exchange_net_flow_amount": "exchg_net_flow_amt",
        "total_net_flow_amount": "tot_net_flow_amt",
    }


def test_daily_sums_come_without_the_repeated_rows(spark):
    flows_ = base_rows(spark).drop("morningstar_category_grouped", "gdp")
    months = [r[0] for r in flows_.select("month_number").distinct().collect()]
    values = [(m, float(d) if (m + d) % 3 else None, 7.5 if m == max(months) else None) for m in months for d in range(5)]
    macro = spark.createDataFrame(values, "month_number int, GDP double, Sentiment double")
    returns = flows_.select("month_number", "ticker_symbol").distinct().withColumns(
        {"morningstar_category_grouped": F.lit("x"), "return_1_month": F.when(F.col("month_number") % 2 == 0, 0.25)}
    )
    text = {*V.FILL_KEYS, "month_number", "ticker_symbol"}
    filled = base.filled_base(base.base_table(flows_, macro, returns))
    sums = [F.sum(F.col(c).cast("decimal(28,2)")).alias(c) for c in filled.columns if c not in text]
    expected = filled.groupBy("month_number", "ticker_symbol").agg(F.count(F.lit(1)).alias("n_rows"), *sums)
    got = base.filled_sums(flows_, macro, returns)
    assert got.columns == expected.columns and rows(got) == rows(expected) != []
    assert "_gaps_GDP" in plan(got)


@pytest.mark.parametrize("days", [1, 2])
@pytest.mark.parametrize("known", [True, False])
def test_only_columns_with_gaps_go_through_windows(spark, tmp_path, days, known):
    wide = base_rows(spark)
    flows_ = wide.drop("gdp", "morningstar_category_grouped")
    flows_ = flows_.withColumn("sale_amount", F.col("investment_vehicle_id").cast("decimal(18,2)"))
    if known:
        flows_ = flows_.fillna(0, ["redemption_amount"]).withColumn("redemption_amount", F.col("redemption_amount").cast("decimal(18,2)"))
    months = [(m, 1.0 * m, None if m % 3 else m + d / 2) for m in (*range(201701, 201712), *range(201801, 201813)) for d in range(days)]
    macro = spark.createDataFrame(months, "month_number int, Sentiment double, GDP double")
    returns = spark.createDataFrame(
        [(m, "T", "x", m / 7) for m in (*range(201701, 201713), *range(201802, 201813))],
        "month_number int, ticker_symbol string, morningstar_category_grouped string, return_1_month double",
    )
    parts = [saved(df, tmp_path / n) for n, df in (("flows", flows_), ("macro", macro), ("returns", returns))]
    table = base.base_table(*parts)
    for got, expected in (
        (base.filled_table(*parts), base.filled_base(table)),
        (base.features_table(*parts), base.base_features(table)),
    ):
        assert got.columns == expected.columns and rows(got) == rows(expected) != []
        text = plan(got)
        for column, gaps in {"GDP": True, "redemption_amount": not known, "sale_amount": False, "Sentiment": False, "return_1_month": False}.items():
            assert (f"last(_high_{column}" in text) == gaps
        # Where a month has one row, indicators without gaps are joined behind the windows.
        assert any("Window" in n for n in max(ancestors(text, "Sentiment"), key=len)) == (days > 1)


def test_columns_with_gaps(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 3, None), (3, 4, "z")], "a int, b int, c string")
    assert base.columns_with_gaps(df, ["a", "b", "c"]) == ["b", "c"]
    assert base.columns_with_gaps(df, []) == base.columns_with_gaps(df.where("a > 9"), ["a", "b"]) == []


def test_tasks_follow_the_files_read(spark, tmp_path):
    files = saved(spark.range(1000).withColumn("k", F.col("id") % 7), tmp_path / "read")
    size = sum(f.stat().st_size for f in (tmp_path / "read").glob("*.parquet"))
    for parts in (1, 3, 40):
        dealt = settle.dealt(files.groupBy("k").count(), ["k"], files, -(-size // parts))
        assert dealt.rdd.getNumPartitions() == parts
    assert "REPARTITION_BY_COL" in plan(settle.dealt(files, ["k"], spark.createDataFrame([(1,)], "x int"), 1))
