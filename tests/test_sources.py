"""Readers, saved tables, views and settled tables."""

import os

import pytest
from flowtide.functions import fixed_values as V
from flowtide.operators import lookups
from flowtide.plans import macro
from flowtide.sources import readers, settle, tables
from pyspark.sql import functions as F

from tests.helpers import plan, rows


@pytest.mark.parametrize(
    "path, name",
    [
        ("/data/House Pricing-Index.csv", "house_pricing_index"),
        ("file:/data/TED Spread.csv/", "ted_spread"),
        ("XCSV data.csv", "xcsv_data"),
        ("a.csv.csv", "a.csv"),
    ],
)
def test_series_name(path, name):
    assert readers.series_name(path) == name


def test_series_folder(spark, tmp_path):
    folder = tmp_path / "macro data"
    folder.mkdir()
    (folder / "House Pricing-Index.csv").write_text("AsOfDate,House Price Index\n01-31-2020,1.5\n")
    (folder / "GDP.csv").write_text("AsOfDate,GDP\n01-31-2020,.\n")
    (folder / "notes.txt").write_text("not a series")
    spark.createDataFrame([("01-31-2020", "7")], ["AsOfDate", "Oil"]).write.option(
        "header", True
    ).csv(str(folder / "Oil-Price.csv"))
    series = readers.read_series_dir(spark, str(folder))
    assert sorted(series) == ["gdp", "house_pricing_index", "oil_price"]
    assert all(t == "string" for df in series.values() for _, t in df.dtypes)
    assert rows(series["oil_price"]) == [("01-31-2020", "7")]
    table = macro.macro_monthly(series, ["house_pricing_index", "gdp", "oil_price"])
    assert table.columns == ["month_number", "House_Price_Index", "GDP", "Oil"]
    assert rows(table) == [(202001, 1.5, None, 7.0)]


def test_series_with_schema(spark, tmp_path):
    (tmp_path / "x.csv").write_text("AsOfDate,GDP\n01-31-2020,2\n")
    df = readers.read_series(spark, str(tmp_path / "x.csv"), "AsOfDate string, GDP double")
    assert rows(df) == [("01-31-2020", 2.0)]


def test_macro_rows_per_month(spark):
    def one(name, *data):
        return spark.createDataFrame(list(data), f"AsOfDate string, {name} string")

    series = {
        "a": one("A", ("01-02-2020", "1"), ("01-03-2020", "2"), ("02-03-2020", "x"), ("bad", "4")),
        "b": one("B", ("01-02-2020", "5"), ("03-01-2020", "6")),
    }
    every = macro.macro_monthly(series, ["a", "b"])
    assert rows(every) == [(None, 4.0, None), (202001, 1.0, 5.0), (202001, 2.0, None), (202002, None, None)]
    last = macro.macro_monthly(series, ["a", "b"], last_of_month=True)
    assert (202001, 2.0, 5.0) in rows(last)
    assert every.dtypes == last.dtypes


def test_macro_default_order_needs_all_series():
    with pytest.raises(KeyError):
        macro.macro_monthly({V.MACRO_SERIES[0]: None})


def test_jdbc_arguments():
    full = readers.jdbc_arguments(
        "jdbc:x", "t", column="id", bounds=(100000, 400000), num_partitions=10, properties={"user": "u"}
    )
    assert full == {
        "url": "jdbc:x", "table": "t", "properties": {"user": "u"}, "column": "id",
        "lowerBound": 100000, "upperBound": 400000, "numPartitions": 10,
    }
    assert readers.jdbc_arguments("jdbc:x", "t") == {"url": "jdbc:x", "table": "t", "properties": {}}


@pytest.mark.parametrize(
    "part", [{"bounds": (1, 2), "num_partitions": 3}, {"column": "id"}, {"num_partitions": 10}]
)
def test_jdbc_split_must_be_complete(part):
    with pytest.raises(ValueError):
        readers.jdbc_arguments("jdbc:x", "t", **part)


def test_snapshot_reuses_until_refreshed(spark):
    tables.ensure_database(spark, "flow_store")
    name = "flow_store.numbers"
    calls = []

    def build(df):
        def make():
            calls.append(1)
            return df

        return make

    first = spark.createDataFrame([(1,)], "x int")
    second = spark.createDataFrame([("a", 2.0)], "y string, z double")
    assert rows(tables.snapshot(spark, name, build(first), refresh=True)) == [(1,)]
    assert rows(tables.snapshot(spark, name, build(second), refresh=False)) == [(1,)]
    assert len(calls) == 1
    replaced = tables.snapshot(spark, name, build(second), refresh=True)
    assert replaced.columns == ["y", "z"] and rows(replaced) == [("a", 2.0)]


def test_snapshot_partitions_prune(spark, tmp_path):
    tables.ensure_database(spark, "flow_store")
    df = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("month_number"))
    saved = tables.snapshot(
        spark, "flow_store.by_month", lambda: df, True,
        path=str(tmp_path / "by_month"), partition_by=["month_number"],
    )
    one = saved.where("month_number = 1")
    assert one.count() == 25 and len(one.select("id").inputFiles()) <= len(saved.inputFiles())
    assert "PartitionFilters: [isnotnull(month_number" in plan(one)


def test_views(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    assert rows(tables.register_view(df, "some_rows")) == [(1, 2), (1, 3)]
    view = tables.view_from_sql(spark, "some_sums", "SELECT k, sum(v) AS v FROM some_rows GROUP BY k")
    assert rows(view) == [(1, 5)]
    again = tables.view_from_sql(spark, "some_sums", "SELECT max(v) AS v FROM some_rows")
    assert rows(again) == [(3,)]


def test_settled_rows_come_from_the_named_folder_and_go(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert settle.shared_folder(spark) == folder
    with settle.settled_scope(spark):
        df = settle.settle(spark.range(5).select("id", F.array("id").alias("a")))
        files = df.inputFiles()
        assert all(folder in f for f in files) and rows(df) == [(i, [i]) for i in range(5)]
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_sizes_are_measured_once_without_rows_on_the_driver(spark):
    lookup = spark.range(3000).select("id", F.array_repeat(F.lit("x" * 100), 300).alias("many"))
    assert settle.measured_bytes(lookup) > 3000 * 300 * 100
    assert not settle.fits_broadcast(lookup) and settle.fits_broadcast(spark.range(1000))
    settle._measured[lookup] = 1
    assert settle.fits_broadcast(lookup)


def test_failed_rebuild_keeps_the_old_rows(spark):
    tables.ensure_database(spark, "flow_store")
    name = "flow_store.survivor"
    tables.snapshot(spark, name, lambda: spark.range(3), refresh=True)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.snapshot(spark, name, lambda: broken, refresh=True)
    assert rows(spark.table(name)) == [(0,), (1,), (2,)]
    own = tables.snapshot(spark, name, lambda: spark.table(name).where("id > 0"), refresh=True)
    assert rows(own) == [(1,), (2,)]
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_no_series_is_lost(spark, tmp_path):
    top = tmp_path / "data"
    (top / "data").mkdir(parents=True)
    (top / "GDP.CSV").write_text("AsOfDate,GDP\n01-31-2020,1\n")
    (top / "data" / "data.csv").write_text("AsOfDate,x\n01-31-2020,1\n")
    assert set(readers.read_series_dir(spark, str(top))) == {"gdp", "data"}
    (top / "A B.csv").write_text("AsOfDate,x\n")
    (top / "a-b.csv").write_text("AsOfDate,x\n")
    with pytest.raises(ValueError, match="one name"):
        readers.read_series_dir(spark, str(top))


class FakeReader:
    def __init__(self):
        self.given = None

    def jdbc(self, **arguments):
        self.given = arguments
        return "rows"


def test_read_jdbc_passes_the_split_on():
    class Session:
        read = FakeReader()

    rows_of = readers.read_jdbc(
        Session, "jdbc:x", "t", column="id", bounds=(1, 9), num_partitions=4
    )
    assert rows_of == "rows"
    assert Session.read.given["numPartitions"] == 4 and Session.read.given["column"] == "id"


def jobs_of(spark, group, work):
    context = spark.sparkContext
    context.setJobGroup(group, group)
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(group))


def test_a_lookup_that_is_a_query_runs_once(spark, tmp_path):
    """Its own work is counted: every run of the lookup calls the accumulating function once a row."""
    calls = spark.sparkContext.accumulator(0)

    def seen(value):
        calls.add(1)
        return value

    mark = F.udf(seen, "bigint")
    grouped = spark.range(6).groupBy((F.col("id") % 3).alias("id")).agg(F.count("*").alias("n"))
    lookup = grouped.select("id", mark("n").alias("n"))
    with settle.settled_scope(spark):
        assert rows(lookups.lookup_join(spark.range(4), lookup, "id")) == [(0, 2), (1, 2), (2, 2)]
        assert calls.value == 3


def test_plain_reads_are_not_settled_again(spark, tmp_path):
    path = str(tmp_path / "stored")
    spark.range(9).withColumn("n", F.col("id") * 2).write.parquet(path)
    stored = spark.read.schema("id bigint, n bigint").parquet(path)
    plain = stored.where("id > 3").select("n")
    assert settle.read_once(plain) is plain and settle.read_once(stored) is stored
    with settle.settled_scope(spark):
        assert settle.read_once(stored.distinct()).inputFiles() != stored.inputFiles()
    nothing = stored.distinct().withColumn("none", F.lit(None))
    assert settle.read_once(nothing) is nothing  # a column that parquet can't hold
    assert jobs_of(spark, "plain", lambda: settle.read_once(plain)) == 0
