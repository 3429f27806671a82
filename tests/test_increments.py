"""Snapshots refreshed by partition, and tables that are switched in one step."""

import os

import pytest
from flowtide.sources import increments, tables
from pyspark.sql import functions as F

from tests.helpers import rows


@pytest.fixture
def flows(spark):
    data = [(2019, "a", 1), (2019, "b", 2), (2020, "a", 3), (2021, "a'/=%", 4), (None, "z", 5)]
    return spark.createDataFrame(data, "year int, fund string, amount int")


def folders(path):
    return {n for n in os.listdir(path) if n.startswith("version-")}


def test_only_changed_partitions_are_written(spark, flows, tmp_path):
    path = str(tmp_path / "s")
    assert len(increments.refresh_snapshot(flows, path, "year")) == 4
    files = set(increments.read_snapshot(spark, path).inputFiles())
    assert increments.refresh_snapshot(flows.orderBy(F.desc("amount")).repartition(3), path, "year") == []
    changed = flows.withColumn("amount", F.when(F.col("year") == 2020, 30).otherwise(F.col("amount")))
    assert increments.refresh_snapshot(changed, path, "year") == ["2020".encode().hex().upper()]
    now = increments.read_snapshot(spark, path)
    assert rows(now) == rows(changed) and len(set(now.inputFiles()) & files) == len(files) - 1
    assert rows(increments.read_snapshot(spark, path, number=1)) == rows(flows)
    assert rows(increments.read_snapshot(spark, path, only=[2020, None])) == rows(changed.where("year = 2020 OR year IS NULL"))


def test_repeated_rows_new_gone_and_empty_partitions(spark, flows, tmp_path):
    path = str(tmp_path / "s")
    increments.refresh_snapshot(flows, path, "fund")
    steps = [flows.union(flows.where("fund = 'b'")), flows.where("fund <> 'b'"), flows.where("false"), flows]
    for step in steps:
        increments.refresh_snapshot(step, path, "fund")
        assert rows(increments.read_snapshot(spark, path)) == rows(step)
    increments.refresh_snapshot(increments.read_snapshot(spark, path).where("amount > 2"), path, "fund")
    assert rows(increments.read_snapshot(spark, path)) == rows(flows.where("amount > 2"))


def test_a_changed_schema_is_written_whole(spark, flows, tmp_path):
    path = str(tmp_path / "s")
    increments.refresh_snapshot(flows, path, "year")
    wider = flows.withColumn("amount", F.col("amount").cast("bigint")).withColumn("more", F.lit("x"))
    assert len(increments.refresh_snapshot(wider, path, "year")) == 4
    assert rows(increments.read_snapshot(spark, path)) == rows(wider)


def test_a_failed_refresh_and_a_second_writer_change_nothing(spark, flows, tmp_path):
    path = str(tmp_path / "s")
    increments.refresh_snapshot(flows, path, "year")
    broken = flows.withColumn("amount", F.when(F.col("year") == 2020, F.raise_error(F.lit("no"))).otherwise(F.col("amount")))
    with pytest.raises(Exception, match="no"):
        increments.refresh_snapshot(broken, path, "year")
    with pytest.raises(RuntimeError, match="another writer"):
        increments._write_pointer(spark, path, 1, {})
    assert rows(increments.read_snapshot(spark, path)) == rows(flows)


def test_old_snapshots_stay_for_a_stated_time(spark, flows, tmp_path):
    path = str(tmp_path / "s")
    for n in range(3):
        increments.refresh_snapshot(flows.withColumn("amount", F.when(F.col("year") == 2019, n).otherwise(F.col("amount"))), path, "year")
    begun = increments.read_snapshot(spark, path, number=2)
    assert increments.clean_snapshots(spark, path, 3600) == 0 and begun.count() == 5
    assert increments.clean_snapshots(spark, path, -1) == 2
    with pytest.raises(ValueError):
        increments.read_snapshot(spark, path, number=2)
    assert increments.read_snapshot(spark, path).where("year = 2019").agg(F.max("amount")).first()[0] == 2
    assert increments.read_snapshot(spark, path).count() == 5


def test_build_is_not_called_without_refresh(spark, flows, tmp_path):
    path = str(tmp_path / "s")
    increments.incremental_snapshot(spark, path, lambda: flows, True, "year")
    assert rows(increments.incremental_snapshot(spark, path, lambda: 1 / 0, False, "year")) == rows(flows)
    with pytest.raises(ValueError):
        increments.read_snapshot(spark, str(tmp_path / "none"))


def test_an_overwritten_table_exists_throughout_and_its_readers_finish(spark, tmp_path):
    tables.ensure_database(spark, "flow_store")
    name, path = "flow_store.switched", str(tmp_path / "t")
    tables.overwrite_table(spark.range(3), name, path=path)
    begun = spark.read.parquet(*spark.table(name).inputFiles())
    dropped = []
    real = spark.sql
    spark.sql = lambda text, *a, **k: (dropped.append(text) if text.startswith("DROP") else None, real(text, *a, **k))[1]
    try:
        tables.overwrite_table(spark.range(3, 5), name, path=path)
    finally:
        del spark.sql
    assert not dropped and rows(spark.table(name)) == [(3,), (4,)] and begun.count() == 3
    tables.overwrite_table(spark.range(9, 10), name, path=path)
    assert rows(spark.table(name)) == [(9,)] and len(folders(path)) == 2
    tables.drop_table(spark, name)
    assert not folders(path)
