"""Ordered writes: positions, hot keys, NULLs, and a proof that notices what is wrong."""

import random

import pytest
from flowtide.sources import ordered, settle
from pyspark.sql import functions as F

from tests.helpers import plan


def written(df, path, *args, **options):
    with settle.settled_scope(df.sparkSession):
        ordered.write_ordered(df, path, *args, **options)
    return ordered.read_ordered(df.sparkSession, path, df.schema)


def breaks(rows, *args):
    return sum(r["breaks"] for r in ordered.order_proof(rows, *args).collect())


def test_positions_equal_a_sorted_list_even_with_a_hot_key(spark, tmp_path):
    draw = random.Random(5)
    values = [(draw.choice([7, 7, 7, None, draw.randrange(50)]), draw.choice("abc"), i % 90) for i in range(600)]
    df = spark.createDataFrame(values + values[:40], "k int, t string, n int").repartition(5)
    rows = written(df, str(tmp_path / "up"), ["k"], parts=6)
    expected = sorted(values + values[:40], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    got = sorted(rows.collect(), key=lambda r: r["position"])
    assert [(r["k"], r["t"], r["n"]) for r in got] == expected
    assert [r["position"] for r in got] == list(range(1, len(expected) + 1))
    assert len({r["order_range"] for r in got if r["k"] == 7}) > 1
    assert breaks(rows, ["k"]) == 0 and breaks(rows, ["k", "t"]) == 0

    moved = rows.withColumn("k", F.when(F.col("position") == 300, 1000).otherwise(F.col("k")))
    assert breaks(moved, ["k"]) == 1
    assert breaks(rows.where("position <> 300"), ["k"]) == 1
    assert breaks(rows.where("position > 1"), ["k"]) == 1


def test_descending_order_puts_nulls_last(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (None, "a"), (3, "b"), (3, "a")], "k int, t string")
    rows = written(df, str(tmp_path / "down"), ["k", "t"], ["k"], parts=3)
    got = [(r["k"], r["t"]) for r in sorted(rows.collect(), key=lambda r: r["position"])]
    assert got == [(3, "a"), (3, "b"), (1, "x"), (None, "a")]
    assert breaks(rows, ["k", "t"], ["k"]) == 0 and breaks(rows, ["k"]) > 0


def test_empty_tables_and_refused_columns(spark, tmp_path):
    none = spark.createDataFrame([], "k int, m map<string,int>")
    assert written(none, str(tmp_path / "none"), ["k"]).count() == 0
    with pytest.raises(ValueError, match="position"):
        ordered.write_ordered(spark.range(3).withColumn("Position", F.lit(1)), str(tmp_path / "x"), ["id"])
    with pytest.raises(ValueError, match="no such"):
        ordered.write_ordered(spark.range(3), str(tmp_path / "x"), ["other"])


def test_reading_some_positions_is_pushed_to_the_scan(spark, tmp_path):
    rows = written(spark.range(50), str(tmp_path / "ids"), ["id"], parts=2)
    assert "GreaterThan(position,10)" in plan(rows.where("position > 10").select("id"))
