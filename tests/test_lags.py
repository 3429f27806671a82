"""Lagged columns and correlations against brute force."""

import random

import pytest
from flowtide.operators import lags
from pyspark.sql import functions as F

from tests.helpers import rows


def test_calendar_crosses_year_ends(spark):
    df = spark.createDataFrame([("a", 202011), ("a", 202102), ("b", 202112), ("b", None), (None, None)], "k string, m int")
    assert rows(lags.calendar(df, "m", ["k"], extra=1)) == [
        ("a", 202011), ("a", 202012), ("a", 202101), ("a", 202102), ("a", 202103), ("b", 202112), ("b", 202201),
    ]


def test_lags_count_months_not_rows(spark):
    rng = random.Random(1)
    months = [y * 100 + m for y in (2019, 2020, 2021) for m in range(1, 13)]
    data = {(k, m): rng.choice([None, rng.randrange(100)]) for k in ("a", None) for m in rng.sample(months, 25)}
    df = spark.createDataFrame([(k, m, v) for (k, m), v in data.items()], "k string, m int, v int")
    place = {m: i for i, m in enumerate(months)}
    earlier = lambda m, n: months[place[m] - n] if place[m] >= n else None
    got = lags.lagged(df, "m", ["v"], [1, 12], by=["k"]).collect()
    assert {(r["k"], r["m"]): (r["v"], r["v_lag_1"], r["v_lag_12"]) for r in got} == {
        (k, m): (v, data.get((k, earlier(m, 1))), data.get((k, earlier(m, 12)))) for (k, m), v in data.items()
    }
    spine = lags.calendar(df, "m", ["k"])
    on_calendar = {(r["k"], r["m"]): r["v_lag_1"] for r in lags.lagged(df, "m", ["v"], [1], by=["k"], spine=spine).collect()}
    assert on_calendar == {key: data.get((key[0], earlier(key[1], 1))) for key in on_calendar} and len(on_calendar) > len(data)


def test_correlations_leave_unknown_pairs_out(spark):
    rng = random.Random(7)
    data = [(rng.choice([None, rng.random()]), rng.choice([None, 0.0, 1.0]), 1.0) for _ in range(200)]
    df = spark.createDataFrame(data, "x double, y double, z double")
    got = {r["indicator"]: r for r in lags.correlations(df, "y", {"x": ("x", 3), "z": ("z", 0)}).collect()}
    pairs = [(x, y) for x, y, _ in data if x is not None and y is not None]
    mx, my = (sum(p[i] for p in pairs) / len(pairs) for i in (0, 1))
    up = sum((x - mx) * (y - my) for x, y in pairs)
    down = (sum((x - mx) ** 2 for x, _ in pairs) * sum((y - my) ** 2 for _, y in pairs)) ** 0.5
    assert got["x"]["n_months"] == len(pairs) and got["x"]["lag"] == 3
    assert got["x"]["correlation"] == pytest.approx(up / down)
    assert got["z"]["correlation"] is None
    none = lags.correlations(df.where("false"), "y", {"x": ("x", 3)}).first()
    assert none["n_months"] == 0 and none["correlation"] is None
