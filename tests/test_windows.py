"""Counters, averages, fills and trailing means, with brute-force checks."""

import random
from decimal import Decimal

import pytest
from flowtide.operators import windows
from flowtide.sources import settle as settling
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.helpers import rows

SCHEMA = "k string, m int, v decimal(18,2)"


def frame(spark, data):
    return spark.createDataFrame(
        [(k, m, None if v is None else Decimal(v)) for k, m, v in data], SCHEMA
    )


def by_month(df, column="v"):
    return [r[column] for r in df.orderBy("k", "m").collect()]


GAPS = [("a", 202001 + i, v) for i, v in enumerate([None, 5, None, 7, None])]


@pytest.mark.parametrize("bounded", [True, False])
@pytest.mark.parametrize(
    "operator, expected",
    [
        (windows.forward_fill, [None, 5, 5, 7, 7]),
        (windows.back_fill, [5, 5, 7, 7, None]),
        (windows.running_first, [None, 5, 5, 5, 5]),
        (windows.fill_gaps, [5, 5, 5, 7, 7]),
    ],
)
def test_fills(spark, operator, expected, bounded):
    got = operator(frame(spark, GAPS), ["k"], "m", ["v"], bounded_groups=bounded)
    assert by_month(got) == expected


def test_fills_treat_null_keys_as_a_group(spark):
    data = [(None, 202001, 5), (None, 202002, None), ("a", 202002, None)]
    for bounded in (True, False):
        got = windows.forward_fill(frame(spark, data), ["k"], "m", ["v"], bounded_groups=bounded)
        assert by_month(got) == [5, 5, None]


def test_peers_share_their_month(spark):
    data = [("a", 202001, None), ("a", 202001, 3), ("a", 202001, 4), ("a", 202002, None)]
    df = frame(spark, data)
    assert rows(windows.forward_fill(df, ["k"], "m", ["v"])) == [
        ("a", 202001, 3), ("a", 202001, 4), ("a", 202001, 4), ("a", 202002, 4),
    ]
    assert [r[2] for r in rows(windows.running_first(df, ["k"], "m", ["v"]))] == [3, 3, 3, 3]


def test_fill_gaps_equals_both_steps_with_peers(spark):
    rng = random.Random(5)
    data = [
        (rng.choice("ab"), 202001 + rng.randrange(8), rng.choice([None, None, rng.randrange(9)]))
        for _ in range(60)
    ]
    df = frame(spark, data)
    steps = windows.back_fill(windows.forward_fill(df, ["k"], "m", ["v"]), ["k"], "m", ["v"])
    assert rows(windows.fill_gaps(df, ["k"], "m", ["v"])) == rows(steps)


MONTHS = [202008, 202009, 202010, 202011, 202012, 202101, 202102]


@pytest.mark.parametrize("bounded", [True, False])
@pytest.mark.parametrize(
    "mode, expected",
    [
        ("month_index", [None, 0, 0.5, 1, 2, 3, 4]),
        ("literal", [None, 0, 0.5, 1, 1.5, None, 5]),
    ],
)
def test_trailing(spark, mode, expected, bounded):
    df = frame(spark, [("a", m, i) for i, m in enumerate(MONTHS)])
    got = windows.trailing_avg(df, "v", ["k"], "m", [3], mode=mode, bounded_groups=bounded)
    assert by_month(got, "avg_v_lag_3_months") == expected


def test_trailing_mode_is_checked(spark):
    with pytest.raises(ValueError):
        windows.trailing_avg(frame(spark, GAPS), "v", ["k"], "m", mode="other")


def index(m):
    return m // 100 * 12 + m % 100


def brute_trailing(data, p):
    result = []
    for k, m, v in data:
        past = [
            x for j, n, x in data if j == k and x is not None and 1 <= index(m) - index(n) <= p
        ]
        result.append((k, m, v, float(sum(past)) / len(past) if past else None))
    return result


SHARED = [HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
ROWS = st.lists(
    st.tuples(
        st.sampled_from(["hot", "hot", "hot", "x", None]),
        st.sampled_from([201911, 201912, 202001, 202002, 202006]),
        st.one_of(st.none(), st.integers(-50, 50)),
    ),
    min_size=1,
    max_size=30,
)


@settings(max_examples=8, deadline=None, suppress_health_check=SHARED)
@given(data=ROWS)
def test_trailing_against_brute_force(spark, data):
    expected = sorted(map(str, brute_trailing(data, 3)))
    for bounded in (True, False):
        got = windows.trailing_avg(
            frame(spark, data), "v", ["k"], "m", [3], bounded_groups=bounded
        ).collect()
        plain = [
            (r.k, r.m, None if r.v is None else int(r.v), r.avg_v_lag_3_months) for r in got
        ]
        assert sorted(map(str, plain)) == expected


@settings(max_examples=8, deadline=None, suppress_health_check=SHARED)
@given(data=ROWS)
def test_fill_properties(spark, data):
    df = frame(spark, data)
    known = {k for k, _, v in data if v is not None}
    filled = windows.fill_gaps(df, ["k"], "m", ["v"]).collect()
    assert len(filled) == len(data)
    assert {r.k for r in filled if r.v is None}.isdisjoint(known)
    before = sorted(str(v) for _, _, v in data if v is not None)
    after = [str(int(r.v)) for r in filled if r.v is not None]
    for value in before:
        after.remove(value)


def test_counter_is_a_dense_rank(spark):
    months = [202112, 201701, 201702, 201701, 199912, None, 20219900, 0, -5]
    df = spark.createDataFrame([(m,) for m in months], "m int")
    ordered = sorted(set(months), key=lambda m: (m is not None, m or 0))
    got = {r.m: r.month_counter for r in windows.month_counter(df, "m").collect()}
    assert got == {m: i + 1 for i, m in enumerate(ordered)}
    assert windows.month_counter(df, "m").count() == len(months)


def test_counter_by_shuffle_join_gives_the_same(spark, monkeypatch):
    df = spark.createDataFrame([(201701 + i % 9, i) for i in range(200)], "m int, i int")
    small = rows(windows.month_counter(df, "m"))
    monkeypatch.setattr(windows, "fits_broadcast", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(windows.month_counter(df, "m")) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_moving_average_of_one_is_the_value(spark):
    df = frame(spark, [("a", 202001 + i, i * i) for i in range(6)])
    got = windows.moving_averages(df, "v", ["k"], "m", [1, 3])
    assert by_month(got, "moving_average_1") == by_month(df)
    assert by_month(got, "moving_average_3")[3] == (1 + 4 + 9) / 3


def test_labels(spark):
    values = ["0.10", "0.10", "0.10", "0.20", "0.15"]
    df = frame(spark, [("a", 202001 + i, v) for i, v in enumerate(values)])
    got = windows.anomaly_labels(df, "v", ["k"], "m")
    assert by_month(got, "period_anomaly_type") == [
        "Normal", "Normal", "Normal", "Strong Anomaly", "Medium Anomaly",
    ]


def test_size_check_counts_text(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "t string, n int")
    assert settling.measured_bytes(df) == 4 * settling.FIXED_COLUMN_BYTES + 3
    assert settling.fits_broadcast(df, 67) and not settling.fits_broadcast(df, 66)
    assert settling.measured_bytes(df.where("n > 5")) == 0
