"""Money in motion: exact totals, proportions, odd amounts."""

import random
from collections import defaultdict
from decimal import Decimal

from flowtide.operators import motion
from pyspark.sql import functions as F

from tests.helpers import plan, rows

SCHEMA = "plan string, class string, came decimal(18,2), went decimal(18,2)"


def moved(spark, data, keys=("plan",)):
    df = spark.createDataFrame([(p, c, came and Decimal(came), went and Decimal(went)) for p, c, came, went in data], SCHEMA)
    return motion.money_in_motion(df, list(keys), "class", F.col("came"), F.col("went"))


def test_proportions_and_rest(spark):
    got = rows(moved(spark, [("p", "a", "0", "30"), ("p", "b", "0", "60"), ("p", "c", "20", "0"), ("p", "d", "10", "0")]))
    assert got == rows_of([("p", "a", None, 20), ("p", "a", "c", "6.67"), ("p", "a", "d", "3.33"),
                           ("p", "b", None, 40), ("p", "b", "c", "13.33"), ("p", "b", "d", "6.67")])


def rows_of(data):
    found = [(p, a, b, Decimal(str(v)).quantize(Decimal("0.01"))) for p, a, b, v in data]
    return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r])


def test_new_money_and_one_sided_groups(spark):
    got = rows(moved(spark, [("p", "a", "5", "0"), ("q", "a", "0", "7"), ("r", "a", "3", "2"), ("s", "a", "0", "0")]))
    assert got == rows_of([("p", None, "a", 5), ("q", "a", None, 7), ("r", "a", "a", 2), ("r", None, "a", 1)])


def test_odd_amounts(spark):
    data = [(None, None, "-4", None), (None, "b", None, "-4"), (None, "b", "1", "1"), (None, "b", "-1", "-1")]
    assert rows(moved(spark, data)) == rows_of([(None, "unknown", "b", 4)])
    assert rows(moved(spark, [])) == []


def test_totals_hold_to_the_cent(spark):
    rng = random.Random(4)
    data = [
        (f"p{rng.randrange(12)}", f"c{rng.randrange(7)}", str(rng.choice([0, 1, 99, 12345, 10**9 + 7]) / 100),
         str(rng.choice([0, 2, 101, 777, 10**9 + 9]) / 100))
        for _ in range(300)
    ]
    came, went = defaultdict(Decimal), defaultdict(Decimal)
    for p, c, a, b in data:
        came[p, c] += Decimal(a)
        went[p, c] += Decimal(b)
    into, out, cells = defaultdict(Decimal), defaultdict(Decimal), {}
    for p, a, b, v in rows(moved(spark, data)):
        assert v > 0 and (a is not None or b is not None)
        out[p, a] += v
        into[p, b] += v
        cells[p, a, b] = v
    for p, c in {**came, **went}:
        assert out[p, c] == went[p, c] and into[p, c] == came[p, c]
    for (p, a, b), v in cells.items():
        if a and b:
            all_in, all_out = (sum(v for (q, _), v in side.items() if q == p) for side in (came, went))
            fair = went[p, a] * came[p, b] / max(all_in, all_out)
            assert abs(v - fair) <= Decimal("0.08")  # a unit per class at most


def test_one_shuffle_after_the_sums(spark):
    assert plan(moved(spark, [("p", "a", "1", "1")])).count("Exchange hashpartitioning") == 2
