"""Money in motion: outflows of a group matched with its inflows across classes, to the smallest unit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.sources.settle import dealt

# Two of these have a product that decimals still hold.
UNITS = "decimal(19,0)"
UNKNOWN = "unknown"
READ_BYTES = 4 * 1024 * 1024  # of the files read, for each task that splits groups


def _product(a: Column, b: Column) -> Column:
    return a.cast(UNITS) * b.cast(UNITS)


def _share(df: DataFrame, value: str, total: str, moved: str, keys: Sequence[str], name: str) -> DataFrame:
    """Split ``moved`` in proportion to ``value`` in whole units, the units left over by the largest remainder."""
    group = W.partitionBy(*keys)
    df = df.withColumns({"_p": _product(F.col(value), F.col(moved)), "_t": F.nullif(F.col(total), F.lit(0)).cast(UNITS)})
    df = df.withColumns({"_floor": F.coalesce(F.expr("_p div _t"), F.lit(0)), "_rest": F.coalesce(F.col("_p") % F.col("_t"), F.lit(0))})
    place = F.row_number().over(group.orderBy(F.col("_rest").desc(), "_class"))
    over = F.col(moved) - F.sum("_floor").over(group)
    return df.withColumn(name, F.col("_floor") + F.when(place <= over, 1).otherwise(0)).drop("_p", "_t", "_floor", "_rest")


def money_in_motion(
    rows: DataFrame,
    keys: Sequence[str],
    asset_class: str,
    inflow: Column,
    outflow: Column,
    *,
    scale: int = 2,
    amount: str = "amount",
) -> DataFrame:
    """Amounts that moved from one class to another within each group of ``keys``.

    The smaller of a group's total outflow and inflow has moved. It is split over the classes left in proportion to their
    outflows and over those entered in proportion to their inflows, each by the largest remainder, and a pair of classes gets the
    product of both shares. Units that rounding leaves over are dealt in the order of the classes, so that all
    sums hold exactly: what leaves a class is its outflow, what enters one its inflow. The rest has a NULL class: ``to_class`` for money that
    left the group, ``from_class`` for new money.

    Amounts below zero count on the other side, NULL as nothing; a NULL class is ``UNKNOWN``; NULL keys are a group.
    Rows are summed by group and class before they move. All that follows is one shuffle by ``keys`` of
    a row per group and class; classes are a short list, so their pairs are as well. Each task sorts its rows several
    times, so their number follows the files read.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    found = rows.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        F.coalesce(F.col(asset_class).cast("string"), F.lit(UNKNOWN)).alias("_class"),
        *[F.coalesce(v, F.lit(0)).cast(f"decimal(28,{scale})").alias(n) for v, n in ((inflow, "_in"), (outflow, "_out"))],
    )
    sums = found.groupBy(*names, "_class").agg(F.sum("_in").alias("_in"), F.sum("_out").alias("_out"))
    sums = dealt(sums, names, rows, READ_BYTES)

    def units(here: str, there: str) -> Column:
        total = F.greatest(F.col(here), F.lit(0)) + F.greatest(-F.col(there), F.lit(0))
        return (total * 10**scale).cast("bigint")

    group = W.partitionBy(*names)
    sides = sums.select(*names, "_class", units("_in", "_out").alias("into"), units("_out", "_in").alias("out"))
    sides = sides.withColumns({"_into": F.sum("into").over(group), "_all": F.sum("out").over(group)})
    sides = sides.withColumn("_moved", F.least("_into", "_all"))
    sides = _share(sides, "out", "_all", "_moved", names, "gone")
    sides = _share(sides, "into", "_into", "_moved", names, "come")

    listed = sides.groupBy(*names, "_moved").agg(F.collect_list(F.struct("_class", "into", "out", "gone", "come")).alias("_c"))
    none = F.lit(None)

    def cell(origin: Column, goal: Column, gone: Column, come: Column, rest: Column) -> Column:
        kinds = (("from_class", origin, "string"), ("to_class", goal, "string"), ("gone", gone, "bigint"))
        kinds += (("come", come, "bigint"), ("rest", rest, "bigint"))
        return F.struct(*[c.cast(kind).alias(n) for n, c, kind in kinds])

    leaving, entering = F.filter("_c", lambda c: c["gone"] > 0), F.filter("_c", lambda c: c["come"] > 0)
    pairs = F.flatten(
        F.transform(
            leaving, lambda a: F.transform(entering, lambda b: cell(a["_class"], b["_class"], a["gone"], b["come"], none))
        )
    )
    left = F.transform(
        F.filter("_c", lambda c: c["out"] > c["gone"]),
        lambda c: cell(c["_class"], none, none, none, c["out"] - c["gone"]),
    )
    new = F.transform(
        F.filter("_c", lambda c: c["into"] > c["come"]),
        lambda c: cell(none, c["_class"], none, none, c["into"] - c["come"]),
    )
    cells = listed.select(*names, "_moved", F.explode(F.concat(pairs, left, new)).alias("cell")).select(*names, "_moved", "cell.*")

    # Units short of a row's and a column's total lie on two equal lines; a pair gets what its stretches share.
    row, column = W.partitionBy(*names, "from_class"), W.partitionBy(*names, "to_class")
    cells = cells.withColumns({"_p": _product(F.col("gone"), F.col("come")), "_t": F.nullif(F.col("_moved"), F.lit(0)).cast(UNITS)})
    cells = cells.withColumn("part", F.expr("_p div _t"))
    cells = cells.withColumn("short", F.col("gone") - F.sum("part").over(row))
    cells = cells.withColumn("lack", F.col("come") - F.sum("part").over(column))
    cells = cells.withColumn("short_to", F.sum("short").over(column.orderBy("from_class")))
    cells = cells.withColumn("lack_to", F.sum("lack").over(row.orderBy("to_class")))
    shared = F.least("short_to", "lack_to") - F.greatest(F.col("short_to") - F.col("short"), F.col("lack_to") - F.col("lack"))
    total = F.coalesce("rest", F.col("part") + F.greatest(shared, F.lit(0)))
    return cells.where(total > 0).select(
        *[F.col(n).alias(k) for k, n in zip(keys, names)],
        "from_class",
        "to_class",
        (total.cast(UNITS) / 10**scale).cast(f"decimal(28,{scale})").alias(amount),
    )
