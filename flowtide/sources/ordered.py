"""Tables written in an order, with the position of every row, and a proof of that order.

Rows are cut into ranges of the order, each range is sorted in its own task, and a row's position is its place in the range behind
the sizes of the ranges before it. No task holds more than a range, and the rows are shuffled once. Ranges are cut by the
whole row, the wanted order first, so that a key that holds a third of all rows is spread over many of them.

Defined results: NULLs come first, last where a column descends; of rows with equal keys the other columns decide, in the table's order, and
rows that are equal throughout have neighbouring positions; an empty table has no ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, MapType, StructField, StructType, VariantType

from flowtide.sources.settle import checked_broadcast, settle

POSITION = "position"
RANGE = "order_range"
ROW_BITS = 33  # of a row's number within its task, in the numbers that Spark gives


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def whole_order(df: DataFrame, order: Sequence[str], descending: Sequence[str] = ()) -> list[Column]:
    """The wanted order, then all other columns that have one."""
    unknown = [c for c in (*order, *descending) if c not in df.columns]
    if unknown or not set(descending) <= set(order):
        raise ValueError(f"no such columns to order by: {unknown or descending}")
    rest = [f.name for f in df.schema.fields if f.name not in order and _orderable(f.dataType)]
    return [F.col(f"`{c}`").desc() if c in descending else F.col(f"`{c}`").asc() for c in (*order, *rest)]


def write_ordered(
    df: DataFrame, path: str, order: Sequence[str], descending: Sequence[str] = (), parts: int | None = None
) -> None:
    """Write the rows to ``path`` with their position from 1, one folder for each range.

    Positions lie close together in a file, so a read of some of them skips the other files.
    """
    taken = {c.lower() for c in df.columns} & {POSITION, RANGE, "_row", "_before"}
    if taken:
        raise ValueError(f"the table has columns of its own named {sorted(taken)}")
    keys = whole_order(df, order, descending)
    ranged = df.repartitionByRange(*keys) if parts is None else df.repartitionByRange(parts, *keys)
    # Settled, so that the numbers don't change when a task is run again.
    rows = settle(ranged.sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id()))
    rows = rows.withColumn(RANGE, F.shiftright("_row", ROW_BITS).cast("int"))
    sizes = rows.groupBy(RANGE).agg(F.count("*").alias("_n"))  # a row for each task of the write
    before = F.sum("_n").over(W.orderBy(RANGE)) - F.col("_n")
    starts = settle(sizes.select(RANGE, before.alias("_before")))
    place = F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    placed = rows.join(checked_broadcast(starts), RANGE).withColumn(POSITION, place)
    placed.select(*[f"`{c}`" for c in df.columns], POSITION, RANGE).write.partitionBy(RANGE).parquet(path)


def read_ordered(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows with their position and range; ``schema`` is that of the table that was written."""
    added = [StructField(POSITION, LongType()), StructField(RANGE, IntegerType())]
    return spark.read.schema(StructType([*schema.fields, *added])).parquet(path)


def order_proof(rows: DataFrame, order: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    """For each range: its rows, first and last position, and ``breaks``, the places where the order or the count of positions fails.

    Rows are compared with their neighbour within a range, and the first row of a range with the last of the range
    before it, so no window is longer than a range or the number of ranges.
    """
    keys = F.struct(*[f"`{c}`" for c in order], POSITION)
    within = W.partitionBy(RANGE).orderBy(POSITION)
    between = W.orderBy(RANGE)

    def broken(before: Column, now: Column) -> Column:
        """Whether a row may not follow the one before it."""
        wrong, tied = F.lit(False), F.lit(True)
        for name in order:
            a, b = before[name], now[name]
            down = name in descending
            # NULLs come first, last where the column descends
            after = (a < b if down else a > b) | ((a.isNull() if down else b.isNull()) & ~a.eqNullSafe(b))
            wrong |= tied & F.coalesce(after, F.lit(False))
            tied &= a.eqNullSafe(b)
        return F.coalesce(before.isNotNull() & (wrong | (before[POSITION] + 1 != now[POSITION])), F.lit(False))

    row = rows.select(RANGE, POSITION, keys.alias("_key"))
    checked = row.withColumn("_broken", broken(F.lag("_key").over(within), F.col("_key")))
    ranges = checked.groupBy(RANGE).agg(
        F.count("*").alias("n_rows"),
        F.min_by("_key", POSITION).alias("_first"),
        F.max_by("_key", POSITION).alias("_last"),
        F.count_if("_broken").alias("_inside"),
    )
    at_start = F.lag("_last").over(between).isNull() & (F.col("_first")[POSITION] != 1)
    outside = broken(F.lag("_last").over(between), F.col("_first")) | at_start
    return ranges.select(
        RANGE,
        "n_rows",
        F.col("_first")[POSITION].alias("first_position"),
        F.col("_last")[POSITION].alias("last_position"),
        (F.col("_inside") + outside.cast("bigint")).alias("breaks"),
    )
