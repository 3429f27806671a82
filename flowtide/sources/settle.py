"""Intermediate tables in the shared folder, and size checks for small ones."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    AtomicType,
    BinaryType,
    CalendarIntervalType,
    MapType,
    NullType,
    StringType,
    StructType,
)

# A lookup above this measured size is joined by shuffle instead of broadcast.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
FIXED_COLUMN_BYTES = 16
UNKNOWN_BYTES = 1 << 60  # what the optimizer reports is beyond it where nobody knows the size

_settled: list[str] = []
_measured: WeakKeyDictionary[DataFrame, float] = WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset, one in the
    warehouse, which all executors reach as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_settled"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, kind: str) -> str:
    """A path in the shared folder that nothing else uses; ``release_settled`` removes it."""
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    _settled.append(path)
    return path


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and read it back from the shared folder.

    Meant for tables that are read more than once: what lies behind them is then
    evaluated a single time, losing an executor costs only a re-read, and later
    steps read no more columns than they use.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, keys: Sequence[str], source: DataFrame, limit: int) -> DataFrame:
    """``df`` dealt by ``keys``, in tasks for ``limit`` bytes each of the files that ``source`` reads.

    For steps that make far more of a row than it holds on its way: left alone, a shuffle's partitions are
    sized by the bytes that go in. Takes no job; sources other than files leave the number to the adaptive planner.
    """
    leaves = source._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    total = sum(sizes)
    return df.repartition(*keys) if total >= UNKNOWN_BYTES else df.repartition(max(1, -(-total // limit)), *keys)


def read_once(df: DataFrame) -> DataFrame:
    """``df`` for a lookup that is measured and then joined, which reads it twice.

    A plain read, filtered and cut to some columns, stays as it is. Anything dearer is settled, so that
    its joins and aggregates run a single time.
    """
    if any(isinstance(f.dataType, (NullType, CalendarIntervalType)) for f in df.schema.fields):
        return df  # parquet has no such columns
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() in ("Project", "Filter"):
        node = node.children().apply(0)
    return df if node.children().isEmpty() else settle(df)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release_settled(spark: SparkSession, since: int = 0) -> None:
    """Remove the settled folders of this process, from the given one on.

    DataFrames built on them can't be evaluated afterwards.
    """
    while len(_settled) > since:
        remove_folder(spark, _settled.pop())


@contextmanager
def settled_scope(spark: SparkSession) -> Iterator[None]:
    """Remove on leaving whatever was settled inside."""
    since = len(_settled)
    try:
        yield
    finally:
        release_settled(spark, since)


def measured_bytes(df: DataFrame) -> float:
    """Size of ``df`` in bytes, from one distributed aggregate.

    Nested values count by their JSON text; a type that has none makes the size
    infinite. A DataFrame is measured once.
    """
    if df not in _measured:
        _measured[df] = _measure(df)
    return _measured[df]


def _measure(df: DataFrame) -> float:
    size = F.lit(0)
    for field in df.schema.fields:
        kind, column = field.dataType, F.col(f"`{field.name}`")
        size += F.lit(FIXED_COLUMN_BYTES)
        if isinstance(kind, (StringType, BinaryType)):
            size += F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(kind, (ArrayType, MapType, StructType)):
            size += F.octet_length(F.to_json(F.struct(column.alias("v"))))
        elif not isinstance(kind, AtomicType):
            return float("inf")
    return df.select(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(df: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` stays within ``limit`` bytes."""
    return measured_bytes(df) <= limit


def hint_small(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast a table known to be small. Otherwise leave the join to the
    optimizer: a shuffle join whose hot keys are split at run time."""
    return F.broadcast(df) if small else df


def checked_broadcast(df: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    return hint_small(df, fits_broadcast(df, limit))
