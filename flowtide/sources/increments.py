"""Snapshots that are refreshed by partition.

The files of every refresh lie in a folder of their own, a subfolder for each partition that changed. A small text file, the pointer, names the
folder that holds each partition, and its checksum. It is written last, under a number of its own, by a rename that
fails if another writer took that number: readers see the old rows or the new ones, whole, and never a gap. Files that an
earlier pointer names stay until ``clean_snapshots`` removes them, so a reader that has begun can finish.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowtide.sources.settle import remove_folder

POINTERS = "_pointers"


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, path: str) -> dict[int, float]:
    """Numbers of the snapshots that exist, with the second each was written."""
    target, files = _path(spark, f"{path}/{POINTERS}")
    if not files.exists(target):
        return {}
    found = {f.getPath().getName(): f.getModificationTime() / 1000 for f in files.listStatus(target)}
    return {int(name[:-5]): at for name, at in sorted(found.items()) if name.endswith(".json") and name[:-5].isdigit()}


def _read_pointer(spark: SparkSession, path: str, number: int) -> dict:
    lines = spark.read.option("wholetext", True).text(f"{path}/{POINTERS}/{number:08d}.json").collect()
    return json.loads(lines[0]["value"])


def _write_pointer(spark: SparkSession, path: str, number: int, pointer: dict) -> None:
    final, files = _path(spark, f"{path}/{POINTERS}/{number:08d}.json")
    draft, _ = _path(spark, f"{path}/{POINTERS}/.{uuid.uuid4().hex}")
    stream = files.create(draft)
    try:
        stream.write(bytearray(json.dumps(pointer).encode()))
    finally:
        stream.close()
    if files.exists(final) or not files.rename(draft, final):
        files.delete(draft, False)
        raise RuntimeError(f"another writer saved snapshot {number} of {path} first")


def _label(partition_by: str):
    return F.coalesce(F.hex(F.encode(F.col(partition_by).cast("string"), "UTF-8")), F.lit("none"))


def partition_checksums(df: DataFrame, partition_by: str) -> dict[str, list[str]]:
    """Number of rows, and sum and exclusive-or of row hashes, of each partition; independent of the order of rows."""
    every = [F.col(f"`{c}`") for c in df.columns]
    sums = df.groupBy(_label(partition_by).alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*every).cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64(F.lit(1), *every)).alias("mixed"),
    )
    return {r["label"]: [str(r["n"]), str(r["total"]), str(r["mixed"])] for r in sums.collect()}


def refresh_snapshot(df: DataFrame, path: str, partition_by: str) -> list[str]:
    """Save ``df`` as the current snapshot at ``path``; the labels of the partitions that had to be written.

    One aggregate finds the partitions whose rows differ from the current snapshot; only these are written. A change of schema
    writes all. ``df`` may read the snapshot that it replaces. Partitions are few enough to be listed: one line each.
    """
    spark = df.sparkSession
    known = _pointers(spark, path)
    number = max(known, default=0)
    before = _read_pointer(spark, path, number) if number else {"schema": None, "partitions": {}}
    sums, schema = partition_checksums(df, partition_by), json.loads(df.schema.json())
    old = before["partitions"] if before["schema"] == schema else {}
    changed = sorted(label for label, mark in sums.items() if label not in old or old[label]["mark"] != mark)
    version = f"version-{uuid.uuid4().hex}"
    if changed:
        label = _label(partition_by)
        rows = df if len(changed) == len(sums) else df.where(label.isin(changed))
        rows.withColumn("_label", label).repartition("_label").write.partitionBy("_label").parquet(f"{path}/{version}")
    partitions = {
        name: {"folder": f"{version}/_label={name}" if name in changed else old[name]["folder"], "mark": mark}
        for name, mark in sums.items()
    }
    if changed or partitions.keys() != before["partitions"].keys() or not number:
        _write_pointer(spark, path, number + 1, {"schema": schema, "partitions": partitions})
    return changed


def read_snapshot(
    spark: SparkSession, path: str, *, number: int | None = None, only: Sequence[Any] | None = None
) -> DataFrame:
    """Rows of the current snapshot, or of an earlier one that still exists; ``only`` some partitions' values, as text."""
    known = _pointers(spark, path)
    if not known or number is not None and number not in known:
        raise ValueError(f"no snapshot {number or ''} at {path}")
    pointer = _read_pointer(spark, path, number or max(known))
    schema = StructType.fromJson(pointer["schema"])
    wanted = None if only is None else {"none" if v is None else str(v).encode().hex().upper() for v in only}
    folders = [
        f"{path}/{p['folder']}" for label, p in pointer["partitions"].items() if wanted is None or label in wanted
    ]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def incremental_snapshot(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], refresh: bool, partition_by: str
) -> DataFrame:
    """The saved rows, first brought up to date when ``refresh`` is set; ``build`` is not called otherwise."""
    if refresh:
        refresh_snapshot(build(), path, partition_by)
    return read_snapshot(spark, path)


def clean_snapshots(spark: SparkSession, path: str, keep_seconds: float) -> int:
    """Remove snapshots replaced more than ``keep_seconds`` ago and the folders that only they name; how many went.

    Pointers go first, so nobody can open a snapshot whose files are being removed. Folders of a refresh that is under way are younger than
    the current pointer and are left alone.
    """
    known = _pointers(spark, path)
    numbers, now = sorted(known), time.time()
    old = [n for n, successor in zip(numbers, numbers[1:]) if now - known[successor] > keep_seconds]
    named = {n: {p["folder"] for p in _read_pointer(spark, path, n)["partitions"].values()} for n in numbers}
    kept = set().union(*(named[n] for n in numbers if n not in old))
    for n in old:
        target, files = _path(spark, f"{path}/{POINTERS}/{n:08d}.json")
        files.delete(target, False)
    for folder in sorted(set().union(*(named[n] for n in old)) - kept):
        remove_folder(spark, f"{path}/{folder}")
    return len(old)
