"""Saved tables, refresh-or-reuse snapshots and temporary views."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

VERSION = "version-"


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def _location(spark: SparkSession, name: str) -> str | None:
    """Where a table's files are, if it lies in a folder of versions."""
    if not spark.catalog.tableExists(name):
        return None
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return facts["data_type"] if facts and VERSION in facts["data_type"] else None


def overwrite_table(
    df: DataFrame, name: str, *, path: str | None = None, partition_by: Sequence[str] = ()
) -> None:
    """Replace a saved table, its schema included.

    The rows are written to a folder of their own under ``path`` (the warehouse by default) and the
    table is pointed at it only after that. If the query fails, the old table stays as it
    is; ``df`` may read the table it replaces. A table without partitions whose columns stay the same is moved to
    the new folder in one step; otherwise it is dropped and created. The version that was replaced keeps its files
    until the next overwrite, so that its readers can finish.
    """
    spark = df.sparkSession
    base = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}"
    folder = f"{base}/{VERSION}{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(folder)
    old = _location(spark, name)
    columns = [f for f in df.schema.fields if f.name not in partition_by]
    columns += [df.schema[c] for c in partition_by]
    if old is not None and not partition_by and spark.table(name).schema == _nullable(df.schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
        _remove_versions(spark, base, {folder, old})
        return
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if partition_by:
        keys = ", ".join(f"`{c}`" for c in partition_by)
        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        spark.sql(f"CREATE TABLE {name} ({types}) USING parquet PARTITIONED BY ({keys}) LOCATION '{folder}'")
        spark.catalog.recoverPartitions(name)
    else:
        spark.catalog.createTable(name, source="parquet", schema=StructType(columns), path=folder)
    _remove_versions(spark, base, {folder, *([old] if old else [])})


def _nullable(schema: StructType) -> StructType:
    """The schema as a saved table gives it back: every column may be NULL."""
    return StructType.fromJson(json.loads(schema.json().replace('"nullable":false', '"nullable":true')))


def _remove_versions(spark: SparkSession, base: str, kept: set[str]) -> None:
    """Remove the versions in a table's folder but those that are kept."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        return
    names = {k.rstrip("/").rsplit("/", 1)[-1] for k in kept}
    for found in files.listStatus(target):
        if found.getPath().getName().startswith(VERSION) and found.getPath().getName() not in names:
            files.delete(found.getPath(), True)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a saved table with the files of all its versions."""
    old = _location(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if old is not None:
        _remove_versions(spark, old.rstrip("/").rsplit("/", 1)[0], set())


def snapshot(
    spark: SparkSession,
    name: str,
    build: Callable[[], DataFrame],
    refresh: bool,
    *,
    path: str | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """The saved table, rebuilt first when ``refresh`` is set.

    ``build`` is not called otherwise, so its sources are not even opened.
    """
    if refresh:
        overwrite_table(build(), name, path=path, partition_by=partition_by)
    return spark.table(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame as a temporary view and return the view's rows."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def view_from_sql(spark: SparkSession, name: str, query: str) -> DataFrame:
    """Define (or redefine) a temporary view by a query; nothing runs until it is read."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {query}")
    return spark.table(name)
