"""Readers: delimited series, parquet and database tables."""

from __future__ import annotations

import re
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def series_name(path: str) -> str:
    """Name of a series from its file name: ``House Pricing-Index.csv`` gives
    ``house_pricing_index``."""
    name = re.sub(r"\.csv$", "", path.rstrip("/").rsplit("/", 1)[-1], flags=re.IGNORECASE)
    return re.sub("[ -]", "_", name).lower()


def read_series(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One delimited file with a header; every column is text unless a schema is given."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_series_dir(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every ``.csv`` entry of a folder as a named DataFrame.

    Spark lists the folder, so any file system it knows will do. A series saved
    by Spark is itself a folder of part files and counts as one entry. Entries whose names
    differ only in what ``series_name`` takes away are refused.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .load(folder)
    )
    root = re.sub(r"^[a-z]+:(//[^/]*)?", "", folder.rstrip("/"), flags=re.IGNORECASE)
    root = f"/{root.lstrip('/')}/"
    entries: dict[str, str] = {}
    for file in map(unquote, listing.inputFiles()):
        head, _, tail = file.partition(root)
        entry = f"{head}{root}{tail.split('/', 1)[0]}"
        if entries.setdefault(series_name(entry), entry) != entry:
            raise ValueError(f"{entry} and {entries[series_name(entry)]} have one name")
    return {name: read_series(spark, path) for name, path in sorted(entries.items())}


def jdbc_arguments(
    url: str,
    table: str,
    *,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict:
    """Arguments of a database read. Bounds only split the read when they come
    with the column they apply to, so one without the other is refused."""
    split = (column, bounds, num_partitions)
    if any(part is not None for part in split) and any(part is None for part in split):
        raise ValueError("column, bounds and num_partitions belong together")
    arguments = {"url": url, "table": table, "properties": dict(properties or {})}
    if column is not None:
        arguments |= {
            "column": column,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": num_partitions,
        }
    return arguments


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table, read over ``num_partitions`` connections split by ``column``."""
    arguments = jdbc_arguments(
        url,
        table,
        column=column,
        bounds=bounds,
        num_partitions=num_partitions,
        properties=properties,
    )
    return spark.read.jdbc(**arguments)
