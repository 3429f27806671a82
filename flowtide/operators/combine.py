"""Joins of several series and unions of several sources."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_series(spine: DataFrame, others: Iterable[DataFrame], key: str) -> DataFrame:
    """Left-join every other series to the spine on one shared key.

    The key stays the partitioning of the growing left side, so series too
    large to broadcast are shuffled once each.
    """
    return reduce(lambda left, right: left.join(right, key, "left"), others, spine)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames; columns are matched by name."""
    return reduce(DataFrame.unionByName, frames)


def union_sources(sources: Mapping[str, DataFrame], tag: str = "data_source") -> DataFrame:
    """Union of named sources, each row tagged with its source."""
    return union_all(df.withColumn(tag, F.lit(name)) for name, df in sources.items())
