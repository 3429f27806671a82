"""Bounded samples of labelled rows to fit a model on."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that no model learns from: every fifth by a checksum of the id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % FOLDS == 0, F.lit(False))


def known_labels(labels: DataFrame, target: str, rows: int, id_column: str = "doc_id") -> DataFrame:
    """Order, id and label of ``rows`` labelled ids at most.

    They are those of the training folds with the smallest hashes, whatever the partitions. A repeated
    id counts once, with its larger label. NULL ids and labels other than 0 and 1 are left out.
    """
    return (
        labels.where(F.col(id_column).isNotNull() & F.col(target).isin(0, 1) & ~held_out(id_column))
        .groupBy(F.col(id_column).cast("bigint").alias("_id"))
        .agg(F.max(target).cast("int").alias("_label"))
        .withColumn("_order", F.xxhash64("_id"))
        .orderBy("_order", "_id")
        .limit(rows)
    )


def sampled_rows(
    docs: DataFrame, chosen: DataFrame, columns: Sequence[str] = ("text",), id_column: str = "doc_id"
) -> DataFrame:
    """The documents of a bounded table of ids, with order, id, label and ``columns``.

    Of rows that repeat an id the smallest counts, so that a repeated id doesn't swell the sample.
    """
    found = docs.select(F.col(id_column).cast("bigint").alias("_id"), F.struct(*columns).alias("_row"))
    return (
        found.join(F.broadcast(chosen), "_id")
        .groupBy("_order", "_id", "_label")
        .agg(F.min("_row").alias("_row"))
        .select("_order", "_id", "_label", "_row.*")
    )


def fit_once(features: DataFrame, fit: Callable[[pa.Table | None], bytes]) -> bytes:
    """Run ``fit`` on all rows of a bounded table in one task and return its result.

    ``fit`` gets None if there are no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)
        table = pa.Table.from_batches(found) if found else None
        yield pa.RecordBatch.from_pydict({"model": pa.array([fit(table)], pa.binary())})

    return features.repartition(1).mapInArrow(run, "model binary").collect()[0]["model"]

