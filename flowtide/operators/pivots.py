"""Wide pivots of sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.functions.columns import known_values
from flowtide.sources.settle import dealt

READ_BYTES = 4 * 1024 * 1024  # of the files read, for each task that makes wide rows


def label_pivot(
    df: DataFrame,
    by: Sequence[str],
    traits: Mapping[str, Column],
    labels: Sequence[Column],
    values: Sequence[str],
    measures: Mapping[str, Column],
    *,
    absolute: bool = False,
) -> DataFrame:
    """One column per label value and measure, named ``<measure>_<value>``.

    A row belongs once to every label that is not NULL; ``labels`` are written in
    terms of the ``traits``. Groups without any listed label stay, as zeros.

    Rows are summed by key and traits first, which shrinks a hot key to its few
    trait combinations before it moves. The narrow sums are then brought
    together by key once, and all wide rows are made within their partition. Wide rows are many times
    larger than the sums, so the number of partitions follows the files read: a task stays as small however large they are.
    """
    narrow = (
        df.withColumns(dict(traits))
        .groupBy(*by, *traits)
        .agg(*[F.sum(amount).alias(name) for name, amount in measures.items()])
    )
    spread = dealt(narrow, by, df, READ_BYTES).select(
        *by,
        F.explode_outer(known_values(labels)).alias("_label"),
        *measures,
    )
    wide = (
        spread.groupBy(*by)
        .pivot("_label", list(values))
        .agg(*[F.sum(name).alias(name) for name in measures])
    )

    # Expression text: building some hundred column objects takes longer than parsing it.
    form = "abs(coalesce(`{}`, 0)) AS `{}`" if absolute else "coalesce(`{}`, 0) AS `{}`"
    cells = [
        form.format(value if len(measures) == 1 else f"{value}_{name}", f"{name}_{value}")
        for name in measures
        for value in values
    ]
    return wide.selectExpr(*[f"`{k}`" for k in by], *cells)


def fund_line_pivot(
    df: DataFrame,
    by: Sequence[str],
    bucket: Column,
    line: Column,
    measures: Mapping[str, Column],
    buckets: Sequence[str],
    lines: Sequence[str],
    *,
    absolute: bool = False,
) -> DataFrame:
    """Fund bucket times business line, as columns ``<measure>_<bucket>_<line>``."""
    return label_pivot(
        df,
        by,
        {"_bucket": bucket, "_line": line},
        [F.concat(F.col("_bucket"), F.lit("_"), F.col("_line"))],
        [f"{b}_{n}" for n in lines for b in buckets],
        measures,
        absolute=absolute,
    )
