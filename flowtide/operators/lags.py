"""Lagged columns on a calendar, and correlations with a target for all of them at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.functions.columns import month_index
from flowtide.operators.windows import attach_by_keys
from flowtide.sources.settle import settle

LAGS = (1, 3, 6)


def month_of_index(index: Column) -> Column:
    """The ``yyyyMM`` key of a consecutive month count."""
    number = (index - 1) % 12 + 1
    return (((index - number) / 12) * 100 + number).cast("int")


def calendar(df: DataFrame, month: str, by: Sequence[str] = (), extra: int = 0) -> DataFrame:
    """Every month from a key's first to its last one, and ``extra`` more, whether the key has rows there or not."""
    at = month_index(F.col(month))
    span = df.groupBy(*by).agg(F.min(at).alias("_first"), F.max(at).alias("_last")).where("_first IS NOT NULL")
    months = F.explode(F.sequence(F.col("_first"), F.col("_last") + extra))
    return span.select(*by, months.alias("_at")).select(*by, month_of_index(F.col("_at")).alias(month))


def lagged(
    df: DataFrame,
    month: str,
    cols: Sequence[str],
    lags: Sequence[int] = LAGS,
    *,
    by: Sequence[str] = (),
    spine: DataFrame | None = None,
) -> DataFrame:
    """Add ``<column>_lag_<n>``: the value of the month ``n`` calendar months earlier, NULL where that month has none.

    Lags count months, not rows, so a hole in the history shifts nothing. Each row is sent to the months that
    look back at it, and one aggregate brings all columns and lags together. ``spine`` names the rows to be
    given lags (``calendar`` for example); by default those of ``df``, which also keep their other columns.
    Of several rows of one key and month the largest value counts.
    """
    at = month_index(F.col(month))
    moves = F.explode(F.array(*[F.struct(F.lit(n).alias("lag"), (at + n).alias("at")) for n in lags])).alias("_to")
    sent = df.where(F.col(month).isNotNull()).select(*by, *cols, moves)
    cells = [F.max(F.when(F.col("_to.lag") == n, F.col(c))).alias(f"{c}_lag_{n}") for c in cols for n in lags]
    wide = sent.groupBy(*by, month_of_index(F.col("_to.at")).alias(month)).agg(*cells)
    names = [f"{c}_lag_{n}" for c in cols for n in lags]
    return attach_by_keys(df if spine is None else spine, settle(wide), [*by, month], names)


def correlations(df: DataFrame, target: str, series: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Correlation of each column with the target: ``indicator``, ``lag``, ``n_months`` and ``correlation``.

    ``series`` gives the name and lag that a column stands for. The co-moments of all columns are gathered in one aggregate with
    partial sums; a row counts for a column only if both values are known. Where either is constant there is no correlation.
    """
    sums, rows = [], []
    for at, (column, (name, lag)) in enumerate(series.items()):
        both = F.col(column).isNotNull() & F.col(target).isNotNull()
        spread = F.stddev_pop(F.when(both, F.col(column))) * F.stddev_pop(F.when(both, F.col(target)))
        sums.append((F.covar_pop(column, target) / F.nullif(spread, F.lit(0.0))).alias(f"_r{at}"))
        sums.append(F.count(F.when(both, 1)).alias(f"_n{at}"))
        rows.append(
            F.struct(
                F.lit(name).alias("indicator"),
                F.lit(lag).alias("lag"),
                F.col(f"_n{at}").alias("n_months"),
                F.col(f"_r{at}").alias("correlation"),
            )
        )
    return df.agg(*sums).select(F.explode(F.array(*rows)).alias("_row")).select("_row.*")
