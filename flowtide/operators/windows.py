"""Month counters, moving averages, gap filling and trailing means.

Gap filling and trailing means come in two plans with the same result:

* ``bounded_groups=False`` (default) for any rows, however many share a key.
  The rows are first reduced to one row per key and period with partial
  aggregation; only this reduced table goes through a window, where a group is
  as long as its history in periods. The outcome is joined back to the rows.
* ``bounded_groups=True`` for rows that are already aggregated, so that a group
  holds a few rows per period. Windows over the rows do it in one shuffle.

Rows that share key and period are peers. In either plan peers first share their largest
(forward) or smallest (backward, first seen) value, so no result depends on the order of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from flowtide.functions.columns import mean, month_index
from flowtide.functions.fixed_values import ANOMALY_LEVELS, ANOMALY_NONE, WINDOW_SIZES
from flowtide.sources.settle import fits_broadcast, hint_small, read_once, settle


def attach_by_keys(df: DataFrame, table: DataFrame, keys: Sequence[str], added: Sequence[str]) -> DataFrame:
    """Left join of a table on keys that may be NULL. A table that is still a query runs once."""
    keyed = read_once(table.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *added))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    joined = df.join(hint_small(keyed, fits_broadcast(keyed)), same, "left")
    return joined.drop(*[f"_key_{k}" for k in keys])


def ranked_months(df: DataFrame, month: str, name: str = "month_counter") -> DataFrame:
    """Every distinct month with its rank, 1 for the earliest.

    The rows are reduced to their distinct months where they are. Only those are
    ordered in one task: a calendar has twelve a year, however many rows there are.
    """
    months = df.select(month).distinct()
    rank = F.row_number().over(W.orderBy(month))
    return settle(months.withColumn(name, rank))


def month_counter(df: DataFrame, month: str, name: str = "month_counter") -> DataFrame:
    """Add the dense rank of the month, 1 for the earliest."""
    return attach_by_keys(df, ranked_months(df, month, name), [month], [name])


def moving_averages(
    df: DataFrame, value: str, by: Sequence[str], order: str, sizes: Sequence[int] = WINDOW_SIZES
) -> DataFrame:
    """Averages over the last ``n`` rows, the current one included.

    Expects aggregated rows, one per key and period.
    """
    history = W.partitionBy(*by).orderBy(order)
    frames = {n: history.rowsBetween(1 - n, W.currentRow) for n in sizes}
    return df.withColumns(
        {
            f"moving_average_{n}": mean(F.sum(value).over(frame), F.count(value).over(frame))
            for n, frame in frames.items()
        }
    )


def anomaly_labels(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    order: str,
    levels: Mapping[int, str] = ANOMALY_LEVELS,
    otherwise: str = ANOMALY_NONE,
    name: str = "period_anomaly_type",
) -> DataFrame:
    """Moving averages plus the label of the first one that the value exceeds.

    The test compares value * count with the window's sum, which is exact for
    decimals: a value equal to its average is never labelled.
    """
    history = W.partitionBy(*by).orderBy(order)
    label = F
    for n, text in levels.items():
        frame = history.rowsBetween(1 - n, W.currentRow)
        above = F.col(value) * F.count(value).over(frame).cast("int") > F.sum(value).over(frame)
        label = label.when(above, F.lit(text))
    return moving_averages(df, value, by, order, list(levels)).withColumn(
        name, label.otherwise(F.lit(otherwise))
    )


def _so_far(by: Sequence[str], order: Sequence[Column]) -> WindowSpec:
    return W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)


def _latest(by: Sequence[str], order: Sequence[str], column: str) -> Column:
    return F.last(column, ignorenulls=True).over(_so_far(by, [F.col(o).asc() for o in order]))


def _following(by: Sequence[str], order: Sequence[str], column: str) -> Column:
    """The window runs backwards: its frame grows instead of being evaluated
    again for every row."""
    return F.last(column, ignorenulls=True).over(_so_far(by, [F.col(o).desc() for o in order]))


def _first_so_far(by: Sequence[str], order: Sequence[str], column: str) -> Column:
    return F.first(column, ignorenulls=True).over(_so_far(by, [F.col(o).asc() for o in order]))


def _first_of_group(by: Sequence[str], order: Sequence[str], column: str) -> Column:
    whole = W.partitionBy(*by).orderBy(*order)
    return F.first(column, ignorenulls=True).over(
        whole.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )


def nearest_known(by: Sequence[str], period: str, low: str, high: str) -> Column:
    """What ``fill_gaps`` fills with, from the columns of the smallest and the largest known value of each period."""
    return F.coalesce(_latest(by, [period], high), _first_of_group(by, [period], low))


def _fill_by_period(df, by, period, cols, found, keep_own):
    """Fill from one row per key and period; ``found(low, high)`` gives the value
    from the columns that hold the smallest and the largest known value."""
    bounds = [f(c).alias(f"_{n}_{c}") for c in cols for n, f in (("low", F.min), ("high", F.max))]
    by_period = settle(df.groupBy(*by, period).agg(*bounds))
    values = by_period.select(
        *by, period, *[found(f"_low_{c}", f"_high_{c}").alias(f"_fill_{c}") for c in cols]
    )
    names = [f"_fill_{c}" for c in cols]
    filled = attach_by_keys(df, values, [*by, period], names)
    replaced = {
        c: F.coalesce(F.col(c), F.col(n)) if keep_own else F.col(n) for c, n in zip(cols, names)
    }
    return filled.withColumns(replaced).drop(*names)


def _fill_in_place(df, by, period, cols, found, keep_own):
    """Fill by windows over the rows; peers share their bounds before any order counts."""
    peers = W.partitionBy(*by, period)
    bounds = {
        f"_{n}_{c}": f(c).over(peers) for c in cols for n, f in (("low", F.min), ("high", F.max))
    }
    values = {c: found(f"_low_{c}", f"_high_{c}") for c in cols}
    filled = {c: F.coalesce(F.col(c), v) if keep_own else v for c, v in values.items()}
    return df.withColumns(bounds).withColumns(filled).drop(*bounds)


def _fill(df, by, period, cols, found, bounded_groups, keep_own=True):
    plan = _fill_in_place if bounded_groups else _fill_by_period
    return plan(df, by, period, cols, found, keep_own)


def forward_fill(
    df: DataFrame, by: Sequence[str], period: str, cols: Sequence[str], *, bounded_groups: bool = False
) -> DataFrame:
    """Replace NULLs by the latest value up to the row's period, the largest among peers."""
    return _fill(df, by, period, cols, lambda low, high: _latest(by, [period], high), bounded_groups)


def back_fill(
    df: DataFrame, by: Sequence[str], period: str, cols: Sequence[str], *, bounded_groups: bool = False
) -> DataFrame:
    """Replace NULLs by the next value from the row's period on, the smallest among peers."""
    return _fill(df, by, period, cols, lambda low, high: _following(by, [period], low), bounded_groups)


def running_first(
    df: DataFrame, by: Sequence[str], period: str, cols: Sequence[str], *, bounded_groups: bool = False
) -> DataFrame:
    """Replace every value by the first one seen up to the row's period, the
    smallest among peers."""
    first = lambda low, high: _first_so_far(by, [period], low)
    return _fill(df, by, period, cols, first, bounded_groups, keep_own=False)


def fill_gaps(
    df: DataFrame, by: Sequence[str], period: str, cols: Sequence[str], *, bounded_groups: bool = False
) -> DataFrame:
    """Forward fill, then back fill what is left at the start of each group.

    What forward filling leaves NULL lies before the group's first value, so one
    window answers both.
    """

    return _fill(df, by, period, cols, lambda low, high: nearest_known(by, period, low, high), bounded_groups)


def trailing_avg(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    month: str,
    periods: Sequence[int] = WINDOW_SIZES,
    *,
    mode: str = "month_index",
    bounded_groups: bool = False,
) -> DataFrame:
    """Mean of the rows in the ``p`` months before the row's own month.

    ``mode="literal"`` takes the frame p+1..1 on the ``yyyyMM`` number itself,
    which holds no months from before a year end.
    """
    if mode not in ("month_index", "literal"):
        raise ValueError(f"unknown mode {mode!r}")
    axis = month_index(F.col(month)) if mode == "month_index" else F.col(month)
    reach = 0 if mode == "month_index" else 1
    history = W.partitionBy(*by).orderBy(axis)
    frames = {p: history.rangeBetween(-(p + reach), -1) for p in periods}
    names = {p: f"avg_{value}_lag_{p}_months" for p in periods}
    if bounded_groups:
        return df.withColumns(
            {names[p]: mean(F.sum(value).over(f), F.count(value).over(f)) for p, f in frames.items()}
        )
    by_month = settle(
        df.groupBy(*by, month).agg(F.sum(value).alias("_total"), F.count(value).alias("_rows"))
    )
    means = by_month.select(
        *by,
        month,
        *[
            mean(F.sum("_total").over(f), F.sum("_rows").over(f)).alias(names[p])
            for p, f in frames.items()
        ],
    )
    return attach_by_keys(df, means, [*by, month], list(names.values()))
