"""Grouped sums of flows. Sums keep the exact type that Spark gives them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.functions.fixed_values import FLOW_MEASURES


def aggregate_flows(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str] = FLOW_MEASURES
) -> DataFrame:
    """Sum of every measure per key combination."""
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def period_totals(
    df: DataFrame, by: Sequence[str], measure: str, name: str = "abs_tot_rdmpt_amt"
) -> DataFrame:
    """Absolute value of the summed measure."""
    return df.groupBy(*by).agg(F.abs(F.sum(measure)).alias(name))


def net_flows(
    df: DataFrame,
    by: Sequence[str],
    parts: Sequence[str] = ("redemption_amount", "sale_amount"),
    name: str = "net_cash_flow",
) -> DataFrame:
    """Sum of sums: a NULL part of a row leaves the other part in the total."""
    first, *rest = [F.sum(p) for p in parts]
    for part in rest:
        first = first + part
    return df.groupBy(*by).agg(first.alias(name))


def flow_totals(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Nine measures of in- and outflow. Combined measures add up row by row, so
    a row with a NULL part counts in none of them."""
    sale, redemption, inward, outward = [F.col(m) for m in FLOW_MEASURES]
    return df.groupBy(*by).agg(
        F.sum(F.abs(redemption)).alias("abs_redemption_amount"),
        F.sum(redemption).alias("redemption_amount"),
        F.sum(sale).alias("sale_amount"),
        F.sum(inward).alias("exchange_in_amount"),
        F.sum(outward).alias("exchange_out_amount"),
        F.sum(redemption + outward).alias("out_amount"),
        F.sum(redemption + sale).alias("net_flow_amount"),
        F.sum(inward + outward).alias("exchange_net_flow_amount"),
        F.sum(redemption + sale + inward + outward).alias("total_net_flow_amount"),
    )


def conditional_sums(
    df: DataFrame, by: Sequence[str], conditions: Mapping[str, Column], measure: Column | str
) -> DataFrame:
    """One sum per condition. Conditions may overlap, and one that is NULL does not hold."""
    amount = F.col(measure) if isinstance(measure, str) else measure
    return df.groupBy(*by).agg(
        *[F.sum(F.when(test, amount).otherwise(0)).alias(name) for name, test in conditions.items()]
    )


def one_row_per_month(df: DataFrame, month: str, date: str, cols: Sequence[str]) -> DataFrame:
    """The last value known in each month, column by column."""
    return df.groupBy(month).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(date))).alias(c) for c in cols]
    )
