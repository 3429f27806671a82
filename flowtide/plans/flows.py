"""Standard flow table from raw flow sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.functions.columns import standardize_columns, valid_id
from flowtide.functions.fixed_values import (
    FIRM_PATTERNS,
    FLOW_COLUMNS,
    FLOW_MEASURES,
    FUND_KEYS,
    MONTH_NUMBER_START,
    PLAN_KEYS,
    SOURCE_A_TAG,
    SOURCE_B_LINE,
    SOURCE_B_TAG,
    VEHICLE_KEYS,
)
from flowtide.operators.aggregates import aggregate_flows
from flowtide.operators.combine import union_all
from flowtide.operators.lookups import attach_firm, lookup_join
from flowtide.sources.settle import fits_broadcast, hint_small

Firms = Mapping[str, Sequence[str]] | DataFrame


def standard_flows(
    raw: DataFrame,
    firms: Firms,
    funds: DataFrame,
    tag: str,
    *,
    line: str | None = None,
    month_start: int = MONTH_NUMBER_START,
    names: Mapping[str, str] = FLOW_COLUMNS,
) -> DataFrame:
    """Flows of the listed firms and funds, summed per plan, firm, line and vehicle.

    ``firms`` are name patterns or a lookup table. Each fund and share class can
    have several vehicles, and each vehicle carries the full amount. The sums
    are therefore made before the vehicles are joined, on rows already reduced to the
    listed funds. A vehicle listed several times carries the amount as many times.
    """
    rows = standardize_columns(raw, names)
    if line is not None:
        rows = rows.where(F.col("business_line_1") == line)
    rows = rows.where(valid_id(F.col("retirement_plan_id")) & (F.col("month_number") > month_start))
    if isinstance(firms, DataFrame):
        rows = lookup_join(rows, firms, "organization_name")
    else:
        rows = attach_firm(rows, firms)
    small = fits_broadcast(funds)
    listed = hint_small(funds.select(*FUND_KEYS).distinct(), small)
    totals = aggregate_flows(rows.join(listed, FUND_KEYS, "left_semi"), [*PLAN_KEYS, *FUND_KEYS])
    vehicles = funds.groupBy(*FUND_KEYS, *VEHICLE_KEYS).agg(F.count(F.lit(1)).alias("_listed"))
    repeated = {m: (F.col(m) * F.col("_listed")).cast(totals.schema[m].dataType) for m in FLOW_MEASURES}
    amounts = [F.when(F.col("_listed") == 1, F.col(m)).otherwise(r).alias(m) for m, r in repeated.items()]
    return (
        totals.join(hint_small(vehicles, small), FUND_KEYS)
        .select(*PLAN_KEYS, *FUND_KEYS, *VEHICLE_KEYS, *amounts)
        .withColumn("data_source", F.lit(tag))
    )


def flows_source_a(raw: DataFrame, funds: DataFrame, firms: Firms = FIRM_PATTERNS, **options) -> DataFrame:
    return standard_flows(raw, firms, funds, SOURCE_A_TAG, **options)


def flows_source_b(raw: DataFrame, funds: DataFrame, firms: Firms = FIRM_PATTERNS, **options) -> DataFrame:
    """The second source contributes one business line only."""
    return standard_flows(raw, firms, funds, SOURCE_B_TAG, **{"line": SOURCE_B_LINE, **options})


def combined_flows(*sources: DataFrame) -> DataFrame:
    return union_all(sources)
