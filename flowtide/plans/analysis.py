"""Redemption analyses on a standard flow or base table.

Monthly totals are settled before they are ranked: they are small, and the facts
behind them are read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.functions.columns import month_index
from flowtide.functions.fixed_values import ANOMALY_NONE
from flowtide.operators.aggregates import flow_totals, net_flows, period_totals
from flowtide.operators.lags import LAGS, correlations, lagged
from flowtide.operators.segments import asof_join
from flowtide.operators.windows import (
    anomaly_labels,
    month_counter,
    moving_averages,
    ranked_months,
)
from flowtide.sources.settle import settle

MONTH = "month_number"
FUND = "parent_fund_acronym_group"
COUNTER = "month_counter"
TOTAL = "abs_tot_rdmpt_amt"
NET = "net_cash_flow"
LABEL = "period_anomaly_type"


def counted_months(df: DataFrame) -> DataFrame:
    """Every month with its consecutive number."""
    return ranked_months(df, MONTH, COUNTER).orderBy(COUNTER)


def _monthly_redemptions(df: DataFrame) -> DataFrame:
    totals = settle(period_totals(df, [MONTH, FUND], "redemption_amount", TOTAL))
    return month_counter(totals, MONTH)


def fund_redemptions(df: DataFrame) -> DataFrame:
    """Absolute redemptions per month and fund."""
    return _monthly_redemptions(df).orderBy(MONTH, FUND)


def fund_detail(df: DataFrame, fund: str, *, ordered: bool = True) -> DataFrame:
    """All rows of one fund with the absolute redemption and the month number.

    They are sorted by month, which costs a second pass over the facts for the sort's ranges;
    ``ordered=False`` leaves them where they are.
    """
    rows = df.where(F.col(FUND) == fund).withColumn(
        "abs_redemption_amount", F.abs("redemption_amount")
    )
    counted = month_counter(rows, MONTH)
    return counted.orderBy(MONTH) if ordered else counted


def redemption_moving_averages(df: DataFrame) -> DataFrame:
    """Monthly redemptions per fund with moving averages."""
    return moving_averages(_monthly_redemptions(df), TOTAL, [FUND], COUNTER)


def net_flow_moving_averages(df: DataFrame) -> DataFrame:
    """Monthly net cash flow per fund with moving averages."""
    totals = settle(net_flows(df, [MONTH, FUND], name=NET))
    return moving_averages(month_counter(totals, MONTH), NET, [FUND], COUNTER)


def redemption_share(
    totals: DataFrame, holdings: DataFrame, by: Sequence[str], *, assets: str = "assets", max_age: int | None = None
) -> DataFrame:
    """Redemptions per month as a share of the assets last reported on or before it.

    Assets that were reported more than ``max_age`` months ago count as unknown, as do those of zero.
    """
    known = asof_join(
        totals, holdings, by, MONTH, [assets], max_age=max_age, axis=month_index, since="assets_month"
    )
    share = F.col(TOTAL).cast("double") / F.nullif(F.col(assets).cast("double"), F.lit(0.0))
    return known.withColumn("redemption_share", share)


def fund_anomalies(df: DataFrame, funds: str | Sequence[str]) -> DataFrame:
    """Monthly redemptions of a fund, labelled by the moving average they exceed."""
    wanted = [funds] if isinstance(funds, str) else list(funds)
    return anomaly_labels(
        _monthly_redemptions(df.where(F.col(FUND).isin(wanted))), TOTAL, [FUND], COUNTER
    )


def macro_correlations(
    months: DataFrame, indicators: DataFrame, cols: Sequence[str], with_lags: Sequence[int] = LAGS
) -> DataFrame:
    """How indicators of the same and of earlier months go with months of high redemptions.

    ``months`` are labelled as by ``fund_anomalies``; a month is high if it has any label but the normal one.
    """
    high = months.select(MONTH, (F.col(LABEL) != ANOMALY_NONE).cast("double").alias("_high"))
    wide = lagged(indicators.select(MONTH, *cols), MONTH, cols, with_lags, spine=high.select(MONTH).distinct())
    now = indicators.select(MONTH, *cols)
    series = {c: (c, 0) for c in cols} | {f"{c}_lag_{n}": (c, n) for c in cols for n in with_lags}
    return correlations(high.join(wide, MONTH).join(now, MONTH, "left"), "_high", series)


def fund_flow_series(df: DataFrame, fund: str) -> DataFrame:
    """In- and outflow measures of one fund by month."""
    totals = settle(flow_totals(df.where(F.col(FUND) == fund), [FUND, MONTH]))
    return month_counter(totals, MONTH).orderBy(COUNTER)
