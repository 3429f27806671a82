"""Wide per-advisor tables: business lines and fund buckets as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.functions.columns import fund_bucket, month_date
from flowtide.functions.fixed_values import (
    ADVISOR_MONTH_START,
    BUSINESS_LINE_KEYS,
    FUND_BUCKETS,
    LINE_1_ALL,
    LINE_2_DCIO,
    LINE_2_SMALL,
    LINE_3_PROPRIETARY,
    TARGET_DATE_BUCKET,
    TARGET_DATE_PREFIXES,
)
from flowtide.operators.pivots import label_pivot
from flowtide.sources.settle import fits_broadcast, hint_small, read_once, settle

BY = ["MO_NUM", "FINCL_ITRMY_PRSON_ID"]
LINES = ["IR", "DCIO", "DCProp", "DCSmallRPSolution", "OtherIR"]
FUND_LINES = ["DCIO", "SmallRP"]


def _single_advisors(facts: DataFrame, total: Column, month_start: int) -> DataFrame:
    """Facts of single advisors with a non-zero total.

    The history filter is on the stored month, so the scan can skip files by it.
    A key that is no month (13, say) has no date and is left out.
    """
    return facts.where(
        (F.col("MO_NUM") >= month_start)
        & (F.col("MO_NUM") % 100).between(1, 12)
        & (F.col("TEAM_IND") == "N")
        & (F.col("FINCL_ITRMY_PRSON_ID") != 0)
        & (total != 0)
    )


def advisor_rows(
    facts: DataFrame,
    vehicles: DataFrame,
    business_lines: DataFrame,
    total: Column,
    month_start: int = ADVISOR_MONTH_START,
    measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Facts of single advisors with a non-zero total, and their two dimensions.

    With ``measures`` only these are kept, for summing by month and advisor. Dimensions within the
    broadcast limit meet the facts where they are. Beyond it the measures are first summed by
    month, advisor and dimension keys, so that partial sums shrink the facts before they move; a
    repeated dimension row repeats the sum as it would repeat the facts.

    Vehicles beyond the limit are joined to the business lines, which hold the same vehicle numbers, so
    that rows are shuffled once for both; only rows without a business line look their vehicle up alone.
    """
    rows = _single_advisors(facts, total, month_start)
    codes = read_once(vehicles.select(F.col("InvestmentVehicleID").alias("INV_VEH_ID"), "ParentFundAcronymCode"))
    lines = read_once(business_lines.select(*BUSINESS_LINE_KEYS, "BusinessLine1", "BusinessLine2", "BusinessLine3"))
    few_codes, few_lines = fits_broadcast(codes), fits_broadcast(lines)
    if measures and few_codes and few_lines:
        rows = rows.select(*BY, *BUSINESS_LINE_KEYS, *[c.alias(n) for n, c in measures.items()])
    elif measures:
        sums = [F.sum(amount).alias(name) for name, amount in measures.items()]
        rows = rows.groupBy(*BY, *BUSINESS_LINE_KEYS).agg(*sums)
    if few_codes:
        coded = rows.join(F.broadcast(codes), "INV_VEH_ID", "left")
        return coded.join(hint_small(lines, few_lines), BUSINESS_LINE_KEYS, "left")
    rows = settle(rows)
    found = rows.join(lines.join(codes, "INV_VEH_ID", "left"), BUSINESS_LINE_KEYS)
    alone = rows.join(lines.select(*BUSINESS_LINE_KEYS), BUSINESS_LINE_KEYS, "left_anti")
    return found.unionByName(alone.join(codes, "INV_VEH_ID", "left"), allowMissingColumns=True)


def advisor_pivot(
    rows: DataFrame,
    measures: dict[str, Column],
    *,
    line1_filter: str | None,
    buckets: Sequence[str] = FUND_BUCKETS,
    absolute: bool = False,
) -> DataFrame:
    """Per month and advisor: a column per business line and per fund bucket and line.

    ``line1_filter`` restricts the first line column; without it that column sums all rows.
    """
    line_2 = F.col("BusinessLine2")
    all_lines = F.lit(True) if line1_filter is None else F.col("BusinessLine1") == line1_filter
    traits = {
        "_bucket": fund_bucket(
            F.col("ParentFundAcronymCode"), buckets, TARGET_DATE_BUCKET, TARGET_DATE_PREFIXES
        ),
        "_all": F.coalesce(all_lines, F.lit(False)),
        "_line": F.when(line_2 == LINE_2_DCIO, "DCIO")
        .when(line_2 == LINE_2_SMALL, "SmallRP")
        .when(line_2.isNotNull(), "Other"),
        "_prop": F.coalesce(F.col("BusinessLine3").isin(LINE_3_PROPRIETARY), F.lit(False)),
    }
    line = F.col("_line")
    labels = [
        F.when(F.col("_all"), F.lit("IR")),
        F.when(line == "DCIO", F.lit("DCIO")),
        F.when(F.col("_prop"), F.lit("DCProp")),
        F.when(line == "SmallRP", F.lit("DCSmallRPSolution")),
        F.when(line == "Other", F.lit("OtherIR")),
        F.when(line.isin(FUND_LINES), F.concat(F.col("_bucket"), F.lit("_"), line)),
    ]
    values = [*LINES, *[f"{b}_{n}" for n in FUND_LINES for b in buckets]]
    wide = label_pivot(rows, BY, traits, labels, values, measures, absolute=absolute)
    names = [f"{m}_{v}" if v in LINES else f"Fund{m}{v}" for m in measures for v in values]
    dated = wide.withColumn("MO_NUM", month_date(F.col("MO_NUM")))
    return dated.toDF("MonthDate", "FinancialIntermediaryPersonID", *names)


def advisor_assets(assets: DataFrame, vehicles: DataFrame, business_lines: DataFrame) -> DataFrame:
    """Assets per month and advisor, 69 columns."""
    total = F.col("ASSET_VAL_AMT") + F.col("TEAM_ALLOC_ASSET_VAL_AMT")
    rows = advisor_rows(assets, vehicles, business_lines, total, measures={"Assets": total})
    return advisor_pivot(rows, {"Assets": F.col("Assets")}, line1_filter=LINE_1_ALL)


def advisor_sales(sales: DataFrame, vehicles: DataFrame, business_lines: DataFrame) -> DataFrame:
    """Absolute sales and redemptions per month and advisor, 136 columns."""
    sold = F.col("SLS_AMT") + F.col("TEAM_ALLOC_SLS_AMT")
    redeemed = F.col("RDMPT_AMT") + F.col("TEAM_ALLOC_RDMPT_AMT")
    measures = {"Sales": sold, "Redemptions": redeemed}
    rows = advisor_rows(sales, vehicles, business_lines, sold + redeemed, measures=measures)
    return advisor_pivot(rows, {name: F.col(name) for name in measures}, line1_filter=None, absolute=True)
