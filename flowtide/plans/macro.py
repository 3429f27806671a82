"""Monthly indicator table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.functions.columns import cast_all, clean_names, month_number, parse_date
from flowtide.functions.fixed_values import MACRO_DATE, MACRO_DATE_FORMAT, MACRO_SERIES
from flowtide.operators.aggregates import one_row_per_month
from flowtide.operators.combine import join_series


def macro_monthly(
    series: Mapping[str, DataFrame],
    order: Sequence[str] = MACRO_SERIES,
    *,
    last_of_month: bool = False,
    month: str = "month_number",
    cast: str | None = "double",
) -> DataFrame:
    """All series joined on their date, with the month key and numeric measures.

    Every date of the first series gives a row. ``last_of_month`` keeps one row
    per month with the last known value of each measure. ``cast=None`` leaves the measures as text.
    """
    spine, *others = [series[name] for name in order]
    joined = join_series(spine, others, MACRO_DATE)
    date = parse_date(F.col(MACRO_DATE), MACRO_DATE_FORMAT)
    dated = clean_names(joined.withColumn("date", date).withColumn(month, month_number(F.col("date"))))
    table = dated.drop(MACRO_DATE)
    if cast is not None:
        table = cast_all(table, cast, except_=["date", month])
    measures = [c for c in table.columns if c not in ("date", month)]
    if last_of_month:
        return one_row_per_month(table, month, "date", measures)
    return table.select(month, *measures)
