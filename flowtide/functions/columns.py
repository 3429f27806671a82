"""Column expressions: month keys, labels and predicates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType


def parse_date(text: Column, pattern: str) -> Column:
    """Text as a date; text that does not match the pattern becomes NULL."""
    return F.try_to_date(text, pattern)


def month_number(date: Column) -> Column:
    """Month key ``yyyyMM`` of a date."""
    return F.year(date) * 100 + F.month(date)


def month_index(month: Column) -> Column:
    """Consecutive month count of a ``yyyyMM`` key, so that range frames can
    cross year ends."""
    return F.floor(month / 100).cast("int") * 12 + month % 100


def month_date(month: Column, shift: int = 1) -> Column:
    """First day of the month ``shift`` months after the key ``yyyyMM``."""
    first = parse_date(F.concat(month.cast("string"), F.lit("01")), "yyyyMMdd")
    return F.add_months(first, shift)


def valid_id(ident: Column) -> Column:
    """True for whole-number ids other than 0; NULL for anything non-numeric."""
    return ident.try_cast("bigint") != 0


def name_contains(name: Column, fragment: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(name).contains(F.lower(F.lit(fragment)))


def known_values(texts: Iterable[Column]) -> Column:
    """Array of the distinct texts that are not NULL; stays in generated code."""
    return F.array_except(F.array(*texts), F.array(F.lit(None).cast("string")))


def matching_labels(
    tests: Iterable[tuple[Column, str]], *, dedupe: bool = True
) -> Column:
    """Array of the labels whose test holds, in the given order."""
    hits = [F.when(test, F.lit(label)) for test, label in tests]
    return known_values(hits) if dedupe else F.array_compact(F.array(*hits))


def map_suffix(text: Column, labels: Mapping[str, str]) -> Column:
    """Label of the first suffix that ``text`` ends with, else NULL."""
    return F.coalesce(*[F.when(text.endswith(end), F.lit(label)) for end, label in labels.items()])


def fund_bucket(
    code: Column, buckets: Iterable[str], prefix_bucket: str, prefixes: Iterable[str]
) -> Column:
    """Bucket of a fund code: one bucket by prefix, the others by equality, else NULL."""
    listed = [b for b in buckets if b != prefix_bucket]
    by_prefix = reduce(or_, [code.startswith(p) for p in prefixes])
    return F.when(by_prefix, F.lit(prefix_bucket)).when(code.isin(listed), code)


def mean(total: Column, count: Column) -> Column:
    """Mean from an exact total and a count; NULL for an empty group."""
    return total.cast("double") / F.nullif(count, F.lit(0))


def standardize_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename source columns, whatever their letter case, to standard names."""
    return df.withColumnsRenamed(dict(names))


def clean_names(df: DataFrame) -> DataFrame:
    """Replace spaces in column names by underscores."""
    return df.toDF(*[name.replace(" ", "_") for name in df.columns])


def cast_all(df: DataFrame, dtype: str | DataType, except_: Iterable[str] = ()) -> DataFrame:
    """Cast every column but the excepted ones; values that do not fit become NULL."""
    keep = set(except_)
    return df.select(
        *[F.col(f"`{c}`") if c in keep else F.col(f"`{c}`").try_cast(dtype).alias(c) for c in df.columns]
    )


def decimals_as_double(df: DataFrame) -> DataFrame:
    """Show exact decimal results as doubles."""
    return df.selectExpr(
        *[
            f"CAST(`{f.name}` AS DOUBLE) AS `{f.name}`"
            if isinstance(f.dataType, DecimalType)
            else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )
