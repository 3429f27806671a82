"""Firm and fund lookups, and joins of facts with lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.functions.columns import map_suffix, matching_labels, name_contains
from flowtide.functions.fixed_values import (
    FIRM_PATTERNS,
    FUND_PREFIXES,
    SHARE_CLASS_SUFFIXES,
)
from flowtide.sources.settle import checked_broadcast, read_once


def _firms(name: str, patterns: Mapping[str, Sequence[str]], dedupe: bool) -> Column:
    tests = [
        (name_contains(F.col(name), fragment), firm)
        for firm, fragments in patterns.items()
        for fragment in fragments
    ]
    return F.explode(matching_labels(tests, dedupe=dedupe))


def attach_firm(
    df: DataFrame,
    patterns: Mapping[str, Sequence[str]] = FIRM_PATTERNS,
    *,
    name: str = "organization_name",
    label: str = "organization_name_standard",
    dedupe: bool = True,
) -> DataFrame:
    """Keep rows whose name holds a firm's fragment and add the firm.

    Same rows as an inner join with ``firm_lookup``, but the patterns are
    tested where the row is, with neither a join nor a shuffle. A name that
    belongs to two firms gives two rows; ``dedupe=False`` also repeats a firm
    for each of its fragments that occurs.
    """
    return df.withColumn(label, _firms(name, patterns, dedupe))


def firm_lookup(
    df: DataFrame,
    patterns: Mapping[str, Sequence[str]] = FIRM_PATTERNS,
    *,
    name: str = "organization_name",
    label: str = "organization_name_standard",
    dedupe: bool = True,
) -> DataFrame:
    """Distinct raw names with the standard firm they belong to."""
    names = df.select(name).distinct()
    return attach_firm(names, patterns, name=name, label=label, dedupe=dedupe)


def fund_lookup(
    listing: DataFrame,
    prefixes: Mapping[str, str] = FUND_PREFIXES,
    suffixes: Mapping[str, str] = SHARE_CLASS_SUFFIXES,
) -> DataFrame:
    """Listed tickers of the funds: prefix gives the fund, suffix the share class."""
    ticker = F.col("ticker_symbol")
    symbols = {fund: [prefix + end for end in suffixes] for fund, prefix in prefixes.items()}
    wanted = [s for tickers in symbols.values() for s in tickers]
    tests = [(ticker.isin(tickers), fund) for fund, tickers in symbols.items()]
    return (
        listing.where(ticker.isin(wanted))
        .select("ticker_symbol", "investment_vehicle_id")
        .distinct()
        .select(
            "ticker_symbol",
            F.explode(matching_labels(tests)).alias("parent_fund_acronym_group"),
            "investment_vehicle_id",
            map_suffix(ticker, suffixes).alias("parent_share_class_name"),
        )
    )


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: str | Sequence[str] | Column, how: str = "inner"
) -> DataFrame:
    """Join facts with a lookup table, broadcast if its measured size allows it.

    A lookup that is itself a query runs once, and is measured and joined where it was settled.
    """
    keys = on if isinstance(on, (str, Column)) else list(on)
    return facts.join(checked_broadcast(read_once(lookup)), keys, how)
