"""Names that hold fragments, for many fragments: an index of grams in place of one test per fragment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.functions.fixed_values import FIRM_PATTERNS
from flowtide.sources.settle import checked_broadcast, settle

GRAM = 3


def pattern_table(spark: SparkSession, patterns: Mapping[str, Sequence[str]] = FIRM_PATTERNS) -> DataFrame:
    """Fragments and firms as rows."""
    found = [(fragment, firm) for firm, fragments in patterns.items() for fragment in fragments]
    return spark.createDataFrame(found, "fragment string, firm string")


def _grams(text: Column, size: int) -> Column:
    """Distinct substrings of a size; of size 0 the empty one."""
    if not size:
        return F.array(F.lit(""))
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    return F.when(
        F.length(text) >= size, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))))
    ).otherwise(F.array().cast("array<string>"))


def names_with_fragments(
    df: DataFrame,
    patterns: DataFrame,
    *,
    name: str = "organization_name",
    fragment: str = "fragment",
    firm: str = "firm",
    label: str = "organization_name_standard",
    dedupe: bool = True,
    gram: int = GRAM,
) -> DataFrame:
    """Distinct names with the firm of each fragment they hold, whatever the case; the same rows as ``firm_lookup``.

    Every fragment is posted under the one of its grams that the fewest names hold, and meets only the names that hold this gram;
    these are verified. Fragments shorter than a gram are posted whole, and names are cut to that size for them too. An empty fragment is in every
    name, NULL in none. A gram that many names share is split by adaptive execution where the fragments are too many to broadcast.
    ``dedupe=False`` repeats a firm for each of its fragments (and each repeated row of ``patterns``) that a name holds.
    """
    names = settle(df.select(F.col(name).alias("_name")).where("_name IS NOT NULL").distinct())
    kept = patterns.select(F.lower(fragment).alias("_fragment"), F.col(firm).alias("_firm")).where("_fragment IS NOT NULL")
    wanted = settle((kept.distinct() if dedupe else kept).withColumn("_size", F.least(F.length("_fragment"), F.lit(gram))))
    sizes = sorted(r[0] for r in wanted.select("_size").distinct().collect())  # at most gram + 1 numbers

    def posted(df: DataFrame, text: Column, of_size: Column | None = None) -> DataFrame:
        cut = [_grams(text, s) if of_size is None else F.when(of_size == s, _grams(text, s)) for s in sizes]
        return df.withColumn("_gram", F.explode(F.flatten(F.array_compact(F.array(*cut)))))

    if not sizes:
        return names.where("false").select(F.col("_name").alias(name), F.lit(None).cast("string").alias(label))
    of_names = posted(names, F.lower("_name"))
    of_fragments = settle(posted(wanted.select("_fragment", "_size").distinct(), F.col("_fragment"), F.col("_size")))
    grams = of_fragments.select("_gram").distinct()
    held = of_names.join(checked_broadcast(grams), "_gram", "left_semi").groupBy("_gram").agg(F.count("*").alias("_n"))
    rarest = F.min(F.struct("_n", "_gram")).alias("_least")
    # A fragment with a gram that no name holds is in none.
    counted = of_fragments.join(held, "_gram", "left").groupBy("_fragment").agg(rarest, F.bool_or(F.col("_n").isNull()).alias("_none"))
    chosen = settle(counted.where("NOT _none").select("_fragment", F.col("_least._gram").alias("_gram")))
    met = of_names.join(checked_broadcast(chosen), "_gram").where(F.lower("_name").contains(F.col("_fragment")))
    found = met.select("_name", "_fragment").join(wanted.select("_fragment", "_firm"), "_fragment")
    found = found.select(F.col("_name").alias(name), F.col("_firm").alias(label))
    return found.distinct() if dedupe else found
