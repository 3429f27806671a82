"""SimHash near-duplicates: byte-position inverted index with count filtering.

Fingerprints of at most ``MAX_BITS`` differing bits differ in as many bytes at most, so ``SHARED_BYTES`` (6) of
8 positional bytes at least are shared. Each distinct fingerprint is posted under (position, byte) for
the first three positions, one of which any such pair shares. The list of one byte holds a
256th of all fingerprints, so a list of more than ``MAX_LIST`` members is split: its members are posted again under the
list's bytes and one of the next positions, as long as no more than two positions are skipped. A list of d
bytes holds a 256^d-th, and there are (d + 1)(d + 2) / 2 of them for a fingerprint. Splitting starts at the depth at which evenly
spread fingerprints have short lists, so that longer ones aren't posted in vain.

Two fingerprints meet in the one list that holds the first bytes they share: pairs that agree at a skipped position
are left to another list. For pairs that meet the shared positional bytes are tallied, pairs that
reach the guaranteed minimum are retained, and their differing bits verified.

At six bytes the minimum is reached and nothing is left to split. What is then still long (65,536 members at most, the values of
two bytes) is linked without pairs: two fingerprints of two differing bits at most both are within one bit
of a third value, so each member is listed under the 65 values within one bit of it, and
members of a value are linked to the smallest of them.

Equal fingerprints are grouped first; only distinct ones are indexed, and nothing is expanded into
all pairs of a group. Nothing is collected or broadcast but a count and a checksum per round.

Defined results: a NULL text counts as empty; texts without words have fingerprint zero and
link like any other; repeated rows are reported once each; a NULL id takes part but is never
the smallest (the component of NULL ids alone is NULL).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm import textops
from flowtide.llm.graph import components
from flowtide.sources.settle import settle

SHINGLE = 3
SEED = 42
MAX_BITS = 2
SHARED_BYTES = 8 - MAX_BITS
MAX_LIST = 64
LAST_ID = (1 << 63) - 1  # stands for a NULL id: after all others

_LOWER = bytes(textops.LOWER.tolist())
_CHUNK = 1 << 15


def fingerprint(text: bytes) -> int:
    """Signed 64-bit SimHash of a text's word shingles, repeats included."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
    reach = min(SHINGLE, len(words)) - 1
    starts = np.concatenate([[0], blanks + 1])[: len(words) - reach].tolist()
    ends = np.concatenate([blanks, [len(line)]])[reach:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = np.array(hashes[at : at + _CHUNK], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def _free(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_fingerprint(docs: DataFrame, name: str) -> DataFrame:
    """All columns, and the fingerprint of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text) for text in textops.byte_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int64())], [*batch.schema.names, name]
            )

    schema = docs.select("*", F.lit(0).cast("bigint").alias(name)).schema
    return docs.mapInArrow(run, schema)


def _byte(column: Column, at: int) -> Column:
    return F.shiftrightunsigned(column, 8 * at).bitwiseAND(F.lit(0xFF))


def shared_bytes(left: Column, right: Column) -> Column:
    """Tally of the byte positions at which two fingerprints agree."""
    tally = F.lit(0)
    for at in range(8):
        tally += (_byte(left, at) == _byte(right, at)).cast("int")
    return tally


def paths(depth: int) -> list[tuple[int, ...]]:
    """The positions that may be the first ``depth`` ones which two linked fingerprints share."""
    return [p for p in combinations(range(8), depth) if p[-1] < depth + 8 - SHARED_BYTES]


def first_depth(count: int, max_list: int) -> int:
    """Bytes in a list's key at which evenly spread fingerprints have lists of ``max_list`` members at most."""
    depth = 1
    while depth < SHARED_BYTES and count > max_list << 8 * depth:
        depth += 1
    return depth


def _posted(prints: DataFrame, depth: int) -> DataFrame:
    """Each fingerprint under its bytes at every path: (part, value, fp); a part's bits are its positions."""
    keys = []
    for path in paths(depth):
        value = reduce(lambda found, at: found * 256 + _byte(F.col("fp"), at), path, F.lit(0).cast("bigint"))
        keys.append(F.struct(F.lit(sum(1 << p for p in path)).alias("part"), value.alias("value")))
    return prints.select("fp", F.explode(F.array(*keys)).alias("key")).select("key.part", "key.value", "fp")


def _split(listed: DataFrame, depth: int) -> DataFrame:
    """Members of lists of ``depth`` bytes, posted under one byte more."""
    part, value, fp = F.col("part"), F.col("value"), F.col("fp")
    nexts = [
        F.when(
            part < (1 << p),
            F.struct((part + (1 << p)).alias("part"), (value * 256 + _byte(fp, p)).alias("value")),
        )
        for p in range(depth, depth + 1 + 8 - SHARED_BYTES)
    ]
    deeper = listed.select("fp", F.explode(F.filter(F.array(*nexts), lambda k: k.isNotNull())).alias("key"))
    return deeper.select("key.part", "key.value", "fp")


def _list_links(short: DataFrame) -> DataFrame:
    """Linked pairs of short lists, each in the list of the first bytes that it shares."""
    left = short.select("part", "value", F.col("fp").alias("a"))
    right = short.select("part", "value", F.col("fp").alias("b"))
    a, b, part = F.col("a"), F.col("b"), F.col("part")
    first = F.lit(True)
    for p in range(7):  # a position skipped by the list: not in it, though a later one is
        skipped = (part >= (2 << p)) & (part.bitwiseAND(F.lit(1 << p)) == 0)
        first &= ~skipped | (_byte(a, p) != _byte(b, p))
    return (
        left.join(right, ["part", "value"])
        .where((a < b) & first & (shared_bytes(a, b) >= SHARED_BYTES))
        .where(F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS)
        .select("a", "b")
    )


def _links_by_neighbours(long: DataFrame) -> DataFrame:
    members = long.select("fp").distinct()
    flips = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.shiftleft(F.lit(1).cast("bigint"), i)) for i in range(64)]]
    near = members.select(F.explode(F.array(*flips)).alias("hub"), "fp")
    lowest = near.groupBy("hub").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    return near.join(lowest, "hub").select(F.col("fp").alias("a"), "b").where("a <> b")


def fingerprint_links(distinct: DataFrame, max_list: int = MAX_LIST, depth: int | None = None) -> DataFrame:
    """Links that join exactly the fingerprints reachable over ``MAX_BITS`` differing bits.

    Every linked pair is there but those of lists that stay long at six bytes, which are linked
    through common neighbours. ``depth`` is the number of bytes to begin with.
    """
    depth = first_depth(distinct.count(), max_list) if depth is None else depth
    postings, found = _posted(distinct, depth), []
    while True:
        sizes = postings.groupBy("part", "value").agg(F.count("*").alias("members")).where("members > 1")
        listed = settle(postings.join(sizes, ["part", "value"]))
        found.append(_list_links(listed.where(F.col("members") <= max_list)))
        long = listed.where(F.col("members") > max_list)
        if long.isEmpty():
            break
        if depth == SHARED_BYTES:
            found.append(_links_by_neighbours(long))
            break
        postings, depth = _split(long, depth), depth + 1
    return reduce(DataFrame.union, found)


def fingerprint_groups(prints: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """For each distinct fingerprint of (doc_id, fp): ``root``, its own smallest id ``first_key`` and the
    component's ``component_id``. NULL ids come last."""
    distinct = settle(
        prints.groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(LAST_ID))).alias("first_key"))
    )
    found = components(fingerprint_links(distinct.select("fp"), max_list), "a", "b")
    rooted = settle(
        distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first_key", F.coalesce("root", "fp").alias("root")
        )
    )
    smallest = rooted.groupBy("root").agg(F.min("first_key").alias("component_id"))
    return rooted.join(smallest, "root")


def near_duplicates(docs: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """Fingerprint and component of every document: the smallest id reachable."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    prints = settle(with_fingerprint(rows, "fp").select("doc_id", "fp"))
    groups = fingerprint_groups(prints, max_list).select("fp", "component_id")
    known = F.when(F.col("component_id") != LAST_ID, F.col("component_id"))
    return prints.join(groups, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), known.alias("component_id")
    )


def keep_one(docs: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    Rows that repeat an id with its text stay once. Documents meet the survivors by fingerprint and
    id together, so a large group of copies is spread over many tasks.
    """
    fp, key = _free(docs, "fp"), _free(docs, "first_key")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    prints = settle(with_fingerprint(rows, "fp").select("doc_id", "fp"))
    groups = fingerprint_groups(prints, max_list)
    chosen = groups.groupBy("root").agg(F.min(F.struct("first_key", "fp")).alias("first"))
    survivors = chosen.select(F.col("first.fp").alias(fp), F.col("first.first_key").alias(key))
    marked = with_fingerprint(docs, fp).withColumn(key, F.coalesce(F.col("doc_id"), F.lit(LAST_ID)))
    return marked.join(survivors, [fp, key]).dropDuplicates([fp, key]).select(*[f"`{c}`" for c in docs.columns])
