"""MinHash near-duplicates: an inverted join of signature coordinates, verified on whole shingle sets.

A text's set holds its distinct runs of five words (of all words, where it has fewer). Two texts are linked if
their sets are similar by ``SIMILARITY`` percent or more. Texts of equal words form one class; classes are what is indexed.

* A class is posted under the coordinate-value pairs of its first ``INDEXED`` minima. Similar texts share ``NEEDED`` of them,
  so any two agree within the first ``INDEXED - NEEDED + 1`` in an order that all texts use: only this prefix is posted, the
  rarest values first, as a table of 65,536 counters tells.
* Pairs that meet in a list and whose sizes allow the similarity have their collisions counted, over the indexed coordinates first; those that
  can't reach ``NEEDED`` are skipped, the others are counted over all ``COORDINATES`` and stay if they reach ``MATCHES``. Counting
  compares the lowest byte of each value, which finds no collision less.
* A pair of 85 % falls below one of the two thresholds with a chance of 4 in 100,000, a pair of 88 % with one in a million.
* Pairs that remain are confirmed on whole sets of 64-bit shingle hashes.

Lists of more than ``SHORT`` classes take two steps with the same outcome as all pairs: in blocks of about ``BLOCK`` members, all are compared
with one hub, which links most of a large group of near copies; after that only pairs of different components are counted, block
against block, each in the first list that it shares. So a group of many similar texts costs a few comparisons each, nothing is
capped, and the result doesn't depend on either constant.

Defined results: ASCII letters count in lower case; NULL texts and texts without words have empty sets and are linked with nothing;
a NULL id takes part but is never the smallest (a component of NULL ids alone is NULL, and its rows are kept); rows that repeat an id with
its text get the same row of results; an empty table gives no rows; other columns are not read, whatever their names. A text is never cut: a
long one is hashed in parts of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm import textops
from flowtide.llm.graph import components
from flowtide.sources.settle import checked_broadcast, settle

SHINGLE = 5
SIMILARITY = 85
COORDINATES, MATCHES = 256, 192
INDEXED, NEEDED = 64, 42
PREFIX = INDEXED - NEEDED + 1
SHORT = 32
BLOCK = 1024
TRIED_HUBS = 32
ORDER_SLOTS = 1 << 16
LAST_ID = (1 << 63) - 1  # stands for a NULL id: after all others

_SEEDS = np.random.default_rng(11).integers(0, 1 << 63, (2, COORDINATES), np.uint64) | np.uint64(1)
_STEP = np.uint64(0x100000001B3)
_NUMBERS = np.arange(INDEXED, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_PART = 2048  # shingles hashed at once
_COMPARED = 1 << 16  # pairs counted at once

Batches = Iterator[pa.RecordBatch]


def word_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> Iterator[tuple[bytes, np.ndarray]]:
    """Digest of the words and the sorted distinct shingle hashes of each text."""
    lowered = textops.LOWER[data]
    words = textops.Words(lowered, offsets, textops.SPACED)
    hashes, ends = words.hashes(), np.cumsum(words.per_doc())
    for doc, (first, last) in enumerate(zip(np.append(0, ends[:-1]).tolist(), ends.tolist())):
        own = hashes[first:last]
        reach = min(shingle, len(own))
        value = np.zeros(len(own) - reach + 1 if reach else 0, np.uint64)
        for i in range(reach):
            value = textops.mixed(value * _STEP + own[i : len(own) - reach + 1 + i])
        line = lowered[offsets[doc] : offsets[doc + 1]].tobytes()
        yield hashlib.blake2b(b" ".join(line.split()), digest_size=16).digest(), np.unique(value)


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, ~np.uint64(0))
    for at in range(0, len(shingles), _PART):
        part = textops.mixed(shingles[at : at + _PART] * _STEP)
        least = np.minimum(least, (part[:, None] * _SEEDS[0] + _SEEDS[1]).min(0))
    return textops.mixed(least)


def _each_text(batches: Batches, shingle: int) -> Iterator[tuple[pa.RecordBatch, list[tuple[bytes, np.ndarray]]]]:
    for batch in batches:
        data, offsets = textops.raw(batch.column("text"))
        for a, b in textops.pieces(offsets):
            part = data[offsets[a] : offsets[b]]
            yield batch.slice(a, b - a), list(word_sets(part, offsets[a : b + 1] - offsets[a], shingle))


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a two-dimensional array as binary values."""
    return pa.array([row.tobytes() for row in rows], pa.binary())


def _sign(batches: Batches, shingle: int) -> Batches:
    for batch, found in _each_text(batches, shingle):
        signed = np.array([signature(s) for _, s in found]).reshape(-1, COORDINATES)
        keys = textops.mixed(signed[:, :INDEXED] + _NUMBERS).view(np.int64)
        ends = np.arange(len(found) + 1, dtype=np.int32) * INDEXED
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array([digest for digest, _ in found], pa.binary()),
                pa.array([len(s) for _, s in found], pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(keys.ravel())),
                _binary(signed.astype(np.uint8)),
            ],
            ["id", "digest", "n", "keys", "sketch"],
        )


def _slot(key: Column) -> Column:
    return F.shiftrightunsigned(key, 48).cast("int")


def _ranked(signed: DataFrame) -> DataFrame:
    """Each class with the prefix of its list keys, rarest first.

    The order comes from counters of a fixed number; any order is right as long as all texts use the same.
    """
    tally = signed.where("n > 0").select(F.explode("keys").alias("key")).groupBy(_slot(F.col("key")).alias("slot")).count()
    counts = np.zeros(ORDER_SLOTS, np.int64)
    for row in tally.collect():
        counts[row["slot"]] = row["count"]
    shared = signed.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.asarray(batch.column("keys").flatten()).view(np.uint64).reshape(-1, INDEXED)
            often = shared.value[(keys >> np.uint64(48)).astype(np.int64)]
            first = np.take_along_axis(keys, np.lexsort((keys, often), axis=1)[:, :PREFIX], 1).view(np.int64)
            ends = np.arange(len(first) + 1, dtype=np.int32) * PREFIX
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("n"),
                    pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(first).ravel())),
                    batch.column("sketch"),
                ],
                ["node", "n", "prefix", "sketch"],
            )

    return signed.mapInArrow(run, "node bigint, n bigint, prefix array<bigint>, sketch binary")


def _sketches(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def matched(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows ``i`` and ``j`` agree at enough coordinates; all are counted only where the indexed ones do."""
    good = (left[i, :INDEXED] == right[j, :INDEXED]).sum(1) >= NEEDED
    at = np.flatnonzero(good)
    good[at] = (left[i[at]] == right[j[at]]).sum(1) >= MATCHES
    return good


class _Lists:
    """The postings of some lists, in the order of lists and blocks."""

    def __init__(self, table: pa.Table):
        self.key, self.one, self.two, self.own, self.node, self.n, self.root = (
            np.asarray(table.column(name)) for name in ("key", "one", "two", "own", "node", "n", "root")
        )
        self.sketch = _sketches(table.column("sketch"))
        prefix = table.column("prefix").combine_chunks()
        self.prefix = np.asarray(prefix.flatten()).reshape(-1, PREFIX)
        new = (self.key[1:] != self.key[:-1]) | (self.one[1:] != self.one[:-1]) | (self.two[1:] != self.two[:-1])
        self.runs = np.concatenate([[0], np.flatnonzero(new) + 1, [len(self.key)]])

    def counted(self, i: np.ndarray, j: np.ndarray, similarity: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that reach both thresholds and whose sizes allow the similarity."""
        found = [(i[:0], j[:0])]
        for at in range(0, len(i), _COMPARED):
            a, b = i[at : at + _COMPARED], j[at : at + _COMPARED]
            low, high = np.minimum(self.n[a], self.n[b]), np.maximum(self.n[a], self.n[b])
            fits = (100 * low >= similarity * high) & (self.node[a] != self.node[b])
            a, b = a[fits], b[fits]
            enough = matched(self.sketch, self.sketch, a, b)
            found.append((a[enough], b[enough]))
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])

    def once(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs whose first common list this is."""
        first = np.zeros(len(i), bool)
        for at in range(0, len(i), _PART):
            a, b = i[at : at + _PART], j[at : at + _PART]
            shared = (self.prefix[a][:, :, None] == self.prefix[b][:, None, :]).any(2)
            first[at : at + _PART] = self.prefix[a, shared.argmax(1)] == self.key[a]
        return i[first], j[first]

    def hub_pairs(self, similarity: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """In each block, all members with the one of the first few that most of them match."""
        for first, last in zip(self.runs[:-1].tolist(), self.runs[1:].tolist()):
            others = np.arange(first, last)
            tried = (np.full(len(others), hub) for hub in range(first, min(last, first + TRIED_HUBS)))
            yield max((self.counted(hub, others, similarity) for hub in tried), key=lambda pairs: len(pairs[0]))

    def cross_pairs(self, similarity: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of different components, of one block or between two."""
        for first, last in zip(self.runs[:-1].tolist(), self.runs[1:].tolist()):
            at = np.arange(first, last)
            left, right = at[self.own[at] == self.one[first]], at[self.own[at] == self.two[first]]
            for start in range(0, len(left), 256):
                part = left[start : start + 256]
                apart = self.root[part][:, None] != self.root[right][None, :]
                if self.one[first] == self.two[first]:
                    apart &= part[:, None] < right[None, :]
                i, j = np.nonzero(apart)
                yield self.once(*self.counted(part[i], right[j], similarity))

    def named(self, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Batches:
        for i, j in pairs:
            if len(i):
                a, b = np.minimum(self.node[i], self.node[j]), np.maximum(self.node[i], self.node[j])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _whole_runs(batches: Batches) -> Iterator[_Lists]:
    """Rows of a sorted partition in parts that cut no run; a run has about two blocks at most."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([*kept, batch])
            other = np.zeros(table.num_rows, bool)
            for name in ("key", "one", "two"):
                mark = np.asarray(table.column(name))
                other |= mark != mark[-1]
            last = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if last:
                yield _Lists(table.slice(0, last))
            kept = table.slice(last).to_batches()
    if kept:
        yield _Lists(pa.Table.from_batches(kept))


def _compared(postings: DataFrame, ranked: DataFrame, pairs: Callable[[_Lists], Iterator]) -> DataFrame:
    """Pairs (a, b) found in postings of key, node, members, one, two, own and root."""

    def run(batches: Batches) -> Batches:
        for lists in _whole_runs(batches):
            yield from lists.named(pairs(lists))

    held = ranked.select("node", "prefix", "sketch")
    full = postings.join(held, "node").select("key", "one", "two", "own", "node", "n", "root", "prefix", "sketch")
    dealt = full.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two", "node")
    return settle(dealt.mapInArrow(run, "a bigint, b bigint").distinct())


def _blocks(block: int) -> Column:
    return F.ceil(F.col("members") / block).cast("int")


def _own_block(block: int) -> Column:
    return F.pmod(F.xxhash64("node"), _blocks(block)).cast("int")


def _short_list_pairs(listed: DataFrame, ranked: DataFrame, short: int, similarity: int) -> DataFrame:
    """All pairs of the lists of ``short`` members at most, then counted."""
    few = listed.where(F.col("members") <= short)
    first = few.select("key", F.col("node").alias("a"), F.col("n").alias("m"))
    second = few.select("key", F.col("node").alias("b"), F.col("n").alias("k"))
    fits = (F.col("a") < F.col("b")) & (100 * F.least("m", "k") >= similarity * F.greatest("m", "k"))
    pairs = first.join(second, ["key"]).where(fits).select("a", "b").distinct()

    def run(batches: Batches) -> Batches:
        for batch in batches:
            every = np.arange(batch.num_rows)
            good = matched(_sketches(batch.column("x")), _sketches(batch.column("y")), every, every)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    left = ranked.select(F.col("node").alias("a"), F.col("sketch").alias("x"))
    right = ranked.select(F.col("node").alias("b"), F.col("sketch").alias("y"))
    both = settle(pairs).join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return settle(both.mapInArrow(run, "a bigint, b bigint"))


def _hub_pairs(listed: DataFrame, ranked: DataFrame, short: int, block: int, similarity: int) -> DataFrame:
    postings = listed.where(F.col("members") > short).withColumn("own", _own_block(block))
    postings = postings.withColumns({"one": F.col("own"), "two": F.col("own"), "root": F.col("node")})
    return _compared(postings, ranked, lambda lists: lists.hub_pairs(similarity))


def _remaining_pairs(
    listed: DataFrame, ranked: DataFrame, found: DataFrame, short: int, block: int, similarity: int
) -> DataFrame:
    """Pairs of longer lists whose members are not yet of one component."""
    rooted = settle(
        listed.where(F.col("members") > short)
        .join(found, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    several = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    other = F.explode(F.sequence(F.lit(0), _blocks(block) - 1)).alias("other")
    postings = (
        rooted.join(several.select("key"), "key", "left_semi")
        .withColumn("own", _own_block(block))
        .select("*", other)
        .withColumns({"one": F.least("own", "other"), "two": F.greatest("own", "other")})
        .drop("other")
    )
    return _compared(postings, ranked, lambda lists: lists.cross_pairs(similarity))


def _sets(rows: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """Whole shingle sets of the classes that are in a pair, from one text of each."""
    nodes = settle(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    wanted = settle(classes.join(checked_broadcast(nodes), "node").select("node", "digest", "first_key"))

    def run(batches: Batches) -> Batches:
        for _, found in _each_text(batches, shingle):
            digests, sets = [d for d, _ in found], [s.tobytes() for _, s in found]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(sets, pa.binary())], ["digest", "shingles"])

    first_keys = settle(wanted.select(F.col("first_key").alias("id")).distinct())
    texts = rows.join(checked_broadcast(first_keys), "id", "left_semi")
    found = texts.mapInArrow(run, "digest binary, shingles binary")
    return settle(found.join(checked_broadcast(wanted), "digest").select("node", "shingles").dropDuplicates(["node"]))


def _confirmed(
    pairs: DataFrame, rows: DataFrame, classes: DataFrame, similarity: int, shingle: int
) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    sets = _sets(rows, classes, pairs, shingle)
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y")
    return settle(joined.mapInArrow(run, "a bigint, b bigint"))


def _links(
    rows: DataFrame, signed: DataFrame, classes: DataFrame, similarity: int, shingle: int, short: int, block: int
) -> DataFrame:
    """Confirmed links that join exactly the classes reachable over similar pairs."""
    own = checked_broadcast(settle(classes.select("node")))
    one_each = signed.where("n > 0").join(own, F.col("row") == F.col("node"), "left_semi")
    ranked = settle(_ranked(one_each.select(F.col("row").alias("node"), "n", "keys", "sketch")))
    postings = ranked.select("node", "n", F.explode("prefix").alias("key"))
    sizes = postings.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    listed = settle(postings.join(sizes, "key"))
    pairs = _short_list_pairs(listed, ranked, short, similarity)
    if listed.where(F.col("members") > short).isEmpty():
        return _confirmed(pairs, rows, classes, similarity, shingle)
    pairs = settle(pairs.union(_hub_pairs(listed, ranked, short, block, similarity)).distinct())
    links = _confirmed(pairs, rows, classes, similarity, shingle)
    found = settle(components(links, "a", "b"))
    more = _remaining_pairs(listed, ranked, found, short, block, similarity)
    return links.union(_confirmed(more, rows, classes, similarity, shingle))


def near_duplicates(
    docs: DataFrame, similarity: int = SIMILARITY, shingle: int = SHINGLE, short: int = SHORT, block: int = BLOCK
) -> DataFrame:
    """For every document: size of its set, component (the smallest id reachable) and whether it is the one to keep.

    ``similarity`` is in percent; the thresholds are chosen for 85 or more.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("id"), "text")
    schema = "id bigint, digest binary, n bigint, keys array<bigint>, sketch binary"
    signed = rows.mapInArrow(lambda batches: _sign(batches, shingle), schema)
    signed = settle(signed.withColumn("row", F.monotonically_increasing_id()))
    classes = settle(
        signed.groupBy("digest").agg(F.min("id").alias("first_key"), F.min("row").alias("node"))
    )
    found = components(_links(rows, signed, classes, similarity, shingle, short, block), "a", "b")
    rooted = settle(classes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node")))
    smallest = rooted.groupBy("root").agg(F.min("first_key").alias("component"))
    named = rooted.join(smallest, "root").select("digest", "component")
    doc_id = F.when(F.col("id") != LAST_ID, F.col("id"))
    component = F.when(F.col("n") > 0, F.when(F.col("component") != LAST_ID, F.col("component"))).otherwise(doc_id)
    return (
        signed.select("id", "digest", "n")
        .join(named, "digest")
        .select(doc_id.alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
