"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are lower-cased and every run of other ASCII characters than letters and digits becomes one
blank. An item is read through windows of ``WINDOW_WORDS`` words that begin ``STRIDE_WORDS`` words apart (the
last ends with the item), so every passage of ``WINDOW_WORDS + STRIDE_WORDS - 1`` words or more holds a whole
one; an item of fewer words than a window is one window. A window of m bytes may differ by ``min(m // EDIT_BYTES, m // GRAM - 1)``
edits; cut into one piece more than that, at least one piece stands unchanged in any such
place. The first ``GRAM`` bytes of all pieces are looked up at every position of a text, the places
found are sifted by Myers' bit-parallel distance, many at once, and what is left is verified with it one by one.

What a window finds is measured on the longer segments of ``SEGMENT_WORDS`` words or more around it.
Such a segment may differ by as many edits as can't spoil all of the disjoint windows in it, so none is missed.

Items are searched in blocks of bounded size, one pass over the documents each, so what is
shipped to the executors doesn't grow with the benchmark. Texts are never shuffled.

Defined results: NULL texts are empty and have no hits; items of fewer than ``MIN_WORDS`` words (NULL and empty ones
among them) would be found by chance and are not searched; repeated rows of either table are
reported alike; of several places of an item in a text those of a segment count before those of a window
alone, then the closest, then the first. Segments are numbered first, windows after them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm import textops

WINDOW_WORDS = 8
STRIDE_WORDS = 2
SEGMENT_WORDS = 16
GRAM = 8
EDIT_BYTES = 10
MIN_WORDS = 5
BLOCK_BYTES = 4 << 20

RESULT = "doc_id bigint, item_id bigint, distance int, segment int"

# Letters in lower case, digits and all beyond ASCII stay; the rest are blanks.
_PLAIN = bytes(textops.LOWER[b] if textops.ALNUM[b] else 0x20 for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SIFT_BYTES = 64  # of a window, as many as a machine word has bits
_SLICE = 1 << 14  # places sifted at once


def plain_bytes(text: bytes) -> bytes:
    """Normal form, with a blank at either end."""
    return b" %b " % b" ".join(text.decode().lower().encode().translate(_PLAIN).split())


def plain(text: bytes) -> str:
    """Normal form, one character per UTF-8 byte, with a blank at either end."""
    return plain_bytes(text).decode("latin-1")


class Segment(NamedTuple):
    item: int
    number: int
    text: str
    budget: int
    first: int = 0  # byte of the item's normal form
    window: bool = False


def window_budget(length: int) -> int:
    """Edits that a window may have; its pieces are never shorter than ``GRAM`` bytes."""
    return max(0, min(length // EDIT_BYTES, length // GRAM - 1))


def segments(item: int, text: str | None) -> list[Segment]:
    """Segments of an item, then its windows. An item of one window has no others."""
    words = plain((text or "").encode()).split()
    count = len(words)
    if count < MIN_WORDS:
        return []
    starts = [0]
    for word in words:
        starts.append(starts[-1] + len(word) + 1)
    last = max(0, count - WINDOW_WORDS)
    spans = [(a, min(a + WINDOW_WORDS, count)) for a in sorted({*range(0, last + 1, STRIDE_WORDS), last})]
    budgets = [window_budget(starts[b] - 1 - starts[a]) for a, b in spans]
    found = []
    if last:
        parts = max(1, count // SEGMENT_WORDS)
        cuts = [i * count // parts // STRIDE_WORDS * STRIDE_WORDS for i in range(parts)] + [count]
        for a, b in zip(cuts[:-1], cuts[1:]):
            total, at = 0, a
            for (c, d), budget in zip(spans, budgets):
                if at <= c and d <= b:
                    total, at = total + budget + 1, d
            found.append(Segment(item, len(found), " ".join(words[a:b]), total - 1, starts[a]))
    for (a, b), budget in zip(spans, budgets):
        found.append(Segment(item, len(found), " ".join(words[a:b]), budget, starts[a], True))
    return found


def piece_cuts(length: int, budget: int) -> list[int]:
    """Where the ``budget + 1`` pieces begin, and the end."""
    return [i * length // (budget + 1) for i in range(budget + 2)]

def myers(pattern: str, text: str, budget: int) -> int | None:
    """Smallest edit distance of ``pattern`` to any part of ``text``, if within ``budget``.

    One bit vector of the pattern's length per step over the text.
    """
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << len(pattern) - 1
    up, down, score = full, 0, len(pattern)
    best = score
    for c in text:
        same = masks.get(c, 0)
        across = same | down
        along = ((same & up) + up ^ up) | same
        rise, fall = down | ~(along | up) & full, up & along
        score += bool(rise & top) - bool(fall & top)
        best = min(best, score)
        rise, fall = rise << 1 & full, fall << 1 & full
        up, down = fall | ~(across | rise) & full, rise & across
    return best if best <= budget else None


class Matcher:
    """Index of the pieces of all windows of a block of items."""

    def __init__(self, items: list[tuple[int, str | None]]):
        self.windows: list[Segment] = []
        self.around: list[list[Segment]] = []
        grams, owners, places = [], [], []
        for item, text in items:
            parts = segments(item, text)
            longer = [s for s in parts if not s.window]
            for window in parts[len(longer) :]:
                if not longer:  # a whole item without edits stands between blanks
                    window = window if window.budget else window._replace(text=f" {window.text} ")
                end = window.first + len(window.text)
                self.around.append([s for s in longer if s.first <= window.first and end <= s.first + len(s.text)])
                for at in piece_cuts(len(window.text), window.budget)[:-1]:
                    grams.append(window.text[at : at + GRAM].encode("latin-1"))
                    owners.append(len(self.windows))
                    places.append(at)
                self.windows.append(window)
        self.empty = not grams
        if self.empty:
            return
        keys = np.frombuffer(b"".join(grams), "<u8")
        order = np.argsort(keys, kind="stable")
        self.keys, self.begin = np.unique(keys[order], return_index=True)
        self.begin = np.append(self.begin, len(keys))
        self.owners, self.places = np.array(owners)[order], np.array(places)[order]
        self.shift = np.uint64(64 - max(16, min(24, len(keys).bit_length() + 5)))
        self.known = np.zeros(1 << 64 - int(self.shift), bool)
        self.known[(self.keys * _MIX) >> self.shift] = True
        self.budgets = np.array([w.budget for w in self.windows])
        lengths = np.array([min(_SIFT_BYTES, len(w.text)) for w in self.windows])
        self.lengths, self.top = lengths, np.uint64(1) << (lengths - 1).astype(np.uint64)
        # Bytes are told apart by their lower five bits here: a sifted place can only seem closer than it is.
        self.masks = np.zeros((len(self.windows), 32), np.uint64)
        heads = b"".join(w.text[:_SIFT_BYTES].encode("latin-1").ljust(_SIFT_BYTES, b"\0") for w in self.windows)
        heads = np.frombuffer(heads, np.uint8).reshape(-1, _SIFT_BYTES) & 31
        for i in range(_SIFT_BYTES):
            rows = np.flatnonzero(lengths > i)
            self.masks[rows, heads[rows, i]] |= np.uint64(1 << i)

    def _places(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Window and expected start of each place where one of its pieces stands, in bounded parts."""
        grams = np.ndarray(len(data) - GRAM + 1, "<u8", data, strides=(1,))
        at = np.flatnonzero(self.known[(grams * _MIX) >> self.shift])
        key = np.minimum(np.searchsorted(self.keys, grams[at]), len(self.keys) - 1)
        true = self.keys[key] == grams[at]
        at, key = at[true], key[true]
        many = self.begin[key + 1] - self.begin[key]
        ends = np.cumsum(many)
        total = int(ends[-1]) if len(ends) else 0
        for first in range(0, total, _SLICE):
            number = np.arange(first, min(first + _SLICE, total))
            hit = np.searchsorted(ends, number, side="right")
            entry = self.begin[key[hit]] + number - (ends[hit] - many[hit])
            yield self.owners[entry], at[hit] - self.places[entry]

    def _sift(self, data: np.ndarray, window: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Which places may be within the budget, by Myers' distance of the window's first bytes."""
        budget, top = self.budgets[window], self.top[window]
        score = self.lengths[window].copy()
        steps = int((score + 2 * budget).max())
        row, best = window * 32, score.copy()
        masks, at = self.masks.ravel(), start - budget
        up, down = np.full(len(window), ~np.uint64(0)), np.zeros(len(window), np.uint64)
        for _ in range(steps):
            same = masks[row + data.take(at, mode="clip")]
            across = same | down
            along = ((same & up) + up ^ up) | same
            rise, fall = down | ~(along | up), up & along
            score += (rise & top) != 0
            score -= (fall & top) != 0
            np.minimum(best, score, out=best)
            rise, fall = rise << np.uint64(1), fall << np.uint64(1)
            up, down = fall | ~(across | rise), rise & across
            at += 1
        return best <= budget

    def _found(self, lines: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """Each line that may hold an item, with the windows and starts that may be within their budgets."""
        data = np.frombuffer(b"".join(lines) + bytes(GRAM), np.uint8)
        low, ends = data & 31, np.cumsum([len(line) for line in lines])
        kept = [np.zeros((0, 2), np.int64)]
        for window, start in self._places(data):
            good = self._sift(low, window, start)
            kept.append(np.stack([window[good], start[good]], 1))
        places = np.unique(np.concatenate(kept), axis=0)
        # a piece of the window lies in the line, its start may lie a few edits before
        line = np.searchsorted(ends, places[:, 1] + self.budgets[places[:, 0]], side="right")
        order = np.argsort(line, kind="stable")
        for number, group in zip(*_runs(line[order], places[order])):
            first = int(ends[number]) - len(lines[number])
            yield number, [(w, s - first) for w, s in group.tolist()]

    def _distance(self, segment: Segment, line: bytes, start: int) -> int | None:
        reach = segment.budget
        stretch = line[max(0, start - reach) : max(0, start + len(segment.text) + reach)].decode("latin-1")
        return 0 if segment.text in stretch else myers(segment.text, stretch, reach) if reach else None

    def _line_hits(self, line: bytes, places: list[tuple[int, int]]) -> dict[int, tuple[int, int]]:
        found: dict[int, tuple[int, int]] = {}
        tried = set()
        for w, start in places:
            for segment in self.around[w]:
                begin = start - (self.windows[w].first - segment.first)
                if (segment, begin) not in tried:
                    tried.add((segment, begin))
                    distance = self._distance(segment, line, begin)
                    if distance is not None:
                        best = (distance, segment.number)
                        found[segment.item] = min(found.get(segment.item, best), best)
        alone: dict[int, tuple[int, int]] = {}
        for w, start in places:
            window = self.windows[w]
            if window.item not in found:
                distance = self._distance(window, line, start)
                if distance is not None:
                    best = (distance, window.number)
                    alone[window.item] = min(alone.get(window.item, best), best)
        return found | alone

    def all_hits(self, texts: list[bytes]) -> list[dict[int, tuple[int, int]]]:
        """Distance and segment of each item that each text holds."""
        hits: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
        for first, lines in _groups([] if self.empty else texts):
            for number, places in self._found(lines):
                hits[first + number] = self._line_hits(lines[number], places)
        return hits

    def hits(self, text: bytes) -> dict[int, tuple[int, int]]:
        """Distance and segment of each item that a text holds."""
        return self.all_hits([text])[0]

    def clean(self, texts: list[bytes]) -> list[bool]:
        """Whether each text holds no item. A segment within its budget holds a window within its own."""
        clean = [True] * len(texts)
        for first, lines in _groups([] if self.empty else texts):
            for number, places in self._found(lines):
                held = (self._distance(self.windows[w], lines[number], start) is not None for w, start in places)
                clean[first + number] = not any(held)
        return clean


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Equal neighbouring keys with their values."""
    if not len(keys):
        return [], []
    at = np.flatnonzero(np.diff(keys)) + 1
    return keys[np.append(0, at)].tolist(), np.split(values, at)


def _groups(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Normal forms of neighbouring texts of a bounded size, or of one longer text, with the first one's number."""
    for a, b in textops.pieces(np.cumsum([0, *map(len, texts)])):
        yield a, [plain_bytes(t) for t in texts[a:b]]


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str | None]]]:
    """Distinct items in blocks of ``block_bytes`` of text, or of one longer item.

    The rows stream to the driver one partition at a time and leave it block by block.
    """
    size, block = 0, []
    distinct = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    for row in distinct.toLocalIterator():
        length = len(row["text"]) * 2
        if block and size + length > block_bytes:
            yield block
            size, block = 0, []
        block.append((row["item_id"], row["text"]))
        size += length
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each document with each item found in it: ids, the distance and which segment."""
    rows, spark = docs.select("doc_id", "text"), docs.sparkSession
    found = None
    for block in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value)
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                texts = list(textops.byte_texts(batch.column("text")))
                hits = [
                    (doc, item, *best)
                    for doc, found in zip(ids, matcher.all_hits(texts))
                    for item, best in sorted(found.items(), key=str)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([h[i] for h in hits], kind)
                        for i, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))
                    ],
                    ["doc_id", "item_id", "distance", "segment"],
                )

        part = rows.mapInArrow(run, RESULT)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], RESULT) if found is None else found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    spark = docs.sparkSession
    for block in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value)
            for batch in batches:
                clean = matcher.clean(list(textops.byte_texts(batch.column("text"))))
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
