"""Fill-in-the-middle transformation: cuts at units, found in a Fenwick tree over blocks of the text.

Units are runs of ASCII letters and single other code points. A text is divided into blocks of ``BLOCK`` bytes; two Fenwick trees hold
how many units and how many code points begin in each. The block in which the unit of a cut begins is found by binary-lifting
descent, the place inside it by looking at that block alone; the same trees give the number of code points ahead of a cut.

A text becomes, by hashes of its id: ``plain``, the text itself; ``psm``, prefix, suffix and middle behind their marks; ``spm``, suffix,
prefix and middle. Texts that hold a mark are left plain, so that ``restore`` always rebuilds the text.

Defined results: a NULL text counts as empty and is plain; a NULL id is hashed as an empty one; repeated rows give equal results; an empty
table gives no rows; other columns are not read, whatever their names. Texts are never cut short: a long one has more blocks. Bytes
that are not valid UTF-8 are kept as they are; a continuation byte belongs to the code point ahead of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm import textops

BLOCK = 4096
SEED = "1"
PLAIN_FROM = 90  # of 100
SPM_BELOW = 20  # of 100
# The marks.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

RESULT = (
    "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
    "output binary, restored binary, output_sha256 string, restored_sha256 string"
)

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False


class Fenwick:
    """Prefix sums of counts, and the block in which a running number falls."""

    def __init__(self, counts: np.ndarray):
        self.size = len(counts)
        self.tree = np.concatenate([[0], counts]).astype(np.int64)
        span = 1
        while span < self.size + 1:  # each level adds the nodes that end at odd multiples of the span
            parents = np.arange(2 * span, self.size + 1, 2 * span)
            self.tree[parents] += self.tree[parents - span]
            span *= 2

    def before(self, block: int) -> int:
        """Sum of the counts of the blocks ahead of this one."""
        total = 0
        while block:
            total += int(self.tree[block])
            block &= block - 1
        return total

    def find(self, number: int) -> tuple[int, int]:
        """The block that holds the item with this number, from 0, and how many of its items come first.

        For a number beyond the last item: the number of blocks, and what is left.
        """
        block, left = 0, number
        step = 1 << self.size.bit_length()
        while step:
            ahead = block + step
            if ahead <= self.size and self.tree[ahead] <= left:
                block, left = ahead, left - int(self.tree[ahead])
            step >>= 1
        return block, left


class Units:
    """Where the units and code points of a text begin, counted by block."""

    def __init__(self, text: bytes, block: int = BLOCK):
        data = np.frombuffer(text, np.uint8)
        self.block, self.size = block, len(data)
        self.lead = _LEAD[data]
        self.lead[:1] = True
        letter = _LETTER[data]
        self.first = self.lead.copy()
        self.first[1:] &= ~(letter[1:] & letter[:-1])
        starts = np.arange(0, self.size, block)
        sums = (lambda marks: np.add.reduceat(marks, starts, dtype=np.int64)) if self.size else (lambda marks: np.zeros(0, np.int64))
        self.units, self.points = Fenwick(sums(self.first)), Fenwick(sums(self.lead))
        self.count = self.units.before(self.units.size)
        self.length = self.points.before(self.points.size)

    def cut(self, number: int) -> int:
        """The byte at which the unit with this number begins; the end for the number of units."""
        block, left = self.units.find(number)
        if block == self.units.size:
            return self.size
        start = block * self.block
        return start + int(np.flatnonzero(self.first[start : start + self.block])[left])

    def points_before(self, byte: int) -> int:
        block = byte // self.block
        return self.points.before(min(block, self.points.size)) + int(self.lead[block * self.block : byte].sum())


class Infilled(NamedTuple):
    units: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def transform(doc_id: int | None, text: bytes, seed: str = SEED, block: int = BLOCK) -> Infilled:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    one, two, three, four = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    units = Units(text, block)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or three % 100 >= PLAIN_FROM:
        return Infilled(units.count, "plain", None, None, text)
    low, high = sorted(number % (units.count + 1) for number in (one, two))
    a, b = units.cut(low), units.cut(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    before = units.points_before(a)
    if four % 100 < SPM_BELOW:
        form, parts = "spm", (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    else:
        form, parts = "psm", (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    return Infilled(units.count, form, before, units.points_before(b) - before, b"".join(parts))


def restore(output: bytes, form: str) -> bytes:
    """The text, from an output and its form alone."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    head, middle = output.split(MIDDLE, 1)
    one, two = head.removeprefix(first).split(second, 1)
    return one + middle + two if form == "psm" else two + middle + one


def infill(docs: DataFrame, seed: str = SEED, block: int = BLOCK) -> DataFrame:
    """Every document with its units, form, lengths, output, rebuilt text and the digests of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = textops.raw(batch.column("text"))
            for a, b in textops.pieces(offsets):
                part = batch.slice(a, b - a)
                ids, texts = part.column("doc_id").to_pylist(), textops.byte_texts(part.column("text"))
                made = [transform(i, text, seed, block) for i, text in zip(ids, texts)]
                back = [restore(m.output, m.form) for m in made]
                sha = lambda values: [hashlib.sha256(v).hexdigest() for v in values]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([m.units for m in made], pa.int64()),
                        pa.array([m.form for m in made], pa.string()),
                        pa.array([m.prefix_chars for m in made], pa.int64()),
                        pa.array([m.middle_chars for m in made], pa.int64()),
                        pa.array([m.output for m in made], pa.binary()),
                        pa.array(back, pa.binary()),
                        pa.array(sha(m.output for m in made), pa.string()),
                        pa.array(sha(back), pa.string()),
                    ],
                    [field.split()[0] for field in RESULT.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, RESULT)
