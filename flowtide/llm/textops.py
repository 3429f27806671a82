"""Words and n-grams of a batch of texts as numpy arrays.

All helpers work on the UTF-8 bytes of an Arrow string column, without a Python
object per word. Texts are taken in pieces of a bounded number of bytes; a text is never
cut, so a longer one forms a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

PIECE_BYTES = 1 << 20
LONG_WORD = 48
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)
_SPIN = np.uint64(0xD6E8FEB86659FD93)

# Byte classes: what is part of a word.
SPACED = np.ones(256, bool)  # all but the blank and 0x09 to 0x0D
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)  # ASCII letters and digits, and all that is not ASCII
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, end to end, and where each text begins. NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(what, np.uint8) if what is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = raw(column)
    view = memoryview(np.ascontiguousarray(data))
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield bytes(view[start:end])


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of ``limit`` bytes at most, or of one longer text."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


class Words:
    """The words of several texts: ``doc``, ``start`` and ``end`` of each, in order."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, member: np.ndarray):
        self.data, self.count = data, len(offsets) - 1
        inside = member[data]
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = offsets[1:-1]
        before[edges[edges < len(data)]] = False
        after[edges[edges > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1

    def per_doc(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.count)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, equal for equal words."""
        length = self.end - self.start
        value = length.astype(np.uint64) * _MIX
        active = np.flatnonzero(length <= LONG_WORD)
        for at in range(LONG_WORD):
            active = active[length[active] > at]
            if not len(active):
                break
            value[active] = (value[active] ^ self.data[self.start[active] + at]) * _STEP
        for i in np.flatnonzero(length > LONG_WORD).tolist():
            value[i] = xxhash.xxh64_intdigest(self.data[self.start[i] : self.end[i]].tobytes())
        return mixed(value)


def beginnings(words: Words, lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of the first ``n`` bytes of each longer word, for each of some lengths."""
    size = words.end - words.start
    value = np.zeros(len(size), np.uint64)
    hashes, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    active = np.arange(len(size))
    for at in range(max(lengths)):
        active = active[size[active] > at + 1]
        value[active] = (value[active] ^ words.data[words.start[active] + at]) * _STEP
        if at + 1 in lengths:
            hashes.append(mixed(value[active] ^ np.uint64(at + 1)))
            docs.append(words.doc[active])
    return np.concatenate(hashes), np.concatenate(docs)


def mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * _SPIN
    return value ^ (value >> np.uint64(29))


def word_pairs(hashes: np.ndarray, doc: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each pair of words ``gap`` places apart in one text."""
    if len(hashes) <= gap:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    same = doc[gap:] == doc[:-gap]
    apart = np.uint64(gap * int(_MIX) & (1 << 64) - 1)
    joint = mixed(hashes[:-gap] * _STEP + hashes[gap:] + apart)
    return joint[same], doc[gap:][same]


def byte_grams(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot and text of each run of four UTF-8 bytes in a text."""
    if len(data) < 4:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    wide = data.astype(np.uint32)
    gram = wide[:-3] | wide[1:-2] << np.uint32(8) | wide[2:-1] << np.uint32(16) | wide[3:] << np.uint32(24)
    slot = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    same = doc[:-3] == doc[3:]
    return slot[same].astype(np.int64), doc[:-3][same]


def slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)
