"""SentencePiece encoding and decoding on the tokenizers library.

The model file is a protobuf; its pieces, scores, types and normaliser settings are read here by
field number. From them a ``tokenizers`` model is rebuilt: a unigram model with its scores, or, where the
trainer says BPE, the merges that the scores imply, either with byte fallback. The normaliser
writes blanks as the marker and puts one in front.

Where no piece has the marker behind another character, no piece crosses from one marked word to the next, and
words can be encoded on their own: each distinct one is encoded once per worker, in
batches over several threads, and kept in a table of two halves of bounded size: a full half becomes the older
one, and only words that neither holds are encoded again. Each encoding is compared with the reference library's. Documents are read once, without a shuffle.

Defined results: NULL and empty texts have no tokens; repeated rows are encoded alike; a text that
holds the marker itself can't be told from one with blanks, so its ``round_trip`` is false.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from flowtide.llm import textops

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
TABLE_ROWS = 1 << 17
ENCODED_AT_ONCE = 1 << 12
THREADS = 2
# Piece types, model types and field numbers of the model file.
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
PIECES, TRAINER, NORMALIZER = 1, 2, 3

RESULT = "doc_id bigint, n_tokens bigint, ids_sha256 string, round_trip boolean, parity boolean"
TOKENS = "doc_id bigint, ids array<int>, n_tokens bigint, round_trip boolean, parity boolean"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protobuf message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            if size is None:
                if key & 7 != 2:
                    raise ValueError(f"wire type {key & 7} in the model file")
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class Model(NamedTuple):
    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    dummy_prefix: bool
    squeeze: bool
    charsmap: bytes

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)

    @property
    def words_apart(self) -> bool:
        """Whether no piece has the marker behind another character, so that words are encoded alone."""
        return not any(MARK in piece.lstrip(MARK) for piece, _, kind in self.pieces if kind != CONTROL)


def parse_model(data: bytes) -> Model:
    pieces, trainer, normalizer = [], {}, {}
    for number, value in message(data):
        if number == PIECES:
            found = dict(message(value))
            score = struct.unpack("<f", found[2])[0] if 2 in found else 0.0
            pieces.append((found[1].decode(), score, found.get(3, NORMAL)))
        elif number == TRAINER:
            trainer = dict(message(value))
        elif number == NORMALIZER:
            normalizer = dict(message(value))
    return Model(
        pieces,
        trainer.get(3, UNIGRAM),
        bool(trainer.get(35, 0)),
        bool(normalizer.get(3, 1)),
        bool(normalizer.get(4, 1)),
        normalizer.get(2, b""),
    )


def merges_of(model: Model) -> list[tuple[str, str]]:
    """Pairs in the order in which their joint piece is preferred: by its score."""
    vocabulary = {piece: i for i, (piece, _, _) in enumerate(model.pieces)}
    found = []
    for piece, score, kind in model.pieces:
        if kind in (NORMAL, USER):
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in vocabulary and right in vocabulary:
                    found.append((-score, vocabulary[piece], vocabulary[left], vocabulary[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build_tokenizer(model: Model) -> Tokenizer:
    """The whole tokenizer: normaliser, model with byte fallback, decoder."""
    if model.kind == UNIGRAM:
        scored = [(piece, score) for piece, score, _ in model.pieces]
        core = models.Unigram(scored, unk_id=model.unknown, byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        vocabulary = {piece: i for i, (piece, _, _) in enumerate(model.pieces)}
        core = models.BPE(
            vocabulary,
            merges_of(model),
            unk_token=model.pieces[model.unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError(f"model type {model.kind} of the model file")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip(left=True, right=True)]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    tokenizer.decoder = decoders.Sequence(
        [
            decoders.Replace(MARK, " "),
            decoders.ByteFallback(),
            decoders.Fuse(),
            *([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []),
        ]
    )
    return tokenizer


class Codec:
    """Encodes and decodes the texts of one worker."""

    _SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

    def __init__(self, data: bytes, table_rows: int = TABLE_ROWS, check: bool = True):
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))  # read when the library starts its threads
        self.model = parse_model(data)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data) if check else None
        self.apart = self.model.words_apart and not self.model.charsmap and not self.model.squeeze
        self.tokenizer = build_tokenizer(self.model)
        if self.apart:
            self.tokenizer.normalizer = normalizers.Sequence([])
        self.table: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.table_rows, self.differ = table_rows, set()
        self.bytes_of = [self._bytes(piece, kind) for piece, _, kind in self.model.pieces]

    def forget(self) -> None:
        """Empty the table of words."""
        self.table, self.older, self.differ = {}, {}, set()

    @staticmethod
    def _bytes(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:-1], 16)])
        if kind in (CONTROL, UNKNOWN):
            return b"" if kind == CONTROL else " ⁇ ".encode()
        return piece.replace(MARK, " ").encode()

    def segments(self, text: str) -> list[str]:
        """The normal form of a text in parts that are encoded on their own."""
        if not text:
            return []
        if self.model.dummy_prefix and MARK not in text:
            words = text.split(" ")
            if "" not in words:
                return [MARK + word for word in words]
        marked = text.replace(" ", MARK)
        return self._SEGMENT.findall(MARK + marked if self.model.dummy_prefix else marked)

    def _learn(self, segments: set[str]) -> None:
        """Encode what is in neither half of the table; what the older half has moves to the newer one."""
        if len(self.table) + len(segments) > self.table_rows // 2:
            self.older, self.table = self.table, {}
            self.differ.intersection_update(self.older)
        older, table = self.older, self.table
        fresh = []
        for segment in segments:
            if segment in older:
                table[segment] = older[segment]
            elif segment not in table:
                fresh.append(segment)
        for at in range(0, len(fresh), ENCODED_AT_ONCE):
            part = fresh[at : at + ENCODED_AT_ONCE]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            table.update(zip(part, [array("i", ids).tobytes() for ids in found]))
            if self.reference:
                self._compare(part, found)

    def _compare(self, segments: list[str], found: list[list[int]]) -> None:
        """Note the segments that the reference encodes otherwise. It puts its own marker in front, so one is
        taken off first."""
        prefixed = self.model.dummy_prefix
        own = [(s, s[1:], ids) for s, ids in zip(segments, found) if s[0] == MARK] if prefixed else [(s, s, ids) for s, ids in zip(segments, found)]
        theirs = self.reference.encode([text for _, text, _ in own], num_threads=1)
        self.differ.update([s for (s, text, ids), other in zip(own, theirs) if ids != other and text])

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """Token ids as 32-bit integers, and whether the reference library agrees."""
        if not self.apart:
            theirs = self.reference.encode(texts, num_threads=1) if self.reference else None
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids = [f.ids if t else [] for f, t in zip(found, texts)]
            same = [True] * len(ids) if theirs is None else [a == b for a, b in zip(ids, theirs)]
            return [(struct.pack(f"<{len(i)}i", *i), s) for i, s in zip(ids, same)]
        parts = [self.segments(text) for text in texts]
        fresh = set().union(*parts).difference(self.table)
        if fresh:
            held = self.table
            self._learn(fresh)
            if self.table is not held:  # a new half begins: it takes all of this group
                self._learn(set().union(*parts))
        known, differ = self.table.__getitem__, self.differ
        return [(b"".join(map(known, part)), not differ or differ.isdisjoint(part)) for part in parts]

    def decode(self, ids: bytes) -> bytes:
        """The text in UTF-8."""
        line = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<i4").tolist()))
        return line[1:] if self.model.dummy_prefix and line[:1] == b" " else line


GROUP_BYTES = 1 << 18


@lru_cache(maxsize=1)
def _codec(data: bytes) -> Codec:
    """One codec for all tasks of a worker; building it takes most of a second."""
    return Codec(data)


def _groups(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of ``GROUP_BYTES`` in all, or one longer text, with the place of the first."""
    _, offsets = textops.raw(column)
    for a, b in textops.pieces(offsets, GROUP_BYTES):
        yield a, [text or "" for text in column.slice(a, b - a).to_pylist()]


def encode_documents(docs: DataFrame, model_path: str = MODEL_PATH, *, with_ids: bool = True) -> DataFrame:
    """Token ids of every document, or a digest of them; the model file is read on the driver."""
    with open(model_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        gc.disable()  # millions of short lists, none of them in a circle
        try:
            for batch in batches:
                yield from encoded(codec, batch)
        finally:
            codec.forget()
            gc.enable()

    def encoded(codec: Codec, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows:
            ids = batch.column("doc_id")
            for at, group in _groups(batch.column("text")):
                rows = codec.encode(group)
                back = [codec.decode(row) == text.encode() for (row, _), text in zip(rows, group)]
                length = np.array([len(row) // 4 for row, _ in rows], np.int64)
                columns = {"doc_id": ids.slice(at, len(group))}
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    flat = np.frombuffer(b"".join([row for row, _ in rows]), "<i4")
                    columns["ids"] = pa.ListArray.from_arrays(ends, pa.array(flat))
                columns["n_tokens"] = pa.array(length)
                if not with_ids:
                    columns["ids_sha256"] = pa.array([hashlib.sha256(row).hexdigest() for row, _ in rows])
                columns["round_trip"] = pa.array(back)
                columns["parity"] = pa.array([same for _, same in rows])
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(run, TOKENS if with_ids else RESULT)
