"""Quality rules: plain counts, and a calibrated n-gram regression on what passes them.

The regression reads hashed word n-grams (one and two words) and character n-grams
(four UTF-8 units), each family with the norm of its text, and is fitted on a bounded sample of
labelled rows. A part of the sample is kept back to turn scores into probabilities. Scoring reads
whole texts in Arrow batches, without a shuffle; the weights take ``16 * 2**BITS`` bytes whatever
the input.

Defined results: a NULL text counts as an empty one; an empty or short text fails the base
rules; repeated rows are judged alike; NULL ids are kept. Without labels of
both kinds the base rules alone decide if all labels are good or there are none.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowtide.llm import sampling, textops
from flowtide.llm.linear import Sparse, fit_logistic, fit_scale, sigmoid

BITS = 16
SAMPLE_ROWS = 3000
CALIBRATION_SHARE = 0.25
KEEP_AT = 0.5

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

RESULT = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, score double"
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in runs of ``window`` words that occur twice or more.

    Runs are numbered by doubling their length, so equal numbers mean equal words.
    """
    seen: dict[bytes, int] = {}
    rank = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    length = 1
    while length < window:
        step = min(length, window - length)
        if len(rank) <= step:
            return 0
        rank = np.unique(rank[:-step] * (rank.max() + 1) + rank[step:], return_inverse=True)[1]
        length += step
    twice = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    edge[: len(twice)] += twice
    edge[window : window + len(twice)] -= twice
    return int((np.cumsum(edge) > 0).sum())


def _docs_with_repeats(hashes: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """Texts in which two runs of words have the same hash; none with a repeat is missed."""
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    last = len(hashes) - window + 1
    run = doc[:last].astype(np.uint64)
    for at in range(window):
        run = run * np.uint64(0x9E3779B97F4A7C15) + hashes[at : at + last]
    within = doc[window - 1 :] == doc[:last]
    run, where = run[within], doc[:last][within]
    ordered = np.sort(run)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    return np.unique(where[np.isin(run, again)]) if len(again) else np.zeros(0, np.int64)


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def base_counts(data: np.ndarray, offsets: np.ndarray, words: textops.Words, hashes: np.ndarray) -> dict:
    """The counts of the base rules for each text of a piece."""
    total = words.per_doc()
    starts = textops.SPACED[data] & ((data & 0xC0) != 0x80)
    sums = {}
    for name, member in (("word_chars", starts), ("n_symbols", SYMBOL[data])):
        running = np.concatenate([[0], np.cumsum(member, dtype=np.int64)])
        sums[name] = running[offsets[1:]] - running[offsets[:-1]]
    view = memoryview(np.ascontiguousarray(data))
    bounds = offsets.tolist()
    lines = [_repeated_lines(bytes(view[a:b])) for a, b in zip(bounds[:-1], bounds[1:])]
    repeats = np.zeros(words.count, np.int64)
    for i in _docs_with_repeats(hashes, words.doc, WINDOW).tolist():
        repeats[i] = repeated_words(bytes(view[bounds[i] : bounds[i + 1]]).split())
    failed = (total < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * total)
    return {
        "n_words": total,
        **sums,
        "n_dup_lines": np.array(lines, np.int64),
        "n_repeat_words": repeats,
        "base_failed": failed,
    }


def _grams(data, offsets, words, hashes) -> list[tuple[np.ndarray, np.ndarray]]:
    """Slots and texts of the two families; the second one lies above the first."""
    pair, pair_doc = textops.word_pairs(hashes, words.doc, 1)
    word_slot = textops.slots(np.concatenate([hashes, pair]), BITS)
    byte_slot, byte_doc = textops.byte_grams(data, offsets, BITS)
    return [(word_slot, np.concatenate([words.doc, pair_doc])), (byte_slot + (1 << BITS), byte_doc)]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slots and values of each labelled text."""
    for batch in batches:
        data, offsets = textops.raw(batch.column("text"))
        for a, b in textops.pieces(offsets):
            part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            words = textops.Words(part, own, textops.SPACED)
            slot, value, doc = [], [], []
            for found, where in _grams(part, own, words, words.hashes()):
                norm = np.sqrt(np.maximum(np.bincount(where, minlength=b - a), 1))
                key, count = np.unique(where * (4 << BITS) + found, return_counts=True)
                doc.append(key // (4 << BITS))
                slot.append(key % (4 << BITS))
                value.append(count / norm[doc[-1]])
            slot, value, doc = map(np.concatenate, (slot, value, doc))
            order = np.argsort(doc, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=b - a))]).astype(np.int32)
            rows = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("_order"),
                    rows.column("_id"),
                    rows.column("_label"),
                    pa.ListArray.from_arrays(ends, pa.array(slot[order].astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(value[order].astype(np.float32))),
                ],
                ["_order", "_id", "_label", "slot", "value"],
            )


FEATURES = "_order bigint, _id bigint, _label int, slot array<int>, value array<float>"


def sparse_rows(table: pa.Table) -> tuple[Sparse, np.ndarray]:
    """Feature rows in the order of their hash, so that partitions don't matter."""
    table = table.sort_by([("_order", "ascending"), ("_id", "ascending")]).combine_chunks()
    slots = table["slot"].combine_chunks()
    lengths = np.diff(slots.offsets.to_numpy())
    x = Sparse(
        slots.flatten().to_numpy(),
        table["value"].combine_chunks().flatten().to_numpy().astype(np.float64),
        np.repeat(np.arange(len(lengths)), lengths),
        len(lengths),
    )
    return x, table["_label"].to_numpy().astype(np.float64)


def calibration_part(rows: int, share: float = CALIBRATION_SHARE) -> np.ndarray:
    """Rows kept back for calibration: the last ones by hash order."""
    return np.arange(rows) >= rows - int(rows * share)


def _fit(table: pa.Table | None) -> bytes:
    weights, bias, scale = np.zeros(2 << BITS), 0.0, (1.0, 0.0)
    if table is not None and table.num_rows:
        x, y = sparse_rows(table)
        kept_back = calibration_part(x.rows)
        weights, bias = fit_logistic(x.pick(~kept_back), y[~kept_back], 2 << BITS)
        scale = fit_scale(x.pick(kept_back).times(weights) + bias, y[kept_back])
    out = io.BytesIO()
    np.savez(out, weights=weights, scale=np.array([scale[0], scale[1], bias]))
    return out.getvalue()


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> bytes:
    """The fitted model, about a megabyte."""
    sample = sampling.sampled_rows(docs, sampling.known_labels(labels, "quality", rows))
    return sampling.fit_once(sample.mapInArrow(_features, FEATURES), _fit)


class Scorer:
    def __init__(self, model: bytes):
        stored = np.load(io.BytesIO(model))
        self.weights = stored["weights"]
        self.slope, self.shift, self.bias = stored["scale"].tolist()

    def probability(self, data, offsets, words, hashes) -> np.ndarray:
        score = np.full(words.count, self.bias)
        for found, where in _grams(data, offsets, words, hashes):
            norm = np.sqrt(np.maximum(np.bincount(where, minlength=words.count), 1))
            score += np.bincount(where, self.weights[found], minlength=words.count) / norm
        return sigmoid(self.slope * score + self.shift)


def judge(column: pa.Array, scorer: Scorer, keep_at: float = KEEP_AT) -> dict[str, np.ndarray]:
    """Counts, score and verdict of every text of a column."""
    data, offsets = textops.raw(column)
    found: list[dict] = []
    for a, b in textops.pieces(offsets):
        part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        words = textops.Words(part, own, textops.SPACED)
        hashes = words.hashes()
        rows = base_counts(part, own, words, hashes)
        rows["score"] = scorer.probability(part, own, words, hashes)
        rows["kept"] = ~rows["base_failed"] & (rows["score"] >= keep_at)
        found.append(rows)
    return {k: np.concatenate([rows[k] for rows in found]) for k in found[0]} if found else {}


def score_quality(docs: DataFrame, model: bytes, keep_at: float = KEEP_AT) -> DataFrame:
    """Counts, score and verdict of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            if batch.num_rows:
                rows = judge(batch.column("text"), scorer, keep_at)
                columns = {"doc_id": batch.column("doc_id"), **{k: pa.array(v) for k, v in rows.items()}}
                yield pa.RecordBatch.from_pydict({k.split()[0]: columns[k.split()[0]] for k in RESULT.split(", ")})

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def keep_good(docs: DataFrame, model: bytes, keep_at: float = KEEP_AT) -> DataFrame:
    """The documents that pass, with all their columns; no join is needed."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(judge(batch.column("text"), scorer, keep_at)["kept"]))

    return docs.mapInArrow(run, docs.schema)
