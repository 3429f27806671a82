"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A word is a run of ASCII letters and digits and of any characters beyond ASCII, A-Z lower-cased. A text's features
are its distinct words, neighbouring pairs and pairs with one word between, hashed to
``2**BITS`` slots. Inflected words share a stem rather than a form, so words also count by their first
bytes (``STEMS``), and a word or stem that a text repeats (``REPEATS`` times) is a further feature. Training goes once through a bounded sample per pass, with a
rate of its own for each slot; the L1 term leaves most weights at exactly zero. What is
broadcast are the slots and values of the others, ``12 * 2**BITS`` bytes at the very most.

Defined results: a NULL text counts as empty; an empty text scores by the bias alone; repeated
rows score alike; a NULL id is not held out. Without labels of both kinds every score
is that class (or 0 without any label).
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowtide.llm import sampling, textops
from flowtide.llm.linear import sigmoid

BITS = 20
SAMPLE_ROWS = 10000
PASSES = 5
STEMS = (5, 7)
REPEATS = (2, 4)
MIN_ROWS = 3  # slots of fewer sample rows take no part
ALPHA, BETA, L1, L2 = 2.0, 1.0, 6.0, 0.0
REJECT_AT = 0.5

FEATURES = "_order bigint, _id bigint, _label int, slot array<int>"
RESULT = "doc_id bigint, held_out boolean, score double, predicted int"


MASK = (1 << BITS) - 1


def _again(slot: np.ndarray, times: int) -> np.ndarray:
    """Slot of the feature that a word's or stem's slot occurs so often in a text."""
    return textops.slots(textops.mixed(slot.astype(np.uint64) + np.uint64(times << BITS)), BITS)


def _grams(data: np.ndarray, offsets: np.ndarray, used: np.ndarray | None = None, leads: np.ndarray | None = None):
    """Text and slot of each feature as one number, ``text << BITS | slot``, distinct and in order.

    ``used`` tells the slots that are asked for, ``leads`` those of them and of words whose repetition is.
    """
    words = textops.Words(textops.LOWER[data], offsets, textops.ALNUM)
    hashes = words.hashes()
    stem, stem_doc = textops.beginnings(words, STEMS)
    near, near_doc = textops.word_pairs(hashes, words.doc, 1)
    skip, skip_doc = textops.word_pairs(hashes, words.doc, 2)
    single = textops.slots(np.concatenate([hashes, stem]), BITS)
    single |= np.concatenate([words.doc, stem_doc]) << BITS
    joint = textops.slots(np.concatenate([near, skip]), BITS)
    joint |= np.concatenate([near_doc, skip_doc]) << BITS
    if used is not None:
        single, joint = single[leads[single & MASK]], joint[used[joint & MASK]]
    single, count = np.unique(single, return_counts=True)
    again = [k - (k & MASK) + _again(k & MASK, n) for n in REPEATS for k in (single[count >= n],)]
    key = np.unique(np.concatenate([single, *again, joint]))
    return key if used is None else key[used[key & MASK]]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = textops.raw(batch.column("text"))
        for a, b in textops.pieces(offsets):
            key = _grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            ends = np.searchsorted(key, np.arange(b - a + 1) << BITS).astype(np.int32)
            rows = batch.slice(a, b - a)
            found = pa.ListArray.from_arrays(ends, pa.array((key & MASK).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in ("_order", "_id", "_label")], found],
                ["_order", "_id", "_label", "slot"],
            )


class Ftrl:
    """Per-coordinate follow-the-regularised-leader; the last slot is the bias, without L1."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, slot: np.ndarray) -> np.ndarray:
        z, l1 = self.z[slot], np.where(slot == len(self.z) - 1, 0.0, L1)
        active = np.maximum(np.abs(z) - l1, 0)
        return -np.sign(z) * active / ((BETA + np.sqrt(self.n[slot])) / ALPHA + L2)

    def learn(self, slot: np.ndarray, label: float) -> None:
        weights = self.weights(slot)
        error = float(sigmoid(weights.sum())) - label
        n = self.n[slot]
        self.n[slot] = n + error * error
        self.z[slot] += error - (np.sqrt(n + error * error) - np.sqrt(n)) / ALPHA * weights


def _fit(table: pa.Table | None) -> bytes:
    size = 1 << BITS
    slot, value, bias = np.zeros(0, np.int64), np.zeros(0), -40.0
    if table is not None and table.num_rows:
        table = table.sort_by([("_order", "ascending"), ("_id", "ascending")])
        labels = table["_label"].to_numpy().astype(np.float64)
        rows = table["slot"].combine_chunks()
        ends, flat = rows.offsets.to_numpy(), rows.flatten().to_numpy()
        if 0 < labels.sum() < len(labels):
            model = Ftrl(size)
            common = np.bincount(flat, minlength=size) >= MIN_ROWS
            texts = [flat[a:b][common[flat[a:b]]] for a, b in zip(ends[:-1], ends[1:])]
            for _ in range(PASSES):
                for found, label in zip(texts, labels.tolist()):
                    model.learn(np.append(found, size), label)
            every = model.weights(np.arange(size + 1))
            slot = np.flatnonzero(every[:size])
            value, bias = every[slot], float(every[size])
        else:
            bias = 40.0 if labels.sum() else -40.0
    out = io.BytesIO()
    np.savez(out, slot=slot.astype(np.int32), value=value, bias=np.array([bias]))
    return out.getvalue()


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> bytes:
    """The slots and values of the weights that are not zero."""
    sample = sampling.sampled_rows(docs, sampling.known_labels(labels, "toxic", rows))
    return sampling.fit_once(sample.mapInArrow(_features, FEATURES), _fit)


class Scorer:
    def __init__(self, model: bytes):
        stored = np.load(io.BytesIO(model))
        self.weights = np.zeros(1 << BITS)
        self.weights[stored["slot"]] = stored["value"]
        self.used, every = self.weights != 0, np.arange(1 << BITS)
        self.leads = np.logical_or.reduce([self.used, *[self.used[_again(every, n)] for n in REPEATS]])
        self.bias = float(stored["bias"][0])

    def scores(self, column: pa.Array) -> np.ndarray:
        data, offsets = textops.raw(column)
        total = np.full(len(offsets) - 1, self.bias)
        for a, b in textops.pieces(offsets):
            part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            key = _grams(part, own, self.used, self.leads)
            value = self.weights[key & MASK]
            total[a:b] += np.bincount(key >> BITS, value, minlength=b - a)
        return sigmoid(total)


def score_toxicity(docs: DataFrame, model: bytes, reject_at: float = REJECT_AT) -> DataFrame:
    """Score and prediction of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            score = scorer.scores(batch.column("text"))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "score": pa.array(score),
                    "predicted": pa.array((score >= reject_at).astype(np.int32)),
                }
            )

    rows = docs.select("doc_id", sampling.held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, RESULT)


def drop_toxic(docs: DataFrame, model: bytes, reject_at: float = REJECT_AT) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(scorer.scores(batch.column("text")) < reject_at))

    return docs.mapInArrow(run, docs.schema)
