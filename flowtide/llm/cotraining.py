"""Quality classifier by co-training of a text view and a metadata view.

The text view reads hashed word and character n-grams and the text's shape (length, repeats, symbols, in steps), the metadata view
language, source, both together and the magnitude of the stated length. Both start from a bounded sample of labelled rows.
In each of ``ROUNDS`` rounds both score every unlabelled row of the training folds in Arrow batches, and each view labels for the other
one the ``PER_ROUND`` rows of either class that it is surest of, found by a distributed top-k. A row has to be surer than the
base rate, no more, so that a weak view teaches as well; what it teaches is its calibrated probability, not a bare class, so
that a weak view's labels weigh little and those of a view that knows nothing don't arise.
Each view is calibrated on labelled rows kept back, and in the end the two log-odds are added, with
the base rate counted once, as for views independent given the class. All documents are scored in
Arrow batches; both models are of fixed size.

Defined results: NULL texts count as empty, NULL metadata is a value of its own; repeated rows score
alike; NULL ids are scored, but teach nothing; of unlabelled rows that repeat an id the higher scores count; texts are read whole, in pieces,
whatever their length; an empty table gives no rows; other columns are not read, whatever their names. Ties go to the smaller hash of the id.
Without labels of both kinds the score is the class that there is (0.5 without any).
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm import quality_rules, sampling, textops
from flowtide.llm.linear import Sparse, fit_logistic, fit_scale, sigmoid
from flowtide.sources.settle import settle

LABELLED_ROWS = 2400
ROUNDS = 3
PER_ROUND = 100
KEEP_AT = 0.5
META_BITS = 12
SHAPE_STEPS = 64
FAMILY = 8.0  # sum of the values of a family of n-grams in any text
SHAPES = 5
PIECE_BYTES = 1 << 18
TEXT_SIZE = (2 << quality_rules.BITS) + SHAPES * SHAPE_STEPS
META = ("lang", "source", "n_chars")

FEATURES = quality_rules.FEATURES + ", meta array<int>"
RESULT = "doc_id bigint, text_score double, meta_score double, score double, kept boolean"


def _slot(value: str) -> int:
    return zlib.crc32(value.encode()) >> 32 - META_BITS


def meta_slots(batch: pa.RecordBatch) -> list[list[int]]:
    """Four slots for each row."""
    known: dict[tuple, list[int]] = {}
    rows = zip(*[batch.column(c).to_pylist() for c in META])
    found = []
    for lang, source, length in rows:
        size = None if length is None else int(length).bit_length()
        key = (lang, source, size)
        if key not in known:
            parts = (f"lang={lang!r}", f"source={source!r}", f"both={lang!r},{source!r}", f"size={size}")
            known[key] = [_slot(part) for part in parts]
        found.append(known[key])
    return found


def shape_slots(data: np.ndarray, offsets: np.ndarray, words: textops.Words, hashes: np.ndarray) -> np.ndarray:
    """Steps of each text's length, repeated words, repeated lines, symbols and different words."""
    counts = quality_rules.base_counts(data, offsets, words, hashes)
    total = np.maximum(counts["n_words"], 1)
    each = textops.mixed(hashes ^ textops.mixed(words.doc.astype(np.uint64) + np.uint64(1)))
    different = words.doc[np.unique(each, return_index=True)[1]]
    steps = [
        2 * np.log2(counts["n_words"] + 1),
        np.ceil(5 * counts["n_repeat_words"] / total),
        np.ceil(np.log2(counts["n_dup_lines"] + 1)),
        np.ceil(np.log2(1 + 100 * counts["n_symbols"] / np.maximum(counts["word_chars"], 1))),
        10 * np.bincount(different, minlength=words.count) / total,
    ]
    first = (2 << quality_rules.BITS) + np.arange(SHAPES) * SHAPE_STEPS
    return np.minimum(np.stack(steps, 1).astype(np.int64), SHAPE_STEPS - 1) + first


def text_parts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Slots of the text view, piece by piece: first and last text, and each slot with its text and value."""
    data, offsets = textops.raw(column)
    for a, b in textops.pieces(offsets, PIECE_BYTES):
        part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        words = textops.Words(part, own, textops.SPACED)
        hashes = words.hashes()
        shapes = shape_slots(part, own, words, hashes)
        for slot, where in quality_rules._grams(part, own, words, hashes):
            yield a, b, slot, where, np.maximum(np.bincount(where, minlength=b - a), 1) / FAMILY
        yield a, b, shapes.ravel(), np.repeat(np.arange(b - a), SHAPES), np.ones(b - a)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slots and values of both views for each sampled text, a piece of a batch at a time."""
    for batch in batches:
        for a, b in textops.pieces(textops.raw(batch.column("text"))[1], PIECE_BYTES):
            rows = batch.slice(a, b - a)
            keys, values = [], []
            for _, _, slot, where, norm in text_parts(rows.column("text")):
                key, count = np.unique(where * TEXT_SIZE + slot, return_counts=True)
                keys.append(key)
                values.append((count / norm[key // TEXT_SIZE]).astype(np.float32))
            key, value = np.concatenate(keys), np.concatenate(values)
            order = np.argsort(key)
            key = key[order]
            ends = pa.array(np.searchsorted(key, np.arange(b - a + 1) * TEXT_SIZE).astype(np.int32))
            columns = [rows.column(c) for c in ("_order", "_id", "_label")]
            columns.append(pa.ListArray.from_arrays(ends, pa.array((key % TEXT_SIZE).astype(np.int32))))
            columns.append(pa.ListArray.from_arrays(ends, pa.array(value[order])))
            columns.append(pa.array(meta_slots(rows), pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in FEATURES.split(", ")])


def learn(own: Sparse, goal: np.ndarray, checked: Sparse, truth: np.ndarray, size: int) -> tuple[np.ndarray, list[float]]:
    """A view's weights from its own rows, and slope, shift and bias; calibrated on the rows kept back."""
    weights, bias = fit_logistic(own, goal, size, rounds=40)
    slope, shift = fit_scale(checked.times(weights) + bias, truth)
    return weights, [slope, shift, bias]


def _fit(table: pa.Table | None) -> bytes:
    parts = {"text": np.zeros(TEXT_SIZE), "meta": np.zeros(1 << META_BITS), "scale": np.zeros(7)}
    if table is not None and table.num_rows:
        narrow = table.drop_columns(["slot", "value"]).sort_by([("_order", "ascending"), ("_id", "ascending")])
        text, labels = quality_rules.sparse_rows(table)
        del table
        known = np.flatnonzero(labels >= 0)
        seen = labels[known]
        if len(seen) and 0 < seen.sum() < len(seen):
            slots = narrow["meta"].combine_chunks().flatten().to_numpy()
            meta = Sparse(slots, np.ones(len(slots)), np.repeat(np.arange(text.rows), 4), text.rows)
            checked = np.zeros(len(labels), bool)
            checked[known[quality_rules.calibration_part(len(known))]] = True
            views = {"text": (text, TEXT_SIZE), "meta": (meta, 1 << META_BITS)}
            del text, meta
            found = []
            for view in ("text", "meta"):
                x, size = views.pop(view)
                taught = narrow[f"to_{view}"].to_numpy().astype(np.float64)
                goal = np.where(labels >= 0, labels, taught)
                rows = ((labels >= 0) & ~checked) | ~np.isnan(taught)
                own, kept_back = x.pick(rows), x.pick(checked)
                del x  # the rows picked are all that is used
                parts[view], scale = learn(own, goal[rows], kept_back, labels[checked], size)
                found += scale
            share = float(labels[checked].mean()) if checked.any() else 0.5
            share = min(max(share, 1e-3), 1 - 1e-3)
            parts["scale"] = np.array([*found, np.log(share / (1 - share))])
        elif len(seen):
            parts["scale"][[1, 4, 6]] = 40.0 if seen.sum() else -40.0
    out = io.BytesIO()
    np.savez(out, **parts)
    return out.getvalue()


def surest(docs: DataFrame, labels: DataFrame, model: bytes, taken: DataFrame, count: int = PER_ROUND) -> DataFrame:
    """The unlabelled rows of the training folds that either view is surest of: id, order, and what it teaches the other view.

    Every row is scored where it is; of the texts only ids and scores move. ``taken`` holds the ids that were
    taught before, a few hundred a round.
    """
    base = float(sigmoid(Scorer(model).scale[6]))
    scored = score_documents(docs.where(F.col("doc_id").isNotNull() & ~sampling.held_out()), model)
    labelled = labels.select(F.col("doc_id").cast("bigint").alias("_id")).distinct()
    scored = scored.select(F.col("doc_id").alias("_id"), F.col("text_score").alias("text"), F.col("meta_score").alias("meta"))
    scored = scored.join(F.broadcast(taken.select("_id")), "_id", "left_anti").join(labelled, "_id", "left_anti")
    scored = scored.groupBy("_id").agg(F.max("text").alias("text"), F.max("meta").alias("meta"))
    scored = settle(scored.withColumn("_order", F.xxhash64("_id")))
    none = F.lit(None).cast("double")

    def best(view: str, good: bool) -> DataFrame:
        score = F.col(view)
        sure, first = (score > base, score.desc()) if good else (score < base, score.asc())
        found = scored.where(sure).orderBy(first, "_order", "_id").limit(count)
        to_text, to_meta = (none, score) if view == "text" else (score, none)
        return found.select("_id", "_order", to_text.alias("to_text"), to_meta.alias("to_meta"))

    found = reduce(DataFrame.union, [best(view, good) for view in ("text", "meta") for good in (True, False)])
    return found.groupBy("_id", "_order").agg(F.max("to_text").alias("to_text"), F.max("to_meta").alias("to_meta"))


def train(
    docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, rounds: int = ROUNDS, per_round: int = PER_ROUND
) -> bytes:
    """Both fitted views, about a megabyte.

    What is fitted in one task is bounded by the parameters: ``rows`` labelled rows and four times ``per_round`` taught ones a round.
    """
    columns = ("text", "lang", "source", "n_chars")
    narrow = docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("bigint").alias("n_chars"))
    chosen = sampling.known_labels(labels, "quality", rows).select("_id", "_label", "_order")
    known = sampling.sampled_rows(narrow, chosen, columns).mapInArrow(_features, FEATURES)
    none = F.lit(None).cast("double")
    sample = settle(known.withColumns({"to_text": none, "to_meta": none}))
    model = sampling.fit_once(sample, _fit)
    for _ in range(rounds):
        picked = settle(surest(docs, labels, model, sample, per_round))
        if picked.isEmpty():
            break
        taught = sampling.sampled_rows(narrow, picked.withColumn("_label", F.lit(-1)), columns).mapInArrow(_features, FEATURES)
        taught = taught.join(F.broadcast(picked.select("_id", "to_text", "to_meta")), "_id")
        sample = sample.unionByName(settle(taught))
        model = sampling.fit_once(sample, _fit)
    return model


class Scorer:
    def __init__(self, model: bytes):
        stored = np.load(io.BytesIO(model))
        self.text, self.meta, self.scale = stored["text"], stored["meta"], stored["scale"].tolist()

    def scores(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slope, shift, bias, meta_slope, meta_shift, meta_bias, prior = self.scale
        text = np.full(batch.num_rows, bias)
        for a, b, slot, where, norm in text_parts(batch.column("text")):
            text[a:b] += np.bincount(where, self.text[slot], minlength=b - a) / norm
        meta = self.meta[np.array(meta_slots(batch), np.int64).reshape(-1, 4)].sum(1) + meta_bias
        one, two = slope * text + shift, meta_slope * meta + meta_shift
        return sigmoid(one), sigmoid(two), sigmoid(one + two - prior)


def score_documents(docs: DataFrame, model: bytes, keep_at: float = KEEP_AT) -> DataFrame:
    """Scores of both views, the combined score and the verdict of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            one, two, both = scorer.scores(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, (one, two, both, both >= keep_at))],
                [part.split()[0] for part in RESULT.split(", ")],
            )

    rows = docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("bigint").alias("n_chars"))
    return rows.mapInArrow(run, RESULT)
