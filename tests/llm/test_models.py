"""Trained operators: base counts against brute force, held-out accuracy, odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from flowtide.llm import cotraining, queries, quality_rules, textops, toxicity
from flowtide.llm.linear import sigmoid
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if count[r] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(covered), failed


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts_match_brute_force(spark, docs, odd):
    model = quality_rules._fit(None)
    for table in (docs.select("doc_id", "text"), odd):
        texts = sorted(brute(r["text"]) for r in table.collect())
        found = sorted(tuple(r[c] for c in BASE) for r in quality_rules.score_quality(table, model).collect())
        assert found == texts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
def test_repeated_words_match_brute_force(words):
    assert quality_rules.repeated_words(words) == brute(b" ".join(words).decode())[4]


def test_quality_separates_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op1_quality_rules(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id")
    judged = rows.where("crc32(cast(doc_id as string)) % 5 = 0 and not base_failed")
    counts = {(r[0], r[1]): r[2] for r in judged.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, True), 0) / (counts.get((1, True), 0) + counts.get((1, False), 0)) > 0.97
    assert counts.get((0, False), 0) / (counts.get((0, True), 0) + counts.get((0, False), 0)) > 0.8


def test_toxicity_separates_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op2_toxicity(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id").where("held_out")
    counts = {(r[0], r[1]): r[2] for r in rows.groupBy("toxic", "predicted").count().collect()}
    assert counts.get((1, 1), 0) / (counts.get((1, 1), 0) + counts.get((1, 0), 0)) > 0.85
    assert counts.get((0, 1), 0) / (counts.get((0, 1), 0) + counts.get((0, 0), 0)) < 0.02


def test_toxicity_features_of_stems_and_repeats():
    def features(*texts):
        data, offsets = textops.raw(pa.array(texts))
        key = toxicity._grams(data, offsets)
        return [set((key[key >> toxicity.BITS == i] & toxicity.MASK).tolist()) for i in range(len(texts))]

    one, other, short, empty = features("Fantastic!", "fantastique", "fan", "")
    assert len(one) == len(other) == 3 and len(one & other) == 2  # a word and two stems
    assert len(short) == 1 and not empty
    once, twice, four = features("fan", " ".join(["fan"] * 2), " ".join(["fan"] * 4))
    assert once < twice < four
    assert (len(once), len(twice), len(four)) == (1, 3, 5)  # pair; pair, skip pair; second and fourth time


def test_toxicity_scores_are_sums_of_the_features_weights(docs, labels):
    model = toxicity.train(docs, labels)
    scorer = toxicity.Scorer(model)
    column = docs.select("text").limit(80).toArrow()["text"].combine_chunks()
    data, offsets = textops.raw(column)
    key = toxicity._grams(data, offsets)
    sums = np.bincount(key >> toxicity.BITS, scorer.weights[key & toxicity.MASK], minlength=len(column))
    assert scorer.used.any() and np.allclose(scorer.scores(column), sigmoid(sums + scorer.bias))


@pytest.fixture(scope="module")
def judged_by_cotraining(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op6_cotraining(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id")
    held = rows.where("crc32(cast(doc_id as string)) % 5 = 0")
    return Counter({(r[0], r[1]): r[2] for r in held.groupBy("quality", "kept").count().collect()})


def test_cotraining_keeps_held_out_good_rows(judged_by_cotraining):
    counts = judged_by_cotraining
    assert counts[1, True] / (counts[1, True] + counts[1, False]) > 0.97


@pytest.mark.xfail(reason="open: 102 of 122 bad held-out rows are dropped, the goal is 0.9")
def test_cotraining_drops_held_out_bad_rows(judged_by_cotraining):
    counts = judged_by_cotraining
    assert counts[0, False] / (counts[0, False] + counts[0, True]) > 0.9


def first_model(docs, labels):
    return cotraining.train(docs, labels, rounds=0)


def test_a_round_of_cotraining_matches_brute_force(spark, docs, labels):
    labels = labels.where("doc_id % 2 = 0")
    model = first_model(docs, labels)
    base = sigmoid(cotraining.Scorer(model).scale[6])
    taken = spark.range(0, 50).select(F.col("id").alias("_id"))
    known = {r[0] for r in labels.collect()} | set(range(50))
    scores = {
        r["doc_id"]: (r["text_score"], r["meta_score"])
        for r in cotraining.score_documents(docs, model).collect()
        if r["doc_id"] not in known and zlib.crc32(str(r["doc_id"]).encode()) % 5
    }
    order = {r[0]: r[1] for r in docs.selectExpr("doc_id", "xxhash64(doc_id)").collect()}
    expected = {}
    for view in (0, 1):
        for sign in (-1, 1):
            sure = [i for i, s in scores.items() if sign * (s[view] - base) < 0]
            for i in sorted(sure, key=lambda i: (sign * scores[i][view], order[i], i))[:7]:
                expected.setdefault(i, [None, None])[1 - view] = scores[i][view]
    found = cotraining.surest(docs.repartition(5), labels, model, taken, 7).collect()
    assert {r["_id"]: [r["to_text"], r["to_meta"]] for r in found} == expected
    assert all(any(goal[to] is not None for goal in expected.values()) for to in (0, 1))


def test_cotraining_beats_either_view_where_both_know_something(spark):
    rng = random.Random(3)
    good, bad = [f"g{i}" for i in range(300)], [f"b{i}" for i in range(300)]
    both = [f"w{i}" for i in range(300)]
    rows, known = [], []
    for i in range(2500):
        y = rng.random() < 0.6
        words = [rng.choice((good if y else bad) if rng.random() < 0.12 else both) for _ in range(12)]
        lang = rng.choice("abc" if y == (rng.random() < 0.85) else "def")
        source = rng.choice("uvw" if y == (rng.random() < 0.8) else "xyz")
        rows.append((i, " ".join(words), lang, source, 60))
        known.append((i, int(y), 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4)
    truth = spark.createDataFrame(known, "doc_id bigint, quality int, toxic int")
    model = cotraining.train(docs, truth.where("doc_id < 200"), per_round=60)
    judged = cotraining.score_documents(docs, model).join(truth, "doc_id").where("doc_id >= 200").toPandas()
    right = [((judged[c] >= 0.5) == (judged["quality"] == 1)).mean() for c in ("text_score", "meta_score", "score")]
    assert right[2] > max(right[:2]) and right[2] > 0.85
    alone = cotraining.score_documents(docs, first_model(docs, truth.where("doc_id < 200"))).join(truth, "doc_id")
    alone = alone.where("doc_id >= 200").toPandas()
    assert right[0] > ((alone["text_score"] >= 0.5) == (alone["quality"] == 1)).mean()  # the text view has been taught


def test_cotraining_reads_every_unlabelled_row_and_no_held_out_one(spark, docs, labels):
    labels = labels.where("doc_id % 2 = 0")
    held = "crc32(cast(doc_id as string)) % 5 = 0"
    changed = docs.withColumn("text", F.when(F.expr(held), F.lit("other words")).otherwise(F.col("text")))
    model = cotraining.train(docs, labels, rounds=1, per_round=20)
    assert model == cotraining.train(changed.repartition(3), labels, rounds=1, per_round=20)
    none = F.lit(None).cast("bigint").alias("_id")
    found = cotraining.surest(docs, labels, model, spark.range(0).select(none), 10**6)
    free = docs.where(f"not ({held})").join(labels, "doc_id", "left_anti").select("doc_id").distinct()
    assert found.where("to_meta is not null").count() == free.count()  # each is surer than the base rate in one way


@pytest.mark.parametrize("labelled", [True, False])
def test_odd_rows_are_scored(odd, none, labels, labelled):
    known = labels if labelled else labels.where("false")
    quality, toxic = quality_rules.train(odd, known), toxicity.train(odd, known)
    both = cotraining.train(odd, known, rounds=1)
    for table, count in ((odd, 8), (none, 0)):
        assert quality_rules.score_quality(table, quality).count() == count
        assert toxicity.score_toxicity(table, toxic).count() == count
        assert cotraining.score_documents(table, both).count() == count
        assert quality_rules.keep_good(table, quality).columns == odd.columns
        assert toxicity.drop_toxic(table, toxic).count() <= count
    scores = [r["score"] for r in toxicity.score_toxicity(odd, toxic).collect()]
    assert all(0 <= s <= 1 for s in scores)


def test_training_ignores_partitions_and_held_out_rows(docs, labels):
    once = toxicity.train(docs.repartition(3), labels.repartition(5), rows=50)
    assert once == toxicity.train(docs.coalesce(1), labels.orderBy("doc_id"), rows=50)
    other = labels.selectExpr(
        "doc_id", "quality", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) as toxic"
    )
    assert once == toxicity.train(docs, other, rows=50)
