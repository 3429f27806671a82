"""The pipeline's stages and the whole run on a small table."""

from collections import Counter

import corpus_pipeline
from flowtide.llm import decontamination, simhash


def test_stages_keep_columns_and_take_effect(spark, docs, sf_dir):
    rows, counts = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, sf_dir).cache()
        assert rows.columns == docs.columns, name
        counts.append(rows.count())
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < counts[0]
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert decontamination.find_leaks(rows, bench).count() == 0
    assert simhash.near_duplicates(rows).select("component_id").distinct().count() == counts[-1]


def test_run(spark, sf_dir):
    tokens = corpus_pipeline.run(spark, sf_dir)
    assert tokens.where("round_trip and parity").count() == tokens.count() > 0


def test_stages_take_odd_and_empty_tables(spark, odd, none, sf_dir):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for table in (odd, none):
            kept = stage(spark, table, sf_dir)
            assert kept.columns == odd.columns, name
            left = Counter(map(str, table.collect()))
            assert Counter(map(str, kept.collect())) <= left, name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, odd, sf_dir).count() == odd.count() and last(spark, none, sf_dir).count() == 0
