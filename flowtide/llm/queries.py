"""Registered queries of this subpackage: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.llm import (
    chat,
    cotraining,
    decontamination,
    infilling,
    licenses,
    minhash,
    pieces,
    quality_rules,
    simhash,
    spelling,
    toxicity,
    url_filters,
    warc,
)
from flowtide.sources.settle import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark, sf):
    docs = table(spark, sf, "documents")
    model = quality_rules.train(docs, table(spark, sf, "labels"))
    return quality_rules.score_quality(docs, model)


def op2_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels"))
    return toxicity.score_toxicity(docs, model)


def op3_decontamination(spark, sf):
    return decontamination.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op4_licenses(spark, sf):
    return licenses.scan_licenses(table(spark, sf, "documents"))


def op5_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op6_cotraining(spark, sf):
    docs = table(spark, sf, "documents")
    return cotraining.score_documents(docs, cotraining.train(docs, table(spark, sf, "labels")))


def op7_warc(spark, sf):
    path = new_folder(spark, "warc")
    warc.write_archives(table(spark, sf, "pages"), path)
    return warc.read_archives(spark, path).drop("payload", "target_uri")


def op8_url_filters(spark, sf):
    return url_filters.judge_urls(table(spark, sf, "pages"), table(spark, sf, "labels"))


# The conversation added to the table.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op9_chat(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return chat.digests(chat.format_conversations(turns.unionByName(added)))


def op10_sentencepiece(spark, sf):
    return pieces.encode_documents(table(spark, sf, "documents"), with_ids=False)


def op11_minhash(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"))


def op12_infilling(spark, sf):
    return infilling.infill(table(spark, sf, "documents")).drop("output", "restored")


def op13_spelling(spark, sf):
    return spelling.spelling_variants(table(spark, sf, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_licenses": op4_licenses,
    "op5_simhash": op5_simhash,
    "op6_cotraining": op6_cotraining,
    "op7_warc": op7_warc,
    "op8_url_filters": op8_url_filters,
    "op9_chat": op9_chat,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_minhash": op11_minhash,
    "op12_infilling": op12_infilling,
    "op13_spelling": op13_spelling,
}
