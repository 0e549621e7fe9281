"""The registered queries of the operators, each over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lakecart.llm import (
    attention_mil,
    chat_rotation,
    cross_entropy,
    language_id,
    ngram_ratio,
    page_text,
    pfair_mix,
    rendezvous,
    simhash_variants,
    spaced_seed,
    spelling_variants,
    url_rules,
    whitening,
)
from lakecart.llm.common import held_out, table
from lakecart.llm.oracle import ORACLE_SQL

N_SHARDS = 16


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sample = language_id.training_sample(docs.filter(~held_out(F.col("doc_id"))), "text", "lang", "doc_id")
    found = language_id.identify(docs.select("doc_id", "text"), language_id.train(sample))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rendezvous.assign_shards(table(spark, sf_dir, "documents"), [1.0] * N_SHARDS)
    return rendezvous.number_slots(
        docs.select("doc_id", "size", "text_crc32", "law", "shard", "grown_shard"), F.col("doc_id"))


def op3_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = chat_rotation.rotate(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return shown.withColumn("spans", spans)


def op4_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    seen = ~held_out(F.col("doc_id"))
    model = attention_mil.fit(docs.filter(seen), labels.filter(seen))
    scored = attention_mil.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return ngram_ratio.judge(docs, ngram_ratio.ratio_table(docs, labels.filter("quality = 1")))


def op6_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair_mix.schedule(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "source", "size", "start", "block", "release", "deadline", "slot", "kept")


def op7_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_variants.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op8_spaced_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seed.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark))


def op10_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return cross_entropy.score(docs, labels.filter("quality = 1"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(table(spark, sf_dir, "embeddings"))


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_variants.vocabulary(table(spark, sf_dir, "documents"))
    return spelling_variants.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_language_id, op2_rendezvous_shards, op3_chat_perspectives, op4_attention_mil, op5_ngram_ratio,
           op6_pfair_mix, op7_simhash_variants, op8_spaced_seed, op9_url_rules, op10_cross_entropy,
           op11_whitening, op12_page_text, op13_spelling_variants)
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    pipeline = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return ORACLE_SQL | pipeline
