"""From raw documents to a sharded training corpus, in five stages.

Every stage takes (spark, docs, sf_dir), works on all documents that its
predecessor kept, and returns documents; ``run`` writes each stage's result as
Parquet to the shared folder and reads it again as the next one's input.

1. quality       documents that the attention model rejects go
2. near_dedup    of each group of SimHash near-duplicates one document stays
3. decontaminate documents that hold a benchmark passage go
4. mix           documents beyond their source's part of the mix go
5. shard         every document gets its shard
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecart.llm import attention_mil, pfair_mix, rendezvous, simhash_variants, spaced_seed
from lakecart.llm.common import held_out, table
from lakecart.llm.storage import materialize

N_SHARDS = 16
#: No SQL can express the classifier's training.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents outside the held-out fold, rejects by score."""
    seen = ~held_out(F.col("doc_id"))
    model = attention_mil.fit(docs.filter(seen), table(spark, sf_dir, "labels").filter(seen))
    return docs.filter(attention_mil.score_column(model, docs["text"]) >= attention_mil.THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Three-word shingles, fingerprints within two bits; the smallest id of a group stays."""
    return simhash_variants.keep_one(docs, simhash_variants.near_duplicates(docs, shingle=3, max_bits=2))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return spaced_seed.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Natural shares with no source above a third: only such a source's surplus goes."""
    return pfair_mix.keep_mix(docs, pfair_mix.schedule(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with size, text_crc32, law, shard and grown_shard."""
    return rendezvous.assign_shards(docs, [1.0] * N_SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
