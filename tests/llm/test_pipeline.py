import re

import pytest
import xxhash

import corpus_pipeline as cp
from conftest import SF_SMALL
from lakecart.llm import attention_mil
from lakecart.llm.common import held_out
from lakecart.llm.storage import materialize
from llm_frames import awkward_documents, no_documents
from pyspark.sql import functions as F
from test_rendezvous import choose
from test_simhash_variants import groups, plain
from test_spaced_seed import brute as leaks


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output over the small table."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        result = materialize(stage(spark, docs, SF_SMALL), f"test-{name}")
        out[name] = (docs, result)
        docs = result
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_names_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "shard"]
    for name, (before, after) in stages.items():
        assert after.columns[:len(before.columns)] == before.columns
        assert (name == "shard") == (len(after.columns) > len(before.columns))


def test_quality_by_the_model(spark, stages):
    before, after = stages["quality"]
    seen = ~held_out(F.col("doc_id"))
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = attention_mil.score(before, attention_mil.fit(before.filter(seen), labels.filter(seen)))
    assert ids(after) == ids(rows.filter("predicted = 1"))
    assert 0 < after.count() < before.count()


def test_near_dedup_by_brute_force(stages):
    before, after = stages["near_dedup"]
    rows = before.collect()
    root, least = groups({plain(r.text) for r in rows}, 2), {}
    for r in rows:
        g = root[plain(r.text)]
        least[g] = min(r.doc_id, least.get(g, r.doc_id))
    assert ids(after) == sorted(least.values())


def test_decontamination_by_brute_force(spark, stages):
    before, after = stages["decontaminate"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    grams = lambda t: {tuple(w[i:i + 2]) for w in [re.split(r"[\W_]+", t.lower())] for i in range(len(w) - 1)}
    near = set().union(*(grams(t) for _, t in items))
    rows_near = [(d, t) for d, t in rows if grams(t) & near]
    bad = {d for d, _ in leaks(rows_near, items)}
    assert ids(after) == sorted(d for d, _ in rows if d not in bad)


def test_mix_by_brute_force(stages):
    before, after = stages["mix"]
    by, size = {}, lambda r: len(r.text.encode()) + 1
    for r in before.collect():
        h = xxhash.xxh64_intdigest(b"mix", xxhash.xxh64_intdigest(str(r.doc_id).encode(), 42))
        by.setdefault(r.source, []).append((h - (1 << 64) if h >> 63 else h, r.doc_id, size(r)))
    # No source of this table holds more than a third: all of it is the mix.
    total = sum(x[2] for rows in by.values() for x in rows)
    assert max(sum(x[2] for x in rows) for rows in by.values()) <= total / 3
    assert ids(after) == ids(before)


def test_shards_by_brute_force(stages):
    before, after = stages["shard"]
    assert ids(after) == ids(before)
    assert all(r.shard == choose(r.doc_id, [1.0] * cp.N_SHARDS) for r in after.collect())


def test_run_is_its_stages(spark, stages):
    out = cp.run(spark, SF_SMALL)
    key = lambda r: r.doc_id
    assert sorted(out.collect(), key=key) == sorted(stages["shard"][1].collect(), key=key)


@pytest.mark.parametrize("name,stage", cp.STAGES)
def test_awkward_and_empty_tables(spark, name, stage):
    docs = awkward_documents(spark)
    out = stage(spark, docs, SF_SMALL)
    if name != "shard":
        assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) <= docs.count()
    if name in ("mix", "decontaminate", "shard"):
        assert len(rows) == docs.count() or name == "mix"
    # Values of other columns, also of those named like internal ones, pass unchanged.
    assert {r.id for r in rows} <= {"i"} and {r.score for r in rows} <= {"s"} and {r.last for r in rows} <= {"l"}
    assert stage(spark, no_documents(spark), SF_SMALL).count() == 0


def test_awkward_source_is_capped(spark):
    """One source with most of the bytes: its surplus goes, everything else stays."""
    docs = spark.range(0, 600).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 200).alias("text"), F.lit("en").alias("lang"),
                                      F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 16)).alias("source"))
    out = cp.mix(spark, docs, SF_SMALL).groupBy("source").count().collect()
    n = {r.source: r["count"] for r in out}
    assert n["hot"] == pytest.approx(sum(n.values()) / 3, abs=2)
    assert sum(v for k, v in n.items() if k != "hot") == 150
