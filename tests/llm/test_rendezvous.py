import collections
import math
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from lakecart.llm import rendezvous as rv
from llm_frames import awkward_documents, no_documents


def choose(key, weights):
    text = b"" if key is None else str(key).encode()
    first = xxhash.xxh64_intdigest(text, 42)
    draws = []
    for j, w in enumerate(weights):
        h = xxhash.xxh64_intdigest(f"{rv.SALT}-{j}".encode(), first)
        draws.append((-math.log(((h >> 11) + 0.5) / 2**53) / w, j))
    return min(draws)[1]


def test_shards_by_brute_force(spark):
    weights = [1.0, 2.0, 0.5]
    rows = rv.assign_shards(awkward_documents(spark), weights).collect()
    for r in rows:
        data = (r.text or "").encode()
        assert r.shard == choose(r.doc_id, weights)
        assert r.grown_shard == choose(r.doc_id, [*weights, sum(weights) / 3])
        assert r.grown_shard in (r.shard, 3)
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")


def test_weights_are_met_and_few_keys_move(spark):
    keys = spark.range(0, 40_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = rv.assign_shards(keys, [1.0, 2.0, 3.0, 4.0], new_weight=2.0).select("shard", "grown_shard").collect()
    share = collections.Counter(r.shard for r in rows)
    for j, w in enumerate([1, 2, 3, 4]):
        assert share[j] / len(rows) == pytest.approx(w / 10, abs=0.01)
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {4}
    assert len(moved) / len(rows) == pytest.approx(2 / 12, abs=0.01)


@pytest.mark.parametrize("buckets", [1, 7, rv.BUCKETS])
def test_slots_are_gapless(spark, buckets):
    narrow = rv.assign_shards(awkward_documents(spark), [1.0] * 4).select("doc_id", "size", "text_crc32", "shard")
    narrow = narrow.unionByName(narrow.filter("doc_id = 8"))  # repeated rows
    out = rv.number_slots(narrow, F.col("doc_id"), buckets=buckets).collect()
    assert len(out) == narrow.count()
    by = collections.defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    again = rv.number_slots(narrow.repartition(5), F.col("doc_id"), buckets=buckets).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, again), key=repr)


def test_a_hot_key_is_counted_before_it_is_numbered(spark):
    rows = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit(0).alias("shard"))
    out = rv.number_slots(rows, F.col("doc_id"))
    assert sorted(r.slot for r in out.collect()) == list(range(3000))


def test_edges(spark):
    assert rv.number_slots(rv.assign_shards(no_documents(spark), [1.0]).select("doc_id", "shard"), F.col("doc_id")).count() == 0
    with pytest.raises(ValueError):
        rv.shard_of(F.lit(1), [])
    with pytest.raises(ValueError):
        rv.shard_of(F.lit(1), [1.0, 0.0])


def test_rows_of_a_hot_key_spread_over_buckets(spark):
    """A third of the rows without a key: none of the windows that number rows gets more than a few of them."""
    rows = spark.range(0, 60_000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("doc_id"), F.col("id").alias("size"), F.lit(0).alias("shard"))
    slots = rv.number_slots(rows, F.col("doc_id"), buckets=64)
    assert slots.agg(F.count("slot"), F.count_distinct("slot"), F.max("slot")).first()[:] == (60_000, 60_000, 59_999)
    # Rows without a key are spread evenly over the whole order.
    at = [r.n for r in slots.filter("doc_id is null").groupBy(F.floor(F.col("slot") / 6000)).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(at) == 10 and 1700 < min(at) and max(at) < 2300


def test_columns_named_like_the_internal_ones(spark):
    names = ["_n", "_h", "_b", "_t", "_s", "_c", "_start", "_at", "_i"]
    rows = spark.range(0, 50).select(F.col("id").alias("doc_id"), F.lit(0).alias("shard"), *[(F.col("id") * 3).alias(c) for c in names])
    out = rv.number_slots(rows, F.col("doc_id"), buckets=4).collect()
    assert sorted(r.slot for r in out) == list(range(50))
    assert all(r[c] == 3 * r.doc_id for r in out for c in names)
