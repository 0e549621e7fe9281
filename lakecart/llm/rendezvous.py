"""Sharding by rendezvous (highest random weight) hashing of stable record keys.

Every (key, shard) pair gets a uniform number u from XXH64; the shard with the
smallest ``-ln(u) / weight`` takes the record.  Shard j of weight w_j so gets
its share w_j / sum(w) of the keys, the key and the shard list alone decide
(law ``key``), and a further shard takes records only into itself: about
w_new / sum(w) of them move, none between the old shards.  The choice is a
plain expression: no shuffle, and skewed keys don't matter to it.

Slots number the rows of a shard from 0 in the order of a hash over the whole
row.  No task sees a whole shard: rows equal in all columns are first counted
(partial aggregation), each shard's hash range is cut into buckets, and a
bucket's start comes from the bucket counts of its shard.  Rows that share a
key (or have none) but differ elsewhere fall in different buckets.

Defined results: a null key hashes like the empty text; a null text has 0
bytes (size 1) and the checksum of the empty text; repeated rows share a shard
and get consecutive slots; equal hashes are ordered by the columns; very long
texts are measured whole; columns called size, text_crc32, law, shard,
grown_shard or slot are replaced by the results, all others pass through
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecart.llm.common import free_name

LAW = "key"
SALT = "rendezvous"
#: Buckets that a shard's rows are numbered in.
BUCKETS = 4096


def shard_of(key: Column, weights: list[float]) -> Column:
    """The shard (0-based int) of a key among shards of these positive weights."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one for each shard")
    text = F.coalesce(key.cast("string"), F.lit(""))

    def draw(j: int) -> Column:
        # 53 bits give u in (0, 1); the shard number breaks ties.
        u = (F.shiftrightunsigned(F.xxhash64(text, F.lit(f"{SALT}-{j}")), 11) + 0.5) / float(1 << 53)
        return F.struct((-F.ln(u) / F.lit(float(weights[j]))).alias("d"), F.lit(j).alias("j"))

    draws = [draw(j) for j in range(len(weights))]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["j"]


def assign_shards(docs: DataFrame, weights: list[float], key_col: str = "doc_id", text_col: str = "text",
                  new_weight: float | None = None) -> DataFrame:
    """``docs`` with size, text_crc32, law, shard and grown_shard (with one more shard of ``new_weight``, or the mean weight)."""
    more = sum(weights) / len(weights) if new_weight is None else new_weight
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    return docs.withColumns({
        "size": (F.octet_length(text) + 1).cast("bigint"),
        "text_crc32": F.crc32(text).cast("bigint"),
        "law": F.lit(LAW),
        "shard": shard_of(F.col(key_col), weights),
        "grown_shard": shard_of(F.col(key_col), [*weights, more]),
    })


def number_slots(rows: DataFrame, order_by: Column, shard_col: str = "shard", buckets: int = BUCKETS) -> DataFrame:
    """``rows`` with ``slot``, gapless from 0 in each shard, in the order of a hash of ``order_by`` and the row."""
    rows = rows.drop("slot")
    columns = rows.columns
    n, h, b, t, s, c, begin, at, i = (free_name(f"_{x}", columns) for x in ("n", "h", "b", "t", "s", "c", "start", "at", "i"))
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(n))
    # The whole row: rows of one hot key spread over the buckets.
    counted = counted.withColumn(h, F.xxhash64(order_by.cast("string"), *columns))
    # Signed order of the hash: buckets are equal ranges of it.
    counted = counted.withColumn(b, F.least(F.lit(buckets - 1), F.floor((F.col(h) / float(1 << 63) + 1) / 2 * buckets).cast("int")))
    total = counted.groupBy(shard_col, b).agg(F.sum(n).alias(t))
    before = Window.partitionBy(shard_col).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    start = total.select(F.col(shard_col).alias(s), F.col(b).alias(c), F.coalesce(F.sum(t).over(before), F.lit(0)).alias(begin))
    inside = Window.partitionBy(shard_col, b).orderBy(h, *[x for x in columns if x != shard_col]).rowsBetween(
        Window.unboundedPreceding, -1)
    placed = counted.withColumn(at, F.coalesce(F.sum(n).over(inside), F.lit(0))).join(
        start, (F.col(shard_col) == F.col(s)) & (F.col(b) == F.col(c)))
    return placed.select(*columns, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)).alias(i), begin, at).select(
        *columns, (F.col(begin) + F.col(at) + F.col(i)).cast("bigint").alias("slot"))
