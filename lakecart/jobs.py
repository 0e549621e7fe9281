"""Concurrent submission of independent Spark jobs (one per table)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Tables of one layer are independent jobs; submit a few at once so small
# tables share the cluster instead of queueing behind each other.
TABLE_PARALLELISM = 4


def per_table(fn, items, parallelism: int | None = None) -> dict:
    """Run ``fn(item)`` for each item as concurrent Spark jobs; re-raise the first failure."""
    items = list(items)
    if parallelism is None:
        active = SparkSession.getActiveSession()
        conf = active.conf.get("spark.lakecart.tableParallelism", None) if active else None
        parallelism = int(conf) if conf else TABLE_PARALLELISM
    if parallelism <= 1 or len(items) <= 1:
        return {k: fn(k) for k in items}
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        futures = {k: pool.submit(fn, k) for k in items}
        return {k: f.result() for k, f in futures.items()}
