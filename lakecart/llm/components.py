"""Connected components of an edge table, distributed.

Alternating large-star and small-star steps (Kiveris et al. 2014) turn every
component into a star around its smallest node in a logarithmic number of
rounds, also for long chains.  Every step is a grouped minimum (partially
aggregated) and an equality join (whose hot keys adaptive execution can
split); each round's edges are written to the shared folder, and no edge or
label passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecart.llm.storage import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over (hi, lo) edges with hi > lo; returns edges of the same form."""
    there = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    back = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    near = there.unionByName(back) if large else there
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = near.join(least, "u")
    if large:
        out = linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        out = linked.select(F.col("v").alias("hi"), F.col("m").alias("lo")).unionByName(
            least.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
    return out.filter(F.col("hi") > F.col("lo")).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node of its component.

    Edges may repeat, point either way or join a node to itself; an edge with a null end is no edge.
    """
    now = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    now = materialize(now, "edges")
    digest = _digest(now)
    while digest[0]:
        now = materialize(_star(_star(now, large=True), large=False), "edges")
        before, digest = digest, _digest(now)
        if digest == before:
            break
    roots = now.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("root"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
