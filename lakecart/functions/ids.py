"""Consecutive row ids in a global order, without a single-partition window.

``row_number() OVER (ORDER BY k)`` with no PARTITION BY sends every row to one
task.  Here the rows are range-partitioned and sorted by ``k`` and written
once, tagged with their position inside their partition, so every later use
sees the same layout.  The per-partition counts (one row per partition) give
each partition's starting offset, and a join on the partition number yields
the global id.  The same steps run for inputs of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecart.session import scratch_dir

# Ids mostly follow each other: written as differences they take next to no room.
_KEYS_OPTIONS = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
# monotonically_increasing_id = partition index << 33 | row position in partition.
_ROW_BITS = 33


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, safe from lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.options(**_KEYS_OPTIONS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dense_row_id(df: DataFrame, order_by: list[str | Column], id_col: str) -> DataFrame:
    """Append ``id_col`` = 1-based position of each row in ``order_by`` order.

    Equal to ``row_number() OVER (ORDER BY order_by)``; rows tied on every
    ``order_by`` column get consecutive ids in an unspecified order.  The ids
    are stable: they derive from a written table.
    """
    # The input position breaks ties, so rows equal on every key (say a third
    # of the table) can still be split across range partitions.
    ordered = df.withColumn("_tie", F.monotonically_increasing_id()).orderBy(*order_by, "_tie").drop("_tie")
    tagged = _written(ordered.withColumn("_mid", F.monotonically_increasing_id()), "row-ids")
    part = F.shiftright("_mid", _ROW_BITS)
    counts = tagged.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition. Written, so its size is known when the join is planned.
    offsets = _written(counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")), "row-offsets")
    out = tagged.join(offsets, part == F.col("_p"))
    position = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return out.withColumn(id_col, (F.col("_offset") + position + 1).cast("bigint")).drop("_mid", "_p", "_offset")
