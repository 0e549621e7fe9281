"""Intermediate tables in the cluster's shared folder, and the checks behind broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecart.session import scratch_dir


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once to the folder of ``spark.checkpoint.dir`` and read back.

    Cuts the lineage: a lost executor never makes it run again, and, unlike
    ``checkpoint()``, the plan is computed once only.  ``options`` are the Parquet writer's.
    """
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """A broadcast hint where a written table has at most ``max_rows`` rows; else a plain (shuffled) join side.

    The count of a written table comes from the files' footers.
    """
    return F.broadcast(df) if df.count() <= max_rows else df
