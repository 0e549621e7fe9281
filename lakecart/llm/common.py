"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fold that no classifier learns from: crc32(doc_id as text) mod 5 = 0.

    A null id counts as the empty text (crc32 0), so it is held out.
    """
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores put before it until no column (in any case) is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def utf8_buffers(arr) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string array and its n + 1 offsets; a null has length 0."""
    arr = arr.cast(pa.large_binary()) if not pa.types.is_large_binary(arr.type) else arr
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if arr.null_count:
        arr = arr.fill_null(b"")
    _, offs, data = arr.buffers()
    offsets = np.frombuffer(offs, np.int64, n + 1, arr.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]
