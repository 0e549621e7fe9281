"""Deterministic faults planted into silver tables, so that every check has something to find.

Each kind of fault strikes the rows whose primary key is divisible by its
number; see ``FAULTS``.  The clean tables stay as they are: faults are
projections over them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecart.schemas import TABLES

FAULTS = {
    "repeat": 11,  # the row occurs twice
    "null": 13,  # updated_at is missing
    "value": 17,  # columns with accepted values hold 'bogus'
    "range": 19,  # columns with a range hold -1
    "orphan": 23,  # references point to -1
    "sum": 29,  # the last amount or stock of row arithmetic is one too high
    "cents": 31,  # money has three decimals
}
SUM_COLUMN = {"orders": "total_amount", "order_items": "total_price", "inventory_logs": "new_quantity"}
CENTS_COLUMN = {"orders": "tax", "payments": "amount", "products": "price"}


def plant(df: DataFrame, table: str) -> DataFrame:
    """A silver table with every kind of fault that its rules can find."""
    s = TABLES[table]
    struck = lambda kind: F.col(s.primary_key) % FAULTS[kind] == 0
    new = {"updated_at": F.when(~struck("null"), F.col("updated_at"))}
    if table in CENTS_COLUMN:
        c = CENTS_COLUMN[table]
        new[c] = F.when(struck("cents"), F.floor(F.col(c)) + F.lit(0.125)).otherwise(F.col(c))
    if table in SUM_COLUMN:
        c = SUM_COLUMN[table]
        new[c] = F.when(struck("sum"), F.col(c) + 1).otherwise(new.get(c, F.col(c)))
    for c in s.accepted:
        new[c] = F.when(struck("value"), F.lit("bogus")).otherwise(F.col(c))
    for c in s.ranges:
        new[c] = F.when(struck("range"), F.lit(-1)).otherwise(new.get(c, F.col(c)))
    for fk in s.foreign_keys:
        new[fk.column] = F.when(struck("orphan"), F.lit(-1)).otherwise(F.col(fk.column))
    faulty = df.withColumns({c: e.cast(df.schema[c].dataType) for c, e in new.items()})
    copies = F.when(struck("repeat"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return faulty.withColumn("_copy", F.explode(copies)).drop("_copy")


def damage(raw: DataFrame, table: str) -> DataFrame:
    """Raw text of a source table with values that silver can't hold (key not divisible: unchanged)."""
    s = TABLES[table]
    kinds = {"int": "value", "double": "range", "ts": "null", "date": "orphan"}
    key = F.col(s.primary_key)
    cols = []
    for c, kind in s.columns:
        text = F.col(c).cast("string")
        cols.append((F.when(key % FAULTS[kinds[kind]] == 0, F.lit("oops")).otherwise(text) if kind in kinds else text).alias(c))
    return raw.select(*cols)
