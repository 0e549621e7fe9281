"""Content parity of a table's stages: order-free fingerprints of every column and of whole rows.

A row count says nothing when one row replaces another.  Here every value's
text is hashed (60 bits of its MD5; two stages that are only compared: XXH64 of
their values) and the hashes are added up per column: the sum does not depend on
row order or partitioning, needs one row per task in the shuffle and differs (but
for a chance of 2^-60) where any value was altered, lost or doubled.  Values that changed places within a column leave its
sum as it is, so a second sum hashes each row as a whole.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecart.operators.silver import silver_column
from lakecart.schemas import spec

#: Name under which the fingerprint of whole rows is listed.
ROW = "*"
# Stands for NULL beside any text; texts themselves get a mark in front.
NULL, VALUE = "0", "1"


# Sums are taken over parts of a hash, so that they stay far from a long's limits (10^12 rows).
PART_BITS = 22


NULL_MD5 = hashlib.md5(NULL.encode()).hexdigest()


def _md5(c: Column) -> Column:
    """MD5 of a value's text in hex; NULL's is known beforehand."""
    return F.when(c.isNull(), F.lit(NULL_MD5)).otherwise(F.md5(F.concat(F.lit(VALUE), c.cast("string")).cast("binary")))


def _number(md5: Column) -> Column:
    """60 bits of an MD5; those of NULL's are known beforehand, as the conversion takes longer than the hash."""
    number = F.conv(F.substring(md5, 1, 15), 16, 10).cast("bigint")
    return F.when(md5 == F.lit(NULL_MD5), F.lit(int(NULL_MD5[:15], 16)).cast("bigint")).otherwise(number)


def _parts(name: str) -> list[Column]:
    """The sums of a hash column's three parts."""
    h = F.col(name)
    cut = [F.shiftright(h, 2 * PART_BITS), F.shiftright(h, PART_BITS).bitwiseAND(F.lit((1 << PART_BITS) - 1)),
           h.bitwiseAND(F.lit((1 << PART_BITS) - 1))]
    return [F.sum(c).alias(f"{name}_{i}") for i, c in enumerate(cut)]


def _total(name: str) -> str:
    """SQL of the sum of whole hashes, as text, from the sums of ``_parts``."""
    part = lambda i: f"cast(coalesce({name}_{i}, 0) as decimal(20,0))"
    return (f"cast(cast({part(0)} * {1 << 2 * PART_BITS}bd + {part(1)} * {1 << PART_BITS}bd + {part(2)} as decimal(38,0)) as string)")


def _listed(wide: DataFrame, table: str, found: list[tuple[str, str, str]]) -> DataFrame:
    """One row for each (stage, column, hash name) of the one-row frame of sums."""
    stack = ", ".join(f"'{stage}', '{column}', {_total(name)}" for stage, column, name in found)
    return wide.selectExpr(f"'{table}' AS table_name", "rows", f"stack({len(found)}, {stack}) AS (stage, column_name, fingerprint)") \
               .select("table_name", "stage", "rows", "column_name", "fingerprint")


def fingerprints(df: DataFrame, table: str, stage: str, whole: bool = True) -> DataFrame:
    """(table_name, stage, column_name, rows, fingerprint) of every source column and (``whole``) of the rows (``ROW``), in one pass."""
    columns = spec(table).column_names
    hashes = df.select(*[_md5(F.col(c)).alias(f"m{i}") for i, c in enumerate(columns)])
    names = [f"f{i}" for i in range(len(columns) + whole)]
    numbers = [_number(F.col(f"m{i}")) for i in range(len(columns))]
    if whole:
        row = F.concat_ws(",", *[F.col(f"m{i}") for i in range(len(columns))])
        numbers.append(_number(F.md5(row.cast("binary"))))
    wide = hashes.select(*[n.alias(f) for n, f in zip(numbers, names)]).agg(
        F.count(F.lit(1)).alias("rows"), *[p for f in names for p in _parts(f)])
    return _listed(wide, table, [(stage, c, f) for c, f in zip([*columns, ROW], names)])


def _fast(c: Column, kind: str) -> Column:
    """XXH64 of a value (NULL has a hash of its own); of a double's text, as the hash of doubles takes -0 for 0."""
    return F.xxhash64(c.cast("string") if kind == "double" else c)


def parity_sums(table: str, stages: dict[str, dict[str, Column]], df: DataFrame) -> DataFrame:
    """``fingerprints`` of several stages (their columns as expressions over ``df``) in one pass, by XXH64.

    Two stages are only compared with each other, so any hash will do: this one takes a tenth of the time of MD5.
    """
    columns = spec(table).columns
    hashes, rows, found = [], [], []
    for k, (stage, of) in enumerate(stages.items()):
        names = [f"h{k}_{i}" for i in range(len(columns))]
        hashes += [_fast(of[c], kind).alias(n) for (c, kind), n in zip(columns, names)]
        rows.append(F.xxhash64(*[F.col(n) for n in names]).alias(f"h{k}_row"))
        found += [(stage, c, n) for (c, _), n in zip(columns, names)] + [(stage, ROW, f"h{k}_row")]
    wide = df.select(*hashes).select("*", *rows).agg(F.count(F.lit(1)).alias("rows"), *[p for _, _, n in found for p in _parts(n)])
    return _listed(wide, table, found)


def content_parity(extracts: dict[str, DataFrame], text_bronze: dict[str, DataFrame], silver: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, landed, cleaned): OK or MISMATCH between extract and bronze, and bronze and silver.

    ``extracts`` are the extracted rows as text, ``text_bronze`` the all-text
    scans of what landed, ``silver`` the stored tables.  Each is scanned once;
    bronze gives the text and what silver must hold (the same casts).  An empty
    string lands as an empty field, which reads as NULL, so both count as NULL.
    """
    parts = []
    for t in silver:
        columns = spec(t).columns
        blank = {c: F.nullif(F.col(c).cast("string"), F.lit("")) for c, _ in columns}
        expected = {c: silver_column(c, kind) for c, kind in columns}
        parts += [parity_sums(t, {"extract": blank}, extracts[t]), parity_sums(t, {"bronze": blank, "expected": expected}, text_bronze[t]),
                  parity_sums(t, {"silver": {c: F.col(c) for c, _ in columns}}, silver[t])]
    of = lambda stage: F.max(F.when(F.col("stage") == stage, F.struct("rows", "fingerprint")))
    same = lambda a, b: F.when(F.col(a) == F.col(b), "OK").otherwise("MISMATCH")
    return (reduce(DataFrame.unionByName, parts).groupBy("table_name", "column_name")
            .agg(*[of(s).alias(s) for s in ("extract", "bronze", "expected", "silver")])
            .select("table_name", "column_name", same("extract", "bronze").alias("landed"), same("expected", "silver").alias("cleaned")))
