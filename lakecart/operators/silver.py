"""Silver layer: one cast-and-clean projection per bronze table.

Row-count preserving, one ``select`` per table, all built-in expressions.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecart.functions.clean import (cast_lost, clean_date, clean_text, clean_trim, clean_ts,
                                      to_bigint, to_double, to_int)
from lakecart.schemas import spec
from lakecart.sources.bronze import MALFORMED


#: Marks the columns of ``with_silver``.
CAST = "_silver_"


def silver_column(column: str, kind: str, strict: bool = False) -> Column:
    c = F.col(column)
    if kind == "id":
        return to_bigint(c, strict)
    if kind == "int":
        return to_int(c, strict)
    if kind == "double":
        return to_double(c, strict)
    if kind == "str":
        return clean_trim(c)
    if kind == "text":
        return clean_text(c)
    if kind == "ts":
        return clean_ts(c, strict)
    if kind == "date":
        return clean_date(c, strict)
    raise ValueError(f"unknown column kind {kind}")


def silver_select(bronze: DataFrame, table: str, strict: bool = False) -> DataFrame:
    """Cast and clean a bronze table into its silver shape (``dt`` passed through).

    Of a frame that holds the cast values already (``with_silver``), these are taken.
    """
    have = set(bronze.columns)
    cols = [(F.col(f"{CAST}{c}") if f"{CAST}{c}" in have else silver_column(c, kind, strict)).alias(c)
            for c, kind in spec(table).columns]
    return bronze.select(*cols, F.col("dt"))


def loss_rules(table: str, cast: bool = False) -> list[tuple[str, Column]]:
    """What the silver projection loses, as predicates over the all-text scan of bronze (``cast``: over ``with_silver``).

    One rule for each column that is cast (non-blank text that becomes NULL),
    and one for records with a wrong number of fields.
    """
    rules = [(f"cast_loss({c})", cast_lost(c, F.col(f"{CAST}{c}") if cast else silver_column(c, k)))
             for c, k in spec(table).columns if k not in ("str", "text")]
    return [*rules, ("field_count", F.col(MALFORMED).isNotNull())]


def with_silver(text_bronze: DataFrame, table: str, strict: bool = False) -> DataFrame:
    """The all-text scan with the silver value of every column beside it (``CAST`` + name): each value is cast once."""
    return text_bronze.select("*", *[silver_column(c, k, strict).alias(f"{CAST}{c}") for c, k in spec(table).columns])


# How a record is written again from its fields.
RECORD_OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def quarantined(text_bronze: DataFrame, table: str) -> DataFrame:
    """(table_name, dt, file, record, reasons) of every raw record that silver can't hold whole.

    ``text_bronze`` is ``read_bronze(.., as_text=True)``.  ``reasons`` are the
    names of all ``loss_rules`` that the record breaks, in their order.  A
    record with a wrong number of fields is kept as it was read, any other is
    written again from its fields (the same text, but for quotes that it didn't
    need).  Rows are only filtered and projected, so this scales with the scan;
    repeated records are all kept; no losses -> no rows.
    """
    rules = loss_rules(table)
    record = F.coalesce(F.col(MALFORMED), F.to_csv(F.struct(*spec(table).column_names), RECORD_OPTIONS))
    return (text_bronze.where(reduce(or_, [lost for _, lost in rules]))
            .select(F.lit(table).alias("table_name"), "dt", F.col("_metadata.file_path").alias("file"), record.alias("record"),
                    F.array_compact(F.array(*[F.when(lost, F.lit(name)) for name, lost in rules])).alias("reasons")))


def cast_loss_counts(text_bronze: DataFrame, table: str) -> DataFrame:
    """(table_name, rule, violations) of ``loss_rules`` in one pass over ``read_bronze(.., as_text=True)``."""
    rules = loss_rules(table)
    wide = text_bronze.agg(*[F.count_if(lost).alias(f"c{i}") for i, (_, lost) in enumerate(rules)])
    stack = ", ".join(f"'{name}', c{i}" for i, (name, _) in enumerate(rules))
    return wide.selectExpr(f"'{table}' AS table_name", f"stack({len(rules)}, {stack}) AS (rule, violations)")
