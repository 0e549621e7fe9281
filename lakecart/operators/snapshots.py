"""Several snapshots of one table as one: the latest row of every key, and what the days say about a table's health.

A full extract lands every day, so the newest day is the table.  Where an
extract may be partial (only changed rows, or a day that was cut short), the
newest day alone loses every key that it does not name; the latest row per key
does not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecart.schemas import spec


def latest_per_key(silver: DataFrame, table: str) -> DataFrame:
    """Of each primary key the row of its newest ``dt`` (within one day: the newest ``updated_at``).

    A grouped maximum of the whole row behind (dt, updated_at): partially
    aggregated on both sides of one shuffle, so a key that comes back every
    day costs one row per task, where a window would sort all of its rows in
    one.  Rows that tie on both times are told apart by their other columns,
    so the result does not depend on the reading order.  Rows without a key
    can't be matched with others and stay, all of them.
    """
    s = spec(table)
    order = ["dt", "updated_at", *[c for c in s.column_names if c not in (s.primary_key, "updated_at")]]
    newest = (silver.where(F.col(s.primary_key).isNotNull()).groupBy(s.primary_key)
              .agg(F.max(F.struct(*order)).alias("_row"))
              .select(s.primary_key, "_row.*").select(*silver.columns))
    return newest.unionByName(silver.where(F.col(s.primary_key).isNull()))


def key_counts(silver: DataFrame, table: str) -> DataFrame:
    """(keys, keyless): how many rows ``latest_per_key`` must give."""
    pk = spec(table).primary_key
    return silver.agg(F.count_distinct(pk).alias("keys"), F.count_if(F.col(pk).isNull()).alias("keyless"))


def freshness(counts: DataFrame, as_of: str | None = None, drop: float = 0.5, jump: float = 2.0) -> DataFrame:
    """Every day of every table from its first snapshot on, with what is wrong with it.

    ``counts`` has (table_name, dt, row_count), one row per landed snapshot
    (``sources.bronze.partition_row_counts``).  The calendar runs to ``as_of``
    (default: the newest snapshot of any table), so a table that stopped
    landing shows up too.  ``previous_rows`` is the row count of the last
    earlier day that landed with rows.  status, first that applies:

        missing   no snapshot
        empty     a snapshot without rows
        drop      fewer than ``drop`` times the previous rows
        jump      more than ``jump`` times the previous rows
        ok

    One row per table and day: the calendar is generated from each table's
    first day, never joined day by day to all tables.
    """
    days = counts.select("table_name", F.to_date("dt").alias("day"), "row_count")
    end = F.to_date(F.lit(as_of)) if as_of else F.col("_end")
    spans = days.groupBy("table_name").agg(F.min("day").alias("_first"), F.max("day").alias("_last"))
    if not as_of:  # one row per table
        spans = spans.crossJoin(F.broadcast(spans.agg(F.max("_last").alias("_end"))))
    calendar = spans.select("table_name", F.explode(F.sequence("_first", F.greatest(end, "_last"))).alias("day"))
    seen = calendar.join(days, ["table_name", "day"], "left")
    before = Window.partitionBy("table_name").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("row_count") > 0, F.col("row_count")), ignorenulls=True).over(before)
    out = seen.withColumn("previous_rows", last)
    status = (F.when(F.col("row_count").isNull(), "missing").when(F.col("row_count") == 0, "empty")
              .when(F.col("row_count") < drop * F.col("previous_rows"), "drop")
              .when(F.col("row_count") > jump * F.col("previous_rows"), "jump").otherwise("ok"))
    return out.select("table_name", F.date_format("day", "yyyy-MM-dd").alias("dt"), "row_count", "previous_rows",
                      (F.col("row_count") - F.col("previous_rows")).alias("change"), status.alias("status"))


class StaleError(RuntimeError):
    pass


def alert(report: DataFrame, dt: str | None = None) -> None:
    """Raise on every day (or on one ``dt``) of a freshness report that is not ok."""
    bad = report.where("status <> 'ok'")
    bad = bad.where(F.col("dt") == dt) if dt else bad
    found = bad.orderBy("table_name", "dt").collect()  # one row per table and day at most
    if found:
        raise StaleError("; ".join(f"{r.table_name} {r.dt}: {r.status}" for r in found))
