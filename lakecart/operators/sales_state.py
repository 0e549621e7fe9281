"""Daily sales kept up to date day by day, from mergeable state.

Sums and counts of separate days add up; distinct counts don't, because an
order or a customer may occur in several days' rows.  So the state holds, for
every landed day (``dt``) and sale date, exact sums and the sets of ids as
bitmaps (one row per 64 consecutive ids, only where there are any).  When a day
is added or replaced, only that day's silver rows are read and only its part of
the state is written; the mart is then merged from the state alone: sums added,
bitmaps united and counted.  The result is that of ``gold.daily_sales`` over all
days.

A bitmap is one bigint, so the state never takes more than a fixed number of
bytes per distinct id, however widely a sale date's ids are spread, and rows of
numbers are all that is shuffled and aggregated.

The state of a day is a partition folder of two Parquet tables; replacing a day
replaces its folders, so repeating an update after a failure changes nothing.
A state whose ``bits`` are binary (written before bitmaps were bigints) can't be
merged: update all its days to rebuild it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecart.functions.money import money
from lakecart.schemas import SALE_STATUSES
from lakecart.sinks.files import replace_days
from lakecart.sources.bronze import path_exists

AMOUNTS = ("subtotal", "tax", "shipping_cost", "total_amount")
IDS = ("order_id", "user_id")
SUMS_SCHEMA = ("sale_date date, " + ", ".join(f"{c} decimal(38,2)" for c in AMOUNTS)
               + ", amounts bigint, dt string")
BITS_SCHEMA = "sale_date date, id_column string, bucket bigint, bits bigint, dt string"
# 2 ** 6 = 64 consecutive ids share a bitmap.
_WORD = 6


def _sales(orders: DataFrame, statuses: tuple[str, ...]) -> DataFrame:
    return orders.where(F.col("status").isin(*statuses)).withColumn("sale_date", F.col("order_date").cast("date"))


def day_sums(orders: DataFrame, statuses: tuple[str, ...] = SALE_STATUSES) -> DataFrame:
    """Per (dt, sale date): exact sums of the amounts and how many totals there are."""
    return _sales(orders, statuses).groupBy("dt", "sale_date").agg(
        *[F.sum(money(c)).cast("decimal(38,2)").alias(c) for c in AMOUNTS], F.count(money("total_amount")).alias("amounts"))


def _bucket(i: Column) -> Column:
    """Number of the 64 ids that ``i`` is one of (rounded down, for negative ids too)."""
    return F.shiftright(i, _WORD)


def _bit(i: Column) -> Column:
    """The bitmap of its bucket in which only ``i`` is marked."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i.bitwiseAND(F.lit((1 << _WORD) - 1)).cast("int"))


def day_bits(orders: DataFrame, statuses: tuple[str, ...] = SALE_STATUSES) -> DataFrame:
    """Per (dt, sale date, id column, bucket): the ids that occur, as a bitmap."""
    ids = F.explode(F.array(*[F.struct(F.lit(c).alias("id_column"), F.col(c).alias("id")) for c in IDS]))
    seen = _sales(orders, statuses).select("dt", "sale_date", ids.alias("i")).select("dt", "sale_date", "i.*").where("id is not null")
    return (seen.groupBy("dt", "sale_date", "id_column", _bucket(F.col("id")).alias("bucket"))
            .agg(F.bit_or(_bit(F.col("id"))).alias("bits")))


def update(spark: SparkSession, orders: DataFrame, state_root: str, days: list[str]) -> None:
    """Bring the state of ``days`` up to date; ``orders`` is silver (partitioned by ``dt``: only those days are read).

    A day without sale rows (or without any row) leaves no state.
    """
    changed = orders.where(F.col("dt").isin(*days))
    replace_days(spark, day_sums(changed), f"{state_root}/sums", days)
    replace_days(spark, day_bits(changed), f"{state_root}/bits", days)


def _state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def merged(spark: SparkSession, state_root: str) -> DataFrame:
    """The ``daily_sales`` mart from the state of all days."""
    sums = (_state(spark, f"{state_root}/sums", SUMS_SCHEMA).groupBy("sale_date")
            .agg(*[F.sum(c).alias(c) for c in AMOUNTS], F.sum("amounts").alias("amounts")))
    united = (_state(spark, f"{state_root}/bits", BITS_SCHEMA).groupBy("sale_date", "id_column", "bucket")
              .agg(F.bit_or("bits").alias("bits")))
    counted = united.groupBy(F.col("sale_date").alias("_day")).agg(*[
        F.sum(F.when(F.col("id_column") == c, F.bit_count("bits")).otherwise(0)).alias(c) for c in IDS])
    both = sums.join(counted, sums["sale_date"].eqNullSafe(counted["_day"]), "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    return both.select(
        "sale_date", n("order_id").alias("total_orders"), n("user_id").alias("unique_customers"),
        F.col("subtotal").cast("double").alias("subtotal"), F.col("tax").cast("double").alias("total_tax"),
        F.col("shipping_cost").cast("double").alias("total_shipping"), F.col("total_amount").cast("double").alias("total_revenue"),
        F.try_divide(F.col("total_amount").cast("double"), F.col("amounts")).alias("avg_order_value"))
