"""Report queries over the gold marts (and the silver tables for stock and type checks).

Top-k reports order by the report key plus a unique tie-break, so the
``limit`` returns the same rows on every run (TakeOrderedAndProject: each
task keeps k rows, the driver merges k per task).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bronze_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each bronze table."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
              for t, df in tables.items()]
    return reduce(DataFrame.unionByName, frames)


def silver_types(users: DataFrame, k: int = 5) -> DataFrame:
    """Spot check of the timestamp cast: a few users with the type of ``created_at``.

    Spark names the zone-less type ``timestamp_ntz``; the family is reported.
    """
    return (users.select("user_id", "first_name", "last_name", "email", "created_at",
                         F.regexp_replace(F.typeof("created_at"), "_ntz$", "").alias("created_at_type"))
                 .orderBy(F.asc_nulls_last("user_id")).limit(k))


def daily_revenue(daily_sales: DataFrame, k: int = 10) -> DataFrame:
    return (daily_sales.select("sale_date", "total_orders", "unique_customers",
                               F.round("total_revenue", 2).alias("total_revenue"),
                               F.round("avg_order_value", 2).alias("avg_order_value"))
                       .orderBy(F.desc_nulls_last("sale_date")).limit(k))


def top_customers(clv: DataFrame, k: int = 5) -> DataFrame:
    return (clv.orderBy(F.desc_nulls_last("lifetime_value"), F.asc_nulls_last("user_id")).limit(k)
               .select("user_id",
                       F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name"),
                       "country", "total_orders",
                       F.round("lifetime_value", 2).alias("lifetime_value"),
                       "first_order_date", "last_order_date"))


def best_sellers(top_products: DataFrame, k: int = 10) -> DataFrame:
    return (top_products.orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("product_id")).limit(k)
                        .select("product_name", "category_name", "sku", "total_units_sold", "total_orders",
                                F.round("total_revenue", 2).alias("total_revenue"),
                                F.round("avg_rating", 2).alias("avg_rating"),
                                "total_reviews"))


def payment_rates(rates: DataFrame) -> DataFrame:
    return (rates.select("payment_method", "payment_status", "transaction_count",
                         F.round("total_amount", 2).alias("total_amount"),
                         F.round("pct_of_method", 2).alias("pct_of_method"))
                 .orderBy(F.asc_nulls_last("payment_method"), F.asc_nulls_last("payment_status")))


def carrier_performance(shipping: DataFrame) -> DataFrame:
    """Roll-up of the daily mart; ``total_orders_affected`` adds per-day distinct counts."""
    return (shipping.groupBy("carrier", "event_type")
                    .agg(F.sum("event_count").alias("total_events"),
                         F.sum("orders_affected").alias("total_orders_affected"))
                    .orderBy(F.asc_nulls_last("carrier"), F.asc_nulls_last("event_type")))


def low_stock(products: DataFrame, threshold: int = 20) -> DataFrame:
    return (products.where(F.col("inventory_quantity") < threshold)
                    .select("product_id", "name", "sku", "inventory_quantity")
                    .orderBy(F.asc_nulls_last("inventory_quantity"), F.asc_nulls_last("product_id")))
