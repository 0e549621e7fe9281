"""The driver's TPC-H-style tables mapped onto the ten commerce source tables.

The mapping is the one in FIXTURES.md section B, written with the DataFrame
API.  ``source_table`` returns a table exactly as the relational source would
hold it (all columns of ``schemas.TABLES[t]``, source types).  Fill rules for
columns the mapping leaves out:

* text columns → NULL;
* ``created_at`` → the row's own event time where the table has one, else
  2020-01-01 00:00:00; ``updated_at`` → ``created_at``;
* ``shipping_events.shipping_event_id`` → the same line-item position id as
  ``order_items.order_item_id`` (one shipping event per line item).

Row ids that the mapping defines by a global ORDER BY (categories, line items)
come from ``dense_row_id`` and are written once per session.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecart.functions.clean import clean_text, clean_trim
from lakecart.functions.extract_text import extract_text
from lakecart.functions.ids import dense_row_id
from lakecart.schemas import SILVER_TYPES, spec

SNAPSHOT_DT = "2024-01-01"
EPOCH_TS = "2020-01-01 00:00:00"

# Sort order that defines line-item ids.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]

_ID_CACHE: dict[tuple, DataFrame] = {}
_CACHE_LOCK = threading.RLock()


def read_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables (the relation is built once per session: no re-listing)."""
    return _cached(spark, sf_dir, f"input:{name}", lambda: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def _cached(spark: SparkSession, sf_dir: str, key: str, build) -> DataFrame:
    cache_key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"), key)
    with _CACHE_LOCK:  # re-entrant: a build may read other cached inputs
        if cache_key not in _ID_CACHE:
            for old in [k for k in _ID_CACHE if k[:2] != cache_key[:2]]:
                del _ID_CACHE[old]  # of a session that has ended
            _ID_CACHE[cache_key] = build()
        return _ID_CACHE[cache_key]


def _epoch() -> Column:
    return F.lit(EPOCH_TS).cast("timestamp_ntz")


def _mod(c: str, m: int) -> Column:
    return F.col(c) % F.lit(m)


def categories_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(category_id, name): one row per distinct part type, ids in name order."""
    def build():
        types = read_input(spark, sf_dir, "part").select(F.col("p_type").alias("name")).distinct()
        return dense_row_id(types, ["name"], "category_id").select("category_id", "name")
    return _cached(spark, sf_dir, "categories", build)


def line_items_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their position id ``line_id`` in LINE_ORDER."""
    def build():
        li = read_input(spark, sf_dir, "lineitem").select(
            *LINE_ORDER, "l_returnflag", "l_linestatus")
        return dense_row_id(li, LINE_ORDER, "line_id")
    return _cached(spark, sf_dir, "line_items", build)


def _users(spark, sf_dir, with_ids):
    c = read_input(spark, sf_dir, "customer")
    n = read_input(spark, sf_dir, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    last = F.substring("c_name", 10, 9)
    return j.select(
        F.col("c_custkey").alias("user_id"),
        F.substring("c_name", 1, 8).alias("first_name"),
        last.alias("last_name"),
        F.concat(F.lit("user_"), last, F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country"),
        _epoch().alias("created_at"),
    )


def _categories(spark, sf_dir, with_ids):
    return categories_keyed(spark, sf_dir).select("category_id", "name", _epoch().alias("created_at"))


def _products(spark, sf_dir, with_ids):
    p = read_input(spark, sf_dir, "part")
    cats = categories_keyed(spark, sf_dir)
    j = p.join(cats, p.p_type == cats.name)
    return j.select(
        F.col("p_partkey").alias("product_id"),
        F.col("category_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
        F.concat(F.lit("SKU-"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("sku"),
        F.col("p_size").alias("inventory_quantity"),
        _epoch().alias("created_at"),
    )


def _orders(spark, sf_dir, with_ids):
    o = read_input(spark, sf_dir, "orders")
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    total = F.col("o_totalprice").cast("decimal(18,2)")
    tax = F.round(total * F.lit(0.08).cast("decimal(3,2)"), 2)
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(status == "F", "delivered")
         .when((status == "O") & (prio == "1-URGENT"), "shipped")
         .when(status == "O", "confirmed")
         .when(prio == "5-LOW", "cancelled")
         .when(prio == "2-HIGH", "returned")
         .otherwise("pending").alias("status"),
        F.lit("USD").alias("currency"),
        (total - tax - F.lit(5.00).cast("decimal(3,2)")).cast("double").alias("subtotal"),
        tax.cast("double").alias("tax"),
        F.lit(5.00).cast("double").alias("shipping_cost"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").alias("created_at"),
    )


def _line_source(spark, sf_dir, with_ids):
    if with_ids:
        return line_items_keyed(spark, sf_dir)
    return read_input(spark, sf_dir, "lineitem").withColumn("line_id", F.lit(None).cast("bigint"))


def _order_items(spark, sf_dir, with_ids):
    li = _line_source(spark, sf_dir, with_ids)
    return li.select(
        F.col("line_id").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        (F.col("l_quantity").cast("decimal(10,0)") * F.col("l_extendedprice").cast("decimal(12,2)"))
        .cast("double").alias("total_price"),
        F.col("l_shipdate").alias("created_at"),
    )


def _payments(spark, sf_dir, with_ids):
    o = read_input(spark, sf_dir, "orders")
    prio, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderkey").alias("order_id"),
        F.when(prio == "1-URGENT", "credit_card").when(prio == "2-HIGH", "debit_card")
         .when(prio == "3-MEDIUM", "paypal").when(prio == "4-NOT SPECIFIED", "bank_transfer")
         .otherwise("gift_card").alias("payment_method"),
        F.when(status == "F", "completed").when(status == "O", "pending")
         .otherwise("failed").alias("payment_status"),
        F.col("o_totalprice").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("o_orderdate").alias("processed_at"),
        F.col("o_orderdate").alias("created_at"),
    )


def _shipping_events(spark, sf_dir, with_ids):
    li = _line_source(spark, sf_dir, with_ids)
    flags = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    carrier = _mod("l_suppkey", 5)
    return li.select(
        F.col("line_id").alias("shipping_event_id"),
        F.col("l_orderkey").alias("order_id"),
        F.when(flags == "AF", "delivered").when(flags == "AO", "in_transit")
         .when(flags == "NF", "picked_up").when(flags == "NO", "label_created")
         .when(flags == "RF", "returned").otherwise("delivery_failed").alias("event_type"),
        F.col("l_shipdate").alias("event_timestamp"),
        F.when(carrier == 0, "UPS").when(carrier == 1, "FedEx").when(carrier == 2, "DHL")
         .when(carrier == 3, "USPS").otherwise("Amazon Logistics").alias("carrier"),
        F.col("l_shipdate").alias("created_at"),
    )


def _product_reviews(spark, sf_dir, with_ids):
    d = read_input(spark, sf_dir, "documents")
    review_date = F.lit(SNAPSHOT_DT).cast("date")
    return d.select(
        F.col("doc_id").alias("review_id"),
        _mod("doc_id", 197).alias("product_id"),
        _mod("doc_id", 149).alias("user_id"),
        (F.lit(1) + _mod("doc_id", 5)).cast("int").alias("rating"),
        F.col("source").alias("title"),
        F.col("text").alias("body"),
        review_date.alias("review_date"),
        review_date.cast("timestamp_ntz").alias("created_at"),
    )


def _inventory_logs(spark, sf_dir, with_ids):
    e = read_input(spark, sf_dir, "events")
    et = F.col("event_type")
    fl = F.floor("value")
    return e.select(
        F.col("event_id").alias("inventory_log_id"),
        _mod("event_id", 197).alias("product_id"),
        F.when(et == "purchase", "sold").when(et == "signup", "received")
         .when(et == "click", "returned").otherwise("adjusted").alias("event_type"),
        fl.cast("int").alias("quantity"),
        F.lit(100).alias("previous_quantity"),
        F.when(et.isin("signup", "click"), (F.lit(100) + fl).cast("int"))
         .otherwise(F.greatest((F.lit(100) - fl).cast("int"), F.lit(0))).alias("new_quantity"),
        F.col("ts").alias("event_timestamp"),
        F.col("ts").alias("created_at"),
    )


def _cart_events(spark, sf_dir, with_ids):
    e = read_input(spark, sf_dir, "events")
    et = F.col("event_type")
    return e.select(
        F.col("event_id").alias("cart_event_id"),
        F.col("user_id"),
        _mod("event_id", 197).alias("product_id"),
        F.when(et == "purchase", "removed").when(et == "view", "updated")
         .when(et == "error", "abandoned").otherwise("added").alias("event_type"),
        _mod("event_id", 4).cast("int").alias("quantity"),
        F.col("ts").alias("event_timestamp"),
        F.col("ts").alias("created_at"),
    )


_MAPPERS = {
    "users": _users,
    "categories": _categories,
    "products": _products,
    "orders": _orders,
    "order_items": _order_items,
    "payments": _payments,
    "shipping_events": _shipping_events,
    "product_reviews": _product_reviews,
    "inventory_logs": _inventory_logs,
    "cart_events": _cart_events,
}


def source_table(spark: SparkSession, sf_dir: str, table: str, with_ids: bool = True) -> DataFrame:
    """The mapped source table with every column of its spec, in spec order.

    ``with_ids=False`` leaves globally ordered ids (line items) NULL, which
    skips their sort; marts never read them.
    """
    s = spec(table)
    mapped = _MAPPERS[table](spark, sf_dir, with_ids)
    present = set(mapped.columns)
    cols = []
    for c, kind in s.columns:
        if c in present:
            cols.append(F.col(c).cast(SILVER_TYPES[kind]).alias(c))
        elif c == "updated_at":
            cols.append(F.col("created_at").alias(c))
        else:
            cols.append(F.lit(None).cast(SILVER_TYPES[kind]).alias(c))
    return mapped.select(*cols)


def silver_equivalent(source: DataFrame, table: str, dt: str = SNAPSHOT_DT) -> DataFrame:
    """What silver holds after landing ``source`` once: text rules applied, ``dt`` added."""
    s = spec(table)
    cols = []
    for c, kind in s.columns:
        if kind == "str":
            cols.append(clean_trim(c).alias(c))
        elif kind == "text":
            cols.append(clean_text(c).alias(c))
        else:
            cols.append(F.col(c))
    return source.select(*cols, F.lit(dt).alias("dt"))


def fixture_silver(spark: SparkSession, sf_dir: str, table: str, with_ids: bool = False) -> DataFrame:
    """Silver-shaped table straight from the mapping (no CSV round trip)."""
    return silver_equivalent(source_table(spark, sf_dir, table, with_ids), table)


def raw_text(source: DataFrame, table: str) -> DataFrame:
    """The source table as its extract writes it: time columns as zoned text, texts padded.

    Text columns get one blank on each side (silver must trim it), numbers keep their type.
    """
    padded = [F.concat(F.lit(" "), F.col(c), F.lit(" ")).alias(c) if kind in ("str", "text") else F.col(c)
              for c, kind in spec(table).columns]
    return extract_text(source.select(*padded), table)


def typed_source(source: DataFrame, table: str) -> DataFrame:
    """The source table with the types a relational driver delivers: instants, days and exact amounts."""
    kinds = {"ts": "timestamp", "date": "date", "double": "decimal(12,2)"}
    return source.select(*[F.col(c).cast(kinds[kind]).alias(c) if kind in kinds else F.col(c)
                           for c, kind in spec(table).columns])
