"""Gold marts over silver tables: pure DataFrame → DataFrame functions.

Every mart aggregates before it joins, so the big tables shrink map-side
(partial aggregation) before any shuffle and a hot key never lands whole in
one task.  Where the mart's definition multiplies rows through a join (a
dimension row present twice, or two child tables joined on the same key),
the multiplicity is counted and applied arithmetically instead of emitting
the joined pairs: the results equal the join-then-group definition exactly.

Money sums are exact decimals cast to DOUBLE; NULLs sort last in both
directions, as in the warehouse.

The warehouse statements end in ORDER BY, but a stored table has no reading
order, so ``sort`` defaults to False: marts are written with a per-file sort
on their leading key (``MART_SORT_KEYS``, no shuffle; tight Parquet min/max
statistics) and report queries order what they show.  ``sort=True`` gives the
statement's global order (a range shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecart.functions.money import cents, cents_parts, from_parts, money, money_avg, money_sum, round_half_up_pct
from lakecart.schemas import SALE_STATUSES


def _one() -> F.Column:
    return F.count(F.lit(1))


def daily_sales(orders: DataFrame, statuses: tuple[str, ...] = SALE_STATUSES, sort: bool = False) -> DataFrame:
    """Revenue and order volume per order day, sale statuses only."""
    sales = orders.where(F.col("status").isin(*statuses))
    out = sales.groupBy(F.col("order_date").cast("date").alias("sale_date")).agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("user_id").alias("unique_customers"),
        money_sum("subtotal").cast("double").alias("subtotal"),
        money_sum("tax").cast("double").alias("total_tax"),
        money_sum("shipping_cost").cast("double").alias("total_shipping"),
        money_sum("total_amount").cast("double").alias("total_revenue"),
        money_avg("total_amount").alias("avg_order_value"),
    )
    return out.orderBy(F.asc_nulls_last("sale_date")) if sort else out


def customer_lifetime_value(users: DataFrame, orders: DataFrame,
                            statuses: tuple[str, ...] = SALE_STATUSES, sort: bool = False) -> DataFrame:
    """Spend and order span per user; users without a sale order are kept with NULLs.

    The status test belongs to the join condition, so it filters the orders
    side before the left join.  Orders are reduced to one row per user first;
    ``_m`` counts user rows sharing one (id, name, email, country) group,
    which the join-then-group definition multiplies sums by.
    """
    per_user = (orders.where(F.col("status").isin(*statuses))
                .groupBy("user_id").agg(
                    F.count_distinct("order_id").alias("_orders"),
                    money_sum("total_amount").alias("_sum"),
                    F.count(money("total_amount")).alias("_n"),
                    F.min(F.col("order_date").cast("date")).alias("_first"),
                    F.max(F.col("order_date").cast("date")).alias("_last"),
                ))
    keys = ["user_id", "first_name", "last_name", "email", "country"]
    joined = users.select(*keys).join(per_user, "user_id", "left")
    grouped = joined.groupBy(*keys).agg(
        _one().alias("_m"),
        F.max("_orders").alias("_orders"), F.max("_sum").alias("_sum"), F.max("_n").alias("_n"),
        F.max("_first").alias("_first"), F.max("_last").alias("_last"),
    )
    out = grouped.select(
        *keys,
        F.coalesce(F.col("_orders"), F.lit(0)).alias("total_orders"),
        (F.col("_sum") * F.col("_m")).cast("double").alias("lifetime_value"),
        F.try_divide(F.col("_sum").cast("double"), F.col("_n")).alias("avg_order_value"),
        F.col("_first").alias("first_order_date"),
        F.col("_last").alias("last_order_date"),
        F.datediff("_last", "_first").cast("bigint").alias("customer_lifespan_days"),
    )
    return out.orderBy(F.desc_nulls_last("lifetime_value")) if sort else out


def _product_base(products: DataFrame, categories: DataFrame, order_items: DataFrame,
                  reviews: DataFrame) -> DataFrame:
    """One row per (product, name, sku, category name, price) group with per-side aggregates.

    ``_w`` = product × category rows in the group, ``_r`` = review rows of the
    product; the join-then-group definition repeats every item row
    ``_w * max(_r, 1)`` times.
    """
    items = order_items.groupBy("product_id").agg(
        F.sum("quantity").alias("_units"),
        F.count_distinct("order_id").alias("_orders"),
        money_sum("total_price").alias("_revenue"),
    )
    revs = reviews.groupBy("product_id").agg(
        F.sum("rating").alias("_rsum"),
        F.count("rating").alias("_rn"),
        F.count_distinct("review_id").alias("_reviews"),
        _one().alias("_r"),
    )
    cats = categories.select("category_id", F.col("name").alias("category_name"))
    p = products.select("product_id", "category_id", F.col("name").alias("product_name"), "sku",
                        F.col("price").alias("unit_price"))
    # Category lookup first: the product_id joins then leave rows partitioned
    # by product_id, which the final grouping reuses without another shuffle.
    joined = (p.join(cats, "category_id", "left")
               .join(items, "product_id", "left")
               .join(revs, "product_id", "left"))
    keys = ["product_id", "product_name", "sku", "category_name", "unit_price"]
    return joined.groupBy(*keys).agg(
        _one().alias("_w"),
        *[F.max(c).alias(c) for c in ("_units", "_orders", "_revenue", "_rsum", "_rn", "_reviews", "_r")],
    )


def _product_select(base: DataFrame, fan_out: bool, sort: bool) -> DataFrame:
    mult = (F.col("_w") * F.coalesce(F.col("_r"), F.lit(1))) if fan_out else F.lit(1)
    out = base.select(
        "product_id", "product_name", "sku", "category_name", "unit_price",
        (F.col("_units") * mult).cast("bigint").alias("total_units_sold"),
        F.coalesce(F.col("_orders"), F.lit(0)).alias("total_orders"),
        (F.col("_revenue") * mult).cast("double").alias("total_revenue"),
        F.try_divide(F.col("_rsum").cast("double"), F.col("_rn")).alias("avg_rating"),
        F.coalesce(F.col("_reviews"), F.lit(0)).alias("total_reviews"),
    )
    return out.orderBy(F.desc_nulls_last("total_revenue")) if sort else out


def top_products(products: DataFrame, categories: DataFrame, order_items: DataFrame,
                 reviews: DataFrame, sort: bool = False) -> DataFrame:
    """Units, orders, revenue and rating per product, as defined: item and review
    rows are joined on the same product, so unit and revenue sums count each
    item once per review of the product.  Distinct counts and the average
    rating are not affected."""
    return _product_select(_product_base(products, categories, order_items, reviews), True, sort)


def top_products_exact(products: DataFrame, categories: DataFrame, order_items: DataFrame,
                       reviews: DataFrame, sort: bool = False) -> DataFrame:
    """``top_products`` with each side aggregated on its own: true units and revenue."""
    return _product_select(_product_base(products, categories, order_items, reviews), False, sort)


def inventory_movement(inventory_logs: DataFrame, products: DataFrame, sort: bool = False) -> DataFrame:
    """Stock events per product, type and day, with the product's name and SKU."""
    moves = inventory_logs.groupBy(
        "product_id", "event_type", F.col("event_timestamp").cast("date").alias("event_date")
    ).agg(
        _one().alias("_n"),
        F.sum("quantity").alias("_q"),
        F.sum("new_quantity").alias("_s"),
        F.count("new_quantity").alias("_c"),
    )
    p = products.select("product_id", F.col("name").alias("product_name"), "sku")
    joined = moves.join(p, "product_id", "left")
    out = joined.groupBy("product_id", "product_name", "sku", "event_type", "event_date").agg(
        F.sum("_n").alias("event_count"),
        F.sum("_q").alias("total_quantity_moved"),
        F.try_divide(F.sum("_s").cast("double"), F.sum("_c")).alias("avg_stock_after_event"),
    )
    return out.orderBy(F.desc_nulls_last("event_date"), F.asc_nulls_last("product_name")) if sort else out


def payment_success_rates(payments: DataFrame, sort: bool = False) -> DataFrame:
    """Count, amount and share of each status within its payment method."""
    grouped = payments.groupBy("payment_method", "payment_status").agg(
        _one().alias("transaction_count"),
        money_sum("amount").cast("double").alias("total_amount"),
        money_avg("amount").alias("avg_amount"),
    )
    method_total = F.sum("transaction_count").over(Window.partitionBy("payment_method"))
    out = grouped.withColumn("pct_of_method", round_half_up_pct("transaction_count", method_total))
    return out.orderBy(F.asc_nulls_last("payment_method"), F.asc_nulls_last("payment_status")) if sort else out


def shipping_performance(shipping_events: DataFrame, sort: bool = False) -> DataFrame:
    """Events and distinct orders per carrier, event type and day."""
    out = shipping_events.groupBy(
        "carrier", "event_type", F.col("event_timestamp").cast("date").alias("event_date")
    ).agg(
        _one().alias("event_count"),
        F.count_distinct("order_id").alias("orders_affected"),
    )
    return out.orderBy(F.desc_nulls_last("event_date"), F.asc_nulls_last("carrier"),
                       F.asc_nulls_last("event_type")) if sort else out


def sales_by_category(products: DataFrame, categories: DataFrame, orders: DataFrame, order_items: DataFrame,
                      statuses: tuple[str, ...] = SALE_STATUSES) -> DataFrame:
    """Units, order lines and revenue of sale orders per category and day, with subtotals.

    ``level`` names the grouping set of a row: ``category_day``, ``category``
    (all days), ``day`` (all categories), ``total``; the columns that a level
    sums over are NULL.  Items of orders without a sale status or without an
    order row are left out; a product without a category (or no product) counts
    under a NULL category of its own.

    Items meet their order by one shuffle (grouping them by order and product
    first would shuffle nearly every line twice, as hardly any order has a
    product twice; an order with very many lines is split by adaptive
    execution), are then reduced to one row per product and day, and only those
    rows are looked up and expanded into the four sets.
    """
    sales = orders.where(F.col("status").isin(*statuses)).groupBy("order_id", F.col("order_date").cast("date").alias("sale_date")) \
                  .agg(_one().alias("_o"))
    # An order present twice (two snapshots) counts its lines twice, as the join would.
    lines = order_items.select("order_id", "product_id", "quantity", cents("total_price").alias("_c"))
    high, low = cents_parts("_c")
    per_product = lines.join(sales, "order_id").groupBy("product_id", "sale_date").agg(
        F.sum("_o").alias("_n"), F.sum(F.col("quantity") * F.col("_o")).alias("_q"),
        F.sum(high * F.col("_o")).alias("_high"), F.sum(low * F.col("_o")).alias("_low")) \
        .withColumn("_r", from_parts("_high", "_low"))
    named = (products.select("product_id", "category_id")
             .join(categories.select("category_id", F.col("name").alias("category_name")), "category_id", "left")
             .groupBy("product_id", "category_name").agg(_one().alias("_w")))
    facts = per_product.join(named, "product_id", "left").select(
        "category_name", "sale_date", F.coalesce("_w", F.lit(1)).alias("_w"), "_n", "_q", "_r")
    both, neither = [F.col("category_name"), F.col("sale_date")], []
    cube = facts.groupingSets([both, both[:1], both[1:], neither], *both).agg(
        F.sum(F.col("_n") * F.col("_w")).alias("order_lines"), F.sum(F.col("_q") * F.col("_w")).alias("units"),
        F.sum((F.col("_r") * F.col("_w").cast("decimal(10,0)")).cast("decimal(38,2)")).cast("double").alias("revenue"),
        F.grouping_id("category_name", "sale_date").alias("_set"))
    level = F.element_at(F.array(*map(F.lit, ("category_day", "category", "day", "total"))), (F.col("_set") + 1).cast("int"))
    return cube.where("order_lines is not null").select(level.alias("level"), "category_name", "sale_date", "order_lines", "units", "revenue")


# Per-file sort keys used when a mart is written (leading ORDER BY key of each statement).
# Of marts whose reports want the largest: (value, key).
MART_RANGE_KEYS = {
    "customer_lifetime_value": ("lifetime_value", "user_id"),
    "top_products": ("total_revenue", "product_id"),
}
MART_SORT_KEYS = {
    "daily_sales": ["sale_date"],
    "customer_lifetime_value": ["lifetime_value"],
    "top_products": ["total_revenue"],
    "top_products_exact": ["total_revenue"],
    "inventory_movement": ["event_date", "product_name"],
    "payment_success_rates": ["payment_method", "payment_status"],
    "shipping_performance": ["event_date", "carrier", "event_type"],
}


def build_marts(silver: dict[str, DataFrame], sort: bool = False) -> dict[str, DataFrame]:
    """All six marts from a dict of silver tables."""
    return {
        "daily_sales": daily_sales(silver["orders"], sort=sort),
        "customer_lifetime_value": customer_lifetime_value(silver["users"], silver["orders"], sort=sort),
        "top_products": top_products(silver["products"], silver["categories"], silver["order_items"],
                                     silver["product_reviews"], sort=sort),
        "inventory_movement": inventory_movement(silver["inventory_logs"], silver["products"], sort=sort),
        "payment_success_rates": payment_success_rates(silver["payments"], sort=sort),
        "shipping_performance": shipping_performance(silver["shipping_events"], sort=sort),
    }
