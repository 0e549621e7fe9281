"""Mart semantics on hand-made silver rows."""

import datetime as dt

from pyspark.sql import functions as F

from lakecart.operators import gold, reports

D = dt.date(2024, 1, 1)


def orders(spark, rows):
    return spark.createDataFrame(
        rows, "order_id bigint, user_id bigint, order_date date, status string, subtotal double, tax double, "
              "shipping_cost double, total_amount double, dt string")


def users(spark, rows):
    return spark.createDataFrame(rows, "user_id bigint, first_name string, last_name string, email string, "
                                       "country string, dt string")


def test_daily_sales_status_filter_and_exact_sums(spark):
    o = orders(spark, [
        (1, 1, D, "processing", 0.1, 0.2, 0.0, 0.3, "d"),
        (2, 1, D, "confirmed", 9.0, 0.0, 0.0, 9.0, "d"),
        (3, 2, D, "delivered", 0.1, 0.2, 0.0, 0.3, "d"),
    ])
    r = gold.daily_sales(o).collect()
    assert len(r) == 1
    row = r[0]
    assert (row.total_orders, row.unique_customers) == (2, 2)
    assert row.total_revenue == 0.6  # exact decimal sum, not 0.6000000000000001
    assert row.avg_order_value == 0.3


def test_clv_user_without_orders_and_lifespan(spark):
    u = users(spark, [(1, "A", "One", "a@x", "NL", "d"), (2, "B", "Two", "b@x", "NL", "d"),
                      (3, "C", "Three", "c@x", "NL", "d")])
    o = orders(spark, [
        (10, 1, D, "shipped", 1.0, 0.0, 0.0, 10.0, "d"),
        (11, 1, dt.date(2024, 1, 11), "delivered", 1.0, 0.0, 0.0, 20.0, "d"),
        (12, 2, D, "cancelled", 1.0, 0.0, 0.0, 99.0, "d"),
        (13, 3, D, "delivered", 1.0, 0.0, 0.0, 5.0, "d"),
    ])
    res = {r.user_id: r for r in gold.customer_lifetime_value(u, o).collect()}
    assert res[1].total_orders == 2 and res[1].lifetime_value == 30.0 and res[1].customer_lifespan_days == 10
    assert res[2].total_orders == 0 and res[2].lifetime_value is None and res[2].first_order_date is None
    assert res[3].customer_lifespan_days == 0
    ordered = gold.customer_lifetime_value(u, o, sort=True).collect()
    assert ordered[-1].user_id == 2  # NULL sorts last in DESC


def test_two_snapshots_double_sums_not_distincts(spark):
    u = users(spark, [(1, "A", "One", "a@x", "NL", "d1"), (1, "A", "One", "a@x", "NL", "d2")])
    o = orders(spark, [(10, 1, D, "shipped", 1.0, 0.0, 0.0, 10.0, "d1"),
                       (10, 1, D, "shipped", 1.0, 0.0, 0.0, 10.0, "d2")])
    r = gold.customer_lifetime_value(u, o).first()
    # users x orders join: 2 user rows x 2 order rows = 4 pairs of 10.0
    assert r.total_orders == 1 and r.lifetime_value == 40.0 and r.avg_order_value == 10.0
    ds = gold.daily_sales(o).first()
    assert ds.total_orders == 1 and ds.total_revenue == 20.0


def product_frames(spark):
    products = spark.createDataFrame([(1, 1, "P1", "S1", 5.0), (2, 1, "P2", "S2", 7.0)],
                                     "product_id bigint, category_id bigint, name string, sku string, price double")
    cats = spark.createDataFrame([(1, "C")], "category_id bigint, name string")
    items = spark.createDataFrame([(100, 1, 1, 10.0), (101, 1, 2, 20.0)],
                                  "order_id bigint, product_id bigint, quantity int, total_price double")
    reviews = spark.createDataFrame([(1, 1, 5), (2, 1, 4), (3, 1, 3)],
                                    "review_id bigint, product_id bigint, rating int")
    return products, cats, items, reviews


def test_top_products_fan_out_vs_exact(spark):
    p, c, i, r = product_frames(spark)
    fan = {x.product_id: x for x in gold.top_products(p, c, i, r).collect()}
    exact = {x.product_id: x for x in gold.top_products_exact(p, c, i, r).collect()}
    assert fan[1].total_units_sold == 9 and exact[1].total_units_sold == 3
    assert fan[1].total_revenue == 90.0 and exact[1].total_revenue == 30.0
    assert fan[1].total_orders == exact[1].total_orders == 2
    assert fan[1].avg_rating == exact[1].avg_rating == 4.0
    assert fan[1].total_reviews == 3
    # never sold, never reviewed: kept, sums NULL, counts 0
    assert fan[2].total_units_sold is None and fan[2].total_orders == 0 and fan[2].total_reviews == 0


def test_top_products_matches_join_then_group(spark):
    """The arithmetic multiplicity equals the literal join-then-group definition, duplicates included."""
    p, c, i, r = product_frames(spark)
    p = p.unionByName(p.where("product_id = 1"))  # product row present twice
    c = c.unionByName(c)                            # category row present twice
    fast = sorted(tuple(x) for x in gold.top_products(p, c, i, r).collect())
    pp = p.alias("p")
    j = (pp.join(c.alias("c"), F.col("p.category_id") == F.col("c.category_id"), "left")
           .join(i.alias("oi"), F.col("p.product_id") == F.col("oi.product_id"), "left")
           .join(r.alias("pr"), F.col("p.product_id") == F.col("pr.product_id"), "left"))
    slow = j.groupBy(F.col("p.product_id"), F.col("p.name").alias("product_name"), F.col("p.sku"),
                     F.col("c.name").alias("category_name"), F.col("p.price").alias("unit_price")).agg(
        F.sum("oi.quantity").alias("u"), F.count_distinct("oi.order_id").alias("o"),
        F.sum("oi.total_price").alias("rev"), F.avg("pr.rating").alias("a"), F.count_distinct("pr.review_id").alias("n"))
    slow = sorted(tuple(x) for x in slow.collect())
    assert fast == slow


def test_payment_pct_sums_to_100(spark):
    pays = spark.createDataFrame(
        [("card", "completed", 1.0)] * 2 + [("card", "failed", 1.0)] + [("paypal", "pending", 2.5)],
        "payment_method string, payment_status string, amount double")
    res = gold.payment_success_rates(pays).collect()
    pct = {(x.payment_method, x.payment_status): x.pct_of_method for x in res}
    assert pct == {("card", "completed"): 66.67, ("card", "failed"): 33.33, ("paypal", "pending"): 100.0}


def test_shipping_and_carrier_rollup(spark):
    ev = spark.createDataFrame(
        [(1, "UPS", "delivered", dt.datetime(2024, 1, 1, 10)), (1, "UPS", "delivered", dt.datetime(2024, 1, 1, 11)),
         (2, "UPS", "delivered", dt.datetime(2024, 1, 2, 9))],
        "order_id bigint, carrier string, event_type string, event_timestamp timestamp_ntz")
    sp = gold.shipping_performance(ev)
    assert sorted((r.event_date.day, r.event_count, r.orders_affected) for r in sp.collect()) == [(1, 2, 1), (2, 1, 1)]
    roll = reports.carrier_performance(sp).first()
    assert (roll.total_events, roll.total_orders_affected) == (3, 2)


def test_inventory_movement_avg_and_names(spark):
    logs = spark.createDataFrame(
        [(1, "sold", 3, 7, dt.datetime(2024, 1, 1)), (1, "sold", 2, 4, dt.datetime(2024, 1, 1)),
         (9, "received", 1, 1, dt.datetime(2024, 1, 1))],
        "product_id bigint, event_type string, quantity int, new_quantity int, event_timestamp timestamp_ntz")
    prods = spark.createDataFrame([(1, "P1", "S1")], "product_id bigint, name string, sku string")
    res = {r.product_id: r for r in gold.inventory_movement(logs, prods).collect()}
    assert (res[1].event_count, res[1].total_quantity_moved, res[1].avg_stock_after_event) == (2, 5, 5.5)
    assert res[9].product_name is None


def test_reports_top_k_tie_break(spark):
    clv = spark.createDataFrame(
        [(i, "F", "L", "NL", 1, 10.0 if i < 8 else None, D, D) for i in range(10)],
        "user_id bigint, first_name string, last_name string, country string, total_orders bigint, "
        "lifetime_value double, first_order_date date, last_order_date date")
    top = [r.user_id for r in reports.top_customers(clv).collect()]
    assert top == [0, 1, 2, 3, 4]
    assert reports.top_customers(clv).first().full_name == "F L"


def test_hot_product_a_third_of_all_rows(spark):
    """One product holds a third of the items and reviews: results stay exact and items are
    partially aggregated before their first shuffle (a hot key costs one row per task there)."""
    items = spark.range(0, 3000).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50 + 2).alias("product_id"),
        (F.col("id") % 4 + 1).cast("int").alias("quantity"),
        ((F.col("id") % 7 + 1) * 1.25).alias("total_price"))
    reviews = spark.range(0, 300).select(
        F.col("id").alias("review_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50 + 2).alias("product_id"),
        (F.col("id") % 5 + 1).cast("int").alias("rating"))
    products = spark.range(1, 53).select(F.col("id").alias("product_id"), F.lit(1).cast("bigint").alias("category_id"),
                                         F.concat(F.lit("P"), F.col("id")).alias("name"), F.lit("S").alias("sku"),
                                         F.lit(2.5).alias("price"))
    cats = spark.createDataFrame([(1, "C")], "category_id bigint, name string")
    fast = gold.top_products(products, cats, items, reviews)
    j = (products.alias("p").join(cats.alias("c"), "category_id", "left")
         .join(items.alias("oi"), F.col("p.product_id") == F.col("oi.product_id"), "left")
         .join(reviews.alias("pr"), F.col("p.product_id") == F.col("pr.product_id"), "left"))
    slow = j.groupBy(F.col("p.product_id")).agg(
        F.sum("oi.quantity").alias("u"), F.count_distinct("oi.order_id").alias("o"),
        F.sum(F.col("oi.total_price").cast("decimal(18,2)")).cast("double").alias("rev"),
        F.avg("pr.rating").alias("a"), F.count_distinct("pr.review_id").alias("n"))
    got = sorted((r.product_id, r.total_units_sold, r.total_orders, r.total_revenue, r.avg_rating, r.total_reviews)
                 for r in fast.collect())
    want = sorted(tuple(r) for r in slow.collect())
    assert got == want
    hot = [g for g in got if g[0] == 1][0]
    assert hot[2] == 1000 and hot[5] == 100
    plan = spark._jvm.PythonSQLUtils.explainString(fast._jdf.queryExecution(), "simple")
    assert "partial_sum(quantity" in plan and "partial_count(distinct order_id" in plan
