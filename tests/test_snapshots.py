"""Several snapshots: latest row per key, freshness, day-wise sales state, content parity, re-landed empty days."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakecart.operators import gold, quality, sales_state
from lakecart.operators.content import ROW, content_parity, fingerprints
from lakecart.operators.snapshots import StaleError, alert, freshness, latest_per_key
from lakecart.plans.medallion import ParityError, build_silver, scratch_layout, silver_frame
from lakecart.schemas import spec
from lakecart.sinks.files import land_backfill, land_csv, partition_days, replace_days
from lakecart.sources.bronze import read_bronze
from lakecart.sources.fixtures import fixture_silver, raw_text, source_table
from lakecart.streaming.incremental import empty_days, run_incremental


def payments(spark, rows):
    """(payment_id, status, updated, dt) as silver payments."""
    df = spark.createDataFrame(rows, "payment_id bigint, payment_status string, updated_at string, dt string")
    cols = [F.col(c).cast(f.dataType) if c in df.columns else F.lit(None).cast(f.dataType).alias(c)
            for c, f in ((f.name, f) for f in spec("payments").silver_schema().fields)]
    return df.select(*cols)


def test_latest_row_of_each_key(spark):
    rows = [(1, "a", "2024-01-01", "2024-01-01"), (1, "b", "2023-01-01", "2024-01-02"), (2, "a", "2024-01-01", "2024-01-01"),
            (3, "x", "2024-01-02", "2024-01-02"), (3, "y", "2024-01-03", "2024-01-02"), (3, "z", None, "2024-01-02"),
            (4, "t", "2024-01-01", "2024-01-01"), (4, "s", "2024-01-01", "2024-01-01"),
            (None, "n", "2024-01-01", "2024-01-01"), (None, "n", "2024-01-01", "2024-01-01")]
    got = latest_per_key(payments(spark, rows).repartition(5), "payments")
    assert got.columns == spec("payments").silver_schema().names
    assert sorted((r.payment_id or 0, r.payment_status, r.dt) for r in got.collect()) == [
        (0, "n", "2024-01-01"), (0, "n", "2024-01-01"), (1, "b", "2024-01-02"), (2, "a", "2024-01-01"),
        (3, "y", "2024-01-02"), (4, "t", "2024-01-01")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan
    assert latest_per_key(payments(spark, []), "payments").count() == 0


def test_silver_of_partial_snapshots_keeps_absent_keys(spark):
    layout = scratch_layout(spark, "partial")
    raw = raw_text(source_table(spark, SF_SMALL, "orders"), "orders")
    n = land_csv(raw, layout.raw, "orders", "2024-01-01")
    m = land_csv(raw.where("order_id % 4 = 0"), layout.raw, "orders", "2024-01-02")
    where = build_silver(spark, layout, ("orders",), snapshot="latest_per_key")["orders"]
    got = {r.dt: r["count"] for r in spark.read.parquet(where).groupBy("dt").count().collect()}
    assert got == {"2024-01-01": n - m, "2024-01-02": m}
    assert silver_frame(spark, layout, "orders", snapshot="latest_per_key").count() == n


def test_latest_per_key_is_gated(spark, monkeypatch):
    from lakecart.plans import medallion
    layout = scratch_layout(spark, "gated")
    land_csv(raw_text(source_table(spark, SF_SMALL, "categories"), "categories"), layout.raw, "categories", "2024-01-01")
    monkeypatch.setattr(medallion, "latest_per_key", lambda df, t: df.limit(3))
    with pytest.raises(ParityError):
        build_silver(spark, layout, ("categories",), snapshot="latest_per_key")


def test_freshness(spark):
    days = {"a": [(1, 100), (2, 100), (4, 0), (5, 40), (6, 100)], "b": [(3, 10)], "c": [(5, 7), (6, 7)]}
    counts = spark.createDataFrame([(t, f"2024-01-0{d}", n) for t, ds in days.items() for d, n in ds], "table_name string, dt string, row_count bigint")
    got = {(r.table_name, int(r.dt[-1])): (r.row_count, r.previous_rows, r.change, r.status) for r in freshness(counts).collect()}
    assert got == {
        ("a", 1): (100, None, None, "ok"), ("a", 2): (100, 100, 0, "ok"), ("a", 3): (None, 100, None, "missing"),
        ("a", 4): (0, 100, -100, "empty"), ("a", 5): (40, 100, -60, "drop"), ("a", 6): (100, 40, 60, "jump"),
        ("b", 3): (10, None, None, "ok"), ("b", 4): (None, 10, None, "missing"), ("b", 5): (None, 10, None, "missing"),
        ("b", 6): (None, 10, None, "missing"), ("c", 5): (7, None, None, "ok"), ("c", 6): (7, 7, 0, "ok")}
    assert freshness(counts, as_of="2024-01-08").where("dt = '2024-01-08' and status = 'missing'").count() == 3
    with pytest.raises(StaleError, match="a 2024-01-06: jump; b 2024-01-06: missing"):
        alert(freshness(counts), "2024-01-06")
    alert(freshness(counts), "2024-01-02")
    assert freshness(counts.limit(0)).count() == 0


def orders(spark, rows):
    """(order_id, user_id, date, status, total, dt)"""
    df = spark.createDataFrame(rows, "order_id bigint, user_id bigint, order_date string, status string, total_amount double, dt string")
    fill = {"order_date": F.col("order_date").cast("date"), "subtotal": F.lit(1.25), "tax": F.lit(None), "shipping_cost": F.lit(0.1)}
    return df.select(*[fill.get(f.name, F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in spec("orders").silver_schema().fields])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_sales_state_equals_a_full_rebuild(spark, workdir):
    silver, state = f"{workdir}/orders", f"{workdir}/state"
    day1 = [(i, i % 7, f"2023-05-0{1 + i % 3}", "delivered" if i % 4 else "pending", i * 1.01, "2024-01-01") for i in range(60)]
    day1 += [(None, 3, "2023-05-01", "shipped", None, "2024-01-01"), (70, None, None, "shipped", 2.5, "2024-01-01"),
             (-5, 2**40, "2023-05-02", "shipped", 2.5, "2024-01-01")]
    day2 = [(i, i % 11, "2023-05-01", "delivered", 5.0, "2024-01-02") for i in range(40, 90)]
    again = [r for r in day1 if r[0] is None or r[0] % 3]
    read = lambda: spark.read.schema(spec("orders").silver_schema()).option("basePath", silver).parquet(silver)
    for rows, days in ((day1, ["2024-01-01"]), (day2, ["2024-01-02"]), (again, ["2024-01-01"]), ([], ["2024-01-02", "2024-01-03"])):
        replace_days(spark, orders(spark, rows), silver, days)
        sales_state.update(spark, read(), state, days)
        assert rows_of(sales_state.merged(spark, state)) == rows_of(gold.daily_sales(read()))
    assert partition_days(spark, f"{state}/bits") == ["2024-01-01"]


def test_sales_state_reads_changed_days_only(spark, workdir):
    silver = f"{workdir}/orders"
    replace_days(spark, orders(spark, [(i, 1, "2023-05-01", "shipped", 1.0, f"2024-01-0{1 + i % 3}") for i in range(9)]), silver,
                 ["2024-01-01", "2024-01-02", "2024-01-03"])
    changed = spark.read.parquet(silver).where(F.col("dt").isin("2024-01-02"))
    plan = sales_state.day_bits(changed)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-02" in plan.split("PartitionFilters")[1][:120]
    assert len(changed.inputFiles()) and spark.read.parquet(silver).count() == 9


def test_sales_state_takes_bytes_by_the_id(spark):
    day, far = "2024-01-01", [i * 32768 + s for i in range(-50, 50) for s in (-1, 0, 1)]  # spread: 3 ids in every 32,768
    n = 1000  # and close together
    rows = spark.createDataFrame([(i, "2023-05-01") for i in far] + [(i, "2023-05-02") for i in range(n)], "order_id bigint, d string")
    fill = {"order_id": F.col("order_id"), "user_id": F.lit(7), "order_date": F.col("d").cast("date"), "status": F.lit("shipped"), "dt": F.lit(day)}
    silver = rows.select(*[fill.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in spec("orders").silver_schema().fields])
    bits = sales_state.day_bits(silver.unionByName(silver)).where("id_column = 'order_id'")
    assert dict(bits.dtypes)["bits"] == "bigint"  # binary bitmaps are of one size, whatever they hold
    got = {str(r.sale_date): (r.n, r.ids) for r in bits.groupBy("sale_date").agg(F.count("*").alias("n"), F.sum(F.bit_count("bits")).alias("ids")).collect()}
    assert got["2023-05-01"] == (200, len(far)) and got["2023-05-02"] == (-(-n // 64), n)
    plan = sales_state.day_bits(silver)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_sales_state_keeps_the_least_and_largest_ids(spark, workdir):
    ids = [-2**63, -2**63 + 1, -65, -64, -63, -1, 0, 1, 63, 64, 2**63 - 64, 2**63 - 1]
    df = orders(spark, [(i, ids[-1 - k], "2023-05-01", "shipped", 1.0, dt) for k, i in enumerate(ids) for dt in ("2024-01-01", "2024-01-02")])
    sales_state.update(spark, df, workdir, ["2024-01-01", "2024-01-02"])
    row = sales_state.merged(spark, workdir).first()
    assert (row.total_orders, row.unique_customers) == (len(ids), len(ids))


def test_content_parity_sees_what_counts_do_not(spark):
    layout = scratch_layout(spark, "content")
    raw = raw_text(source_table(spark, SF_SMALL, "products"), "products")
    land_csv(raw, layout.raw, "products", "2024-01-01")
    bronze = read_bronze(spark, layout.raw, "products", as_text=True)
    good = silver_frame(spark, layout, "products")

    def found(extract=raw, silver=good):
        rows = content_parity({"products": extract}, {"products": bronze}, {"products": silver}).collect()
        return ({r.column_name for r in rows if r.landed != "OK"}, {r.column_name for r in rows if r.cleaned != "OK"})

    assert found() == (set(), set())
    assert found(silver=good.repartition(7)) == (set(), set())
    altered = F.when(F.col("product_id") == 9, F.lit(None)).otherwise(F.col("sku"))
    assert found(silver=good.withColumn("sku", altered)) == (set(), {"sku", ROW})
    swapped = F.when(F.col("product_id") == 1, 2).when(F.col("product_id") == 2, 1).otherwise(F.col("product_id"))
    assert found(silver=good.withColumn("product_id", swapped)) == (set(), {ROW})
    doubled = good.where("product_id <> 5").unionByName(good.where("product_id = 6"))
    assert {"product_id", "sku", ROW} <= found(silver=doubled)[1]
    assert found(extract=raw.withColumn("name", F.concat("name", F.lit("x")))) == ({"name", ROW}, set())


def test_fingerprints_tell_null_from_text(spark):
    one = lambda v: {r.column_name: r.fingerprint for r in fingerprints(
        spark.createDataFrame([(1, v, None, None, None)], "category_id bigint, name string, description string, created_at string, updated_at string"),
        "categories", "s").collect()}
    assert len({one(v)["name"] for v in (None, "", "0", "1", "a")}) == 5


def test_sales_by_category_by_hand(spark):
    o = orders(spark, [(1, 1, "2024-01-01", "shipped", 1.0, "d"), (2, 1, "2024-01-02", "delivered", 1.0, "d"), (3, 1, "2024-01-02", "pending", 1.0, "d"),
                       (4, 1, None, "shipped", 1.0, "d")])
    items = spark.createDataFrame([(1, 10, 2, 20.0), (1, 11, 1, 5.5), (2, 10, 3, 30.0), (2, 12, 1, 7.0), (2, 99, 1, 1.0), (3, 10, 9, 90.0),
                                   (4, 11, 1, 5.5), (8, 10, 1, 1.0)], "order_id bigint, product_id bigint, quantity int, total_price double")
    products = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "product_id bigint, category_id bigint")
    cats = spark.createDataFrame([(1, "a"), (2, "b")], "category_id bigint, name string")
    got = {(r.level, r.category_name, r.sale_date and r.sale_date.day): (r.order_lines, r.units, r.revenue)
           for r in gold.sales_by_category(products, cats, o, items).collect()}
    assert got == {
        ("category_day", "a", 1): (1, 2, 20.0), ("category_day", "b", 1): (1, 1, 5.5), ("category_day", "a", 2): (1, 3, 30.0),
        ("category_day", None, 2): (2, 2, 8.0), ("category_day", "b", None): (1, 1, 5.5),
        ("category", "a", None): (2, 5, 50.0), ("category", "b", None): (2, 2, 11.0), ("category", None, None): (2, 2, 8.0),
        ("day", None, 1): (2, 3, 25.5), ("day", None, 2): (3, 5, 38.0), ("day", None, None): (1, 1, 5.5), ("total", None, None): (6, 9, 69.0)}
    assert gold.sales_by_category(products, cats, o.limit(0), items).count() == 0


def test_checks_scan_each_table_once(spark):
    silver = {t: fixture_silver(spark, SF_SMALL, t) for t in ("users", "orders", "payments")}
    for t, df in silver.items():
        df.write.mode("overwrite").saveAsTable(f"scan_once_{t}")
    silver = {t: spark.table(f"scan_once_{t}") for t in silver}
    for check in (quality.check_referential, quality.check_unique):
        plan = check(silver)._jdf.queryExecution().sparkPlan().toString()
        assert {t: plan.count(f"FileScan parquet spark_catalog.default.scan_once_{t}") for t in silver} == dict.fromkeys(silver, 1)
    for t in silver:
        spark.sql(f"DROP TABLE scan_once_{t}")


def test_a_day_that_lands_again_empty_leaves_silver(spark, workdir):
    layout = scratch_layout(spark, "empties")
    src = raw_text(source_table(spark, SF_SMALL, "payments"), "payments")
    out, ckpt = f"{workdir}/silver", f"{workdir}/ckpt"
    n = land_csv(src, layout.raw, "payments", "2024-01-01")
    land_csv(src, layout.raw, "payments", "2024-01-02")
    run_incremental(spark, layout.raw, "payments", out, ckpt)
    assert spark.read.parquet(out).count() == 2 * n
    land_csv(src.limit(0), layout.raw, "payments", "2024-01-02")
    assert empty_days(spark, layout.raw, "payments") == ["2024-01-02"]
    run_incremental(spark, layout.raw, "payments", out, ckpt)
    assert {r.dt: r["count"] for r in spark.read.parquet(out).groupBy("dt").count().collect()} == {"2024-01-01": n}
    land_csv(src.limit(2), layout.raw, "payments", "2024-01-02")  # rows again
    run_incremental(spark, layout.raw, "payments", out, ckpt)
    assert spark.read.parquet(out).where("dt = '2024-01-02'").count() == 2


def test_backfill_replaces_the_days_it_names(spark):
    layout = scratch_layout(spark, "backfill")
    raw = raw_text(source_table(spark, SF_SMALL, "categories"), "categories")
    three = raw.withColumn("dt", F.concat(F.lit("2024-01-0"), (F.col("category_id") % 3 + 1).cast("string")))
    land_backfill(three, layout.raw, "categories")
    land_backfill(three.where("dt = '2024-01-02'").limit(1), layout.raw, "categories")
    got = {r.dt: r["count"] for r in read_bronze(spark, layout.raw, "categories").groupBy("dt").count().collect()}
    want = {r.dt: r["count"] for r in three.groupBy("dt").count().collect()}
    assert got == want | {"2024-01-02": 1}
