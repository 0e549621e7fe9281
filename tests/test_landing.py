"""Landing typed and damaged data, publishing, version folders, loads as frames and statements."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecart.functions.extract_text import time_text
from lakecart.functions.money import money, not_money
from lakecart.operators.keys import MissingKeyError, append_frames
from lakecart.operators.quality import check_cast_loss, run_checks
from lakecart.plans import medallion
from lakecart.plans.medallion import (ParityError, bronze_frame, build_bronze, build_gold, build_silver, current_tables, extract,
                                      one_snapshot, read_silver, run_all, scratch_layout, silver_frame)
from lakecart.schemas import INSERT_ORDER, TABLE_NAMES, spec
from lakecart.session import is_local
from lakecart.sinks import files
from lakecart.sinks.files import MalformedRecords, clean_raw_csv, land_csv, prune_versions, write_table, write_version
from lakecart.sources import jdbc
from lakecart.sources.bronze import partition_row_counts, raw_file_inventory, read_bronze
from lakecart.sources.fixtures import fixture_silver, raw_text, source_table, typed_source
from lakecart.streaming.incremental import run_incremental

from conftest import SF_SMALL

DAY = "2024-01-01"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("table", TABLE_NAMES)
def test_typed_extract_survives_to_silver(spark, table):
    layout = scratch_layout(spark, "typed")
    source = source_table(spark, SF_SMALL, table, with_ids=False)
    extract({table: typed_source(source, table)}, layout, DAY)
    columns = [c for c, k in spec(table).columns if k in ("ts", "date", "double")]
    assert rows(silver_frame(spark, layout, table), *columns) == rows(fixture_silver(spark, SF_SMALL, table), *columns)


def test_time_text_of_every_type(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 10, 0, 0, 123456), dt.date(2024, 2, 29), "2024-01-01 10:00:00+00"),
         (dt.datetime(1969, 12, 31, 23, 59, 59, 500000), None, None), (None, None, None)],
        T.StructType([T.StructField("n", T.TimestampNTZType()), T.StructField("d", T.DateType()), T.StructField("s", T.StringType())]))
    df = df.withColumn("t", F.col("n").cast("timestamp"))
    kinds = {f.name: f.dataType for f in df.schema}
    want = [("2024-01-01 10:00:00.123456+00",) * 2 + ("2024-02-29 00:00:00+00", "2024-01-01 10:00:00+00"),
            ("1969-12-31 23:59:59.5+00",) * 2 + (None, None), (None,) * 4]
    text = df.select(*[time_text(F.col(c), kinds[c]).alias(c) for c in "ntds"])
    assert [tuple(r) for r in text.collect()] == want
    # Instants don't depend on the session's zone, not even where local times repeat.
    instants = spark.range(1).select(F.timestamp_micros(F.lit(1_698_537_600_000_001)).alias("t"))  # 2023-10-29 00:00:00.000001 UTC
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
        assert instants.select(time_text(F.col("t"), T.TimestampType())).first()[0] == "2023-10-29 00:00:00.000001+00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def payments(spark):
    return raw_text(source_table(spark, SF_SMALL, "payments"), "payments")


def test_adding_nothing_leaves_the_day(spark, workdir):
    df = payments(spark).limit(5)
    land_csv(df, workdir, "payments", DAY)
    assert land_csv(df.limit(0), workdir, "payments", DAY, overwrite=False) == 0
    assert read_bronze(spark, workdir, "payments").count() == 5
    assert land_csv(df, workdir, "payments", DAY, overwrite=False) == 5
    assert read_bronze(spark, workdir, "payments").count() == 10
    assert land_csv(df.limit(0), workdir, "payments", DAY) == 0  # an empty day replaces it
    assert read_bronze(spark, workdir, "payments").count() == 0
    assert land_csv(df.limit(0), workdir, "payments", "2024-01-02", overwrite=False) == 0  # a new day gets its header
    assert os.listdir(f"{workdir}/payments/dt=2024-01-02")


def test_a_missing_metric_is_an_error(spark, workdir, monkeypatch):
    land_csv(payments(spark).limit(3), workdir, "payments", DAY)
    monkeypatch.setattr(files.Observation, "get", property(lambda self: {}))
    with pytest.raises(KeyError):
        land_csv(payments(spark).limit(3), workdir, "payments", DAY)
    monkeypatch.undo()
    assert read_bronze(spark, workdir, "payments").count() == 3


def test_files_follow_bytes(spark, workdir):
    df = spark.range(0, 4000, numPartitions=1).select(
        *[(F.col("id") if c == "review_id" else F.concat_ws("", *[F.sha2(F.concat("id", F.lit(f"-{i}")), 256) for i in range(8)]) if c == "body" else F.lit(None)).cast(f.dataType).alias(c)
          for c, f in zip(spec("product_reviews").column_names, spec("product_reviews").bronze_schema())])
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "8k")
        land_csv(df, workdir, "product_reviews", DAY)
    finally:
        spark.conf.set(size, before)
    assert len([f for f in os.listdir(f"{workdir}/product_reviews/dt={DAY}") if f.endswith(".csv")]) > 1
    assert read_bronze(spark, workdir, "product_reviews").count() == 4000


def test_landing_again_replaces_the_day_in_incremental_silver(spark, workdir):
    layout = scratch_layout(spark, "again")
    src, out, ckpt = payments(spark), f"{workdir}/silver", f"{workdir}/ckpt"
    land_csv(src, layout.raw, "payments", DAY)
    run_incremental(spark, layout.raw, "payments", out, ckpt)
    land_csv(src.limit(7), layout.raw, "payments", DAY)
    land_csv(src.limit(2), layout.raw, "payments", "2024-01-02")
    run_incremental(spark, layout.raw, "payments", out, ckpt)
    assert rows(spark.read.parquet(out).groupBy("dt").count(), "dt", "count") == [(DAY, 7), ("2024-01-02", 2)]
    marts = build_gold(spark, layout, {"payments": spark.read.parquet(out)} | {
        t: fixture_silver(spark, SF_SMALL, t) for t in TABLE_NAMES if t != "payments"})
    assert spark.read.parquet(marts["payment_success_rates"]).agg(F.sum("transaction_count")).first()[0] == 9


def test_a_failed_gate_publishes_nothing(spark, monkeypatch):
    layout = scratch_layout(spark, "gate")
    sources = {"payments": payments(spark)}
    first = run_all_silver(spark, layout, sources)
    name = f"{layout.silver_db}.payments"
    n = spark.table(name).count()
    real = medallion.silver_select
    monkeypatch.setattr(medallion, "silver_select", lambda df, t, strict=False: real(df, t, strict).where("payment_id % 2 = 0"))
    with pytest.raises(ParityError):
        build_silver(spark, layout, ("payments",))
    monkeypatch.undo()
    assert current_tables(spark, layout.silver_root, ["payments"]) == first
    assert spark.table(name).count() == n
    with pytest.raises(ParityError):  # bronze itself lost rows of the extract
        build_silver(spark, layout, ("payments",), extracted=(DAY, {"payments": n + 1}))
    assert current_tables(spark, layout.silver_root, ["payments"]) == first
    second = build_silver(spark, layout, ("payments",), extracted=(DAY, {"payments": n}))
    assert current_tables(spark, layout.silver_root, ["payments"]) == second != first


def run_all_silver(spark, layout, sources):
    extract(sources, layout, DAY)
    build_bronze(spark, layout, tuple(sources))
    return build_silver(spark, layout, tuple(sources))


def test_unpublished_versions_are_ignored_and_pruning_keeps_recent(spark):
    layout = scratch_layout(spark, "prune")
    df = spark.range(3)
    made = [write_table(spark, df, layout.gold_db, "t", layout.gold_root) for _ in range(4)]
    newer = write_version(df, "t", layout.gold_root)
    assert current_tables(spark, layout.gold_root, ["t"]) == {"t": made[-1]}
    assert prune_versions(spark, layout.gold_root, "t", keep=1) == [made[1], made[0]]
    assert spark.read.parquet(newer).count() == spark.read.parquet(made[2]).count() == 3
    assert spark.table(f"{layout.gold_db}.t").count() == 3
    assert prune_versions(spark, layout.gold_root, "absent") == []


def damaged(spark, root):
    head = ",".join(spec("orders").column_names)
    ts = "2024-01-01 00:00:00+00"
    good = f"1,2,{ts},delivered,USD,1.5,0,0,1.5,,,{ts},{ts}"
    lines = [head, good, good.replace("1,2", "abc,2", 1), good.replace("1.5", "oops", 1), "7,8," + ts, good + ",surplus",
             good.replace(f",{ts},{ts}", f",{ts}+08,2024-13-01", 1)]
    os.makedirs(f"{root}/orders/dt={DAY}")
    with open(f"{root}/orders/dt={DAY}/orders.csv", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_every_loss_is_counted(spark, workdir):
    damaged(spark, workdir)
    text = read_bronze(spark, workdir, "orders", as_text=True)
    found = {r.rule: r.violations for r in check_cast_loss({"orders": text}).collect() if r.violations}
    assert found == {"cast_loss(order_id)": 1, "cast_loss(subtotal)": 1, "cast_loss(created_at)": 1, "cast_loss(updated_at)": 1, "field_count": 2}
    silver = {"orders": medallion.silver_select(text, "orders"), "users": fixture_silver(spark, SF_SMALL, "users")}
    assert {("orders", "field_count", 2)} <= {tuple(r) for r in run_checks(silver, {"orders": text}).collect()}
    with pytest.raises(MalformedRecords):
        clean_raw_csv(spark, workdir, f"{workdir}/clean", ["orders"])


def test_losses_are_in_the_build_metrics(spark):
    layout = scratch_layout(spark, "metrics")
    damaged(spark, layout.raw)
    build_bronze(spark, layout, ("orders",))
    metrics = {}
    build_silver(spark, layout, ("orders",), metrics=metrics)
    assert metrics["orders"]["rows"] == 6 and metrics["orders"]["field_count"] == 2
    assert metrics["orders"]["cast_loss(subtotal)"] == 1


def test_bad_records_are_kept_with_file_and_reason(spark):
    layout = scratch_layout(spark, "quarantine")
    damaged(spark, layout.raw)
    raw = f"{layout.raw}/orders/dt={DAY}/orders.csv"
    lines = open(raw).read().splitlines()
    build_bronze(spark, layout, ("orders",))
    build_silver(spark, layout, ("orders",))
    assert not os.path.exists(layout.quarantine_root)  # only where asked for
    build_silver(spark, layout, ("orders",), quarantine=True)
    rows = spark.table(f"{layout.quarantine_db}.orders").collect()
    assert {r.record: r.reasons for r in rows} == {
        lines[2]: ["cast_loss(order_id)"], lines[3]: ["cast_loss(subtotal)"], lines[4]: ["field_count"], lines[5]: ["field_count"],
        lines[6]: ["cast_loss(created_at)", "cast_loss(updated_at)"]}
    assert {(r.table_name, r.dt, r.file.endswith(f"/orders/dt={DAY}/orders.csv")) for r in rows} == {("orders", DAY, True)}
    # Mended raw data leave no record behind, and silver has all rows both times.
    with open(raw, "w") as f:
        f.write("\n".join(lines[:2]) + "\n")
    build_silver(spark, layout, ("orders",), quarantine=True)
    assert spark.table(f"{layout.quarantine_db}.orders").count() == 0 and spark.table(f"{layout.silver_db}.orders").count() == 1


def test_a_failed_gate_publishes_no_quarantine(spark):
    layout = scratch_layout(spark, "quarantine-gate")
    damaged(spark, layout.raw)
    build_bronze(spark, layout, ("orders",))
    with pytest.raises(medallion.ParityError):
        build_silver(spark, layout, ("orders",), extracted=(DAY, {"orders": 99}), quarantine=True)
    assert not spark.catalog.tableExists(f"{layout.quarantine_db}.orders")


def test_quoted_fields_stay_one_record_in_quarantine(spark):
    layout = scratch_layout(spark, "quarantine-text")
    s = spec("product_reviews")
    values = {c: {"id": "1", "int": "oops", "double": "1.0", "ts": "2024-01-01 00:00:00+00", "date": "2024-01-01 00:00:00+00"}.get(k, 'a, "b"\nc') for c, k in s.columns}
    frame = spark.createDataFrame([tuple(values[c] for c in s.column_names)], ", ".join(f"{c} string" for c in s.column_names))
    land_csv(frame, layout.raw, "product_reviews", DAY)
    build_bronze(spark, layout, ("product_reviews",))
    build_silver(spark, layout, ("product_reviews",), quarantine=True)
    [row] = spark.table(f"{layout.quarantine_db}.product_reviews").collect()
    again = spark.createDataFrame([(row.record,)], "r string").selectExpr(
        "from_csv(r, '" + ", ".join(f"{c} string" for c in s.column_names) + "', map('escape', '\"', 'multiLine', 'true')) AS f").first().f
    assert again.asDict() == values and row.reasons == [f"cast_loss({c})" for c, k in s.columns if k == "int"]


def test_empty_days_are_listed(spark):
    layout = scratch_layout(spark, "days")
    df = payments(spark).limit(4)
    land_csv(df, layout.raw, "payments", DAY)
    land_csv(df.limit(0), layout.raw, "payments", "2024-01-02")
    os.makedirs(f"{layout.raw}/unknown/dt={DAY}")
    open(f"{layout.raw}/unknown/dt={DAY}/x.csv", "w").write("a\n1\n")
    build_bronze(spark, layout, ("payments",))
    assert rows(partition_row_counts(spark, f"{layout.bronze_db}.payments"), "dt", "row_count") == [(DAY, 4), ("2024-01-02", 0)]
    listed = raw_file_inventory(spark, layout.raw).groupBy("table_name", "dt").agg(F.sum("row_count").alias("n"))
    assert rows(listed, "table_name", "dt", "n") == [("payments", DAY, 4), ("payments", "2024-01-02", 0)]
    assert raw_file_inventory(spark, f"{layout.root}/nowhere").count() == 0


def test_latest_without_a_snapshot_raises(spark):
    layout = scratch_layout(spark, "none")
    land_csv(payments(spark).limit(1), layout.raw, "payments", DAY)
    from lakecart.sources.bronze import register_bronze_table
    register_bronze_table(spark, layout.bronze_db, layout.raw, "payments", recover_partitions=False)
    with pytest.raises(LookupError):
        bronze_frame(spark, layout, "payments", snapshot="latest")


def test_only_tables_with_text_are_read_as_whole_files(spark, workdir):
    assert [t for t in TABLE_NAMES if not spec(t).has_text] == ["order_items"]
    raw = raw_text(source_table(spark, SF_SMALL, "order_items", with_ids=False), "order_items")
    land_csv(raw, workdir, "order_items", DAY)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
        df = read_bronze(spark, workdir, "order_items")
        assert df.rdd.getNumPartitions() > len(df.inputFiles())
        assert df.count() == raw.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_money_is_total(spark):
    df = spark.createDataFrame([(1.25,), (0.125,), (1e17,), (None,)], "v double")
    assert [r[0] for r in df.select(money("v")).collect()] == [Decimal("1.25"), Decimal("0.13"), None, None]
    assert [r[0] for r in df.select(F.coalesce(not_money("v"), F.lit(False))).collect()] == [False, True, True, False]


def test_append_frames_remap_ids_and_keys(spark):
    src = {t: source_table(spark, SF_SMALL, t, with_ids=t != "order_items") for t in ("categories", "products", "users", "orders", "payments")}
    out = append_frames(src, {"categories": 1000, "products": 500, "orders": 10_000}, "load-1")
    assert list(out) == [t for t in INSERT_ORDER if t in src]
    for t, df in out.items():
        assert df.columns == src[t].columns and df.count() == src[t].count()
    ids = {t: sorted(r[0] for r in out[t].select(spec(t).primary_key).collect()) for t in out}
    assert ids["categories"][0] == 1001 and ids["users"][0] == 1 and ids["orders"][-1] == 10_000 + len(ids["orders"])
    old = {r.product_id: r.category_id for r in src["products"].collect()}
    names = {r.category_id: r.name for r in src["categories"].collect()}
    new_names = {r.category_id: r.name for r in out["categories"].collect()}
    position = {p: i for i, p in enumerate(sorted(old))}
    for r in out["products"].collect():
        before = sorted(old)[r.product_id - 501]
        assert position[before] == r.product_id - 501
        assert new_names[r.category_id].startswith(names[old[before]] + " ")
    orphan = src["products"].withColumn("category_id", F.lit(-7).cast("bigint"))
    with pytest.raises(MissingKeyError):
        append_frames({"categories": src["categories"], "products": orphan}, {}, "x")


def test_statements_of_the_loads():
    tables = ["orders", "categories", "products", "users"]
    assert jdbc.before_load_sql("append", tables) == []
    assert jdbc.before_load_sql("truncate", tables) == ["TRUNCATE TABLE orders, users, products, categories RESTART IDENTITY CASCADE"]
    fresh = jdbc.before_load_sql("fresh", tables)
    assert [s.split()[4] for s in fresh[:4]] == ["orders", "users", "products", "categories"]
    assert [s.split()[2] for s in fresh[4:]] == ["categories", "products", "users", "orders"]
    product = jdbc.create_table_sql("products")
    for part in ("product_id SERIAL PRIMARY KEY", "category_id INT NOT NULL REFERENCES categories (category_id)",
                 "sku TEXT NOT NULL UNIQUE", "description TEXT,", "CHECK (price >= 0)"):
        assert part in product
    assert "CHECK (rating >= 1 AND rating <= 5)" in jdbc.create_table_sql("product_reviews")
    assert "CHECK (quantity > 0)" in jdbc.create_table_sql("order_items")
    assert "status IN ('pending', 'confirmed'" in jdbc.create_table_sql("orders")
    assert jdbc.after_load_sql(["users"])[0].startswith("SELECT setval(pg_get_serial_sequence('users', 'user_id')")
    with pytest.raises(ValueError):
        jdbc.before_load_sql("merge", tables)


def test_one_snapshot(spark):
    df = spark.createDataFrame([(1, DAY), (1, "2024-01-02"), (2, "2024-01-02")], "id int, dt string")
    assert rows(one_snapshot(df), "id") == [(1,), (2,)] and rows(one_snapshot(df, DAY), "id") == [(1,)]


def test_a_cluster_needs_a_shared_folder():
    assert [is_local(m) for m in ("local", "local[*]", "local[2]", "local-cluster[1,1,1024]", "yarn", "spark://h:1")] == [True] * 3 + [False] * 3


def test_full_build_gate(spark):
    layout = scratch_layout(spark, "full")
    sources = {t: raw_text(source_table(spark, SF_SMALL, t, with_ids=False), t) for t in ("users", "payments")}
    with pytest.raises(KeyError):  # the marts need the other tables, but silver is built and published
        run_all(spark, sources, layout, DAY)
    assert set(read_silver(spark, current_tables(spark, layout.silver_root, TABLE_NAMES))) == {"users", "payments"}
