"""Incremental silver and the latest-snapshot mode."""

from lakecart.plans.medallion import build_bronze, build_silver, scratch_layout
from lakecart.sinks.files import land_csv
from lakecart.sources.fixtures import raw_text, source_table
from lakecart.streaming.incremental import run_incremental

from conftest import SF_SMALL


def test_incremental_silver_processes_each_snapshot_once(spark, workdir):
    layout = scratch_layout(spark, "stream")
    src = raw_text(source_table(spark, SF_SMALL, "payments"), "payments")
    out, ckpt = f"{workdir}/silver_payments", f"{workdir}/ckpt"
    n = land_csv(src, layout.raw, "payments", "2024-01-01")
    run_incremental(spark, layout.raw, "payments", out, ckpt)
    assert spark.read.parquet(out).count() == n
    run_incremental(spark, layout.raw, "payments", out, ckpt)  # nothing new: no duplicates
    assert spark.read.parquet(out).count() == n
    land_csv(src, layout.raw, "payments", "2024-01-02")
    run_incremental(spark, layout.raw, "payments", out, ckpt)
    got = {r.dt: r["count"] for r in spark.read.parquet(out).groupBy("dt").count().collect()}
    assert got == {"2024-01-01": n, "2024-01-02": n}


def test_latest_snapshot_mode(spark):
    layout = scratch_layout(spark, "latest")
    src = raw_text(source_table(spark, SF_SMALL, "orders"), "orders")
    n = land_csv(src, layout.raw, "orders", "2024-01-01")
    land_csv(src.limit(5), layout.raw, "orders", "2024-01-02")
    build_bronze(spark, layout, ("orders",))
    all_locs = build_silver(spark, layout, ("orders",))
    assert spark.read.parquet(all_locs["orders"]).count() == n + 5
    latest = build_silver(spark, layout, ("orders",), snapshot="latest")
    df = spark.read.parquet(latest["orders"])
    assert df.count() == 5 and {r.dt for r in df.select("dt").distinct().collect()} == {"2024-01-02"}


def test_add_snapshot_partition(spark):
    from lakecart.sources.bronze import register_bronze_table, snapshots
    layout = scratch_layout(spark, "addpart")
    src = raw_text(source_table(spark, SF_SMALL, "categories"), "categories")
    land_csv(src, layout.raw, "categories", "2024-01-01")
    name = register_bronze_table(spark, layout.bronze_db, layout.raw, "categories")
    land_csv(src, layout.raw, "categories", "2024-01-02")
    assert snapshots(spark, name) == ["2024-01-01"]
    register_bronze_table(spark, layout.bronze_db, layout.raw, "categories", snapshot="2024-01-02")
    assert snapshots(spark, name) == ["2024-01-01", "2024-01-02"]
    assert spark.table(name).count() == 2 * src.count()


def test_default_stream_checkpoints_are_per_output(spark, workdir):
    layout = scratch_layout(spark, "stream2")
    src = raw_text(source_table(spark, SF_SMALL, "categories"), "categories")
    n = land_csv(src, layout.raw, "categories", "2024-01-01")
    for out in (f"{workdir}/a", f"{workdir}/b"):  # same table, two outputs, default checkpoints
        run_incremental(spark, layout.raw, "categories", out)
        assert spark.read.parquet(out).count() == n
