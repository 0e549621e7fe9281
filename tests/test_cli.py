"""The command-line steps, each finding the previous step's output under --root."""

from lakecart import cli
from lakecart.plans.medallion import extract, scratch_layout
from lakecart.schemas import TABLE_NAMES
from lakecart.sinks.files import current_location
from lakecart.sources.fixtures import raw_text, source_table

from conftest import SF_SMALL


def test_steps_chain_through_the_filesystem(spark, capsys):
    layout = scratch_layout(spark, "cli")
    extract({t: raw_text(source_table(spark, SF_SMALL, t), t) for t in TABLE_NAMES}, layout, "2024-01-01")
    root = layout.root
    cli.main(["bronze", "--root", root], spark=spark)
    cli.main(["silver", "--root", root], spark=spark)
    first = current_location(spark, layout.silver_root, "orders")
    cli.main(["silver", "--root", root, "--tables", "orders"], spark=spark)
    second = current_location(spark, layout.silver_root, "orders")
    assert first and second and second > first
    cli.main(["gold", "--root", root], spark=spark)
    assert current_location(spark, layout.gold_root, "daily_sales")
    cli.main(["check", "--root", root], spark=spark)
    cli.main(["report", "daily_revenue", "--root", root], spark=spark)
    out = capsys.readouterr().out
    assert "sale_date" in out and "unique(user_id)" in out


def test_build_runs_all_layers(spark, capsys):
    layout = scratch_layout(spark, "cli_build")
    extract({t: raw_text(source_table(spark, SF_SMALL, t), t) for t in TABLE_NAMES}, layout, "2024-01-01")
    cli.main(["build", "--root", layout.root, "--run-date", "2024-01-01"], spark=spark)
    assert current_location(spark, layout.gold_root, "shipping_performance")
    assert "fk(order_id->orders.order_id)" in capsys.readouterr().out


def test_current_location_skips_uncommitted_versions(spark, workdir):
    import os
    from lakecart.sinks.files import write_table
    root = f"{workdir}/silver"
    committed = write_table(spark, spark.range(3), "lakecart_loc_test", "t", root)
    # A newer version folder left by a failed build: files but no _SUCCESS marker.
    broken = f"{root}/t/v-999999999999999-deadbeef"
    os.makedirs(broken)
    open(f"{broken}/part-00000.parquet", "w").write("partial")
    assert current_location(spark, root, "t") == committed
    assert current_location(spark, root, "missing") is None
