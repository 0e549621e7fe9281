"""Command line: the pipeline steps as separate runs, like the warehouse scripts.

    spark-submit -m lakecart.cli extract --root R --run-date D --jdbc-url URL --user U --password-file F
    python -m lakecart.cli bronze  --root R [--run-date D]     # register tables, print row counts
    python -m lakecart.cli clean-raw --root R                  # whitespace rewrite into R/raw_clean
    python -m lakecart.cli silver  --root R [--strict] [--snapshot latest|latest_per_key] [--quarantine]
    python -m lakecart.cli gold    --root R
    python -m lakecart.cli check   --root R [--fail]
    python -m lakecart.cli report  NAME --root R               # daily_revenue, top_customers, ...
    python -m lakecart.cli load    --root R --jdbc-url URL --mode append|truncate|fresh --run-id ID ...
    python -m lakecart.cli prune   --root R [--keep N]         # remove old table versions
    python -m lakecart.cli build   --root R [--run-date D]     # bronze, silver, gold, check in one run

Each step finds the previous step's output under ``--root`` (newest committed
version of each table), so no persistent metastore is needed.
"""

from __future__ import annotations

import argparse
import sys

from lakecart.schemas import TABLE_NAMES


def _layout(args):
    from lakecart.plans.medallion import Layout
    return Layout(root=args.root)


def _jdbc_props(args) -> dict[str, str]:
    props = {}
    if args.user:
        props["user"] = args.user
    if args.password_file:
        # Not an argument itself: those can be read in process lists.
        with open(args.password_file) as f:
            props["password"] = f.readline().rstrip("\r\n")
    if args.driver:
        props["driver"] = args.driver
    return props


def cmd_extract(spark, args):
    from lakecart.plans.medallion import extract
    from lakecart.sources.jdbc import extract_jdbc
    tables = args.tables or list(TABLE_NAMES)
    sources = {t: extract_jdbc(spark, args.jdbc_url, t, _jdbc_props(args), args.partitions) for t in tables}
    for t, n in extract(sources, _layout(args), args.run_date).items():
        print(f"{t:<20} {n:>12}")


def cmd_bronze(spark, args):
    from lakecart.operators.reports import bronze_row_counts
    from lakecart.plans.medallion import build_bronze
    layout = _layout(args)
    names = build_bronze(spark, layout, tuple(args.tables or TABLE_NAMES), snapshot=args.run_date)
    bronze_row_counts({t: spark.table(n) for t, n in names.items()}).show(len(names), truncate=False)


def cmd_clean_raw(spark, args):
    from lakecart.sinks.files import clean_raw_csv
    from lakecart.sources.bronze import raw_file_inventory
    layout = _layout(args)
    counts = clean_raw_csv(spark, layout.raw, f"{layout.root.rstrip('/')}/raw_clean", args.tables or TABLE_NAMES)
    for t, n in counts.items():
        print(f"{t:<20} {n:>12}")
    raw_file_inventory(spark, f"{layout.root.rstrip('/')}/raw_clean", "raw_clean").orderBy("file_path").show(1000, truncate=False)


def cmd_silver(spark, args):
    from lakecart.plans.medallion import build_bronze, build_silver
    layout = _layout(args)
    tables = tuple(args.tables or TABLE_NAMES)
    build_bronze(spark, layout, tables)
    metrics: dict = {}
    build_silver(spark, layout, tables, strict=args.strict, snapshot=args.snapshot, metrics=metrics, quarantine=args.quarantine)
    for t, m in metrics.items():
        print(t, m)


def cmd_gold(spark, args):
    from lakecart.plans.medallion import build_gold, current_tables, gold_row_counts, read_silver
    layout = _layout(args)
    silver = read_silver(spark, current_tables(spark, layout.silver_root, TABLE_NAMES))
    gold_row_counts(spark, build_gold(spark, layout, silver, with_exact=args.exact)).show(truncate=False)


def cmd_check(spark, args):
    from lakecart.operators.quality import enforce, run_checks
    from lakecart.plans.medallion import current_tables, read_silver
    from lakecart.sources.bronze import path_exists, read_bronze, table_path
    layout = _layout(args)
    silver = read_silver(spark, current_tables(spark, layout.silver_root, TABLE_NAMES))
    raw = {t: read_bronze(spark, layout.raw, t, as_text=True) for t in silver if path_exists(spark, table_path(layout.raw, t))}
    report = run_checks(silver, raw)
    report.orderBy("table_name", "rule").show(1000, truncate=False)
    if args.fail:
        enforce(report)


def cmd_build(spark, args):
    """Bronze → silver (parity-gated) → gold → quality report, in one run over landed raw data."""
    cmd_bronze(spark, args)
    cmd_silver(spark, args)
    cmd_gold(spark, args)
    cmd_check(spark, args)


REPORTS = {
    "daily_revenue": ("gold", "daily_sales"),
    "top_customers": ("gold", "customer_lifetime_value"),
    "best_sellers": ("gold", "top_products"),
    "payment_rates": ("gold", "payment_success_rates"),
    "carrier_performance": ("gold", "shipping_performance"),
    "low_stock": ("silver", "products"),
    "silver_types": ("silver", "users"),
}


def cmd_report(spark, args):
    from lakecart.operators import reports
    from lakecart.sinks.files import current_location
    layout = _layout(args)
    layer, table = REPORTS[args.name]
    loc = current_location(spark, layout.gold_root if layer == "gold" else layout.silver_root, table)
    if loc is None:
        sys.exit(f"no {layer} table {table} under {args.root}")
    getattr(reports, args.name)(spark.read.parquet(loc)).show(100, truncate=False)


def cmd_load(spark, args):
    from lakecart.plans.medallion import current_tables, read_silver
    from lakecart.plans.medallion import one_snapshot
    from lakecart.sources.jdbc import load_all
    layout = _layout(args)
    silver = read_silver(spark, current_tables(spark, layout.silver_root, args.tables or TABLE_NAMES))
    frames = {t: one_snapshot(df, args.run_date) for t, df in silver.items()}
    for t, n in load_all(frames, args.jdbc_url, _jdbc_props(args), mode=args.mode, run_id=args.run_id).items():
        print(f"{t:<20} {n:>12}")


def cmd_prune(spark, args):
    from lakecart.schemas import GOLD_TABLES
    from lakecart.sinks.files import prune_versions
    layout = _layout(args)
    for root, names in ((layout.silver_root, TABLE_NAMES), (layout.gold_root, (*GOLD_TABLES, "top_products_exact"))):
        for name in names:
            for folder in prune_versions(spark, root, name, keep=args.keep):
                print("removed", folder)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakecart")
    sub = p.add_subparsers(dest="cmd", required=True)

    helps = {
        "extract": "read source tables over JDBC and land them as the run date's raw CSV snapshot",
        "bronze": "register landed CSV as partitioned bronze tables and print their row counts",
        "clean-raw": "rewrite raw CSV with whitespace runs collapsed, into <root>/raw_clean",
        "silver": "cast and clean bronze into silver Parquet, gated on bronze/silver row parity",
        "gold": "build the six gold marts from the newest silver tables",
        "check": "run the data-quality checks over silver and print the report",
        "report": "print one report query",
        "load": "load one snapshot of silver into a relational target over JDBC",
        "prune": "delete old version folders of silver and gold tables",
        "build": "bronze, silver, gold and checks in one run",
    }

    def add(name, fn, jdbc=False):
        sp = sub.add_parser(name, allow_abbrev=False, help=helps[name])
        sp.add_argument("--root", required=True, help="lakehouse root (raw/, silver/, gold/ below it)")
        sp.add_argument("--tables", nargs="*", help="subset of the ten source tables")
        if jdbc:
            sp.add_argument("--jdbc-url", required=True)
            sp.add_argument("--user")
            sp.add_argument("--password-file", help="file on the driver whose first line is the password")
            sp.add_argument("--driver")
        sp.set_defaults(fn=fn)
        return sp

    add("extract", cmd_extract, jdbc=True).add_argument("--run-date", required=True)
    sub.choices["extract"].add_argument("--partitions", type=int, help="key ranges per table (default: from rows and row width)")
    add("bronze", cmd_bronze).add_argument("--run-date")
    add("clean-raw", cmd_clean_raw)
    s = add("silver", cmd_silver)
    s.add_argument("--strict", action="store_true")
    s.add_argument("--snapshot", choices=["all", "latest", "latest_per_key"], default="all")
    s.add_argument("--quarantine", action="store_true", help="keep the raw records that silver can't hold whole, with file and reasons")
    add("gold", cmd_gold).add_argument("--exact", action="store_true", help="also build top_products_exact")
    add("check", cmd_check).add_argument("--fail", action="store_true", help="exit non-zero on violations")
    r = add("report", cmd_report)
    r.add_argument("name", choices=sorted(REPORTS))
    ld = add("load", cmd_load, jdbc=True)
    ld.add_argument("--mode", choices=["append", "truncate", "fresh"], default="append")
    ld.add_argument("--run-date", help="snapshot to load (default: the newest)")
    ld.add_argument("--run-id", help="tells this append load's keys from those of other loads (needed for append)")
    add("prune", cmd_prune).add_argument("--keep", type=int, default=2, help="published versions kept besides the current one")
    b = add("build", cmd_build)
    b.add_argument("--run-date")
    b.add_argument("--strict", action="store_true")
    b.add_argument("--snapshot", choices=["all", "latest", "latest_per_key"], default="all")
    b.add_argument("--quarantine", action="store_true", help="keep the raw records that silver can't hold whole, with file and reasons")
    b.add_argument("--exact", action="store_true")
    b.add_argument("--fail", action="store_true")
    return p


def main(argv=None, spark=None) -> None:
    """Run one step; a session passed in (tests, notebooks) is used and left running."""
    args = parser().parse_args(argv)
    if spark is not None:
        args.fn(spark, args)
        return
    from lakecart.session import build_session
    spark = build_session()
    try:
        args.fn(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
