"""The medallion build: extract → bronze → silver → gold, as Spark jobs.

Each layer function takes a ``Layout`` (where files and catalog tables live)
and fails loudly: a silver row-count mismatch against bronze raises.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakecart.operators.gold import MART_RANGE_KEYS, MART_SORT_KEYS, build_marts, top_products_exact
from lakecart.functions.extract_text import extract_text
from lakecart.operators.silver import loss_rules, quarantined, silver_select, with_silver
from lakecart.operators.snapshots import key_counts, latest_per_key
from lakecart.schemas import GOLD_TABLES, TABLE_NAMES, spec
from lakecart.jobs import per_table
from lakecart.session import scratch_dir
from lakecart.sinks.files import current_location, land_csv, publish, write_ranged, write_table, write_version
from lakecart.sources.bronze import latest_snapshot, read_bronze, register_bronze_table


@dataclass(frozen=True)
class Layout:
    """Storage root and catalog namespaces of one lakehouse."""

    root: str
    raw_prefix: str = "raw"
    bronze_db: str = "lakecart_bronze"
    silver_db: str = "lakecart_silver"
    gold_db: str = "lakecart_gold"
    # Codec of the raw files (``sinks.files.csv_options``): None leaves them plain.
    compression: str | None = None

    @property
    def raw(self) -> str:
        return f"{self.root.rstrip('/')}/{self.raw_prefix.strip('/')}"

    @property
    def silver_root(self) -> str:
        return f"{self.root.rstrip('/')}/silver"

    @property
    def quarantine_db(self) -> str:
        return f"{self.silver_db}_quarantine"

    @property
    def quarantine_root(self) -> str:
        return f"{self.root.rstrip('/')}/quarantine"

    @property
    def gold_root(self) -> str:
        return f"{self.root.rstrip('/')}/gold"


def scratch_layout(spark: SparkSession, name: str) -> Layout:
    """A fresh layout, with its own catalog namespaces, under the shared scratch folder."""
    root = scratch_dir(spark, name)
    tag = root.rsplit("-", 1)[-1]
    return Layout(root=root, bronze_db=f"lakecart_bronze_{tag}", silver_db=f"lakecart_silver_{tag}",
                  gold_db=f"lakecart_gold_{tag}", compression="gzip")


class ParityError(RuntimeError):
    pass


def extract(sources: dict[str, DataFrame], layout: Layout, run_date: str) -> dict[str, int]:
    """Land each source table as the ``dt=run_date`` snapshot; returns observed row counts.

    Time columns may be typed or text; they land as zoned text either way.
    """
    for table in sources:
        spec(table)
    return per_table(lambda t: land_csv(extract_text(sources[t], t), layout.raw, t, run_date, compression=layout.compression), sources)


def build_bronze(spark: SparkSession, layout: Layout, tables=TABLE_NAMES, snapshot: str | None = None) -> dict[str, str]:
    """Register the landed CSV as partitioned external tables and discover partitions.

    With ``snapshot``, tables that already exist only get that day's partition.
    """
    return {t: register_bronze_table(spark, layout.bronze_db, layout.raw, t, snapshot=snapshot) for t in tables}


def bronze_frame(spark: SparkSession, layout: Layout, table: str, strict: bool = False,
                 snapshot: str = "all") -> DataFrame:
    """A bronze table's rows for silver, every column as text: silver does the casts and counts what they lose.

    ``snapshot="all"`` reads every landed ``dt`` (the warehouse behaviour:
    repeated full extracts pile up); ``"latest"`` keeps only the newest
    registered snapshot, pruned at the file listing; ``"latest_per_key"`` reads
    every ``dt`` too, for silver to keep the newest row of each key.
    """
    bronze = read_bronze(spark, layout.raw, table, strict=strict, as_text=True)
    if snapshot == "latest":
        return bronze.where(F.col("dt") == F.lit(latest_snapshot(spark, f"{layout.bronze_db}.{table}")))
    if snapshot not in ("all", "latest_per_key"):
        raise ValueError(f"unknown snapshot mode {snapshot}")
    return bronze


def silver_frame(spark: SparkSession, layout: Layout, table: str, strict: bool = False,
                 snapshot: str = "all") -> DataFrame:
    """Silver projection of a bronze table (see ``bronze_frame`` for ``snapshot``)."""
    return _kept(silver_select(bronze_frame(spark, layout, table, strict, snapshot), table, strict), table, snapshot)


def _kept(silver: DataFrame, table: str, snapshot: str) -> DataFrame:
    return latest_per_key(silver, table) if snapshot == "latest_per_key" else silver


def row_parity(spark: SparkSession, layout: Layout, silver_locations: dict[str, str]) -> DataFrame:
    """(table_name, bronze_rows, silver_rows, status) for every built table, in one job."""
    frames = {t: (read_bronze(spark, layout.raw, t), spark.read.parquet(loc))
              for t, loc in silver_locations.items()}
    return parity_frame(frames)


def parity_frame(frames: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(table_name, bronze_rows, silver_rows, status) from (bronze, silver) frame pairs."""
    parts = []
    for t, (bronze, silver) in frames.items():
        parts.append(bronze.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(t).alias("table_name"), F.col("n").alias("bronze_rows"), F.lit(0).cast("bigint").alias("silver_rows")))
        parts.append(silver.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(t).alias("table_name"), F.lit(0).cast("bigint").alias("bronze_rows"), F.col("n").alias("silver_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.groupBy("table_name").agg(F.sum("bronze_rows").alias("bronze_rows"),
                                        F.sum("silver_rows").alias("silver_rows"))
    return out.withColumn("status", F.when(F.col("bronze_rows") == F.col("silver_rows"), "OK")
                          .otherwise("MISMATCH"))


def build_silver(spark: SparkSession, layout: Layout, tables=TABLE_NAMES, strict: bool = False,
                 verify: bool = True, snapshot: str = "all", metrics: dict | None = None,
                 extracted: tuple[str, dict[str, int]] | None = None, quarantine: bool = False) -> dict[str, str]:
    """Rebuild silver Parquet for ``tables``: write, count, compare, and only then publish.

    Every table must hold as many rows as bronze delivered and, with
    ``extracted`` = (dt, rows per table), as many rows of that snapshot as the
    extract landed.  On any mismatch ParityError is raised and every table
    stays at its previous version.

    ``metrics`` (if given) receives, per table, the bronze row count and what
    the casts lost (``loss_rules``), observed in the pass that writes silver.

    With ``snapshot="latest_per_key"`` silver holds one row per key instead,
    and the gate compares with the keys of bronze (counted in a pass of its own).

    With ``quarantine`` the raw records behind the losses are published beside
    silver, once it has passed the gate (``write_quarantine``).
    """
    observed: dict[str, Observation] = {}

    def build(t: str) -> str:
        # Bronze rows are counted while silver reads them (no second CSV parse);
        # silver rows are counted from the written files.
        observed[t] = Observation(f"bronze_{t}_{uuid.uuid4().hex[:8]}")
        both = with_silver(bronze_frame(spark, layout, t, strict, snapshot), t, strict)
        losses = [F.count_if(lost).alias(name) for name, lost in loss_rules(t, cast=True)]
        both = both.observe(observed[t], F.count(F.lit(1)).alias("rows"), *losses)
        return write_version(_kept(silver_select(both, t, strict=strict), t, snapshot), t, layout.silver_root)

    locations = per_table(build, tables)
    if metrics is not None:
        metrics.update({t: dict(observed[t].get) for t in tables})
    if verify:
        dt, landed = extracted or (None, {})
        frames = [spark.read.parquet(loc).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("dt") == F.lit(dt)).alias("day"))
                  .select(F.lit(t).alias("t"), "n", "day") for t, loc in locations.items()]
        counts = {r.t: r for r in reduce(DataFrame.unionByName, frames).collect()}
        if snapshot == "latest_per_key":
            keys = [key_counts(silver_frame(spark, layout, t, strict), t).select(F.lit(t).alias("t"), (F.col("keys") + F.col("keyless")).alias("n"))
                    for t in tables]
            expected = {r.t: r.n for r in reduce(DataFrame.unionByName, keys).collect()}
            landed = {}  # a day's rows may have been replaced by later ones
        else:
            expected = {t: int(observed[t].get["rows"]) for t in tables}
        bad = [t for t in tables if expected[t] != counts[t].n or t in landed and landed[t] != counts[t].day]
        if bad:
            raise ParityError("Silver row count mismatch: " + ", ".join(bad))
    kept: dict[str, str] = {}
    if quarantine:
        lossy = {t: any(n for rule, n in observed[t].get.items() if rule != "rows") for t in tables}
        kept = write_quarantine(spark, layout, lossy, strict, snapshot)
    for t, location in locations.items():
        publish(spark, layout.silver_db, t, location)
    for t, location in kept.items():
        publish(spark, layout.quarantine_db, t, location)
    return locations


def write_quarantine(spark: SparkSession, layout: Layout, lossy: dict[str, bool], strict: bool = False,
                     snapshot: str = "all") -> dict[str, str]:
    """Write the quarantined records of every table that lost anything; returns the new, unpublished locations.

    A Spark job has one output, so a table with losses is scanned once more;
    the build has counted them already, so the others cost no scan: they get an
    empty version, and only where an earlier build has left records.
    """
    def write(t: str) -> str | None:
        if not lossy[t] and current_location(spark, layout.quarantine_root, t) is None:
            return None
        bad = quarantined(bronze_frame(spark, layout, t, strict, snapshot), t)
        return write_version(bad if lossy[t] else bad.limit(0), t, layout.quarantine_root)

    return {t: location for t, location in per_table(write, lossy).items() if location}


def read_silver(spark: SparkSession, locations: dict[str, str]) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(loc) for t, loc in locations.items()}


def one_snapshot(silver: DataFrame, dt: str | None = None) -> DataFrame:
    """The rows of one snapshot (default: the newest), without ``dt``, as a relational load needs them."""
    if dt is None:
        dt = silver.agg(F.max("dt")).first()[0]
    return silver.where(F.col("dt") == F.lit(dt)).drop("dt")


def current_tables(spark: SparkSession, root: str, names) -> dict[str, str]:
    """Newest published location of each named table under ``root`` (missing ones left out)."""
    found = {n: current_location(spark, root, n) for n in names}
    return {n: loc for n, loc in found.items() if loc}


def build_gold(spark: SparkSession, layout: Layout, silver: dict[str, DataFrame],
               with_exact: bool = False, ranged: bool = False, files: int | None = None) -> dict[str, str]:
    """Write the six marts (and optionally ``top_products_exact``) as Parquet tables.

    With ``ranged`` the marts of ``MART_RANGE_KEYS`` are laid out by their value
    (one more shuffle), so that their top-k reports open only the files they
    need (``sinks.files.top_candidates``); ``files`` fixes the number of files.
    """
    marts = build_marts(silver)
    if with_exact:
        marts["top_products_exact"] = top_products_exact(
            silver["products"], silver["categories"], silver["order_items"], silver["product_reviews"])

    def write(name: str) -> str:
        if not ranged or name not in MART_RANGE_KEYS:
            return write_table(spark, marts[name], layout.gold_db, name, layout.gold_root, sort_within=MART_SORT_KEYS[name])
        location = write_ranged(spark, marts[name], name, layout.gold_root, *MART_RANGE_KEYS[name], files)
        publish(spark, layout.gold_db, name, location)
        return location

    return per_table(write, marts)


def run_all(spark: SparkSession, sources: dict[str, DataFrame], layout: Layout, run_date: str) -> dict:
    """Extract → bronze → silver (parity-gated) → gold; returns counts and locations."""
    counts = extract(sources, layout, run_date)
    build_bronze(spark, layout, tuple(sources), snapshot=run_date)
    metrics: dict = {}
    silver_locs = build_silver(spark, layout, tuple(sources), metrics=metrics, extracted=(run_date, counts))
    gold_locs = build_gold(spark, layout, read_silver(spark, silver_locs))
    return {"extract_counts": counts, "silver": silver_locs, "gold": gold_locs, "silver_metrics": metrics}


def table_row_counts(spark: SparkSession, locations: dict[str, str]) -> DataFrame:
    """(table_name, row_count) for Parquet tables, one job."""
    frames = [spark.read.parquet(loc).agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("table_name"), "row_count")
              for name, loc in locations.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def gold_row_counts(spark: SparkSession, gold_locations: dict[str, str]) -> DataFrame:
    """(table_name, row_count) for every mart."""
    return table_row_counts(spark, gold_locations)


def load_row_counts(spark: SparkSession, database: str, tables) -> DataFrame:
    """(table_name, row_count) per table in ``database``; a table that does not exist counts 0."""
    frames = []
    for t in tables:
        if spark.catalog.tableExists(f"{database}.{t}"):
            n = spark.table(f"{database}.{t}").agg(F.count(F.lit(1)).alias("row_count"))
        else:
            n = spark.range(1).select(F.lit(0).cast("bigint").alias("row_count"))
        frames.append(n.select(F.lit(t).alias("table_name"), "row_count"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


__all__ = ["Layout", "scratch_layout", "extract", "build_bronze", "build_silver", "build_gold",
           "run_all", "row_parity", "gold_row_counts", "read_silver", "silver_frame", "GOLD_TABLES"]
