"""Writers: raw CSV landing, Parquet layer tables, flat CSV dumps."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lakecart.functions.clean import plain_fields, whitespace_all
from lakecart.jobs import per_table
from lakecart.schemas import spec
from lakecart.sources.bronze import CSV_FILES, MALFORMED, read_bronze, table_path

CSV_WRITE_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    # The writer trims blanks by default; raw text must stay byte-exact.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}
# Records of a raw file at most, where a table's fields are short.
RECORDS_PER_FILE = 1_000_000
# Files that a backfill spreads each day over at most.
BACKFILL_FILES = 4
# Folder of a ranged version that lists what each of its files holds.
RANGES = "_ranges"
# Files that a read names one by one; beyond that it skips by the files' own statistics.
NAMED_FILES = 1000
# Marks a version folder that readers may use.
PUBLISHED = "_PUBLISHED"


def sized(df: DataFrame) -> DataFrame:
    """``df`` in output partitions of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.

    A hint, so adaptive execution splits large and joins small partitions by
    their measured bytes while the write itself runs: nothing is computed
    beforehand.  File sizes, and so the tasks of a later multiLine read (one
    per file), follow the bytes of the rows, whatever their number.
    """
    return df.hint("rebalance")


def csv_options(compression: str | None = None) -> dict[str, str]:
    """Writer options of raw files; ``compression="gzip"`` writes ``.csv.gz``, which every reader here takes as well.

    Raw text repeats itself so much that the fastest level leaves about a quarter of it.
    """
    return CSV_WRITE_OPTIONS | ({"compression": compression, "zlib.compress.level": "BEST_SPEED"} if compression else {})


def _observed_rows(obs: Observation) -> int:
    """The row count of a finished write; a missing metric is an error, not a zero."""
    return int(obs.get["rows"])


def _has_csv(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{CSV_FILES}")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def land_csv(df: DataFrame, base: str, table: str, dt: str, overwrite: bool = True, compression: str | None = None) -> int:
    """Write one snapshot to ``{base}/{table}/dt={dt}/`` and return its row count.

    With ``overwrite`` only the ``dt`` partition being written is replaced
    (dynamic partition overwrite), so earlier snapshots stay; without, rows
    are added to it.  The count is observed during the write itself, so it
    always describes what was written.  A snapshot without any row still gets
    a header-only file; adding nothing to a day leaves the day as it is.

    Free text may be long, so tables with such columns are dealt out by bytes
    (``sized``).  Elsewhere a bound on a file's records bounds its bytes too,
    and the rows are written where they are, without a shuffle.
    """
    obs = Observation(f"land_{table}_{uuid.uuid4().hex[:8]}")
    options = csv_options(compression)
    free_text = any(kind == "text" for _, kind in spec(table).columns)
    observed = (sized(df) if free_text else df).observe(obs, F.count(F.lit(1)).alias("rows"))
    (observed.withColumn("dt", F.lit(dt))
        .write.mode("overwrite" if overwrite else "append")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .options(**options)
        .partitionBy("dt")
        .csv(table_path(base, table)))
    rows = _observed_rows(obs)
    folder = f"{table_path(base, table)}/dt={dt}"
    if rows == 0 and (overwrite or not _has_csv(df.sparkSession, folder)):
        # partitionBy writes no file for an empty frame; write the header directly.
        (df.limit(0).coalesce(1).write.mode("overwrite").options(**options).csv(folder))
    return rows


def land_backfill(df: DataFrame, base: str, table: str) -> None:
    """Write many snapshots in one job: each row lands in the day of its ``dt``, and every day named is replaced."""
    (df.repartition("dt", F.pmod(F.xxhash64(*[c for c in df.columns if c != "dt"]), F.lit(BACKFILL_FILES)))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .options(**CSV_WRITE_OPTIONS).partitionBy("dt").csv(table_path(base, table)))


def drop_day(spark: SparkSession, path: str, dt: str) -> None:
    """Remove one day's partition folder, if there is one."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/dt={dt}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(folder):
        fs.delete(folder, True)


def partition_days(spark: SparkSession, path: str) -> list[str]:
    """The ``dt`` partitions of a folder, from its listing."""
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(base)] if fs.exists(base) else []
    return sorted(n[3:] for n in names if n.startswith("dt="))


def replace_days(spark: SparkSession, df: DataFrame, path: str, days: list[str]) -> None:
    """Replace the Parquet partitions of ``days`` with the rows of ``df``; a day without rows loses its folder.

    Dynamic overwrite leaves days that ``df`` does not name as they are, so the
    days named are observed during the write and the others dropped afterwards.
    """
    days = sorted(set(days))
    obs = Observation(f"days_{uuid.uuid4().hex[:8]}")
    rows = [F.count_if(F.col("dt") == dt).alias(f"n{i}") for i, dt in enumerate(days)]
    written = df.where(F.col("dt").isin(*days)).observe(obs, F.count(F.lit(1)).alias("all"), *rows)
    written.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)
    for i, dt in enumerate(days):
        if not obs.get[f"n{i}"]:
            drop_day(spark, path, dt)


def write_version(df: DataFrame, name: str, root: str, sort_within: list[str] | None = None) -> str:
    """Write a Parquet table to a fresh version folder that no reader uses yet; returns it."""
    # Version folders sort by creation time; readers take the newest published one.
    location = f"{root.rstrip('/')}/{name}/v-{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    writer_df = df.sortWithinPartitions(*sort_within) if sort_within else df
    writer_df.write.mode("overwrite").option("compression", "zstd").parquet(location)
    return location


def publish(spark: SparkSession, database: str, name: str, location: str) -> None:
    """Make a written version the table: mark it, then point the catalog at it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    marker = jvm.org.apache.hadoop.fs.Path(f"{location}/{PUBLISHED}")
    marker.getFileSystem(conf).create(marker, True).close()
    full = f"{database}.{name}"
    schema = spark.read.parquet(location).schema
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if spark.catalog.tableExists(full) and _same_columns(spark.table(full).schema, schema):
        # One catalog change: readers resolve the old location or the new one.
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{location}'")
        spark.sql(f"REFRESH TABLE {full}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        # The schema is known: registering with it skips inference from the files.
        spark.catalog.createTable(full, path=location, source="parquet", schema=schema)


def write_table(spark: SparkSession, df: DataFrame, database: str, name: str, root: str,
                sort_within: list[str] | None = None) -> str:
    """Build a Parquet table at a fresh location, then point the catalog at it.

    Writing to a new directory keeps a rebuild safe when ``df`` reads the
    table it replaces; readers see the old or the new version, never a
    half-cleared one.  Returns the new location.
    """
    location = write_version(df, name, root, sort_within)
    publish(spark, database, name, location)
    return location


def write_ranged(spark: SparkSession, df: DataFrame, name: str, root: str, by: str, key: str, files: int | None = None) -> str:
    """Write a Parquet version whose files hold disjoint, falling ranges of ``by``, and a list of these ranges; returns it.

    Rows that tie on ``by`` are split by ``key``, so one value that many rows
    have doesn't make one huge file.  Adaptive execution sizes the files
    unless their number is given.  The list (``_ranges`` in the version's
    folder, which table readers pass over) has one row per file.
    """
    order = [F.desc_nulls_last(by), F.asc_nulls_last(key)]
    ranged = df.repartitionByRange(*([files] if files else []), *order)
    location = write_version(ranged.sortWithinPartitions(*order), name, root)
    (spark.read.schema(df.schema).parquet(location).groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.count(by).alias("n"), F.min(by).alias("lo"), F.max(by).alias("hi"))
        .write.parquet(f"{location}/{RANGES}"))
    return location


def top_candidates(spark: SparkSession, location: str, by: str, k: int) -> DataFrame:
    """Rows of a ``write_ranged`` version that include its ``k`` with the largest ``by``, read from as few files as can be.

    Of the files in falling order of their smallest value, those that together
    hold ``k`` values name a value that the ``k`` largest all reach; files that
    don't reach it are not opened.  Ties with the last one are all included, so
    any tie-break can follow.  With fewer than ``k`` non-null values, all rows.
    """
    table, ranges = spark.read.parquet(location), spark.read.parquet(f"{location}/{RANGES}")
    # One row per file.
    running = F.sum("n").over(Window.orderBy(F.desc("lo"), "file").rowsBetween(Window.unboundedPreceding, 0))
    least = ranges.where("n > 0").select("lo", running.alias("n")).where(F.col("n") >= k).agg(F.max("lo")).first()[0]
    if least is None:
        return table
    reach = [r.file for r in ranges.where(F.col("hi") >= F.lit(least)).select("file").limit(NAMED_FILES + 1).collect()]
    if len(reach) <= NAMED_FILES:
        table = spark.read.schema(table.schema).parquet(*[f"{location}/{f}" for f in reach])
    return table.where(F.col(by) >= F.lit(least))


def _same_columns(a, b) -> bool:
    return [(f.name, f.dataType) for f in a.fields] == [(f.name, f.dataType) for f in b.fields]


def dump_csv(frames: dict[str, DataFrame], out_dir: str, compression: str | None = None) -> dict[str, int]:
    """One flat CSV directory per non-empty table (see ``csv_options``); empty tables are skipped."""
    def dump(name: str) -> int | None:
        df = frames[name]
        if df.isEmpty():  # stops at the first row found
            return None
        obs = Observation(f"dump_{name}_{uuid.uuid4().hex[:8]}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite") \
          .option("maxRecordsPerFile", RECORDS_PER_FILE).options(**csv_options(compression)).csv(f"{out_dir.rstrip('/')}/{name}")
        return _observed_rows(obs)

    return {name: n for name, n in per_table(dump, frames).items() if n is not None}


class MalformedRecords(ValueError):
    """Raw records with too few or too many fields."""


def clean_raw_csv(spark: SparkSession, raw_root: str, clean_root: str, tables, compression: str | None = None) -> dict[str, int]:
    """Rewrite raw CSV with every field's whitespace runs collapsed to one space and stripped.

    Reads all columns as text, keeps the ``dt`` layout, writes under
    ``clean_root`` (raw files are never rewritten in place).  Returns rows per
    table; ``raw_file_inventory`` over ``clean_root`` gives them per file.
    Records whose number of fields is wrong can't be rewritten field by field:
    they are counted in the same pass and make the call fail.

    The short fields of most records have nothing to collapse: one match over
    all of them spares them the pattern for whitespace runs.
    """
    def clean(t: str) -> int:
        short = [c for c, kind in spec(t).columns if kind != "text"]
        raw = read_bronze(spark, raw_root, t, as_text=True)
        obs = Observation(f"clean_{t}_{uuid.uuid4().hex[:8]}")
        seen = raw.observe(obs, F.count(F.lit(1)).alias("rows"), F.count(MALFORMED).alias("malformed"))
        once = lambda c: F.when(F.col("_plain"), F.btrim(F.col(c), F.lit(" "))).otherwise(whitespace_all(c))
        cleaned = seen.withColumn("_plain", plain_fields(short)).select(
            *[(once(c) if c in short else whitespace_all(c)).alias(c) for c in spec(t).column_names], "dt")
        (cleaned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .options(**csv_options(compression)).partitionBy("dt").csv(table_path(clean_root, t)))
        if obs.get["malformed"]:
            raise MalformedRecords(f"{t}: {obs.get['malformed']} records have a wrong number of fields")
        return _observed_rows(obs)

    return per_table(clean, tables)


def _versions(spark: SparkSession, root: str, name: str) -> list[tuple[str, bool]]:
    """(folder, published) of a layer table's versions, newest first, by listing."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}")
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    names = sorted((st.getPath().getName() for st in fs.listStatus(base)
                    if st.isDirectory() and st.getPath().getName().startswith("v-")), reverse=True)
    folders = [f"{root.rstrip('/')}/{name}/{v}" for v in names]
    return [(f, fs.exists(jvm.org.apache.hadoop.fs.Path(f"{f}/{PUBLISHED}"))) for f in folders]


def current_location(spark: SparkSession, root: str, name: str) -> str | None:
    """Newest published version folder of a layer table, by listing.

    Lets a new process find tables without a persistent metastore.
    """
    return next((folder for folder, published in _versions(spark, root, name) if published), None)


def prune_versions(spark: SparkSession, root: str, name: str, keep: int = 2) -> list[str]:
    """Delete a layer table's old version folders; returns them.

    The current version and the ``keep`` published ones before it stay, and so
    does anything newer than the current one (it may be being written).
    """
    versions = _versions(spark, root, name)
    current = next((i for i, (_, published) in enumerate(versions) if published), None)
    if current is None:
        return []
    older = versions[current + 1:]
    stay = [f for f, published in older if published][:keep]
    gone = [f for f, _ in older if f not in stay]
    for f in gone:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return gone
