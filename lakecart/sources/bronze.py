"""Bronze layer: date-partitioned raw CSV read with a fixed positional schema.

CSV dialect of the extract (PostgreSQL ``COPY .. CSV HEADER``): comma, double
quote, quotes doubled inside quoted fields, header line skipped, text fields
may hold line breaks, empty field = NULL.  Only tables with text columns are
read with ``multiLine`` (one task per file); the others split at lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecart.schemas import TABLE_NAMES, spec

CSV_READ_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "enforceSchema": "true",
    "encoding": "UTF-8",
}
# Raw files: plain, or compressed with gzip.
CSV_FILES = "*.{csv,csv.gz}"
# Name of the column that holds records whose number of fields is wrong.
MALFORMED = "_malformed"


def csv_read_options(table: str | None = None) -> dict[str, str]:
    """Reader options of a table's raw files (``None``: of any table's)."""
    multi = table is None or spec(table).has_text
    return {**CSV_READ_OPTIONS, "multiLine": str(multi).lower()}


def table_path(base: str, table: str) -> str:
    spec(table)  # refuses unknown names before any path is built
    return f"{base.rstrip('/')}/{table}"


def text_schema(table: str) -> T.StructType:
    """Every column as text, and the whole record where its number of fields is wrong."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in [*spec(table).column_names, MALFORMED]])


def read_bronze(spark: SparkSession, base: str, table: str, strict: bool = False,
                as_text: bool = False) -> DataFrame:
    """Scan ``{base}/{table}/dt=*/*.csv`` (or ``.csv.gz``) with the table's bronze schema.

    ``strict`` fails on a malformed record instead of NULLing the bad field;
    ``as_text`` reads every column as STRING (silver, raw-file cleaning) and
    adds ``MALFORMED``: the record itself where it has too few or too many
    fields, else NULL.  The partition column ``dt`` is discovered from the
    paths as a string.
    """
    schema = text_schema(table) if as_text else spec(table).bronze_schema()
    return (spark.read.schema(schema)
            .options(**csv_read_options(table))
            .option("columnNameOfCorruptRecord", MALFORMED)
            .option("mode", "FAILFAST" if strict else "PERMISSIVE")
            .option("pathGlobFilter", CSV_FILES)
            .option("basePath", table_path(base, table))
            .csv(table_path(base, table)))


def add_snapshot_partition(spark: SparkSession, table_name: str, base: str, table: str, dt: str) -> None:
    """Register one landed snapshot without re-listing the others (the daily path)."""
    spark.sql(f"ALTER TABLE {table_name} ADD IF NOT EXISTS PARTITION (dt='{dt}') "
              f"LOCATION '{table_path(base, table)}/dt={dt}'")


def _ddl_type(dt) -> str:
    return dt.simpleString().upper()


def register_bronze_table(spark: SparkSession, database: str, base: str, table: str,
                          recover_partitions: bool = True, snapshot: str | None = None) -> str:
    """External CSV table over the landed files, partitioned by ``dt``.

    ``DROP`` + ``CREATE`` replaces only the catalog entry; the files stay.
    Partitions are registered with ``MSCK REPAIR TABLE`` (lists every ``dt``
    folder).  With ``snapshot`` given and the table present, only that
    snapshot's partition is added, so the daily cost does not grow with history.
    """
    s = spec(table)
    name = f"{database}.{table}"
    if snapshot is not None and spark.catalog.tableExists(name):
        add_snapshot_partition(spark, name, base, table, snapshot)
        return name
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    cols = ", ".join(f"`{f.name}` {_ddl_type(f.dataType)}" for f in s.bronze_schema().fields)
    opts = ", ".join(f"'{k}' '{v}'" for k, v in csv_read_options(table).items())
    spark.sql(
        f"CREATE TABLE {name} ({cols}, `dt` STRING) USING csv "
        f"OPTIONS ({opts}) PARTITIONED BY (dt) LOCATION '{table_path(base, table)}'"
    )
    if recover_partitions:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def raw_file_inventory(spark: SparkSession, raw_root: str, prefix: str = "raw") -> DataFrame:
    """Landed CSV files under ``raw_root`` with their table, snapshot and record count.

    Only ``*.csv`` (or ``*.csv.gz``) files at ``{prefix}/{known table}/dt=../file.csv`` qualify,
    and only the folders of known tables are listed and read.  Files that hold
    a header only count 0.  A one-column CSV read still splits records by the
    quoting rules, so the count is of records, not lines.
    """
    root = raw_root.rstrip("/")
    folders = [f"{root}/{t}" for t in TABLE_NAMES if path_exists(spark, f"{root}/{t}")]
    if not folders:
        return spark.createDataFrame([], "table_name string, dt string, file_path string, row_count bigint")
    # Only paths are selected, so the files' contents aren't read here.
    files = (spark.read.format("binaryFile").option("pathGlobFilter", CSV_FILES).option("recursiveFileLookup", "true")
             .load(folders).select(F.col("path").alias("file_path")))
    pattern = rf"/{prefix}/([^/]+)/dt=([^/]+)/[^/]+\.csv(\.gz)?$"
    listed = files.select(
        F.regexp_extract("file_path", pattern, 1).alias("table_name"),
        F.regexp_extract("file_path", pattern, 2).alias("dt"), "file_path").where(F.col("table_name") != "")
    counts = (spark.read.schema("c0 string").options(**csv_read_options()).option("pathGlobFilter", CSV_FILES)
              .option("recursiveFileLookup", "true").csv(folders)
              .groupBy(F.col("_metadata.file_path").alias("p")).agg(F.count(F.lit(1)).alias("n")))
    # Both readers name a file by its URI, but may differ in the slashes after the scheme.
    plain = lambda c: F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
    return listed.join(counts, plain(F.col("file_path")) == plain(F.col("p")), "left").select(
        "table_name", "dt", "file_path", F.coalesce("n", F.lit(0)).alias("row_count"))


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def partition_row_counts(spark: SparkSession, table_name: str) -> DataFrame:
    """(dt, row_count) of every registered snapshot of a bronze table; an empty one counts 0."""
    listed = spark.sql(f"SHOW PARTITIONS {table_name}").select(F.regexp_extract("partition", "^dt=(.*)$", 1).alias("dt"))
    counts = spark.table(table_name).groupBy(F.col("dt").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return listed.join(counts, F.col("dt") == F.col("d"), "left").select("dt", F.coalesce("n", F.lit(0)).alias("row_count"))


def snapshots(spark: SparkSession, table_name: str) -> list[str]:
    """``dt`` values registered for a bronze catalog table (one row per daily snapshot)."""
    return sorted(r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table_name}").collect())


def latest_snapshot(spark: SparkSession, table_name: str) -> str:
    """Newest registered ``dt`` of a bronze table, from catalog metadata (no data scan)."""
    values = snapshots(spark, table_name)
    if not values:
        raise LookupError(f"{table_name} has no registered snapshot")
    return values[-1]
