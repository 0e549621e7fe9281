"""Incremental silver: snapshots cast and cleaned as they land or land again.

The warehouse rebuilds silver in full on every run.  The same projection can
run as a Structured Streaming query over the raw folder: new files name the
days they belong to, and each such day is read from bronze in full and
replaces that day in silver (dynamic partition overwrite).  A day that lands
again therefore replaces its rows and never doubles them, and repeating a
batch after a failure changes nothing.  ``availableNow`` processes what has
landed and stops, so a daily scheduler can run it like a batch job.

The output is a Parquet folder partitioned by ``dt``; give it to
``read_silver`` / ``build_gold`` as the table's location.

A snapshot that lands again without any row has a file with a header only, so
the stream sees no row of it and no day is named.  Such days are found beside
the stream, in the listing of the landed folders, and their rows leave silver
after it (``empty_days``).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecart.operators.silver import silver_select
from lakecart.schemas import spec
from lakecart.session import ensure_checkpoint_dir
from lakecart.sinks.files import drop_day, partition_days
from lakecart.sources.bronze import CSV_FILES, MALFORMED, csv_read_options, read_bronze, table_path, text_schema


def silver_stream(spark: SparkSession, raw_root: str, table: str, out_path: str,
                  checkpoint_location: str | None = None, max_files_per_trigger: int = 1000):
    """Start the incremental bronze → silver query for one table; returns the StreamingQuery."""
    source = (spark.readStream.schema(text_schema(table).add(T.StructField("dt", T.StringType(), True)))
              .options(**csv_read_options(table))
              .option("columnNameOfCorruptRecord", MALFORMED)
              .option("pathGlobFilter", CSV_FILES)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .csv(table_path(raw_root, table)))

    def replace_days(batch: DataFrame, batch_id: int) -> None:
        # One row per landed day of this batch.
        days = [r.dt for r in batch.select("dt").distinct().collect()]
        if days:
            bronze = read_bronze(spark, raw_root, table, as_text=True).where(F.col("dt").isin(*days))
            (silver_select(bronze, table).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("dt").parquet(out_path))

    # One file log per output: two lakehouses streaming the same table must not share it.
    out_key = hashlib.sha1(out_path.encode()).hexdigest()[:12]
    checkpoint = checkpoint_location or f"{_shared_root(spark)}/silver-stream-{table}-{out_key}"
    return (source.writeStream
            .foreachBatch(replace_days)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def _shared_root(spark: SparkSession) -> str:
    return (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")


def empty_days(spark: SparkSession, raw_root: str, table: str) -> list[str]:
    """Landed days whose files hold a header at most, by their sizes (a listing; only tiny compressed files are read)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table_path(raw_root, table)}/dt=*/{CSV_FILES}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    header = len(",".join(spec(table).column_names).encode()) + 2  # with a line end of either form
    rows: dict[str, bool] = {}
    unsure: set[str] = set()
    for st in fs.globStatus(path) or []:
        day, packed = st.getPath().getParent().getName()[3:], st.getPath().getName().endswith(".gz")
        # A compressed header is at most a few bytes longer than the plain one.
        some = st.getLen() > header + 64 * packed
        rows[day] = rows.get(day, False) or some
        if packed and not some:
            unsure.add(day)
    unsure -= {day for day, some in rows.items() if some}
    if unsure:
        found = read_bronze(spark, raw_root, table).where(F.col("dt").isin(*unsure)).select("dt").distinct().collect()
        rows |= {r.dt: True for r in found}
    return sorted(day for day, some in rows.items() if not some)


def run_incremental(spark: SparkSession, raw_root: str, table: str, out_path: str,
                    checkpoint_location: str | None = None) -> None:
    """Process every snapshot landed since the last run, then return."""
    q = silver_stream(spark, raw_root, table, out_path, checkpoint_location)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    for dt in set(empty_days(spark, raw_root, table)) & set(partition_days(spark, out_path)):
        drop_day(spark, out_path, dt)
