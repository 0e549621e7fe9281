"""Relational source and target over JDBC.

Extract reads a table in parallel: the primary-key range is split into
strides, each read by its own executor connection (no single-stream dump
through one worker); their number follows the table's rows and row width.
Loads write per partition with batched inserts.  Executors connect to the
database directly.  Statements that only the database can run (tables with
their constraints, truncation with restarted identities, sequence positions)
are made as text from the table specs.

Not exercised by the test suite: the repository runs no database.  The
calls are the plain ``DataFrameReader.jdbc`` / ``DataFrameWriter.jdbc`` API.
Partitioned reads see one consistent snapshot only if the source is quiet
while the extract runs; JDBC writes commit per partition, so a load that
must be all-or-nothing should target a staging table first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecart.operators.keys import append_frames
from lakecart.schemas import COLUMN_DEFAULTS, INSERT_ORDER, RESTRICTED, SHORT_AMOUNTS, spec

# Assumed bytes of a value by column kind, to size the ranges of an extract.
KIND_BYTES = {"id": 8, "int": 4, "double": 8, "ts": 30, "date": 30, "str": 40, "text": 2000}
PARTITION_BYTES = 128 << 20


def extract_partitions(table: str, rows: int, partition_bytes: int = PARTITION_BYTES) -> int:
    """Ranges to read a table of so many rows in, from the assumed width of its rows."""
    width = sum(KIND_BYTES[kind] for _, kind in spec(table).columns)
    return max(1, -(-rows * width // partition_bytes))


def extract_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
                 num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    """``SELECT *`` of one source table, read as primary-key ranges.

    Bounds and row count come from a one-row query that the database runs;
    the number of ranges follows from them unless it is given (a key with
    large gaps gives uneven ranges: give more then).  Column order is the
    table's, as the bronze CSV expects.
    """
    s = spec(table)
    pk = s.primary_key
    props = {**properties, "fetchsize": str(fetch_size)}
    bounds = spark.read.jdbc(url, f"(SELECT MIN({pk}) AS lo, MAX({pk}) AS hi, COUNT(*) AS n FROM {table}) b",
                             properties=props).first()
    if bounds is None or bounds.lo is None:
        df = spark.read.jdbc(url, table, properties=props)
    else:
        df = spark.read.jdbc(url, table, column=pk, lowerBound=int(bounds.lo), upperBound=int(bounds.hi) + 1,
                             numPartitions=num_partitions or extract_partitions(table, int(bounds.n)), properties=props)
    return df.select(*s.column_names)


# SQL types of the column kinds, as the source database declares them.
SQL_TYPES = {"id": "INT", "int": "INT", "double": "NUMERIC(12,2)", "str": "TEXT", "text": "TEXT",
             "ts": "TIMESTAMPTZ", "date": "TIMESTAMPTZ"}


def create_table_sql(table: str) -> str:
    """CREATE TABLE with the table's keys, NOT NULLs, defaults, references (and what deletes do) and CHECKs."""
    s = spec(table)
    references = {fk.column: fk for fk in s.foreign_keys}
    lines = []
    for c, kind in s.columns:
        if c == s.primary_key:
            lines.append(f"{c} SERIAL PRIMARY KEY")
            continue
        parts = [c, "NUMERIC(10,2)" if (table, c) in SHORT_AMOUNTS else SQL_TYPES[kind]]
        if c in s.not_null:
            parts.append("NOT NULL")
            default = "NOW()" if kind in ("ts", "date") else COLUMN_DEFAULTS.get(c)
            if default:
                parts.append(f"DEFAULT {default}")
        if c in s.unique:
            parts.append("UNIQUE")
        if c in references:
            deleted = "RESTRICT" if (table, c) in RESTRICTED else "CASCADE"
            parts.append(f"REFERENCES {references[c].parent} ({references[c].parent_column}) ON DELETE {deleted}")
        if c in s.accepted:
            values = ", ".join(f"'{v}'" for v in s.accepted[c])
            parts.append(f"CHECK ({c} IN ({values}))")
        if c in s.ranges:
            low, high, inclusive = s.ranges[c]
            parts.append(f"CHECK ({c} {'>=' if inclusive else '>'} {low}" + (f" AND {c} <= {high})" if high is not None else ")"))
        lines.append(" ".join(parts))
    return f"CREATE TABLE {table} (\n  " + ",\n  ".join(lines) + "\n)"


def before_load_sql(mode: str, tables) -> list[str]:
    """Statements that prepare the target: nothing (append), emptied or recreated tables."""
    order = [t for t in INSERT_ORDER if t in tables]
    if mode == "append":
        return []
    if mode == "truncate":
        # One statement: parents can only be emptied together with the tables that refer to them.
        return [f"TRUNCATE TABLE {', '.join(reversed(order))} RESTART IDENTITY CASCADE"]
    if mode == "fresh":
        return [f"DROP TABLE IF EXISTS {t} CASCADE" for t in reversed(order)] + [create_table_sql(t) for t in order]
    raise ValueError(f"unknown load mode {mode}")


def after_load_sql(tables) -> list[str]:
    """Moves each table's sequence behind the ids that the load gave out."""
    return [f"SELECT setval(pg_get_serial_sequence('{t}', '{spec(t).primary_key}'), "
            f"GREATEST((SELECT COALESCE(MAX({spec(t).primary_key}), 0) FROM {t}), 1))" for t in INSERT_ORDER if t in tables]


def run_sql(spark: SparkSession, url: str, properties: dict[str, str], statements: list[str]) -> None:
    """Run statements in the database, in one transaction."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        connection.setAutoCommit(False)
        for sql in statements:
            connection.createStatement().execute(sql)
        connection.commit()
    finally:
        connection.close()


def load_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 5_000) -> None:
    """Insert the rows of one table."""
    spec(table)
    df.write.option("batchsize", batch_size).mode("append").jdbc(url, table, properties=properties)


def last_id(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> int:
    """The largest primary key of a target table, 0 if it has no row."""
    pk = spec(table).primary_key
    row = spark.read.jdbc(url, f"(SELECT COALESCE(MAX({pk}), 0) AS n FROM {table}) c", properties=properties).first()
    return int(row[0]) if row else 0


def load_all(frames: dict[str, DataFrame], url: str, properties: dict[str, str], mode: str = "append",
             run_id: str | None = None) -> dict:
    """Load tables parent-first, then count rows in the target.

    ``append``: new ids, tagged text keys and remapped references (``run_id``
    is needed); ``truncate``: tables emptied and their identities restarted
    before; ``fresh``: tables recreated with all constraints before.
    """
    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession
    run_sql(spark, url, properties, before_load_sql(mode, frames))
    if mode == "append":
        frames = append_frames(frames, {t: last_id(spark, url, t, properties) for t in frames}, run_id or "")
    order = [t for t in INSERT_ORDER if t in frames]
    for t in order:
        load_jdbc(frames[t], url, t, properties)
    run_sql(spark, url, properties, after_load_sql(frames))
    return {t: load_row_count(spark, url, t, properties) for t in order}


def load_row_count(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> int:
    """Post-load row count, computed by the database."""
    row = spark.read.jdbc(url, f"(SELECT COUNT(*) AS n FROM {table}) c", properties=properties) \
               .select(F.col("n").cast("bigint")).first()
    return int(row[0]) if row else 0
