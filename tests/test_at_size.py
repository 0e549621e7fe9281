"""Steps that must not grow faster than their input: what they write, shuffle, scan and cast, with the same rows as before."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakecart.functions.clean import OTHER_ZONE, UTC_SUFFIX, clean_trim, strip_utc
from lakecart.operators.content import content_parity, fingerprints
from lakecart.operators.silver import silver_select, with_silver
from lakecart.sinks import files
from lakecart.sinks.files import clean_raw_csv, dump_csv, land_csv
from lakecart.sources.bronze import raw_file_inventory, read_bronze
from lakecart.sources.fixtures import raw_text, source_table
from lakecart.streaming.incremental import empty_days

DAY, NEXT = "2024-01-01", "2024-01-02"


def raw(spark, table):
    return raw_text(source_table(spark, SF_SMALL, table, with_ids=False), table)


def names(folder):
    return [f for f in os.listdir(folder) if not f.startswith((".", "_"))]


def size(folder):
    return sum(os.path.getsize(f"{folder}/{f}") for f in names(folder))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_compressed_raw_files_read_alike(spark, workdir):
    df, plain, packed = raw(spark, "orders"), f"{workdir}/plain", f"{workdir}/raw"
    assert land_csv(df, plain, "orders", DAY) == land_csv(df, packed, "orders", DAY, compression="gzip") == df.count()
    assert all(f.endswith(".csv.gz") for f in names(f"{packed}/orders/dt={DAY}"))
    assert 3 * size(f"{packed}/orders/dt={DAY}") < size(f"{plain}/orders/dt={DAY}")
    assert same(read_bronze(spark, plain, "orders"), read_bronze(spark, packed, "orders"))
    assert raw_file_inventory(spark, packed).agg(F.sum("row_count")).first()[0] == df.count()
    clean_raw_csv(spark, packed, f"{workdir}/clean", ["orders"], "gzip")
    assert read_bronze(spark, f"{workdir}/clean", "orders").count() == df.count()


def test_days_of_compressed_headers_are_empty(spark, workdir):
    df = raw(spark, "payments")
    land_csv(df.limit(1), workdir, "payments", DAY, compression="gzip")
    land_csv(df.limit(0), workdir, "payments", NEXT, compression="gzip")
    assert empty_days(spark, workdir, "payments") == [NEXT]
    assert land_csv(df.limit(0), workdir, "payments", DAY, overwrite=False, compression="gzip") == 0
    assert read_bronze(spark, workdir, "payments").count() == 1


def test_dumps_can_be_compressed(spark, workdir):
    df = source_table(spark, SF_SMALL, "payments")
    assert dump_csv({"payments": df, "none": df.limit(0)}, workdir, "gzip") == {"payments": df.count()}
    assert all(f.endswith(".csv.gz") for f in names(f"{workdir}/payments"))
    assert spark.read.option("header", True).csv(f"{workdir}/payments").count() == df.count()


def test_short_records_are_landed_without_a_shuffle(spark, workdir, monkeypatch):
    df = raw(spark, "payments").repartition(5).localCheckpoint()
    land_csv(df, workdir, "payments", DAY)
    assert len(names(f"{workdir}/payments/dt={DAY}")) == 5  # a file of each task
    monkeypatch.setattr(files, "RECORDS_PER_FILE", 100)
    n = land_csv(df.coalesce(1), workdir, "payments", DAY)
    assert len(names(f"{workdir}/payments/dt={DAY}")) == -(-n // 100)
    assert read_bronze(spark, workdir, "payments").count() == n == df.count()


def test_cast_values_are_taken(spark, workdir):
    df = raw(spark, "orders").withColumn("tax", F.when(F.col("order_id") % 7 == 0, F.lit("oops")).otherwise(F.col("tax").cast("string")))
    land_csv(df, workdir, "orders", DAY)
    bronze = read_bronze(spark, workdir, "orders", as_text=True)
    both = with_silver(bronze, "orders")
    assert same(silver_select(both, "orders"), silver_select(bronze, "orders"))
    # Only the columns beside the text are cast: none is cast a second time.
    assert "try_cast" not in silver_select(both, "orders")._jdf.queryExecution().analyzed().toString().split("\n")[0].lower()


@pytest.mark.parametrize("fraction", ["", ".5", ".123456", ".1234567"])
def test_zone_rule_is_the_same_by_either_way(spark, fraction):
    base = f"2024-01-01 10:20:30{fraction}"
    ends = ["+00", "+00 ", "+00\n", " +00", "+00+00", "+08", "-05:00", "Z", "", "+0", "+00\u0085", "A+00", "-0500", " UTC+00"]
    values = [(base + e,) for e in ends] + [(v,) for v in (None, "", "+00", "2024-01-01+00", " 2024-01-01 10:20:30+00", "12:30-05:00+00", "x" * 22)]
    s = F.regexp_replace(clean_trim("v"), UTC_SUFFIX, "")
    rule = F.when(s.rlike(OTHER_ZONE), F.lit(None)).otherwise(s)
    got = spark.createDataFrame(values, "v string").select("v", strip_utc("v").alias("a"), rule.alias("b")).collect()
    assert [r for r in got if r.a != r.b] == []


def test_content_parity_scans_bronze_once(spark, workdir):
    df = raw(spark, "payments")
    land_csv(df, workdir, "payments", DAY)
    bronze = read_bronze(spark, workdir, "payments", as_text=True)
    found = content_parity({"payments": df}, {"payments": bronze}, {"payments": silver_select(bronze, "payments").localCheckpoint()})
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert {(r.landed, r.cleaned) for r in found.collect()} == {("OK", "OK")}


def test_fingerprints_are_sums_of_md5(spark):
    from hashlib import md5
    values = ["a", None, "", "a", "é" * 40]
    df = spark.createDataFrame([(i, v, None, None, None) for i, v in enumerate(values)],
                               "category_id bigint, name string, description string, created_at string, updated_at string")
    number = lambda v: int(md5(("0" if v is None else "1" + v).encode()).hexdigest()[:15], 16)
    got = {r.column_name: r.fingerprint for r in fingerprints(df, "categories", "s", whole=False).collect()}
    assert got["name"] == str(sum(map(number, values))) and got["description"] == str(5 * number(None)) and "*" not in got


def test_the_raw_cleaner_gives_the_same_fields_as_the_pattern(spark, workdir):
    """Records with and without whitespace runs, blank fields and nulls, in one table."""
    from lakecart.functions.clean import whitespace_all
    df = raw(spark, "payments").limit(200)
    n = F.col("payment_id") % 5
    odd = df.withColumn("currency", F.when(n == 0, " U  S\u00a0D ").when(n == 1, "  ").when(n == 2, "EUR").otherwise(F.col("currency")))
    land_csv(odd, f"{workdir}/raw", "payments", DAY)
    read = read_bronze(spark, f"{workdir}/raw", "payments", as_text=True).drop("_malformed", "dt")
    clean_raw_csv(spark, f"{workdir}/raw", f"{workdir}/clean", ["payments"])
    got = read_bronze(spark, f"{workdir}/clean", "payments", as_text=True).drop("_malformed", "dt")
    want = read.select(*[F.nullif(whitespace_all(c), F.lit("")).alias(c) for c in read.columns])
    assert got.count() == 200 and same(got, want)


def test_lines_are_shuffled_once_for_sales_by_category(spark):
    """Lines meet their order by one shuffle, without a grouping by order and product first, and carry no wide decimals."""
    from lakecart.operators.gold import sales_by_category
    t = {n: source_table(spark, SF_SMALL, n, with_ids=False) for n in ("products", "categories", "orders", "order_items")}
    plan = sales_by_category(t["products"], t["categories"], t["orders"], t["order_items"])._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "hashpartitioning(order_id" in x and "product_id" in x]
    assert not [x for x in plan.splitlines() if "Aggregate" in x and "keys=[order_id" in x and "product_id" in x]
