"""Bronze CSV fidelity and landing behaviour."""

import os

from pyspark.sql import functions as F

from lakecart.sinks.files import land_csv
from lakecart.sources.bronze import raw_file_inventory, read_bronze
from lakecart.schemas import spec


def reviews_frame(spark, rows):
    s = spec("product_reviews")
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in s.bronze_schema().fields)
    return spark.createDataFrame(rows, cols)


def review(i, title, body):
    return (i, 1, 1, 5, title, body, "2024-01-01 00:00:00+00", "2024-01-01 00:00:00+00", "2024-01-01 00:00:00+00")


def test_quotes_commas_newlines_roundtrip(spark, workdir):
    texts = ['a "q", x\ny', "  padded  ", "line1\r\nline2", 'only "quotes"', "comma,comma"]
    df = reviews_frame(spark, [review(i, t, t) for i, t in enumerate(texts)])
    assert land_csv(df, workdir, "product_reviews", "2024-01-01") == len(texts)
    back = read_bronze(spark, workdir, "product_reviews").orderBy("review_id").collect()
    assert [r.body for r in back] == texts
    assert [r.dt for r in back] == ["2024-01-01"] * len(texts)


def test_null_and_empty_read_as_null(spark, workdir):
    df = reviews_frame(spark, [review(1, None, ""), review(2, "", None)])
    land_csv(df, workdir, "product_reviews", "2024-01-01")
    back = read_bronze(spark, workdir, "product_reviews").orderBy("review_id").collect()
    assert [(r.title, r.body) for r in back] == [(None, None), (None, None)]


def test_partition_overwrite_keeps_other_days(spark, workdir):
    df = reviews_frame(spark, [review(i, "t", "b") for i in range(4)])
    land_csv(df, workdir, "product_reviews", "2024-01-01")
    land_csv(df, workdir, "product_reviews", "2024-01-02")
    land_csv(df.limit(1), workdir, "product_reviews", "2024-01-02")
    counts = {r.dt: r["count"] for r in read_bronze(spark, workdir, "product_reviews").groupBy("dt").count().collect()}
    assert counts == {"2024-01-01": 4, "2024-01-02": 1}


def test_empty_snapshot_writes_header_only(spark, workdir):
    df = reviews_frame(spark, [review(1, "t", "b")]).where("false")
    assert land_csv(df, workdir, "product_reviews", "2024-01-01") == 0
    d = os.path.join(workdir, "product_reviews", "dt=2024-01-01")
    csvs = [f for f in os.listdir(d) if f.endswith(".csv")]
    assert csvs, "header-only file expected"
    lines = sum(len(open(os.path.join(d, f)).read().splitlines()) for f in csvs)
    assert lines == 1
    assert read_bronze(spark, workdir, "product_reviews").count() == 0


def test_bad_number_is_null_or_fails_strict(spark, workdir):
    path = os.path.join(workdir, "orders", "dt=2024-01-01")
    os.makedirs(path)
    header = ",".join(spec("orders").column_names)
    with open(os.path.join(path, "orders.csv"), "w") as f:
        f.write(header + "\n")
        f.write("1,2,2024-01-01 00:00:00+00,delivered,USD,abc,1,1,3,,,2024-01-01 00:00:00+00,2024-01-01 00:00:00+00\n")
    row = read_bronze(spark, workdir, "orders").first()
    assert row.subtotal is None and row.total_amount == 3.0
    import pytest
    with pytest.raises(Exception):
        read_bronze(spark, workdir, "orders", strict=True).collect()


def test_file_inventory_filters_paths(spark, workdir):
    raw = os.path.join(workdir, "raw")
    df = reviews_frame(spark, [review(i, "t", "b") for i in range(3)])
    land_csv(df, raw, "product_reviews", "2024-01-01")
    # A non-CSV file next to the data is ignored.
    open(os.path.join(raw, "product_reviews", "dt=2024-01-01", "notes.txt"), "w").write("x\n")
    inv = raw_file_inventory(spark, raw).groupBy("table_name", "dt").agg(F.sum("row_count").alias("n")).collect()
    assert [(r.table_name, r.dt, r.n) for r in inv] == [("product_reviews", "2024-01-01", 3)]
