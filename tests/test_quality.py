"""Quality checks with planted faults: one violation per rule (FIXTURES C)."""

import datetime as dt

import pytest

from lakecart.operators import quality
from lakecart.operators.keys import MissingKeyError, position_key_map, remap_column
from lakecart.functions.ids import dense_row_id

T = dt.datetime(2024, 1, 1)


def silver(spark):
    users = spark.createDataFrame(
        [(1, "A", "B", "a@x", T, T, "d"), (2, "C", "D", "a@x", T, T, "d"), (3, None, "E", "e@x", T, T, "d")],
        "user_id bigint, first_name string, last_name string, email string, created_at timestamp_ntz, "
        "updated_at timestamp_ntz, dt string")
    orders = spark.createDataFrame(
        [(10, 1, dt.date(2024, 1, 1), "delivered", "USD", 8.0, 1.0, 1.0, 10.0, T, T, "d"),
         (11, 99, dt.date(2024, 1, 1), "bogus", "USD", 8.0, 1.0, 1.0, 11.0, T, T, "d"),
         (11, 1, dt.date(2024, 1, 1), "shipped", "USD", 8.0, 1.0, 1.0, 10.0, T, T, "d")],
        "order_id bigint, user_id bigint, order_date date, status string, currency string, subtotal double, "
        "tax double, shipping_cost double, total_amount double, created_at timestamp_ntz, updated_at timestamp_ntz, "
        "dt string")
    reviews = spark.createDataFrame(
        [(1, 1, 1, 6, dt.date(2024, 1, 1), T, T, "d"), (2, 1, 1, 3, dt.date(2024, 1, 1), T, T, "d")],
        "review_id bigint, product_id bigint, user_id bigint, rating int, review_date date, "
        "created_at timestamp_ntz, updated_at timestamp_ntz, dt string")
    return {"users": users, "orders": orders, "product_reviews": reviews}


def rules(df):
    return {(r.table_name, r.rule): r.violations for r in df.collect()}


def test_unique(spark):
    r = rules(quality.check_unique(silver(spark)))
    assert r[("users", "unique(email)")] == 1
    assert r[("orders", "unique(order_id)")] == 1
    assert r[("users", "unique(user_id)")] == 0


def test_unique_is_per_snapshot(spark):
    s = silver(spark)
    u = s["users"].where("user_id = 1")
    two = {"users": u.unionByName(u.withColumn("dt", u.dt.substr(1, 0)))}
    assert rules(quality.check_unique(two))[("users", "unique(user_id)")] == 0


def test_not_null_accepted_ranges(spark):
    s = silver(spark)
    assert rules(quality.check_not_null(s))[("users", "not_null(first_name)")] == 1
    assert rules(quality.check_accepted_values(s))[("orders", "accepted(status)")] == 1
    assert rules(quality.check_ranges(s))[("product_reviews", "range(rating)")] == 1


def test_referential(spark):
    r = rules(quality.check_referential(silver(spark)))
    assert r[("orders", "fk(user_id->users.user_id)")] == 1
    assert r[("product_reviews", "fk(user_id->users.user_id)")] == 0


def test_consistency(spark):
    r = rules(quality.check_consistency(silver(spark)))
    assert r[("orders", "total_amount=subtotal+tax+shipping_cost")] == 1


def test_enforce_raises(spark):
    import pytest
    with pytest.raises(quality.QualityError):
        quality.enforce(quality.check_unique(silver(spark)))


@pytest.mark.parametrize("rows", [0, 10, 5000, 50_000])
def test_dense_row_id_matches_row_number(spark, rows):
    from pyspark.sql import Window, functions as F
    df = spark.range(0, rows, numPartitions=7).select((F.col("id") * 7919 % 50_021).alias("k"), F.col("id").alias("v"))
    ref = sorted(map(tuple, df.withColumn("rid", F.row_number().over(Window.orderBy("k", "v"))).collect()))
    assert sorted(map(tuple, dense_row_id(df, ["k", "v"], "rid").select("k", "v", "rid").collect())) == ref


def test_remap_and_missing_key(spark):
    stored = spark.createDataFrame([(501,), (502,), (503,)], "user_id bigint")
    km = position_key_map(stored, "user_id")
    child = spark.createDataFrame([(1, 1), (2, 3)], "order_id bigint, user_id bigint")
    out = sorted(tuple(r) for r in remap_column(child, "user_id", km).collect())
    assert out == [(1, 501), (2, 503)]
    bad = spark.createDataFrame([(1, 4)], "order_id bigint, user_id bigint")
    with pytest.raises(MissingKeyError):
        remap_column(bad, "user_id", km)


def test_dense_row_id_splits_a_hot_tie(spark, monkeypatch):
    """A third of the rows share one key: they must not all land in one range partition."""
    from pyspark.sql import functions as F
    from lakecart.functions import ids as module
    written, write = [], module._written
    monkeypatch.setattr(module, "_written", lambda df, name: written.append(write(df, name)) or written[-1])
    df = spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    # Tiny data: stop AQE from merging the range partitions so the split is visible.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = dense_row_id(df, ["k"], "rid")
        ids = sorted(r.rid for r in out.collect())
        per_part = written[0].groupBy(F.shiftright("_mid", 33)).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert ids == list(range(1, 3001))
    assert max(r["count"] for r in per_part) < 1000


def test_run_checks_equals_individual_checks(spark):
    s = silver(spark)
    separate = {}
    for check in (quality.check_unique, quality.check_not_null, quality.check_accepted_values,
                  quality.check_ranges, quality.check_money, quality.check_referential, quality.check_consistency):
        separate.update(rules(check(s)))
    assert rules(quality.run_checks(s)) == separate
