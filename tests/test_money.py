"""Exact money aggregates and half-up percentages at decimal ties."""

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from lakecart.functions.money import money_avg, money_sum, round_half_up_pct


def test_pct_half_up_at_ties(spark):
    cases = [(1, 32), (3, 32), (1, 64), (5, 8), (2, 3), (1, 3), (1, 1), (0, 7), (7, 4000), (1, 200000)]
    df = spark.createDataFrame(cases, "p bigint, w bigint").select("p", "w", round_half_up_pct("p", "w").alias("r"))
    for row in df.collect():
        want = float((Decimal(row.p) * 100 / Decimal(row.w)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
        assert row.r == want, (row.p, row.w, row.r, want)


def test_money_sum_and_avg_are_exact(spark):
    vals = [0.1, 0.2, 0.3, 19.99, 0.01] * 200
    df = spark.createDataFrame([(v,) for v in vals], "a double").repartition(7)
    r = df.agg(money_sum("a").cast("double").alias("s"), money_avg("a").alias("m")).first()
    exact = sum(Decimal(str(v)) for v in vals)
    assert r.s == float(exact)
    assert r.m == float(exact) / len(vals)


def test_sums_of_cents_in_parts_are_exact(spark):
    """Also of amounts whose cents would overflow a long when summed, and of negative ones."""
    from lakecart.functions.money import cents, cents_parts, from_parts
    vals = [Decimal("9999999999999999.99")] * 300 + [Decimal("-9999999999999999.99")] * 7 + [Decimal("-0.01"), Decimal("42949672.96"), Decimal("0.10"), None]
    df = spark.createDataFrame([(v,) for v in vals], "a decimal(18,2)").select(cents("a").alias("c"))
    high, low = cents_parts("c")
    r = df.agg(F.sum(high).alias("h"), F.sum(low).alias("l")).select(from_parts("h", "l").alias("s")).first()
    assert r.s == sum(v for v in vals if v is not None)
    assert df.limit(0).agg(F.sum(high).alias("h"), F.sum(low).alias("l")).select(from_parts("h", "l").alias("s")).first().s is None
