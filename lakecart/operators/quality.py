"""Data-quality checks over silver tables.

Each check returns rows ``(table_name, rule, violations)`` so results of all
checks union into one report.  The source enforced these rules with
constraints; here each is one aggregation pass, pre-aggregated map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecart.functions.money import money, not_money
from lakecart.operators.silver import cast_loss_counts
from lakecart.schemas import TABLES

RESULT_COLUMNS = ["table_name", "rule", "violations"]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _wide_to_rows(wide: DataFrame, table: str, rules: list[str]) -> DataFrame:
    """One-row frame with a column per rule → one row per rule."""
    stack = ", ".join(f"'{r}', CAST(`c{i}` AS BIGINT)" for i, r in enumerate(rules))
    return wide.selectExpr(f"'{table}' AS table_name", f"stack({len(rules)}, {stack}) AS (rule, violations)")


def _counts(df: DataFrame, table: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """Count rows where each rule's predicate is TRUE (NULL counts as passing)."""
    wide = df.agg(*[F.count_if(pred).alias(f"c{i}") for i, (_, pred) in enumerate(rules)])
    return _wide_to_rows(wide, table, [r for r, _ in rules])


def check_unique(silver: dict[str, DataFrame]) -> DataFrame:
    """Duplicate rows per key and snapshot: SUM(count - 1) over repeated non-NULL values.

    All keys of a table are stacked as (rule, key) rows, so one scan and one
    shuffle serve them all; each distinct key is shuffled once.
    """
    frames = []
    for table, df in silver.items():
        s = TABLES[table]
        keys = (s.primary_key, *s.unique)
        stacked = F.array(*[F.struct(F.lit(i).alias("_rule"), F.col(c).cast("string").alias("_key")) for i, c in enumerate(keys)])
        counts = (df.select("dt", F.explode(stacked).alias("_k")).select("dt", "_k.*").where(F.col("_key").isNotNull())
                  .groupBy("dt", "_rule", "_key").agg((F.count(F.lit(1)) - 1).alias("_more")).where("_more > 0"))
        of = lambda i: F.coalesce(F.sum(F.when(F.col("_rule") == i, F.col("_more"))), F.lit(0))
        wide = counts.agg(*[of(i).alias(f"c{i}") for i in range(len(keys))])
        frames.append(_wide_to_rows(wide, table, [f"unique({c})" for c in keys]))
    return _union(frames)


def not_null_rules(table: str) -> list[tuple[str, Column]]:
    return [(f"not_null({c})", F.col(c).isNull()) for c in TABLES[table].not_null]


def accepted_rules(table: str) -> list[tuple[str, Column]]:
    return [(f"accepted({c})", ~F.col(c).isin(*vals)) for c, vals in TABLES[table].accepted.items()]


def _range_violation(c: str, low: float, high: float | None, low_inclusive: bool) -> Column:
    col = F.col(c)
    ok = (col >= low) if low_inclusive else (col > low)
    if high is not None:
        ok = ok & (col <= high)
    return ~ok


def range_rules(table: str) -> list[tuple[str, Column]]:
    return [(f"range({c})", _range_violation(c, *r)) for c, r in TABLES[table].ranges.items()]


def money_rules(table: str) -> list[tuple[str, Column]]:
    """Amounts that the exact money aggregates would round or leave out."""
    return [(f"money({c})", not_money(c)) for c, kind in TABLES[table].columns if kind == "double"]


def consistency_rules(table: str) -> list[tuple[str, Column]]:
    """Row arithmetic of the source: order total, line total, stock after a movement."""
    if table == "orders":
        total = money("subtotal") + money("tax") + money("shipping_cost")
        return [("total_amount=subtotal+tax+shipping_cost", money("total_amount") != total)]
    if table == "order_items":
        line = F.col("quantity").cast("decimal(10,0)") * money("unit_price")
        return [("total_price=quantity*unit_price", money("total_price") != line)]
    if table == "inventory_logs":
        prev, q = F.col("previous_quantity"), F.col("quantity")
        expected = F.when(F.col("event_type").isin("received", "returned"), prev + q) \
                    .otherwise(F.greatest(prev - q, F.lit(0)))
        return [("new_quantity=max(previous+-quantity,0)", F.col("new_quantity") != expected)]
    return []


def _row_check(silver: dict[str, DataFrame], *rule_sets) -> DataFrame:
    """One aggregation pass per table over the union of the given row-level rule sets."""
    frames = []
    for t, df in silver.items():
        rules = [r for rule_set in rule_sets for r in rule_set(t)]
        if rules:
            frames.append(_counts(df, t, rules))
    return _union(frames)


def check_not_null(silver: dict[str, DataFrame]) -> DataFrame:
    return _row_check(silver, not_null_rules)


def check_accepted_values(silver: dict[str, DataFrame]) -> DataFrame:
    return _row_check(silver, accepted_rules)


def check_ranges(silver: dict[str, DataFrame]) -> DataFrame:
    return _row_check(silver, range_rules)


def check_money(silver: dict[str, DataFrame]) -> DataFrame:
    return _row_check(silver, money_rules)


def check_consistency(silver: dict[str, DataFrame]) -> DataFrame:
    return _row_check(silver, consistency_rules)


def check_referential(silver: dict[str, DataFrame]) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row.

    A tagged-union anti join: every table is scanned once and gives, stacked,
    its own key (marked as a parent's) and its references, as (parent table,
    key, reference).  One shuffle on (parent table, key) then sees parents and
    children together.  Both are counted before it, so a hot key is one row of
    each task; a key without a parent's mark leaves its counts as violations.
    """
    refs = [(t, fk) for t in silver for fk in TABLES[t].foreign_keys if fk.parent in silver]
    parents = list(dict.fromkeys(fk.parent for _, fk in refs))
    tagged = []
    for t, df in silver.items():
        entry = lambda parent, column, ref: F.struct(
            F.lit(parents.index(parent)).alias("_parent"), F.col(column).alias("_key"), F.lit(ref).alias("_ref"))
        own = [entry(t, c, -1) for c in dict.fromkeys(fk.parent_column for _, fk in refs if fk.parent == t)]
        entries = own + [entry(fk.parent, fk.column, i) for i, (child, fk) in enumerate(refs) if child == t]
        if entries:
            tagged.append(df.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*").where(F.col("_key").isNotNull()))
    if not refs:
        return silver[next(iter(silver))].sparkSession.createDataFrame([], "table_name string, rule string, violations bigint")
    counts = _union(tagged).groupBy("_parent", "_key").agg(
        F.max(F.col("_ref") < 0).alias("_known"), *[F.count_if(F.col("_ref") == i).alias(f"n{i}") for i in range(len(refs))])
    wide = counts.where(~F.col("_known")).agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)).cast("bigint").alias(f"c{i}") for i in range(len(refs))])
    stack = ", ".join(f"'{t}', 'fk({fk.column}->{fk.parent}.{fk.parent_column})', c{i}" for i, (t, fk) in enumerate(refs))
    return wide.selectExpr(f"stack({len(refs)}, {stack}) AS (table_name, rule, violations)")


def check_cast_loss(text_bronze: dict[str, DataFrame]) -> DataFrame:
    """Values and fields that silver can't hold, from the all-text scans of bronze."""
    return _union([cast_loss_counts(df, t) for t, df in text_bronze.items()])


def run_checks(silver: dict[str, DataFrame], text_bronze: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every check over the given silver tables (and their raw text, if given) as one report frame.

    All row-level rules of a table (not null, accepted values, ranges, row
    arithmetic) are counted in one aggregation pass over it; uniqueness takes one
    scan and shuffle per table, the references one scan per table and one shuffle.
    """
    return _union([check_unique(silver),
                   _row_check(silver, not_null_rules, accepted_rules, range_rules, money_rules, consistency_rules),
                   check_referential(silver), *([check_cast_loss(text_bronze)] if text_bronze else [])])


class QualityError(RuntimeError):
    pass


def enforce(report: DataFrame) -> None:
    """Raise when any rule has violations (the report is small: one row per rule)."""
    failing = report.where(F.col("violations") > 0).collect()
    if failing:
        raise QualityError("; ".join(f"{r.table_name}.{r.rule}={r.violations}" for r in failing))
