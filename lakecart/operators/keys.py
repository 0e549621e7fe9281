"""Key handling for relational loads: surrogate-id remapping and append suffixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecart.functions.clean import run_tag, suffix_email, suffix_name, suffix_sku
from lakecart.functions.ids import dense_row_id
from lakecart.schemas import INSERT_ORDER, spec


class MissingKeyError(KeyError):
    pass


def position_key_map(stored_ids: DataFrame, id_col: str, order_by: list[str | Column] | None = None) -> DataFrame:
    """(position, new_id): the i-th inserted parent row (1-based) and the id the store gave it.

    Insertion order is ``order_by`` (default: the ids themselves, which a
    sequence hands out increasing).
    """
    order = order_by or [id_col]
    keyed = dense_row_id(stored_ids.select(id_col, *[c for c in order if isinstance(c, str) and c != id_col]),
                         order, "position")
    return keyed.select("position", F.col(id_col).alias("new_id"))


def remap_column(child: DataFrame, column: str, key_map: DataFrame, check: bool = True) -> DataFrame:
    """Replace generated positions in ``column`` with stored ids.

    A position without a parent is an error (as a failed lookup is for the
    source loader); the check is one anti join on distinct positions.
    """
    km = key_map.select(F.col("position").alias("_pos"), F.col("new_id").alias("_new"))
    if check:
        missing = (child.where(F.col(column).isNotNull()).select(F.col(column).alias("_pos")).distinct()
                        .join(km, "_pos", "left_anti").limit(5).collect())
        if missing:
            raise MissingKeyError(f"{column}: no parent for positions {[r._pos for r in missing]}")
    joined = child.join(km, child[column] == km["_pos"], "left")
    return joined.select(*[F.col("_new").alias(c) if c == column else child[c] for c in child.columns])


def append_suffix(categories: DataFrame | None, products: DataFrame | None, users: DataFrame | None,
                  run_id: str) -> dict[str, DataFrame]:
    """Make text keys unique for an append load: ``name tag``, ``sku-tag``, ``local+tag@domain``."""
    sfx = run_tag(run_id)
    out = {}
    if categories is not None:
        out["categories"] = categories.withColumn("name", suffix_name("name", sfx))
    if products is not None:
        out["products"] = products.withColumn("sku", suffix_sku("sku", sfx))
    if users is not None:
        out["users"] = users.withColumn("email", suffix_email("email", sfx))
    return out


def append_frames(frames: dict[str, DataFrame], last_ids: dict[str, int], run_id: str) -> dict[str, DataFrame]:
    """The tables of an append load, with text keys and ids that the target doesn't hold yet.

    ``last_ids``: the largest primary key of each target table (0 if empty).
    The i-th row of a table, in the order of its old key, gets id last + i:
    ids are given out here and not by the target, so parallel inserts can't
    disturb them, and every child column that refers to a loaded parent is
    remapped to the parent's new id (a child without its parent is an error).
    The result is in parent-first order.
    """
    text = append_suffix(frames.get("categories"), frames.get("products"), frames.get("users"), run_id)
    maps: dict[str, DataFrame] = {}
    out: dict[str, DataFrame] = {}
    for t in (t for t in INSERT_ORDER if t in frames):
        s = spec(t)
        pk = s.primary_key
        df = text.get(t, frames[t])
        numbered = dense_row_id(df.select(pk), [pk], "_i")
        maps[t] = numbered.select(F.col(pk).alias("position"), (F.col("_i") + F.lit(int(last_ids.get(t, 0)))).alias("new_id"))
        for fk in s.foreign_keys:
            if fk.parent in maps:
                df = remap_column(df, fk.column, maps[fk.parent])
        out[t] = remap_column(df, pk, maps[t], check=False)
    return out
