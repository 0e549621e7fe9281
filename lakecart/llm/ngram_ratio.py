"""Quality rules: base counts of each text, and a hashed n-gram likelihood ratio.

The method: word unigrams and bigrams of every text are hashed into a fixed
number of bins.  Two multinomials with additive smoothing are estimated over
the bins: one from the trusted documents, one from all documents.  A
document's score is the sum of log(p_trusted / p_raw) over its n-grams,
divided by their number; it is kept if the score reaches a fixed threshold.
Every n-gram of every document is counted and scored.

Shape of the job: one pass over the corpus counts bins (partial aggregation;
only bins are shuffled), the ratio table has exactly ``BINS`` numbers and goes
into the second pass as a constant, and the second pass scores each row where
it is: no text and no n-gram is shuffled.

Base counts (see ``base_counts``) reject a text first.

Defined results: a null text has no words; an n-gram-free text has score 0;
no trusted documents -> every score is 0; repeated rows get equal results;
extra columns are left aside; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecart.llm.storage import broadcast_if_small, materialize

BINS = 1 << 15
SMOOTHING = 1.0
#: Mean log ratio per n-gram that a kept document reaches at least.
THRESHOLD = -0.3
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"
#: Trusted ids that may be broadcast.
BROADCAST_IDS = 2_000_000


def words(text: Column) -> Column:
    """The runs of characters other than blank, tab, LF, VT, FF and CR."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _word_hashes(words_col: str) -> Column:
    return F.transform(words_col, lambda w: F.xxhash64(w))


def _runs(hashes: str, n: int) -> Column:
    """Hash of each run of n words, from the array of word hashes."""
    count = F.size(hashes) - n + 1
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(
        *[F.get(hashes, i + k) for k in range(n)]))).otherwise(F.array().cast("array<bigint>"))


def base_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, word hashes (``wh``), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    Steps are separate projections, so that no array is computed twice; the
    search for repeated windows sorts only texts that have any.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    out = docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id", words(F.col("t")).alias("w"), lines.alias("l"),
        F.regexp_count("t", F.lit(f"[{SYMBOLS}]")).cast("bigint").alias("n_symbols"))
    out = out.select("id", _word_hashes("w").alias("wh"), "l", "n_symbols",
                     F.length(F.concat_ws("", "w")).cast("bigint").alias("word_chars"))
    out = out.select("id", "wh", "word_chars", "n_symbols", F.size("wh").cast("bigint").alias("n_words"),
                     (F.size("l") - F.size(F.array_distinct("l"))).cast("bigint").alias("n_dup_lines"),
                     _runs("wh", WINDOW).alias("r"))
    out = out.withColumn("again", F.size(F.array_distinct("r")) < F.size("r"))
    pairs = F.array_sort(F.transform("r", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("s", F.when(F.col("again"), pairs)).drop("r")
    # Sorted by hash, a repeated window has an equal neighbour (out of range: null, never equal).
    here = lambda k: F.get("s", k)["h"]
    at = F.array_sort(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("s") - 1), lambda k: F.coalesce(here(k) == here(k + 1), F.lit(False))
                 | F.coalesce((k > 0) & (here(k) == here(F.greatest(k - 1, F.lit(0)))), F.lit(False))),
        lambda k: F.get("s", k)["i"]))
    out = out.withColumn("a", F.when(F.col("again"), at)).drop("s")
    # Each repeated window covers the words up to the next one, WINDOW at most.
    covered = F.aggregate(
        F.transform("a", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("a", k + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda acc, x: acc + x)
    out = out.withColumn("n_repeat_words", F.when(F.col("again"), covered).otherwise(0).cast("bigint")).drop("a", "again")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _bins(hashes: str, bins: int) -> Column:
    """The bins of a text's words and word pairs."""
    one = F.transform(hashes, lambda h: F.pmod(h, F.lit(bins)).cast("int"))
    two = F.transform(_runs(hashes, 2), lambda h: F.pmod(h, F.lit(bins)).cast("int"))
    return F.concat(one, two)


def ratio_table(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bins: int = BINS, smoothing: float = SMOOTHING) -> list[float]:
    """log(p_trusted / p_raw) of every bin, from all n-grams of all documents.

    ``trusted`` holds the ids of trusted documents.  The result has ``bins``
    numbers whatever the corpus; that bound lets it pass through the driver.
    """
    ids = materialize(trusted.select(F.col(id_col).alias("_id")).filter("_id is not null").distinct(), "trusted-ids")
    side = broadcast_if_small(ids, BROADCAST_IDS)
    grams = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
             .join(side.withColumn("good", F.lit(1)), F.col("id") == F.col("_id"), "left")
             .select("good", words(F.col("t")).alias("w")).select("good", _word_hashes("w").alias("wh")).select("good", _bins("wh", bins).alias("b"))
             # Outer, as a plain explode filters on the array's size, and that filter, pushed
             # below the projections, would build the arrays once more for every element.
             .select("good", F.explode_outer("b").alias("bin")).filter("bin is not null"))
    counted = grams.groupBy("bin").agg(F.count(F.lit(1)).alias("raw"), F.count("good").alias("good")).collect()
    raw, good = [0] * bins, [0] * bins
    for r in counted:
        raw[r["bin"]], good[r["bin"]] = r["raw"], r["good"]
    if not sum(good):
        return [0.0] * bins
    p = math.log(sum(good) + smoothing * bins)
    q = math.log(sum(raw) + smoothing * bins)
    return [math.log(g + smoothing) - p - math.log(n + smoothing) + q for g, n in zip(good, raw, strict=True)]


def judge(docs: DataFrame, table: list[float], id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, base counts, base_failed, kept, and the length-normalised ``ratio``."""
    # One constant: a comma-separated text that the optimizer folds into an array once.
    ratio = F.split(F.lit(",".join(f"{x:.9g}" for x in table)), ",").cast("array<double>")
    out = base_counts(docs, id_col, text_col).withColumn("b", _bins("wh", len(table))).drop("wh")
    total = F.aggregate("b", F.lit(0.0), lambda acc, b: acc + F.get(ratio, b))
    out = out.withColumn("ratio", F.when(F.size("b") > 0, total / F.size("b")).otherwise(0.0)).drop("b")
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", (~F.col("base_failed") & (F.col("ratio") >= threshold)).alias("kept"),
                      F.round("ratio", 6).alias("ratio"))
