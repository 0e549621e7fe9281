"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Words are counted over all whole texts; words that are long and frequent
enough form the vocabulary.  Two words are near if they differ by exactly one
inserted, deleted or replaced code point, which holds exactly if the lengths of
their common prefix and common suffix add up to the longer length minus one or
more.  Tiles are two blocks of words as padded code-point matrices (aligned at
the left for the prefix, at the right for the suffix); all pairs of a tile are
compared densely, in numpy.

Which words meet in a tile: a word pair of longer length L has its edit in one
of ``SEGMENTS`` stretches of the positions 0..L-1, so everything before that
stretch and everything after it is the same in both.  Every word is dealt, as
the longer (L = its length) and as the shorter one (L = its length + 1), to the
key (L, stretch, what stands before and after it): no pair is missed, and each
is counted in the stretch of its first differing position only.  The words of a
key are cut into blocks of about ``BLOCK`` by a hash, and each pair of blocks is
one tile, so no task ever holds a whole key.  A tile returns one row per word
(count of near words, best of them), not its pairs.

The most frequent near word (ties: the smallest in code-point order) is a
word's form if it is at least ``RATIO`` times as frequent.  Counts grow by that
factor along forms, so a chain has at most log(largest count) links and pointer
doubling over written tables finds every root in a few rounds.

Defined results: a null, empty or wordless text adds no word; a null id counts
as the empty text in the misspelling rule; repeated rows count again; ties are
settled as above; very long texts and words are taken whole (a tile's pairs are
compared in slices of bounded size); extra columns are left aside; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecart.llm.storage import broadcast_if_small, materialize

#: A word is a maximal run of these; only A-Z are lower-cased.
WORD = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
#: Stretches that a length is cut into; a key leaves one of them open.
SEGMENTS = 3
#: Words of a block (on average); a key with more is cut into several.
BLOCK = 512
#: Keys with more than one block that may be broadcast; more of them join by a shuffle.
BROADCAST_KEYS = 500_000
# Matrix cells that a slice of pairs may compare at once.
CELLS = 1 << 22
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def misspelt(doc_id: Column, run: Column, every: int = 97) -> Column:
    """``run`` without one code point if its hash with the document's id is a multiple of ``every``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: str = WORD,
               min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = 97) -> DataFrame:
    """(word, n): the words of all texts, with their occurrences, long and frequent enough."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(
        F.translate(text_col, UPPER, LOWER), F.lit(pattern), F.lit(0))).alias("run"))
    words = runs.select(misspelt(F.col("id"), F.col("run"), every).alias("word"))
    counts = words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= min_count)


def _cuts(length: Column, s: int) -> Column:
    return F.floor(length * s / SEGMENTS).cast("int")


def _keys() -> Column:
    """The (length, stretch, rest) keys of ``word``."""
    out = []
    for longer in (0, 1):
        size = F.length("word") + longer
        for s in range(SEGMENTS):
            head = F.substring(F.col("word"), F.lit(1), _cuts(size, s))
            tail = size - _cuts(size, s + 1)  # code points after the open stretch
            end = F.substring(F.col("word"), F.length("word") - tail + 1, tail)
            # The split point is fixed by length and stretch, so the rest needs no mark between its parts.
            out.append(F.struct(size.alias("size"), F.lit(s).alias("stretch"), F.concat(head, end).alias("rest")))
    return F.array(*out)


def tiles(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(size, stretch, words): two blocks of one key; ``words`` has (word, n, second) with ``second`` null in a block's own tile."""
    dealt = words.select("word", "n", F.explode(_keys()).alias("k")).select("word", "n", "k.*")
    # Keys with one word have no pair; the fuller ones are few and cut into blocks.
    full = materialize(words.select(F.explode(_keys()).alias("k")).select("k.*").groupBy("size", "stretch", "rest")
                       .agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > block)
                       .select("size", "stretch", "rest", F.ceil(F.col("c") / block).cast("int").alias("blocks")), "spelling-keys")
    placed = (dealt.join(broadcast_if_small(full, BROADCAST_KEYS), ["size", "stretch", "rest"], "left")
              .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
              .withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    member = F.struct("word", "n", F.when(F.col("own") != F.col("other"), F.col("own") > F.col("other")).alias("second"))
    return (placed.select("size", "stretch", "rest", "word", "n", "own", other)
            .groupBy("size", "stretch", "rest", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
            .agg(F.collect_list(member).alias("words"))
            .filter(F.size("words") > 1).select("size", "stretch", "words"))


def _matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words aligned left and right, padded with 0, and their lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.zeros((len(words), width), np.uint32)
    right = np.zeros((len(words), width), np.uint32)
    left[row, at] = codes
    right[row, at + width - lengths[row]] = codes
    return left, right, lengths


def _run_length(same: np.ndarray) -> np.ndarray:
    """How many leading columns are true."""
    return np.where(same.all(1), same.shape[1], np.argmin(same, axis=1))


def near_pairs(left: np.ndarray, right: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs (i, j) are one edit apart, and the first differing position of each pair."""
    width = left.shape[1]
    longer, shorter = np.maximum(lengths[i], lengths[j]), np.minimum(lengths[i], lengths[j])
    # Padding differs from every code point, so a prefix ends with the shorter word; two ended words would go on.
    prefix = np.minimum(_run_length(left[i] == left[j]), shorter)
    suffix = np.minimum(_run_length((right[i] == right[j])[:, ::-1]), shorter)
    return (prefix + suffix >= longer - 1) & (longer <= width), prefix


def _pairs(sizes: list[tuple[np.ndarray, np.ndarray]], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs of the tiles (first block x second block, or i < j of one block), in slices of about ``most``."""
    left, right, held = [], [], 0
    for first, second in sizes:
        step = max(1, most // max(1, len(second)))
        for a in range(0, len(first), step):
            i, j = np.repeat(first[a:a + step], len(second)), np.tile(second, len(first[a:a + step]))
            if first is second:
                i, j = i[i < j], j[i < j]
            left.append(i), right.append(j)
            held += len(i)
            if held >= most:
                yield np.concatenate(left), np.concatenate(right)
                left, right, held = [], [], 0
    if held:
        yield np.concatenate(left), np.concatenate(right)


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Near words of each word within its tiles: how many, the most frequent of them and its count."""
    for batch in batches:
        for size, group in batch.groupby("size"):
            words, n, spans, stretches = [], [], [], []
            for stretch, members in zip(group["stretch"], group["words"]):
                at = np.arange(len(words), len(words) + len(members))
                words += [m["word"] for m in members]
                n += [m["n"] for m in members]
                if members[0]["second"] is None:
                    spans.append((at, at))
                else:
                    second = np.array([m["second"] for m in members], bool)
                    spans.append((at[~second], at[second]))
                stretches += [stretch] * len(members)
            n, stretches = np.array(n, np.int64), np.array(stretches)
            cuts = np.array([size * s // SEGMENTS for s in range(SEGMENTS + 1)])
            left, right, lengths = _matrices(words, int(size))
            for i, j in _pairs(spans, max(1, CELLS // int(size))):
                # The longer word has the key's length (two shorter ones meet under their own), and the
                # first differing position lies in the open stretch.
                long = np.maximum(lengths[i], lengths[j]) == size
                i, j = i[long], j[long]
                near, prefix = near_pairs(left, right, lengths, i, j)
                near &= np.searchsorted(cuts, np.minimum(prefix, size - 1), side="right") - 1 == stretches[i]
                a, b = np.concatenate([i[near], j[near]]), np.concatenate([j[near], i[near]])
                if not len(a):
                    continue
                found = pd.DataFrame({"a": a, "n": n[b], "word": [words[k] for k in b]})
                found = found.sort_values(["a", "n", "word"], ascending=[True, False, True], kind="stable")
                best = found.drop_duplicates("a")
                yield pd.DataFrame({"word": [words[k] for k in best["a"]], "n_near": found.groupby("a").size().to_numpy(),
                                    "best_n": best["n"].to_numpy(), "best": best["word"].to_numpy()})


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best, best_n) of every word with a near word."""
    found = tiles(words, block).mapInPandas(_compare, "word string, n_near bigint, best_n bigint, best string")
    # The smallest word of the largest count; strings compare by code point.
    top = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("top"))
            .select("word", "n_near", F.col("top.best").alias("best"), (-F.col("top.minus")).alias("best_n")))


def follow(forms: DataFrame, rounds: int) -> DataFrame:
    """(word, root) of (word, form): each form replaced by its own form, the distance doubling every round."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(rounds):
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = materialize(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return now


def group_variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """word, n, n_near, form, form_n, root of a vocabulary (distinct ``word``, ``n``)."""
    words = materialize(words.select("word", "n"), "spelling-words")
    near = words.join(near_words(words, block), "word", "left")
    takes = F.col("best_n") >= ratio * F.col("n")
    formed = materialize(near.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
                                     F.when(takes, F.col("best")).alias("form"), F.when(takes, F.col("best_n")).alias("form_n")), "spelling-forms")
    most = formed.agg(F.max("n")).first()[0] or 1
    links = math.log(most) / math.log(ratio) + 1  # of the longest possible chain
    roots = follow(formed.filter("form is not null"), math.ceil(math.log2(links + 1)))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
