"""SimHash near-duplicates through deletion-variant signatures.

Fingerprint: 64 bits of the majority of the XXH64 hashes of a text's word
shingles.  Two fingerprints link at ``max_bits`` (k) or fewer differing bits.

Search: the fingerprint is cut into k // 2 + 1 segments, so of two linked
fingerprints at least one segment differs in at most one bit.  Every segment
is indexed by its one-wildcard variants (the segment with one position
blanked, once for each position): segments that differ in one bit or none
share a variant.  An equality join on the variant finds candidates and the
whole fingerprints verify them.  If every earlier segment differs in two or
more bits, the last one has at most k mod 2 bits left, so for an even k it is
indexed as it is.  Each pair is reported from the first variant that it shares.

Only distinct fingerprints are indexed, so copies cost nothing.  Buckets of up
to ``BUCKET`` fingerprints are verified in place.  Fingerprints of fuller
buckets (a tight cluster can put any number into one) are linked exactly
another way, without comparing pairs: x and y differ in at most k bits only if
some fingerprint lies within ceil(k / 2) bits of x and floor(k / 2) bits of y,
so every fingerprint is dealt to its neighbourhood and an equality join on the
neighbour, whose groups are bounded by the neighbourhood's size, links them.

Defined results: no words (null, empty or blank text) -> fingerprint zero,
linked like any other; a null id gets a fingerprint and its component's
smallest non-null id (null if there is none); repeated rows are repeated in
the result; very long texts are hashed whole, in pieces; extra columns are left
aside; an empty table gives an empty result; ties don't arise (a bit needs more than half the hashes).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecart.llm.common import utf8_buffers
from lakecart.llm.components import components
from lakecart.llm.storage import broadcast_if_small, materialize

BITS = 64
SEED = 42
#: Fingerprints that one variant's bucket may hold to be verified in place.
BUCKET = 64
#: Shared variants that may be broadcast to the index; more of them join by a shuffle.
BROADCAST_VARIANTS = 500_000
# Bytes of text whose words are held at a time.
PIECE = 1 << 20


def _word_lists(text: bytes, shingle: int) -> Iterator[list[bytes]]:
    """The words of ``text`` in lists that overlap by ``shingle - 1`` words."""
    carry: list[bytes] = []
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and text[end] not in b" \t\n\r\x0b\f":
            end += 1
        words = carry + text[at:end].split()
        yield words
        carry = words[len(words) - shingle + 1:] if len(words) >= shingle else words
        at = end


def fingerprint(text: bytes, shingle: int) -> int:
    """Unsigned fingerprint of one text (UTF-8)."""
    ones, total, last = np.zeros(BITS, np.int64), 0, []
    for words in _word_lists(text.lower(), shingle):  # bytes.lower() folds A-Z only
        last = words
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
        for a in range(0, len(grams), 8192):
            h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams[a:a + 8192]), "<u8")
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            total += len(h)
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(last), SEED) if last else 0
    bits = np.packbits(ones * 2 > total, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(text: Column, shingle: int) -> Column:
    """The fingerprint as a signed long (the same 64 bits)."""

    @F.arrow_udf("long")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            raw, offsets = utf8_buffers(texts)
            out = [fingerprint(raw[a:b].tobytes(), shingle) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.array(np.array(out, np.uint64).view(np.int64))

    return prints(text)


def _variants(fp: Column, max_bits: int) -> Column:
    """Array of (slot, value): the index keys of a fingerprint; a slot names the segment and the blanked position."""
    n_seg = max_bits // 2 + 1
    cuts = [BITS * i // n_seg for i in range(n_seg + 1)]
    out = []
    for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        part = F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) if n_seg > 1 else fp
        whole = s == n_seg - 1 and max_bits % 2 == 0
        for wild in [-1] if whole else range(b - a):
            value = part if wild < 0 else part.bitwiseAND(F.lit(_signed(~(1 << wild))))
            out.append(F.struct(F.lit(s * 65 + wild + 1).alias("slot"), value.alias("value")))
    return F.array(*out)


def _signed(x: int) -> int:
    x &= (1 << BITS) - 1
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _first_slot(diff: Column, max_bits: int) -> Column:
    """The slot of the first variant that two fingerprints with these differing bits share."""
    n_seg = max_bits // 2 + 1
    cuts = [BITS * i // n_seg for i in range(n_seg + 1)]
    slot = F.lit(None).cast("int")
    for s in reversed(range(n_seg)):
        a, b = cuts[s], cuts[s + 1]
        part = F.shiftrightunsigned(diff, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) if n_seg > 1 else diff
        whole = s == n_seg - 1 and max_bits % 2 == 0
        # The differing position is the number of ones below it; an equal segment counts for position 0.
        top = F.when(part == F.lit(_signed(1 << (BITS - 1))), BITS - 1)  # one less would overflow
        place = F.when(part == 0, 0).otherwise(F.coalesce(top, F.bit_count(F.when(top.isNull(), part) - 1).cast("int")))
        slot = F.when(F.bit_count(part) <= (0 if whole else 1), F.lit(s * 65) if whole else place + (s * 65 + 1)).otherwise(slot)
    return slot


def links(prints: DataFrame, fp: str, max_bits: int, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) that connect all distinct fingerprints within ``max_bits`` bits of each other.

    From small buckets come exactly the linked pairs; from full buckets the
    links of each neighbourhood to its smallest member.
    """
    index = (prints.select(F.col(fp).alias("fp")).select("fp", F.explode(_variants(F.col("fp"), max_bits)).alias("k"))
             .select("fp", "k.slot", "k.value"))
    # Variants are counted first (partially aggregated, so a variant that a third of all fingerprints
    # have is one row of each task); only those that several have meet their fingerprints again.
    several = materialize(index.groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "variants")
    shared = materialize(index.join(broadcast_if_small(several, BROADCAST_VARIANTS), ["slot", "value"]), "shared-variants")
    small = shared.filter(F.col("n") <= bucket).groupBy("slot", "value").agg(F.collect_list("fp").alias("all"))
    near = lambda x, y, slot: (y > x) & (F.bit_count(x.bitwiseXOR(y)) <= max_bits) & (
        _first_slot(x.bitwiseXOR(y), max_bits) == slot)
    pairs = (small.select("slot", "all", F.explode("all").alias("a"))
             .select("a", F.explode(F.filter("all", lambda y: near(F.col("a"), y, F.col("slot")))).alias("b")))
    full = shared.filter(F.col("n") > bucket).select("fp").distinct()
    return pairs.unionByName(_neighbour_links(full, max_bits))


def _neighbour_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links through common neighbours, for fingerprints of full buckets."""
    near, far = max_bits // 2, max_bits - max_bits // 2
    masks = lambda r: [_signed(sum(1 << i for i in c)) for k in range(r + 1) for c in combinations(range(BITS), k)]

    def dealt(radius: int) -> DataFrame:
        flips = F.split(F.lit(",".join(map(str, masks(radius)))), ",").cast("array<bigint>")
        return prints.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("at"))

    if near == far:
        # Everything dealt to one neighbour lies within max_bits of each other.
        least = F.min("fp").over(Window.partitionBy("at"))
        return dealt(near).withColumn("a", least).filter(F.col("a") < F.col("fp")).select("a", F.col("fp").alias("b")).distinct()
    x, y = dealt(near).withColumnRenamed("fp", "a"), dealt(far).withColumnRenamed("fp", "b")
    return x.join(y, "at").filter(F.col("a") != F.col("b")).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable),
    ``component`` (smallest fingerprint reachable) and ``text_key`` (hash of the text), as ``keep_one`` takes them."""
    rows = materialize(docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_key"),
                                   fingerprints(F.col(text_col), shingle).alias("fp")), "simhash")
    least = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = components(links(least, "fp", max_bits, bucket), "a", "b")
    rooted = least.join(roots, least["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = rooted.join(of_root, "root").select("fp", "component_id", F.col("root").alias("component"))
    return rows.join(of_print, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component", "text_key")


def keep_one(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component: the one with the smallest id (null last), of these the one with the smallest text hash.

    Documents are told apart by id and text, so rows that share an id (or have
    none) but not the text go or stay each with its own component.  Of rows
    that agree in both, the one with the smallest hash over all columns stays,
    whatever the reading order.  Only the (id, text hash) that go and the few
    that repeat are joined to the documents.
    """
    rank = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("text_key").alias("key"))
    stays = classes.groupBy("component").agg(F.min(rank).alias("first"))
    pairs = classes.groupBy("component", F.col(id_col).alias("_id"), F.col("text_key").alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    is_first = F.col("first.id").eqNullSafe(F.col("_id")) & (F.col("first.key") == F.col("_key"))
    marked = materialize(pairs.join(stays, "component").select("_id", "_key", "_n", is_first.alias("_stays"))
                         .filter("not _stays or _n > 1"), "not-single")
    repeated = marked.filter("_stays")
    here = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    same = lambda side: docs[id_col].eqNullSafe(side["_id"]) & (here == side["_key"])
    single = docs.join(marked, same(marked), "left_anti")
    columns = [docs[c] for c in docs.columns]
    copies = docs.join(repeated, same(repeated)).select(
        repeated["_id"], repeated["_key"], F.struct(*columns).alias("_row"), F.xxhash64(*columns).alias("_order"))
    first = copies.groupBy("_id", "_key").agg(F.min_by("_row", "_order").alias("_row")).select("_row.*")
    return single.unionByName(first)
