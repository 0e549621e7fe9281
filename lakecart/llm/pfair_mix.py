"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in the order of a key hash, are packed into blocks
of ``block`` bytes.  A source of weight w may start its block k no earlier
than slot floor(k / w) (release) and must have it placed before slot
ceil((k + 1) / w) (deadline).  Every slot takes, of the released blocks, the
one with the earliest deadline; with weights that sum to one this meets all
deadlines, so at any slot every source is within one block of its weight.

Windows come from the exact weights (whole numbers out of their sum, about
2^53), so nothing is rounded that could add up over a long schedule.  It is
drawn up in chunks of ``PERIOD`` slots, each by a task of its own: how many
blocks a source has had by a slot X is known without the slots before it, w X
rounded down, or up for the sources whose next deadline is the earliest, as many
as it takes to fill X slots.  From there the rule above runs slot by slot, from
some slots before the chunk on, so it comes to the chunk as the chunk before
leaves it; both ends of a chunk are found in this way and so fit together.

A source that gets fewer than ``MIN_UNITS`` blocks in a chunk shares its place
with the others of that kind, so a chunk tells at most ``PERIOD / MIN_UNITS``
sources apart.  In the shared place every document is due when the mix is
start / w bytes long, at its own source's weight, and a distributed sort by what
is due lays the documents out.  Every document has the release and deadline of
its own source's block, shared place or not.

Positions inside a source are running byte sums over the global order of
(source, hash): rows are numbered with ``dense_row_id``, summed within runs of
``RUN`` rows, and only run totals are summed up per source, so a source with a
third of all rows is no single task's work.

Target weights: given by name, or the natural byte shares with no source above
``max_share`` (what a capped source loses, the others gain in proportion).  The
cap and the length of the mix are worked out from every source by itself; the
pool has no cap.
The mix is as long as the scarcest source allows at the exact weights; a
document is ``kept`` if it starts before its source's part of that length.
Uncapped sources are used up completely.

Defined results: null source = a source of its own; null text = size 1 (sizes
are UTF-8 bytes plus 1); a source without a target weight is not kept and has
no slot; ties (equal hash, id and size) follow each other in any order; named sources without rows are left out; repeated rows count each
time; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakecart.functions.ids import dense_row_id
from lakecart.llm.storage import broadcast_if_small, materialize

BLOCK = 64 * 1024
PERIOD = 1 << 14
MIN_UNITS = 8
MAX_SHARE = 1 / 3
RUN = 4096
# Slots per source that the rule runs ahead of a chunk, to start it as the chunk before ends.
LEAD = 8
#: What all weights together come to in whole numbers.
WHOLE = 1 << 53
#: Blocks whose slots may be broadcast; more of them join by a shuffle.
BROADCAST_BLOCKS = 500_000


def capped_shares(sizes: list[int], max_share: float) -> list[float]:
    """Shares in proportion to sizes, none above ``max_share`` (or above an equal split, if that is more)."""
    cap = max(max_share, 1 / len(sizes))
    capped: set[int] = set()
    while True:
        rest = sum(s for i, s in enumerate(sizes) if i not in capped)
        left = 1 - cap * len(capped)
        shares = [cap if i in capped else left * s / rest for i, s in enumerate(sizes)]
        over = {i for i, x in enumerate(shares) if x > cap * (1 + 1e-12)}
        if not over:
            return shares
        capped |= over


def source_weights(sizes: DataFrame, target: dict[str, float] | None, max_share: float) -> DataFrame:
    """(source, bytes, weight) of every source with a weight, however small; weights sum to one.

    The rule of ``capped_shares`` over a written table: the capped sources are
    those above a number of bytes, which falls until it cuts off no more.
    """
    if target is not None:
        given = sizes.sparkSession.createDataFrame([(s, float(w)) for s, w in target.items() if w > 0], "name string, given double")
        named = sizes.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("name")))
        total = named.agg(F.sum("given")).first()[0] or 1.0
        return named.select("source", "bytes", (F.col("given") / total).alias("weight"))
    n, total = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    cap = max(max_share, 1 / max(1, n))
    capped, rest = 0, total
    while True:
        left = 1 - cap * capped
        bar = cap * (1 + 1e-12) * rest / left
        over = sizes.filter(F.col("bytes") > bar).agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
        if over[0] == capped:
            break
        capped, rest = over[0], total - over[1]
    weight = F.when(F.col("bytes") > bar, cap).otherwise(F.col("bytes") * left / max(1, rest))
    return sizes.select("source", "bytes", weight.alias("weight"))


def rounded_blocks(weights: list[int], x: int, period: int) -> list[int]:
    """Blocks of each source in the first ``x`` slots: x w rounded down, or up for the earliest deadlines.

    A source that may have no block in a chunk is rounded down always, so that its count never falls.
    """
    total = sum(weights)
    done = [w * x // total for w in weights]
    pending = sorted((-(-(k + 1) * total // w), i) for i, (w, k) in enumerate(zip(weights, done)) if w * x % total and w * period >= total)
    for _, i in pending[:x - sum(done)]:
        done[i] += 1
    # Rounding down only leaves room where no other source has a part of a block.
    done[weights.index(max(weights))] += x - sum(done)
    return done


def earliest_deadline_first(weights: list[int], now: list[int], first: int, slots: int, end: list[int] | None = None) -> list[tuple[int, int, int]]:
    """(source, k, slot) in ``slots`` slots from ``first`` on, after ``now`` blocks of each source; with ``end`` up to those counts."""
    total = sum(weights)
    release = lambda s, k: k * total // weights[s]
    deadline = lambda s, k: -(-(k + 1) * total // weights[s])
    waiting = [(release(s, k), s, k) for s, k in enumerate(now) if end is None or k < end[s]]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []  # (deadline, source, k)
    out = []
    for slot in range(first, first + slots):
        while waiting and (waiting[0][0] <= slot or not ready):
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline(s, k), s, k))
        _, s, k = heapq.heappop(ready)
        out.append((s, k, slot))
        if end is None or k + 1 < end[s]:
            heapq.heappush(waiting, (release(s, k + 1), s, k + 1))
    return out


def blocks_before(weights: list[int], x: int, period: int) -> list[int]:
    """Blocks of each source in the first ``x`` slots: the rounded counts some slots earlier, and the rule run from there."""
    ahead = min(x, max(64, LEAD * len(weights)))
    done = rounded_blocks(weights, x - ahead, period)
    for s, k, _ in earliest_deadline_first(weights, done, x - ahead, ahead):
        done[s] = max(done[s], k + 1)
    return done


def one_chunk(weights: list[int], first: int, slots: int) -> list[tuple[int, int, int]]:
    """(source, k, slot) of the blocks in ``slots`` slots from ``first`` on: of the released ones the earliest deadline first."""
    start, end = blocks_before(weights, first, slots), blocks_before(weights, first + slots, slots)
    return earliest_deadline_first(weights, start, first, slots, end)


def one_period(units: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(source, k, release, deadline, slot) of the blocks of one period of whole units."""
    period = sum(units)
    return [(s, k, k * period // units[s], -(-(k + 1) * period // units[s]), slot) for s, k, slot in one_chunk(units, 0, period)]


def chunk_plan(spark: SparkSession, weights: list[int], blocks: list[int], period: int) -> DataFrame:
    """(s, k, slot) of the first ``blocks`` blocks of each source, a task per chunk of ``period`` slots."""
    total = sum(weights)
    chunks = max((-(-n * total // (w * period)) + 1 for n, w in zip(blocks, weights)), default=0)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for c in batch["id"]:
                rows = [r for r in one_chunk(weights, int(c) * period, period) if r[1] < blocks[r[0]]]
                yield pd.DataFrame(rows, columns=["s", "k", "slot"])

    return spark.range(0, chunks, 1, max(1, min(chunks, 10_000))).mapInPandas(draw, "s int, k bigint, slot bigint")


def positions(rows: DataFrame, run: int = RUN, keep: Sequence[str] = ()) -> DataFrame:
    """``rows`` (source, h, id, size, keep..) with ``start``: the bytes before each row in its source, in the order of h."""
    numbered = dense_row_id(rows, ["source", "h", "id", "size"], "n").withColumn("run", F.floor((F.col("n") - 1) / run))
    inside = Window.partitionBy("run", "source").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("s").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    totals = (numbered.groupBy(F.col("run").alias("r"), F.col("source").alias("s")).agg(F.sum("size").alias("t"))
              .withColumn("before", F.coalesce(F.sum("t").over(earlier), F.lit(0))))
    return (numbered.withColumn("in_run", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(totals, (F.col("run") == F.col("r")) & F.col("source").eqNullSafe(F.col("s")))
            .withColumn("start", F.col("in_run") + F.col("before"))
            .select("id", "source", "size", "h", "start", *keep))


def interleaved(placed: DataFrame) -> DataFrame:
    """The rows of sources that share a place with ``at``: the bytes before each row there, interleaved by weight.

    The row at byte b of a source of weight w is due when the mix is b / w
    bytes long.  As a point b inside each row one drawn by its hash is taken,
    so sources of a single document spread over the whole mix as well.
    """
    inside = F.shiftrightunsigned(F.xxhash64("h", "start", F.lit("pool")), 11) / F.lit(float(1 << 53))
    due = (F.col("start") + inside * F.col("size")) / F.col("weight")
    own = F.struct(*[F.col(c) for c in placed.columns])
    rows = placed.select(F.lit(None).cast("string").alias("source"), due.alias("h"), F.col("id"), F.col("size"), own.alias("own"))
    return positions(rows, keep=["own"]).select("own.*", F.col("start").alias("at"))


def schedule(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
             target: dict[str, float] | None = None, max_share: float = MAX_SHARE, block: int = BLOCK,
             period: int = PERIOD) -> DataFrame:
    """One row per document: id, source, size, h, start, own_start, block, release, deadline, slot, kept.

    ``start`` is the document's place in the bytes of its source, or of the sources that share a place with it;
    ``own_start``, ``block``, ``release`` and ``deadline`` are always those of its own source.
    """
    rows = materialize(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        (F.octet_length(F.coalesce(text_col, F.lit(""))) + 1).cast("bigint").alias("size"),
        F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("mix")).alias("h")), "mix-rows")
    sizes = materialize(rows.groupBy("source").agg(F.sum("size").alias("bytes")), "mix-sizes")
    weighed = materialize(source_weights(sizes, target, max_share), "mix-weights")
    total, mix_bytes = weighed.agg(F.sum("bytes"), F.min(F.col("bytes") / F.col("weight"))).first()
    # Sources with a place of their own: at most period / MIN_UNITS. The others share one.
    large = weighed.filter(F.col("weight") >= MIN_UNITS / period).orderBy(F.col("source").asc_nulls_first()).collect()
    places = [(r["source"], r["weight"], r["bytes"]) for r in large]
    shared = (total or 0) - sum(n for _, _, n in places)
    if shared:
        places.append((None, max(0.0, 1 - sum(w for _, w, _ in places)), shared))
    weights = [max(1, round(w * WHOLE)) for _, w, _ in places]
    whole = max(1, sum(weights))
    spark = docs.sparkSession
    named = spark.createDataFrame([(r["source"], i) for i, r in enumerate(large)], "name string, member int")
    base = materialize(
        weighed.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("name")), "left")
        .select(F.col("source").alias("sn"), "weight", (F.col("weight") * (mix_bytes or 0.0)).alias("quota"),
                F.coalesce("member", F.lit(len(large) if shared else None).cast("int")).alias("member")), "mix-sources")
    placed = positions(rows).join(base, F.col("source").eqNullSafe(F.col("sn")), "left")
    if shared:
        placed = materialize(placed, "mix-positions")
        together = F.col("member").eqNullSafe(len(large))
        placed = placed.filter(~together).withColumn("at", F.col("start")).unionByName(interleaved(placed.filter(together)))
    else:
        placed = placed.withColumn("at", F.col("start"))
    placed = placed.withColumn("block", F.floor(F.col("start") / block).cast("bigint")).withColumn("_k", F.floor(F.col("at") / block).cast("bigint"))
    # The mix ends where the scarcest source does, at the exact weights; what a source has beyond it follows at the same pace.
    plan = materialize(chunk_plan(spark, weights, [-(-n // block) for _, _, n in places], period), "mix-plan")
    per_block = F.lit(float(whole)) / F.when(F.col("member") < len(large), F.get(F.array(*map(F.lit, weights or [1])).cast("array<double>"), F.col("member"))).otherwise(F.col("weight") * whole)
    return (placed.join(broadcast_if_small(plan, BROADCAST_BLOCKS), (F.col("member") == F.col("s")) & (F.col("_k") == F.col("k")), "left")
            .select("id", "source", "size", "h", F.col("at").alias("start"), F.col("start").alias("own_start"), "block",
                    F.floor(F.col("block") * per_block).cast("bigint").alias("release"),
                    F.ceil((F.col("block") + 1) * per_block).cast("bigint").alias("deadline"), "slot",
                    # A relative tolerance, as shares are floating point: an uncapped source stays whole.
                    F.coalesce(F.col("start") < F.col("quota") * (1 + 1e-9), F.lit(False)).alias("kept")))


def keep_mix(docs: DataFrame, placed: DataFrame, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text") -> DataFrame:
    """The documents of the mix: of every source those up to its last kept position in the order of the hash.

    Positions grow with the hash, so one hash for each source that isn't used
    up tells its kept documents apart: nothing else is joined to the texts.
    """
    order = F.struct("h", "id", "size")
    ends = materialize(placed.groupBy("source").agg(
        F.max(F.when(F.col("kept"), order)).alias("last"), F.bool_and("kept").alias("all_kept"))
        .filter("not all_kept").select(F.col("source").alias("_s"), "last", F.lit(True).alias("_cut")), "mix-ends")
    own = F.struct(F.xxhash64(F.coalesce(docs[id_col].cast("string"), F.lit("")), F.lit("mix")).alias("h"),
                   docs[id_col].alias("id"),
                   (F.octet_length(F.coalesce(docs[text_col], F.lit(""))) + 1).cast("bigint").alias("size"))
    return (docs.join(ends, docs[source_col].eqNullSafe(ends["_s"]), "left")
            .filter(ends["_cut"].isNull() | (ends["last"].isNotNull() & (own <= ends["last"])))
            .select(*[docs[c] for c in docs.columns]))
