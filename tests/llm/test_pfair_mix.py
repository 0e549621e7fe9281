import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from lakecart.llm import pfair_mix as mix
from llm_frames import awkward_documents, no_documents


def test_one_period_is_pfair():
    rng = random.Random(2)
    for _ in range(20):
        units = [rng.randint(1, 40) for _ in range(rng.randint(1, 12))]
        period = sum(units)
        plan = mix.one_period(units)
        assert [p[4] for p in plan] == list(range(period))
        done = collections.Counter()
        for s, k, release, deadline, slot in plan:
            assert k == done[s]
            assert release == math.floor(k * period / units[s]) <= slot < deadline == math.ceil((k + 1) * period / units[s])
            done[s] += 1
            # Less than one block from the target, at every slot and for every source.
            assert all(abs(done[i] - (slot + 1) * u / period) < 1 for i, u in enumerate(units))
        assert [done[i] for i in range(len(units))] == units


def test_periods_repeat_the_plain_rule():
    """Earliest deadline first over three periods, run without periods, gives the repeated plan."""
    units = [5, 3, 1]
    once, got = mix.one_period(units), []
    for r in range(3):
        got += [(s, r * units[s] + k, r * 9 + slot) for s, k, _, _, slot in once]
    done, plain = [0, 0, 0], []
    for slot in range(27):
        ready = [(-(-(done[s] + 1) * 9 // u), s) for s, u in enumerate(units) if done[s] * 9 // u <= slot]
        _, s = min(ready)
        plain.append((s, done[s], slot))
        done[s] += 1
    assert got == plain


@pytest.mark.parametrize("seed", range(8))
def test_chunks_are_one_pfair_schedule(seed):
    """Drawn up chunk by chunk from exact weights: gapless, in every window, and less than one block off all along."""
    rng = random.Random(seed)
    weights = [[1_000_003 + 17 * i for i in range(12)], [2 ** i for i in range(9)], [10 ** 9] + [10 ** 9 // 100] * 60][seed] if seed < 3 else \
        [int(rng.paretovariate(0.7) * 10 ** 6) for _ in range(rng.randint(1, 30))]
    slots = 2048
    weights = [w for w in weights if w * slots >= mix.MIN_UNITS * sum(weights)]
    total, done = sum(weights), collections.Counter()
    for c in range(5):
        for i, (s, k, slot) in enumerate(mix.one_chunk(weights, c * slots, slots)):
            assert slot == c * slots + i and k == done[s]
            assert k * total // weights[s] <= slot < -(-(k + 1) * total // weights[s])
            assert abs(done[s] - slot * weights[s] / total) < 1
            done[s] += 1
            assert abs(done[s] - (slot + 1) * weights[s] / total) < 1
        assert all(abs(done[s] - (c + 1) * slots * w / total) < 1 for s, w in enumerate(weights))


def test_shares():
    assert mix.capped_shares([50, 30, 20], 0.4) == pytest.approx([0.4, 0.36, 0.24])
    assert mix.capped_shares([98, 1, 1], 0.4) == pytest.approx([0.4, 0.3, 0.3])
    assert mix.capped_shares([90, 10], 0.1) == pytest.approx([0.5, 0.5])
    assert mix.capped_shares([7], 0.3) == [1.0]


def documents(spark, n=3000):
    return spark.range(0, n).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
        F.repeat(F.lit("x"), (F.col("id") * 37 % 90).cast("int")).alias("text"))


def test_positions_by_brute_force(spark):
    rows = mix.schedule(documents(spark), block=500, period=256).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    assert len(rows) == 3000
    for rs in by.values():
        at = 0
        for r in sorted(rs, key=lambda r: (r.h, r.id)):
            assert r.start == at and r.block == at // 500
            at += r.size


def test_mix_is_on_target(spark):
    rows = mix.schedule(documents(spark), block=500, period=256, max_share=0.4).collect()
    kept = [r for r in rows if r.kept]
    size, total = collections.Counter(), sum(r.size for r in kept)
    for r in kept:
        size[r.source] += r.size
    assert size["hot"] / total == pytest.approx(0.4, abs=0.01)
    assert all(r.kept for r in rows if r.source != "hot")
    # Along the schedule every source stays within a block (and a document) of its units.
    blocks = sorted({(r.slot, r.source, r.block) for r in kept})
    weights = {s: n / total for s, n in size.items()}
    end = min(max(b[0] for b in blocks if b[1] == s) for s in weights)
    done = collections.Counter()
    for slot, source, block in blocks:
        if slot < end:
            assert r.release is not None
            done[source] = block + 1
            assert abs(done[source] - (slot + 1) * weights[source]) < 2.5


def test_given_weights_and_pool(spark):
    rows = mix.schedule(documents(spark), target={"hot": 0.5, "s0": 0.5, "absent": 3.0}, block=500).collect()
    kept = [r for r in rows if r.kept]
    assert {r.source for r in kept} == {"hot", "s0"}
    assert all(r.slot is None and not r.kept for r in rows if r.source not in ("hot", "s0"))
    many = spark.range(0, 4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 900).alias("source"), F.lit("abc").alias("text"))
    out = mix.schedule(many, block=16, period=64).collect()  # every source is pooled
    assert len(out) == 4000 and all(r.kept for r in out)
    assert len({r.slot for r in out}) == max(r.slot for r in out) + 1


def test_kept_documents_pass_whole(spark):
    docs = documents(spark).withColumn("last", F.lit("mine"))
    placed = mix.schedule(docs, block=500, max_share=0.4)
    out = mix.keep_mix(docs, placed)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.id for r in placed.collect() if r.kept)


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    placed = mix.schedule(docs, block=64)
    assert placed.count() == docs.count()
    out = mix.keep_mix(docs, placed)
    assert out.columns == docs.columns
    assert out.count() == placed.filter("kept").count()
    empty = mix.schedule(no_documents(spark))
    assert empty.count() == 0 and mix.keep_mix(no_documents(spark), empty).count() == 0


def one_large_and_many_small(spark, small=3000, each=2):
    """One source with a quarter of the bytes, the others tiny and equal."""
    n = small * each
    return spark.range(0, n + n // 3).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") >= n, "large").otherwise(F.format_string("s%05d", F.col("id") % small)).alias("source"),
        F.repeat(F.lit("x"), 99).alias("text"))


def test_the_pool_of_small_sources_is_not_capped(spark):
    docs = one_large_and_many_small(spark)
    placed = mix.schedule(docs, block=1000)
    assert placed.filter("not kept").count() == 0
    assert mix.keep_mix(docs, placed).count() == docs.count()


@pytest.mark.parametrize("max_share", [0.05, 0.2, 0.4])
def test_weights_of_a_table_follow_the_plain_rule(spark, max_share):
    sizes = [500, 300, 90, 40, 30, 20, 10, 5, 5]
    table = spark.createDataFrame([(f"s{i}", b) for i, b in enumerate(sizes)], "source string, bytes bigint")
    got = {r.source: r.weight for r in mix.source_weights(table, None, max_share).collect()}
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(mix.capped_shares(sizes, max_share))


def test_small_sources_get_their_own_target_weights(spark):
    docs = one_large_and_many_small(spark, small=600, each=10)
    rows = mix.schedule(docs, target={"large": 0.5, "s00001": 0.3, "s00599": 0.2}, block=1000, period=1024).filter("kept").collect()
    size = collections.Counter()
    for r in rows:
        size[r.source] += r.size
    assert size["s00001"] == 1000 and size["s00599"] == 700 and size["large"] == 1700


def test_every_small_source_runs_evenly_through_the_mix(spark):
    """3,000 small sources of 1 to 41 documents beside a large one: each is near its weight all along."""
    n = F.when(F.col("i") == 0, 20_000).otherwise(1 + F.col("i") % 41)
    docs = (spark.range(0, 3001).withColumnRenamed("id", "i").withColumn("j", F.explode(F.sequence(F.lit(1), n)))
            .select((F.col("i") * 100_000 + F.col("j")).alias("doc_id"), F.format_string("s%05d", "i").alias("source"),
                    F.repeat(F.lit("x"), 99).alias("text")))
    block = 500
    rows = mix.schedule(docs, block=block).collect()
    assert all(r.kept for r in rows)
    total = sum(r.size for r in rows)
    sizes = collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
    done, worst, at = collections.Counter(), 0.0, 0
    # Over a whole period; after it, what is left of the sources ends one by one.
    for r in sorted((r for r in rows if r.slot < mix.PERIOD), key=lambda r: (r.slot, r.start)):
        # Just before and just after its documents a source is farthest off.
        worst = max(worst, abs(done[r.source] - at * sizes[r.source] / total))
        done[r.source] += r.size
        at += r.size
        worst = max(worst, abs(done[r.source] - at * sizes[r.source] / total))
    assert worst < 2 * block


def test_long_schedules_stay_within_a_block(spark):
    """Twelve sources of nearly equal size over twenty chunks: no deviation from the exact weight adds up."""
    n, block, period = 12, 10, 1024
    docs = spark.range(0, 20 * period * n).select(
        F.col("id").alias("doc_id"), F.format_string("s%02d", F.col("id") % n).alias("source"), F.repeat(F.lit("x"), 9).alias("text"))
    docs = docs.filter(F.col("doc_id") % 1009 > F.col("doc_id") % n * 7)  # sizes differ by a percent or so
    # One block per document: the slot is the place in the mix.
    rows = [(r.slot, r.source) for r in mix.schedule(docs, block=block, period=period).select("slot", "source", "size").collect()]
    sizes = collections.Counter(s for _, s in rows)
    assert len(sizes) == n and len(set(rows)) == len(rows)
    total, done = len(rows), collections.Counter()
    for at, (slot, source) in enumerate(sorted(rows)):
        assert slot >= at
        if slot > at:
            break  # the first source has ended
        assert abs(done[source] - at * sizes[source] / total) < 1
        done[source] += 1
        assert abs(done[source] - (at + 1) * sizes[source] / total) < 1
    assert at > 0.99 * total


def test_every_document_has_the_window_of_its_own_source(spark):
    docs = one_large_and_many_small(spark, small=40, each=60)
    rows = mix.schedule(docs, block=1000, period=128).collect()  # the small ones share a place
    total = sum(r.size for r in rows)
    sizes = collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
    for r in rows:
        w = sizes[r.source] / total
        assert r.block == r.own_start // 1000
        assert r.release == pytest.approx(r.block / w, abs=1) and r.deadline == pytest.approx((r.block + 1) / w, abs=1)
    early = [r for r in rows if not r.release - 1 <= r.slot <= r.deadline]
    assert len(early) < 0.02 * len(rows)
