import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from lakecart.llm import simhash_variants as sim
from lakecart.llm.components import components
from llm_frames import awkward_documents, no_documents


def plain(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def groups(prints, k):
    """Smallest member of each fingerprint's component, by comparing all pairs."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    items = sorted(root)
    for i, x in enumerate(items):
        for y in items[i + 1:]:
            if (x ^ y).bit_count() <= k:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {p: find(p) for p in items}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def cluster(rng, size, bits):
    """Fingerprints around one centre, and some far away."""
    centre = rng.getrandbits(64)
    out = {centre}
    while len(out) < size:
        x = centre
        for b in rng.sample(range(64), rng.randint(1, bits)):
            x ^= 1 << b
        out.add(x)
    return out | {rng.getrandbits(64) for _ in range(20)}


@pytest.mark.parametrize("k,bucket,broadcast", [(0, 64, 0), (1, 2, 9999), (2, 2, 9999), (2, 64, 0), (3, 2, 9999)])
def test_links_connect_as_all_pairs_do(spark, monkeypatch, k, bucket, broadcast):
    monkeypatch.setattr(sim, "BROADCAST_VARIANTS", broadcast)
    rng = random.Random(k)
    prints = cluster(rng, 40, 4) | cluster(rng, 40, 2) | {0, 1, 3, 7, (1 << 64) - 1}
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    edges = sim.links(df, "fp", k, bucket)
    pairs = [(r.a, r.b) for r in edges.collect()]
    assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= k for a, b in pairs)
    want = groups({signed(p) % (1 << 64) for p in prints}, k)
    roots = {r.node: r.root for r in components(edges, "a", "b").collect()}
    got = {}
    for p in want:
        got.setdefault(roots.get(signed(p), signed(p)), set()).add(p)
    expected = {}
    for p, r in want.items():
        expected.setdefault(r, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_each_pair_comes_once_from_small_buckets(spark):
    prints = cluster(random.Random(9), 30, 2)
    pairs = [(r.a, r.b) for r in sim.links(spark.createDataFrame([(signed(p),) for p in prints], "fp bigint"), "fp", 2).collect()]
    unsigned = sorted(prints)
    n = sum((x ^ y).bit_count() <= 2 for i, x in enumerate(unsigned) for y in unsigned[i + 1:])
    assert len(pairs) == len(set(pairs)) == n


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 500 + i) for i in range(1, 40)]
    edges = spark.createDataFrame([*chain, *star, (7, 7), (None, 3), (130, 129)], "a bigint, b bigint")
    got = {r.node: r.root for r in components(edges, "a", "b").collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{500 + i: 500 for i in range(40)}}
    assert components(edges.filter("a = 7"), "a", "b").count() == 0


def test_fingerprints_by_brute_force(spark, monkeypatch):
    docs = awkward_documents(spark)
    rows = docs.select("text", sim.fingerprints(F.col("text"), 3).alias("fp")).collect()
    for r in rows:
        assert r.fp % (1 << 64) == plain(r.text)
    long = next(r.text for r in rows if r.text and len(r.text) > 100_000)
    monkeypatch.setattr(sim, "PIECE", 1000)  # cut in many pieces: the same
    assert sim.fingerprint(long.encode(), 3) == plain(long)


def test_documents_by_brute_force(spark):
    docs = awkward_documents(spark)
    out = sim.near_duplicates(docs).collect()
    rows = docs.collect()
    assert len(out) == len(rows)
    assert {(r.doc_id, r.fingerprint) for r in out} == {(r.doc_id, f"{plain(r.text):016x}") for r in rows}
    root = groups({plain(r.text) for r in rows}, 2)
    least = {}
    for r in rows:
        if r.doc_id is not None:
            least[root[plain(r.text)]] = min(r.doc_id, least.get(root[plain(r.text)], r.doc_id))
    assert {(r.doc_id, r.component_id) for r in out} == {(r.doc_id, least.get(root[plain(r.text)])) for r in rows}


def test_one_of_each_group_stays(spark):
    docs = awkward_documents(spark)
    kept = sim.keep_one(docs, sim.near_duplicates(docs))
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns
    # 1, 2, 3 and a row without id have no words; 5, 6 and 7 are copies; 8 is repeated; the text of the other row without id is its own.
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 8, 9, 10, *range(20, 32)]
    assert ids.count(None) == 1
    empty = no_documents(spark)
    assert sim.keep_one(empty, sim.near_duplicates(empty)).count() == 0


def test_no_text_is_lost_with_its_id(spark):
    """Ids that repeat over different texts, and copies without id."""
    a, b = "one text of some words that is copied around here", "quite another text which only one row holds at all"
    rows = [(1, a, "x"), (1, b, "x"), (None, a, "x"), (None, a, "y"), (2, a, "x"), (1, a, "z"), (None, "a third text of words with no id of its own", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component string")
    runs = []
    for parts in (1, 5):
        again = docs.repartition(parts)
        runs.append(sorted(((r.doc_id or 0), r.text, r.component) for r in sim.keep_one(again, sim.near_duplicates(again)).collect()))
    assert runs[0] == runs[1]
    assert [(i, t) for i, t, _ in runs[0]] == [(0, rows[-1][1]), (1, a), (1, b)]
