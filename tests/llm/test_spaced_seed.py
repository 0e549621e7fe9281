import collections
import random
import re

import pytest

from lakecart.llm import spaced_seed as ss
from llm_frames import WORDS, awkward_documents, no_documents


def tokens(text):
    return [t for t in re.split(r"[\W_]+", (text or "").lower()) if t]


def stretch(agrees):
    """(score, first, last) of the best stretch."""
    score = start = 0
    best = (0, 0, 0)
    for k, same in enumerate(agrees):
        if not score:
            start = k
        score = score + 1 if same else max(score - ss.MISS, 0)
        if same and score > best[0]:
            best = (score, start, k)
    return best


def brute(docs, items):
    """(doc row, item) -> matched, by trying every alignment that one mask proposes."""
    out = {}
    for d, text in docs:
        dt = tokens(text)
        for item, itext in items:
            it = tokens(itext)
            n = len(it)
            if n and n < ss.MIN_TOKENS and dt == it:
                out[(d, item)] = n
            if n < ss.MIN_TOKENS:
                continue
            enough = ss.MIN_SHARE * n if n >= ss.SPAN else n - 1 if n >= ss.ONE_OFF else n
            half = n if n < ss.ONE_OFF else n // 2
            places = [[p + o for o in m] for m in ss.MASKS for p in range(n - m[-1])]
            if n < ss.SPAN:
                places += [list(range(half)), list(range(n - half, n))]
            most, best, inside = 0, 0, set()
            # Alignments with fewer agreeing tokens than any mask names can't be proposed.
            at = {w: [k for k, x in enumerate(it) if x == w] for w in it}
            agree = collections.Counter(j - k for j, w in enumerate(dt) for k in at.get(w, ()))
            least = min(map(len, places))
            for shift in (s for s, c in agree.items() if c >= least):
                same = [0 <= k + shift < len(dt) and dt[k + shift] == it[k] for k in range(n)]
                if any(all(same[k] for k in place) for place in places):
                    most = max(most, sum(same))
                    score, first, last = stretch(same)
                    best = max(best, score)
                    if score >= ss.PIECE_SCORE:
                        inside |= {k for k in range(first, last + 1) if same[k]}
            if most >= enough:
                out[(d, item)] = most
            elif best >= ss.RUN_SCORE or len(inside) >= enough:
                out[(d, item)] = max(most, len(inside))
    return out


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(4)
    say = lambda n: [rng.choice(WORDS) + rng.choice("abcdefgh") for _ in range(n)]
    items = {i: say(n) for i, n in enumerate([30, 15, 12, 9, 6, 4, 3, 40])}
    docs = [(100 + i, " ".join(say(50))) for i in range(20)]
    for i, it in items.items():
        docs.append((200 + i, " ".join(say(20)) + " " + ", ".join(it).upper() + "! " + " ".join(say(20))))
        changed = [w if k % 6 else "zzz" for k, w in enumerate(it)]  # every sixth token substituted
        docs.append((300 + i, " ".join(say(20) + changed + say(5))))
        docs.append((400 + i, " ".join(say(20) + it[:len(it) // 4] + say(20))))  # too little
        docs.append((500 + i, " ".join(it[2:])))  # runs over the start
    items = [(i, " ".join(w)) for i, w in items.items()] + [(50, None), (51, ""), (52, " ".join(items[0])), (None, "one two three four five")]
    return docs + [(1, None), (2, "")], items


def frames(spark, case):
    return (spark.createDataFrame(case[0], "doc_id bigint, text string"),
            spark.createDataFrame(case[1], "item_id bigint, text string"))


def test_by_brute_force(spark, case):
    docs, items = case
    got = {(r.id, r.item): r.matched for r in ss.contamination(*frames(spark, case)).collect()}
    first = [(i, t) for i, t in items if i != 52]  # equal items count as the smallest
    assert got == brute(docs, first)
    assert {(200 + i, i) for i in range(8)} <= set(got)
    assert {(300, 0), (301, 1), (307, 7)} <= set(got)
    assert not any(d in range(100, 200) or d in range(400, 500) for d, _ in got)


def test_shuffled_joins_give_the_same(spark, case, monkeypatch):
    want = sorted(map(tuple, ss.contamination(*frames(spark, case)).collect()))
    monkeypatch.setattr(ss, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, ss.contamination(*frames(spark, case)).collect())) == want


def test_verdicts_and_removal(spark, case):
    docs, bench = frames(spark, case)
    verdicts = ss.judge(docs, bench).collect()
    assert len(verdicts) == docs.count()
    bad = {r.doc_id for r in verdicts if r.contaminated}
    kept = ss.remove_contaminated(docs, bench)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in docs.collect() if r.doc_id not in bad)
    for r in verdicts:
        assert (r.best_item is not None) == r.contaminated == (r.n_items > 0)


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    bench = docs.filter("doc_id = 5").selectExpr("doc_id AS item_id", "text")
    rows = ss.judge(docs, bench).collect()
    assert len(rows) == docs.count()
    assert {r.doc_id for r in rows if r.contaminated} == {5, 6, 7}
    kept = ss.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert ss.remove_contaminated(docs, none).count() == docs.count()
    assert ss.judge(no_documents(spark), bench).count() == 0


def test_planted_passages_of_the_table(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    bad = {r.doc_id for r in ss.judge(docs, bench).filter("contaminated").collect()}
    texts = {r.doc_id: " ".join(tokens(r.text)) for r in docs.collect()}
    whole = {d for d, t in texts.items() if any(" ".join(tokens(b.text)) in t for b in bench.collect())}
    assert whole <= bad and len(bad - whole) <= 2


@pytest.mark.parametrize("bound", [0, 128 << 20])
def test_partial_copies_and_copies_with_inserted_words(spark, monkeypatch, bound):
    monkeypatch.setattr(ss, "BROADCAST_BYTES", bound)
    item = lambda name, n: [f"{name}{i}" for i in range(n)]
    long, mid, short = item("long", 250), item("mid", 60), item("short", 30)
    around = lambda ws: " ".join(item("a", 20) + ws + item("b", 20))
    docs = {
        1: long[70:170], 2: [w if k % 10 else "zzz" for k, w in enumerate(long[70:170])],
        3: mid[:20] + ["x"] + mid[20:40] + ["y"] + mid[40:], 4: short[:10] + ["x"] + short[10:20] + ["y"] + short[20:],
        5: mid[:10] + mid[11:22] + mid[23:33] + mid[34:],  # words left out
        6: long[70:82], 7: (short[:8] + ["x"]) * 6, 8: ["nothing"] * 50}  # a phrase, one phrase again and again
    d = spark.createDataFrame([(i, around(ws)) for i, ws in docs.items()], "doc_id bigint, text string")
    b = spark.createDataFrame([(i, " ".join(ws)) for i, ws in enumerate((long, mid, short))], "item_id bigint, text string")
    rows = {r.doc_id: (r.best_item, r.matched) for r in ss.judge(d, b).filter("contaminated").collect()}
    # Of document 2 the stretch begins after the first substitution.
    assert rows == {1: (0, 100), 2: (0, 90), 3: (1, 60), 4: (2, 30), 5: (1, 57)}
    assert sorted(r.doc_id for r in ss.remove_contaminated(d, b).collect()) == [6, 7, 8]


def planted(n_items=20, seed=7):
    """Items of 3, 6, 30 and 60 tokens, and documents that hold them exactly or with substitutions; clean ones between."""
    rng = random.Random(seed)
    say = lambda n: [rng.choice(WORDS) + rng.choice("abcdefgh") + rng.choice("stuv") for _ in range(n)]
    items, docs = [], {}
    for i in range(n_items):
        for kind, n in enumerate((3, 6, 30, 60)):
            items.append((10 * i + kind, say(n)))
            it = list(items[-1][1])
            if n == 6:
                it[rng.randrange(6)] = "changed"
            if n == 30:
                it.insert(rng.randrange(5, 25), "put"), it.insert(rng.randrange(5, 25), "in")
            if n == 60:
                it = [w if (k + i) % 3 else "zzz" for k, w in enumerate(it)]
            docs[10 * i + kind] = say(30) + it + say(30)
            docs[10_000 + 10 * i + kind] = say(70)
    return items, docs


def test_short_items_and_dense_substitutions_are_found(spark):
    items, docs = planted()
    d = spark.createDataFrame([(i, " ".join(ws)) for i, ws in docs.items()], "doc_id bigint, text string")
    b = spark.createDataFrame([(i, " ".join(ws)) for i, ws in items], "item_id bigint, text string")
    found = {(r.id, r.item) for r in ss.contamination(d, b).collect()}
    for kind in range(4):
        of = [i for i, _ in items if i % 10 == kind]
        assert sum((i, i) in found for i in of) / len(of) >= 0.9
    assert not any(i >= 10_000 for i, _ in found)


def test_the_operator_follows_its_sql(spark):
    import duckdb

    from lakecart.llm.oracle import LEAKS
    items, docs = planted(6, seed=9)
    items += [(500, ["one", "two"]), (501, ["solo"]), (None, ["no", "id", "at", "all", "here"])]
    docs |= {20_000: ["one", "two"], 20_001: ["solo"], 20_002: ["solo", "act"], 20_003: ["a", "no", "id", "at", "all", "here", "b"],
             20_004: items[3][1][:25] + ["x"] * 30}
    rows = [(i, " ".join(ws)) for i, ws in docs.items()] + [(1, None), (None, "")]
    bench = [(i, " ".join(ws)) for i, ws in items]
    got = ss.judge(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(bench, "item_id bigint, text string"))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", bench)
    cur = con.execute(LEAKS)
    names = [c[0] for c in cur.description]
    want = sorted(cur.fetchall(), key=repr)
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=repr) == want
    marked = {r[0] for r in want if r[1]}
    assert {20_000, 20_001, 20_003, 20_004} <= marked and 20_002 not in marked


def test_the_shuffled_plan_carries_ids_and_positions_only(spark, case, monkeypatch):
    monkeypatch.setattr(ss, "BROADCAST_BYTES", 0)
    plan = ss.contamination(*frames(spark, case))._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner, (seed" in line)
    below = plan.splitlines()[plan.splitlines().index(join) + 1]
    assert "dt#" not in below.split("AS")[0]


def test_only_positions_that_meet_a_seed_are_shuffled(spark, case, monkeypatch):
    """Beyond the bound the shuffled side of the seed join grows with the hits, not with the documents."""
    written, plans, real = {}, {}, ss.materialize

    def kept(df, name, **options):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        written[name] = real(df, name, **options)
        return written[name]

    monkeypatch.setattr(ss, "materialize", kept)
    monkeypatch.setattr(ss, "BROADCAST_BYTES", 0)
    docs, bench = frames(spark, case)
    found = ss.contamination(docs, bench)
    positions = docs.select(ss.F.sum(ss.F.size(ss.tokens(ss.F.col("text"))))).first()[0] * len(ss.MASKS)
    assert 0 < written["seed-windows"].count() < positions / 5
    joins = [line for line in plans["seed-windows"].splitlines() if "Join " in line]
    assert "(seed" in joins[0] and "sieve_row" in joins[1]  # the bitmap comes before the shuffle
    assert 0 < written["seed-documents"].count() < docs.count()
    assert found.select("id").distinct().exceptAll(written["seed-documents"].select("id").distinct()).count() == 0


def test_seeds_are_counted_as_what_they_take_in_memory(spark, case, monkeypatch):
    """A hash table of seeds takes more than twice the 48 bytes of a row."""
    docs, bench = frames(spark, case)
    found = []
    monkeypatch.setattr(ss, "_small", lambda df, size: found.append(df.agg(ss.F.sum(size) / ss.F.count(ss.F.lit(1))).first()[0]) or True)
    ss.contamination(docs, bench)
    assert min(found) >= 120
