import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecart.llm import language_id as lid
from lakecart.llm.common import held_out
from llm_frames import awkward_documents, no_documents

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def net(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(~held_out(F.col("doc_id")))
    return lid.train(lid.training_sample(docs, "text", "lang", "doc_id", max_docs=150), steps=250)


def test_held_out_accuracy(spark, net):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(held_out(F.col("doc_id")))
    rows = lid.identify(docs, net).select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_tables_equal_the_convolution(net):
    """The lookup tables give what embedding, convolving and pooling gives."""
    rng = np.random.default_rng(0)
    cls = rng.integers(0, lid.N_CLASSES, (lid.WINDOW, 5))
    got = lid._window_probs(net, lid._tables(net), cls)
    for i in range(5):
        e = net.embed[cls[:, i]]
        pooled = [max(sum(e[p + j] @ net.filters[w][j][:, f] for j in range(w)) + net.bias[w][f]
                      for p in range(lid.WINDOW - w + 1)) for w in lid.WIDTHS for f in range(lid.FILTERS)]
        logit = np.maximum(pooled, 0) @ net.dense + net.dense_bias
        want = np.exp(logit - logit.max())
        assert np.allclose(got[i], want / want.sum(), atol=1e-4)


def test_every_byte_counts_and_batches_do_not(spark, net):
    """A text is read to its end, and neither chunks nor neighbours change a result."""
    tables = lid._tables(net)
    rows = spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars > 500").orderBy("doc_id").collect()
    some = {lang: [r.text for r in rows if r.lang == lang] for lang in ("en", "fr")}
    texts = [some["en"][0][:400] + " " + " ".join(some["fr"]), some["en"][1], "", "x"]
    parts = [t.encode() for t in texts]
    raw = np.frombuffer(b"".join(parts), np.uint8)
    offsets = np.cumsum([0, *map(len, parts)])
    whole = lid.predict_bytes(net, tables, raw, offsets, chunk=7)
    for i, b in enumerate(parts):
        alone = lid.predict_bytes(net, tables, np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        assert np.allclose(whole[i], alone[0], atol=1e-5)
    assert net.langs[whole[0].argmax()] == "fr"


def test_awkward_rows(spark, net):
    docs = awkward_documents(spark)
    out = lid.identify(docs, net).select("doc_id", "text", "lang_pred", "score").collect()
    assert len(out) == docs.count()
    for r in out:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letters)
        assert (r.score == 0) == (not letters)
    assert lid.identify(no_documents(spark), net).count() == 0


def test_nothing_or_one_language_to_learn(spark):
    docs = awkward_documents(spark)
    assert lid.training_sample(no_documents(spark), "text", "lang", "doc_id") == []
    assert {r.lang_pred for r in lid.identify(docs, lid.train([])).collect()} == {"und"}
    one = lid.train([("en", ["some text"])])
    found = lid.identify(docs, one).filter(F.col("lang_pred") != "und").select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in found] == [("en", 1.0)]


def test_sample_is_bounded_and_covers_rare_languages(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("abc ") for _ in range(600)), "big" if i % 50 else "small") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    sample = lid.training_sample(docs, "text", "lang", "doc_id", max_docs=100)
    n = {k: sum(lang == k for lang, _ in sample) for k in ("big", "small")}
    assert n["small"] == 40 and 60 <= n["big"] <= 300
    assert all(len(w) <= lid.WINDOW for _, ws in sample for w in ws)


def test_every_language_is_sampled(spark, monkeypatch):
    rows = [(i, f"word{i % 300}", f"l'{i % 300}\"") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert len({lang for lang, _ in lid.training_sample(docs, "text", "lang", "doc_id")}) == 300
    monkeypatch.setattr(lid, "MAX_LANGS", 299)
    with pytest.raises(ValueError):
        lid.training_sample(docs, "text", "lang", "doc_id")


def test_a_column_named_like_the_internal_one(spark):
    docs = spark.createDataFrame([(1, "some text", 5)], "doc_id bigint, text string, _lid int")
    net = lid.train([("en", ["some text"]), ("fr", ["un texte"])], steps=2)
    row = lid.identify(docs, net).first()
    assert row["_lid"] == 5 and row.lang_pred in ("en", "fr")
