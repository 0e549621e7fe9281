"""The SQL-expressible operators against DuckDB, and the shape of every registered query."""

import duckdb
import pytest

from conftest import SF_SMALL
from lakecart.llm import queries as llm


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted([tuple(round(r[i], 5) if isinstance(r[i], float) else r[i] for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("key", sorted(llm.oracle_sql()))
def test_matches_oracle(spark, con, key):
    df = llm.queries()[key](spark, SF_SMALL)
    cur = con.execute(llm.oracle_sql()[key])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert canon(df.columns, map(tuple, df.collect())) == canon(cols, cur.fetchall())


def test_one_query_per_operator():
    names = list(llm.queries())
    assert [int(n[2:].split("_")[0]) for n in names if n != "pipeline"] == list(range(1, 14))


CONTRACT = {
    "op1_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op2_rendezvous_shards": ["doc_id", "size", "text_crc32", "law", "shard", "grown_shard", "slot"],
    "op4_attention_mil": ["doc_id", "held_out", "score", "predicted"],
    "op5_ngram_ratio": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op7_simhash_variants": ["doc_id", "fingerprint", "component_id"],
}


@pytest.mark.parametrize("key", sorted(CONTRACT))
def test_one_row_per_document(spark, key):
    rows = llm.queries()[key](spark, SF_SMALL)
    assert set(CONTRACT[key]) <= set(rows.columns)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert sorted(r[0] for r in rows.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())
