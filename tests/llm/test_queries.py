"""The registered queries on the smallest tables, against brute force or invariants."""

import hashlib

import duckdb
import pytest

from forgeline.llm import ann, line_dedup, merkle, parity_join, simhash, substrings
from forgeline.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return [(r[0], r[1]) for r in duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()]


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_substrings(spark, docs):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op3_substring_dedup"](spark, SF).collect()}
    assert got == {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, (n, k, t) in substrings.brute_force(docs).items()}


def test_near_duplicates(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op6_ngram_jaccard_join"](spark, SF).collect()}
    assert got == parity_join.brute_force(docs)


def test_simhash(spark, docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op13_simhash_near_dedup"](spark, SF).collect()}
    assert got == simhash.brute_force(docs)


def test_merkle(spark):
    rows = duckdb.sql(f"select doc_id, text, lang, source, n_chars from '{SF}/documents.parquet'").fetchall()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_merkle_manifest"](spark, SF).collect()}
    assert got == merkle.brute_force(rows)


def test_whitening(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    got = QUERIES["op12_embedding_whitening"](spark, SF).collect()
    assert len(got) == 8 * len(rows) and {r.identity_error < 1e-9 for r in got} == {True}


def test_lines(spark, docs):
    got = {r.doc_id: r.text for r in QUERIES["op10_line_dedup"](spark, SF).collect()}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert got == line_dedup.brute_force(docs) == dict(con.execute(ORACLE["op10_line_dedup"]).fetchall())


def test_neighbours(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    want = ann.brute_force(rows, {i for i, _ in rows if i % 100 == 0})
    got = {}
    for r in QUERIES["op7_nearest_neighbours"](spark, SF).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert sum(len(set(got[q]) & {v for _, v in want[q]}) for q in want) / (10 * len(want)) >= 0.95


@pytest.mark.parametrize("name", ["op1_document_fingerprints", "op2_toxicity", "op5_lm_scoring", "op8_sharding", "op9_mixing"])
def test_one_row_per_document(spark, docs, name):
    got = QUERIES[name](spark, SF).select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in docs)
