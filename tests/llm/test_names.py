"""Input columns with the names that modules use inside, dotted names and names of other inputs."""

import re
from pathlib import Path

import pytest

import corpus_pipeline as C
from forgeline.llm import line_dedup, merkle, mixing, parity_join, simhash, whitening

MODULES = [line_dedup, mixing, parity_join, merkle, simhash, whitening, C]
INNER = sorted({n for m in MODULES for n in re.findall(r'"(_*[a-z][a-z_0-9]*)"', Path(m.__file__).read_text())} - {"doc_id", "text", "lang", "source", "n_chars"})
BASE = " ".join(f"w{i}" for i in range(60))
ROWS = [(1, BASE, "en", "s", 1), (2, BASE + " end", "en", "s", 2), (3, "other words\nin two lines", "de", "t", 3), (4, "other words\nin two lines\nand one", None, None, None), (2, BASE + " end", "en", "s", 2)]


def named(spark, names):
    schema = ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long", *[f"`{n}` string" for n in names]])
    return spark.createDataFrame([(*r, *[f"{n}!" for n in names]) for r in ROWS], schema)


@pytest.fixture(scope="module")
def docs(spark):
    assert len(INNER) > 60 and {"__gone", "__id", "__form", "__topic", "__s"} <= set(INNER)
    return named(spark, [*INNER, "a.b", "with space", "column_3"])


def same(result, docs):
    assert result.columns == docs.columns
    rows = result.collect()
    assert rows and all(r[docs.columns.index(n)] == f"{n}!" for r in rows for n in docs.columns[5:])
    return sorted(r[0] for r in rows)


def test_line_dedup(spark, docs):
    assert same(line_dedup.without_repeated_lines(docs), docs) == [1, 2, 2, 3, 4]


def test_mixing(spark, docs):
    assert set(same(mixing.sampled(docs, keep_share=1.0), docs)) <= {1, 2, 3, 4}


def test_keep_one(spark, docs):
    assert same(parity_join.keep_one(docs), docs) == [1, 3, 4]


def test_results_do_not_depend_on_other_columns(spark, docs):
    bare = named(spark, [])
    for operator in (simhash.near_duplicates, merkle.manifest, parity_join.near_duplicates):
        assert sorted(map(str, operator(docs).collect())) == sorted(map(str, operator(bare).collect()))


def test_pipeline_stage(spark, docs):
    assert same(C.drop_repeated_lines(spark, docs, ""), docs)
