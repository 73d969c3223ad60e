import pytest

from forgeline.llm import merkle

LONG = "Word AND word " * 20_000


def rows(n=700):
    """A hot source of many levels, one of exactly a run, one of a run and one, a lone leaf, nulls everywhere."""
    out = []
    for i in range(n):
        source = "hot" if i % 3 else ["s16", "s17", "lone", None, "zé"][i % 5]
        out.append((i * 7 - 50, None if i % 29 == 0 else f"Text {i % 40} Ünï", None if i % 11 == 0 else "en", source, None if i % 13 == 0 else i))
    out += [(90_000 + i, "Run", "en", "run", 3) for i in range(16)] + [(91_000 + i, "Run", "en", "more", 3) for i in range(17)]
    return out + [(92_000, "", "", "", 0), (None, "No Id", "en", "hot", 5), (92_001, LONG, "en", "alone", len(LONG))]


def frame(spark, data):
    return spark.createDataFrame([(*r, 1, 2, "x", "y") for r in data], "doc_id long, text string, lang string, source string, n_chars long, pos long, n long, digest string, tree string")


def result(spark, data):
    return {r.doc_id: tuple(r)[1:] for r in merkle.manifest(frame(spark, data)).collect()}


def test_brute_force(spark, monkeypatch):
    data = rows()
    want = merkle.brute_force(data)
    assert result(spark, data) == want
    assert {v[-1] for v in want.values()} == {True, False}
    monkeypatch.setattr(merkle, "RANGE_ROWS", 50)  # sources that cross ranges, ranges that hold several sources
    assert result(spark, data) == want


@pytest.mark.parametrize("data", [[(5, "A", "en", "s", 1)], [(5, "A", "en", "s", 1), (6, "B", "en", None, 1)], [(i, "a", "en", f"s{i:03d}", 1) for i in range(300)]])
def test_small_and_many_sources(spark, data):
    got = result(spark, data)
    assert got == merkle.brute_force(data)
    if len(data) == 1:  # leaf, subroot and root are one
        assert len(set(got[5][:3])) == 1


def test_repeated_rows(spark):
    data = [(1, "a", "en", "s", 1)] * 40 + [(1, "b", "en", "s", 1)] * 3 + [(None, None, None, None, None)] * 20
    got = merkle.manifest(frame(spark, data)).collect()
    assert len(got) == len(data) and all(r.verified and r.folded_root == r.root for r in got)
    assert len({r.root for r in got}) == 1


def test_empty(spark):
    assert merkle.manifest(frame(spark, [])).collect() == []
