"""Every registered query against its DuckDB oracle (rows-only where there is none)."""

import os

import pytest

from oracle_compare import compare

SF = os.environ.get("FORGELINE_ORACLE_SF", "/root/testdata/sf0.001")


def _names():
    from forgeline.plans.queries import queries

    return sorted(queries())


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF, _names(), verbose=False)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(results, name):
    r = results[name]
    assert r.startswith("OK") or r.startswith("rows-only"), r


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0 and "split_set" in df.columns
