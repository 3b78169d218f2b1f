"""Every registered query against its DuckDB oracle (sf0.001 for speed; the
driver repeats this at sf0.01), plus the entry smoke check."""

import pytest
import xxhash

import __spark_entry__ as entry
from strata.plans.oracles import ORACLES
from strata.plans.registry import QUERIES
from strata.plans.xxh64_sql import xxh64

from .oracle_check import compare, duck


@pytest.fixture(scope="module")
def con(sf_smoke):
    return duck(sf_smoke)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "customer_key"


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(QUERIES) == set(ORACLES)


def test_xxh64_sql_equals_the_package(con):
    texts = ["", "a", "abcd", "é" * 3, "x" * 31, "x" * 32, "y" * 33, "word " * 9, "z" * 64, "q" * 127 + "ü"]
    got = con.execute(f"SELECT t, {xxh64('t', '42::UHUGEINT')} FROM (SELECT unnest(?::VARCHAR[]) AS t)", [texts]).fetchall()
    assert dict(got) == {t: xxhash.xxh64_intdigest(t.encode(), seed=42) for t in texts}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_smoke, con, name):
    res = compare(spark, name, sf_smoke, QUERIES[name], ORACLES.get(name), con)
    assert res["status"] in ("ok", "rows-only"), res
    assert res["spark_rows"] > 0
