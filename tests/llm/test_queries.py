"""The corpus queries that have SQL give the SQL's rows at the smallest data; the others run on it."""

import os
from pathlib import Path

import duckdb
import pytest

from boardloom.llm import corpus_tokens, queries as llm

DATA = os.environ.get("BOARDLOOM_DATA", "/root/testdata/sf0.001")
#: Queries without SQL, tested against brute force, round trips or planted cases in the other modules.
ELSEWHERE = {"p1_found", "p1_unmatched", "p4_found", "p4_restored", "p6_found", "p6_rates", "p7_ids", "p8_mix", "p8_shares", "p9_found", "p9_composition"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def test_every_query_is_tested():
    assert set(llm.queries()) == ELSEWHERE | set(llm.oracle_sql())


@pytest.mark.skipif(not Path(DATA).is_dir() or not Path(corpus_tokens.VOCABULARIES).is_dir(), reason="no data")
@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query(spark, duck, name):
    got = llm.queries()[name](spark, DATA)
    want = duck.execute(llm.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, got.select(*want.columns).toPandas().values.tolist())) == sorted(map(str, want.values.tolist()))
