"""Scans of what is still to do, as the reference is configured."""

from pathlib import Path

import duckdb
import pytest

import boardloom.queries as core

DATA = "/root/testdata/sf0.1"


@pytest.mark.skipif(not Path(DATA).is_dir(), reason="no data")
def test_deadlines_have_no_cap_and_reviews_have_400(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW findings AS SELECT * FROM '{DATA}/findings.parquet'")
    for name in ("pending_deadlines_all", "pending_reviews_run"):
        got = sorted((r.fingerprint, r.first_seen) for r in core.queries()[name](spark, DATA).collect())
        assert got == sorted(duck.execute(core.oracle_sql()[name]).fetchall())
        print(name, len(got))
        assert len(got) > 500 if name == "pending_deadlines_all" else len(got) == 400
