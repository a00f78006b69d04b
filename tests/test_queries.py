"""Every query with SQL gives the SQL's rows at the smallest data."""

import math
import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import boardloom.queries as core

DATA = os.environ.get("BOARDLOOM_DATA", "/root/testdata/sf0.001")


def plain(df):
    out = []
    for r in df[sorted(df.columns)].itertuples(index=False):
        row = []
        for v in r:
            if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
                row.append("NULL")
            elif hasattr(v, "isoformat"):
                row.append(v.isoformat()[:10])
            else:
                row.append(str(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v))
        out.append(tuple(row))
    return sorted(out)


def crawled(got, duck):
    """A title that matches is hit twice: on its page and on the list that the page links to."""
    told = duck.execute(core.oracle_sql()["classify_titles"]).df()
    matching = set(told[told.is_match].row_id.astype(str))
    listed = got[got.url.str.startswith("https://pages.example/n/")]
    assert 0 < len(set(listed.code)) and set(listed.code) <= set(map(str, told.row_id))
    assert not got.duplicated(["code", "url"]).any()
    assert len(set(listed.code) & matching) >= 0.9 * len(set(listed.code))


def discovered(got, duck):
    schools = duck.execute("SELECT DISTINCT site_url, max(reachable) AS up FROM schools WHERE site_url <> '' GROUP BY site_url").df()
    assert set(got.site_url) == set(schools.site_url)
    assert set(got[got.reachable].site_url) >= set(schools[schools.up].site_url)


def matched(got, duck):
    rows = duck.execute("SELECT row_id FROM findings WHERE titolo_pulito IS NOT NULL").df()
    assert got.row_id.is_unique and set(got.row_id) <= set(rows.row_id) and got.pos.isin([0, 1, 2]).all() and (got.likeness >= 0).all()


#: Queries that SQL doesn't express, with what has to hold for their rows.
WITHOUT_SQL = {"crawl_notices": crawled, "discover_sites": discovered, "title_matches": matched}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.skipif(not Path(DATA).is_dir(), reason="no data")
@pytest.mark.parametrize("name", sorted(core.queries()))
def test_query(spark, duck, name):
    got = core.queries()[name](spark, DATA).toPandas()
    sql = core.oracle_sql().get(name)
    if sql is None:
        WITHOUT_SQL[name](got, duck)
        return
    want = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)
