"""Formatting duplicates against brute force."""

import random
import re

from pyspark.sql import functions as F

from boardloom.llm import format_duplicates as fd

KIND = "row_id bigint, school_code string, title string, url string, key string, id string, h1 string"
WORD = re.compile(r"[^\W_]+")


def key(school, title, url):
    url = (url or "").strip().lower()
    url, _, place = url.partition("#")
    path, _, query = url.partition("?")
    path = path[:-1] if path.endswith("/") else path
    return school, tuple(sorted(WORD.findall((title or "").upper().lower()))), path, tuple(sorted(query.split("&"))), place


def brute(rows):
    first, out = {}, set()
    for r, s, t, u in sorted(rows):
        k = key(s, t, u)
        if k in first:
            out.add((first[k], r))
        first.setdefault(k, r)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], KIND)


def test_against_brute_force(spark):
    rng = random.Random(1)
    titles = ["Avviso (interno), Rif. 12", "RIF 12 - avviso interno", "Avviso interno interno 12", "avviso  interno rif 12!", None, "", "ÀÈ Città", "àè CITTÀ"]
    paths = ["https://X.it/a/?b=2&a=1", " https://x.it/A?a=1&b=2\n", "https://x.it/a?a=1&b=3", "https://x.it/a/#f", None, ""]
    rows = [(i, rng.choice(["s", "t", None]), rng.choice(titles), rng.choice(paths)) for i in range(400)]
    assert set(map(tuple, fd.finding_copies(frame(spark, rows)).collect())) == brute(rows)


def test_one_group_holds_most_rows(spark):
    rows = [(i, "s", "Avviso uno" if i % 4 else f"altro {i}", "u") for i in range(6000)]
    got = set(map(tuple, fd.finding_copies(frame(spark, rows)).collect()))
    assert got == brute(rows)
    groups = {r.kept_row_id: r.copies for r in fd.finding_groups(frame(spark, rows)).collect()}
    assert groups[1] == 4500 and len(groups) == 1501 and sum(groups.values()) == 6000


def test_edges(spark):
    assert fd.finding_copies(frame(spark, [])).count() == 0
    long = "parola " * 200_000
    rows = [(1, "s", long, "u"), (2, "s", long.upper(), "u"), (3, "s", long + "x", "u")]
    assert set(map(tuple, fd.finding_copies(frame(spark, rows)).collect())) == {(1, 2)}


def test_url_key(spark):
    df = spark.createDataFrame([("https://x/a/?",), ("https://x/a",)], "u string")
    from boardloom.llm.text_keys import url_key

    assert df.select(url_key(F.col("u"))).distinct().count() == 1


def test_groups_are_a_query(spark):
    from pathlib import Path

    import duckdb
    import pytest

    from boardloom.llm import queries

    data = "/root/testdata/sf0.001"
    if not Path(data).is_dir():
        pytest.skip("no data")
    got = sorted((r.kept_row_id, r.copies) for r in queries.queries()["p2_groups"](spark, data).collect())
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW findings AS SELECT * FROM '{data}/findings.parquet'")
    assert got == sorted(duck.execute(queries.oracle_sql()["p2_groups"]).fetchall())
    assert sum(n for _, n in got) == spark.read.parquet(f"{data}/findings.parquet").count() and max(n for _, n in got) > 1
