"""Mapping of typed values."""

import pytest
from pyspark.sql import functions as F

from boardloom.llm import canonical_values as cv

ENTRIES = [
    (1, "profilo", "esperto madrelingua inglese", "docente madrelingua di inglese"), (2, "profilo", "istruttore di nuoto", None), (3, "profilo", "maestro di scacchi", None),
    (4, "profilo", "responsabile della protezione dei dati", "DPO"), (5, "profilo", "logopedista", None), (101, "category", "dm219", None), (102, "category", "pon_progettista_collaudatore", "PNRR"), (103, "category", "sicurezza", None),
]
TYPED = {
    ("profilo", "esp. madreling. inglese"): 1, ("profilo", "inglese esperto madrelingua"): 1, ("profilo", "espertomadrelinguainglese"): 1, ("profilo", "Esperta madre lingua inglese (interno/esterno)"): 1,
    ("profilo", "n. 1 esperto madrelinuga ingllese - a.s. 2025/26"): 1, ("profilo", "istruttrice_di_nuoto"): 2, ("profilo", "istruttore di scherma"): 0, ("profilo", "maestro di sci"): 0, ("profilo", "D.P.O."): 4,
    ("profilo", "figura di DPO esterno"): 4, ("profilo", "l0gopedista"): 5, ("profilo", "???"): 0, ("profilo", "-"): 0, ("profilo", "giardiniere"): 0, ("profilo", "dm219"): 0, ("profilo", "x" * 50_000): 0,
    ("profilo", "figura di logopedista esterno"): 5, ("profilo", "figura di istruttore di nuoto esterno"): 2, ("profilo", "figura di maestro di scacchi esterno"): 3,
    ("category", "D.M. 219"): 101, ("category", "DM n. 219"): 101, ("category", "collaudatore e progettista PON"): 102, ("category", "pnrr"): 102, ("category", "Sicur.zza"): 103, ("category", "assicurazione"): 0,
}


def reference(spark, rows=ENTRIES):
    return spark.createDataFrame([(i, f, n, "c", a, "clash", "clash") for i, f, n, a in rows], "item_id bigint, field string, label string, category string, alias string, value string, k string")


def test_mapping(spark):
    values = spark.createDataFrame(list(TYPED), "field string, value string")
    got = {(r.field, r.value): r.item_id for r in cv.map_values(values, reference(spark)).collect()}
    assert got == TYPED


def test_findings(spark):
    rows = [(i, "logopedista" if i % 3 else "Logopedista ", "sicurezza" if i % 2 else None) for i in range(300)] + [(900, "", "sicureza"), (901, None, "altro"), (902, "DPO", "dm219")]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "row_id bigint, profilo string, category string, field string, item_id string")
    got = sorted((r.row_id, r.field, r.item_id) for r in cv.canonical_findings(df, reference(spark)).collect())
    assert got == sorted([(i, "profilo", 5) for i in range(0, 300, 3)] + [(900, "category", 103), (901, "category", 0), (902, "profilo", 4)])
    assert [(r.value, r.rows) for r in cv.unmatched(df, reference(spark)).collect()] == [("altro", 1)]
    assert cv.canonical_findings(df.limit(0), reference(spark)).count() == 0
    empty = cv.canonical_findings(df, reference(spark, []))
    assert {r.item_id for r in empty.collect()} == {0}


@pytest.mark.parametrize("least", [0.8, 0.55, 0.3])
def test_join_finds_all_similar_pairs_once(spark, least):
    names = ["tutordaula", "tutoreaule", "aulatutor", "registateatrale", "registiteatro", "medico", "medicicompetenti", "x", "xy", "abcabc", "abcabcabc"]
    left = spark.createDataFrame([("f", w) for w in names], "field string, text string")
    right = spark.createDataFrame([("f", i, w) for i, w in enumerate(names)], "field string, item_id bigint, text string")
    a, b = cv.ordered_sets(left, right)
    got = [(r.text, r.name) for r in cv.similar(a, b, least).collect()]
    sets = {r.text: set(r.grams) for r in a.collect()}
    want = {(t, u) for t, x in sets.items() for u, y in sets.items() if len(x & y) / len(x | y) >= least}
    assert sorted(got) == sorted(want)


def test_words_beside_many_names_are_left_out(spark):
    around = [("profilo", f"n. 2 {n} interno") for _, f, n, _ in ENTRIES if f == "profilo"]
    values = spark.createDataFrame([*around, ("profilo", "DPO interno"), ("profilo", "interno"), ("profilo", "n. 7")], "field string, value string")
    got = {(r.field, r.value): r.item_id for r in cv.map_values(values, reference(spark)).collect()}
    assert got == {**{v: i for v, (i, *_) in zip(around, ENTRIES, strict=False)}, ("profilo", "DPO interno"): 4, ("profilo", "interno"): 0, ("profilo", "n. 7"): 0}


@pytest.mark.parametrize(("word", "typed", "there"), [("nuoto", ["istruttore", "scherma"], False), ("nuoto", ["nouto"], True), ("inglese", ["ingl"], True), ("aula", ["dalua"], True), ("tedesco", ["madrelinguatedesco"], True), ("tedesco", [], False)])
def test_shows(word, typed, there):
    assert cv.shows(word, typed) == there
