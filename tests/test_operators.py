"""The relational operators on small cases."""

import datetime as dt
import io
import json
import random
import ssl
import urllib.error
import zipfile

from pyspark.sql import functions as F

from boardloom.operators import compare, crawling, enrichment, listing, registry, reports, snapshot_diff, state
from boardloom.plans.work import join_small
from boardloom.sources import pages, snapshots

def now():
    return F.timestamp_micros(F.lit(1_780_272_000_000_000))


SNAP = "snapshot_date date, fingerprint string, last_seen timestamp, extra string, rec_key string, __key string"


def day(n):
    return dt.date(2026, 1, n)


def at(n):
    return dt.datetime(2026, 1, 1, 0, 0, 0, n)


def changes(spark, rows):
    df = spark.createDataFrame([(d, k, v, "x", "clash", "clash") for d, k, v in rows], SNAP)
    return sorted(map(tuple, snapshot_diff.finding_changes(df).collect()), key=str)


def brute(rows):
    best = {}
    for d, k, v in rows:
        if d is None:
            continue
        k = k.strip().lower() if k is not None else None
        if (d, k) not in best or (best[d, k] is None) or (v is not None and v > best[d, k]):
            best[d, k] = v
    days = sorted({d for d, _ in best})
    out = []
    for a, b in zip(days, days[1:], strict=False):
        x, y = ({k: v for (d, k), v in best.items() if d == e} for e in (a, b))
        out += [(str(b), k, "added") for k in y.keys() - x.keys()] + [(str(b), k, "removed") for k in x.keys() - y.keys()]
        out += [(str(b), k, "changed") for k in x.keys() & y.keys() if x[k] != y[k]]
    return sorted(out, key=str)


def test_snapshot_changes(spark):
    rng = random.Random(3)
    rows = [(day(rng.randrange(1, 6)), rng.choice(["a", " A", "b\t", "C", "d", None, ""]) if rng.random() < 0.7 else "hot", rng.choice([None, at(1), at(2)])) for _ in range(300)]
    rows += [(None, "x", at(1))]
    assert changes(spark, rows) == brute(rows)


def test_snapshot_changes_edges(spark):
    assert changes(spark, []) == []
    assert changes(spark, [(day(1), "a", at(1)), (day(1), "a", at(1))]) == []
    assert changes(spark, [(day(1), "a", at(1)), (day(2), "b", at(1)), (day(3), "A ", at(1))]) == [("2026-01-02", "a", "removed"), ("2026-01-02", "b", "added"), ("2026-01-03", "a", "added"), ("2026-01-03", "b", "removed")]
    assert changes(spark, [(day(1), "a", at(1)), (day(2), "a", at(2))]) == [("2026-01-02", "a", "changed")]


def test_school_changes(spark):
    kind = "snapshot_date date, code string, last_discovery timestamp, trasparenza_url string"
    rows = [(day(1), "x", None, None), (day(2), " X", None, "  "), (day(3), "x", at(1), "https://A"), (day(3), "x", at(2), " https://B "), (day(4), "X", None, "https://b")]
    got = snapshot_diff.school_changes(spark.createDataFrame(rows, kind)).orderBy("snapshot_date").collect()
    assert [tuple(r) for r in got] == [("2026-01-03", "X", "changed"), ("2026-01-04", "X", "changed")]


def test_join_small_both_ways(spark):
    left = spark.range(1000).select((F.col("id") % 3).cast("string").alias("k"), "id")
    right = spark.createDataFrame([("0", 1), ("1", 2)], "k string, v int")
    for most in (10, 1):
        out = join_small(left, right, "k", "left", max_rows=most, salts=4)
        assert out.count() == 1000 and out.agg(F.sum("v")).head()[0] == 334 + 333 * 2


def test_registry(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("﻿Codice Scuola;REGIONE;SITOWEBSCUOLA;DENOMINAZIONESCUOLA\nA;lombardia;-;\"x;y\"\nB;VENETO;;b\nA;Lombardia;www.a.it;z\n;LOMBARDIA;;n\nA;LOMBARDIA;www.b.it;w\n", encoding="utf-8")
    got = registry.read_registry(spark, str(path), [" lombardia"]).collect()
    assert [(r.code, r.name, r.website, r.province) for r in got] == [("A", "z", "https://www.a.it", "")]
    assert registry.delimiter("a|b\tc") == "|" and registry.delimiter("abc") == ","


GOLDEN = {  # total, reachable, found by region, and the percentages published for them
    "LAZIO": (4029, 2700, 2561, 67.0, 63.6),
    "LOMBARDIA": (6453, 4948, 4866, 76.7, 75.4),
    "UMBRIA": (962, 674, 664, 70.1, 69.0),
}


def test_report_percentages(spark, tmp_path):
    parts = None
    for region, (total, up, found, _, _) in GOLDEN.items():
        n = F.col("id")
        part = spark.range(total).select(F.lit(region).alias("region"), (n < up).alias("reachable"), F.when(n < found, "u").otherwise("").alias("trasparenza_url"), F.when(n < up, "generic").alias("platform"), F.lit("ok").alias("discovery_note"), F.concat(F.lit(region[:2]), n.cast("string")).alias("code"), F.lit("n").alias("name"), F.lit("p").alias("province"), F.lit(None).cast("string").alias("city"))
        parts = part if parts is None else parts.unionByName(part)
    got = {r.region: (r.totale, r.raggiungibili, r.trasparenza, r.raggiungibili_pct, r.trasparenza_pct) for r in reports.by_region(parts).collect()}
    assert got == GOLDEN
    made = reports.write_report(parts.limit(50), str(tmp_path / "r.json"), str(tmp_path / "m.csv"), "now")
    assert json.loads((tmp_path / "r.json").read_text()) == made
    assert (tmp_path / "m.csv").read_bytes().count(b"\r\n") == 51
    assert reports.totals(parts.limit(0)).head().raggiungibili_pct == 0.0


def findings(spark, rows):
    kind = state.FINDINGS
    full = [{f.name: r.get(f.name) for f in kind} for r in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in kind) for r in full], kind)


def test_upsert_is_idempotent_and_freezes(spark):
    old = findings(spark, [{"fingerprint": "a", "score": 0.5, "first_seen": at(1), "last_seen": at(1), "origin": "archivio"}])
    batch = spark.createDataFrame([("a", 0.9, 1), ("b", 0.7, 2), ("b", 0.6, 1)], "fingerprint string, score double, n int")
    one = state.insert_or_touch(old, batch.drop("n"), now(), F.col("score"))
    got = {r.fingerprint: r for r in one.collect()}
    assert (got["a"].score, got["a"].is_new, got["a"].origin) == (0.5, False, "archivio")
    assert (got["b"].score, got["b"].is_new, got["b"].origin) == (0.6, True, "nuovo")
    assert got["a"].first_seen == at(1) and got["a"].last_seen > at(1)
    again = state.insert_or_touch(one.drop("is_new"), batch.drop("n"), now(), F.col("score"))
    assert again.where("is_new").count() == 0 and again.count() == 2
    assert state.insert_or_touch(old.limit(0), batch.drop("n").limit(0), now(), F.col("score")).count() == 0


def test_reviews_overwrite_with_null(spark):
    old = findings(spark, [{"fingerprint": "a", "scadenza": day(3), "titolo_pulito": "t"}, {"fingerprint": "b", "scadenza": day(4)}])
    told = spark.createDataFrame([("a", None, None, "", "p", "")], "fingerprint string, ai_bando boolean, scadenza date, titolo_pulito string, profilo string, doc_url string")
    got = {r.fingerprint: r for r in state.set_reviews(old, told, now()).collect()}
    assert got["a"].scadenza is None and got["a"].titolo_pulito is None and got["a"].profilo == "p" and got["a"].ai_checked
    assert got["b"].scadenza == day(4) and got["b"].ai_checked is None


def test_versions(spark, tmp_path):
    v = state.Versions(spark, str(tmp_path / "s"), state.RUNS)
    assert v.latest() == 0 and v.read().count() == 0
    v.write(v.read().unionByName(state.log_run(v.read(), now(), "crawl", 1, 2)))
    v.write(v.read().unionByName(state.log_run(v.read(), now(), "crawl", 1, 2)))
    assert [r.id for r in v.read().orderBy("id").collect()] == [1, 2]
    v.write(v.read().drop("hits"))
    assert "hits" in v.read().columns
    v.reset()
    assert v.read().count() == 0 and v.latest() == 4


def test_best_hits_like_the_fold(spark):
    rng = random.Random(5)
    events = [(f"c{rng.randrange(3)}", f"u{rng.randrange(6)}", i, rng.choice(["anchor", "page"]), str(i), "k", rng.choice([0.5, 0.6, 0.7])) for i in range(400)]
    want = {}
    for c, u, _, kind, t, _, s in events:
        held = want.get((c, u))
        if held is None or (kind == "anchor" and s > held[1]):
            want[c, u] = (t, s)
    df = spark.createDataFrame(events, "code string, url string, seq int, kind string, title string, category string, score double")
    assert {(r.code, r.url): (r.title, r.score) for r in crawling.best_hits(df).collect()} == want


PAGES = "url string, ok boolean, status int, final_url string, html string, error string"
HOME = "https://www.s.it"


def test_discover_and_crawl(spark):
    entry = HOME + "/albo-online/"
    notice = '<a href="/n/1#x">Avviso pubblico per la selezione di un esperto esterno</a><a href="/bandi/">Bandi di gara</a><a href="#main">Albo online</a><a href="/x">breve</a>'
    rows = [
        (HOME, True, 200, HOME, '<a href="/foo">Albo pretorio</a> wp-content', None),
        (entry, True, 200, entry, notice + " " * 200, None),
        (HOME + "/bandi/", True, 200, HOME + "/bandi/", '<a href="/n/2">Reclutamento esperti madrelingua inglese</a>', None),
        ("https://b.it/", True, 200, "https://b.it/", '<a href="/y"><b>Avvisi</b></a>', None),
        ("https://www.c.it", False, None, None, None, "URLError gone"),
    ]
    table = spark.createDataFrame(rows, PAGES)
    sites = spark.createDataFrame([(HOME,), ("https://www.b.it",), ("https://www.c.it",), ("",)], "site_url string")
    got = {r.site_url: r for r in crawling.discover(sites, table).collect()}
    assert (got[HOME].trasparenza_url, got[HOME].method, got[HOME].platform) == (entry, "path_probe", "wordpress_generic")
    assert (got["https://www.b.it"].trasparenza_url, got["https://www.b.it"].method, got["https://www.b.it"].resolved_url) == ("https://b.it/y", "link_scan", "https://b.it/")
    assert (got["https://www.c.it"].reachable, got["https://www.c.it"].discovery_note) == (False, "URLError gone")
    hits, outcomes = crawling.crawl(spark.createDataFrame([("A", entry), ("B", "https://gone.it")], "code string, trasparenza_url string"), table)
    found = {r.url: r.kind for r in hits.collect()}  # the bodies name a call too
    assert found == {HOME + "/n/1#x": "anchor", HOME + "/n/2": "anchor", entry: "page", HOME + "/bandi/": "page"}
    assert {r.code: (r.ok, r.pages) for r in outcomes.collect()} == {"A": (True, 2), "B": (False, 0)}


def test_scored_pages_are_read_and_normalised_once(spark):
    rows = [(f"{HOME}/{i}", True, 200, f"{HOME}/{i}", f'<a href="/n/{i}">Avviso pubblico per la selezione di un esperto esterno</a><a href="/albo/{i % 3}">Albo online</a>', None) for i in range(9)]
    rows += [(f"{HOME}/albo/{i}", True, 200, f"{HOME}/albo/{i}", f'<a href="/m/{i}">Reclutamento esperti madrelingua</a><a href="/g">Graduatoria esperti esterni</a>', None) for i in range(3)]
    hits, _ = crawling.crawl(spark.createDataFrame([(str(i), f"{HOME}/{i}") for i in range(9)], "code string, trasparenza_url string"), spark.createDataFrame(rows, PAGES))
    plan = hits._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [x for x in plan if "Filter" in x and "regexp_replace" in x]  # else every pattern normalises the text anew
    assert sum("Join" in x for x in plan) == 0  # pages are looked up before, not for each use
    assert {(r.code, r.url[len(HOME) :]) for r in hits.collect() if r.kind == "anchor"} == {(str(i), u) for i in range(9) for u in (f"/n/{i}", f"/m/{i % 3}")}


def test_enrichment(spark):
    read = spark.createDataFrame([("a", HOME, "entro il 3/4/2026"), ("b", HOME, '<a href="/m.pdf">x</a><a href="/d.pdf">y</a>')], "fingerprint string, page_url string, html string")
    att = spark.createDataFrame([(HOME + "/m.pdf", "nulla"), (HOME + "/d.pdf", "scadenza 5/6/2026")], "url string, text string")
    assert {r.fingerprint: r.scadenza for r in enrichment.deadlines(read, att).collect()} == {"a": dt.date(2026, 4, 3), "b": dt.date(2026, 6, 5)}
    docs = spark.createDataFrame([("a", HOME, '<a href="/modulo.pdf">Modulo</a><a href="/x?download=1">Avviso</a><a href="/z.html">no</a>')], "fingerprint string, page_url string, html string")
    assert [(r.doc_url[len(HOME) :], r.place) for r in enrichment.documents_of(docs).orderBy("place").collect()] == [("/x?download=1", 1), ("/modulo.pdf", 2)]
    pend = spark.createDataFrame([("a", "t", "c", "entro il 3/4/2026"), ("b", "t", "c", ""), ("c", "t", "c", "x"), ("d", "t", "c", "bad")], "fingerprint string, title string, category string, text string")
    reply = {"entro il 3/4/2026": '{"is_bando": true, "scadenza": "2026-13-45", "titolo": " T "}', "x": None, "bad": "no json"}
    got = {r.fingerprint: r for r in enrichment.reviewed(pend, lambda t, a, c: reply[t]).collect()}
    assert got.keys() == {"a", "b"} and got["b"].ai_bando is None
    assert (got["a"].ai_bando, got["a"].scadenza, got["a"].titolo_pulito) == (True, dt.date(2026, 4, 3), "T")
    pairs = spark.createDataFrame([(1, "esperto inglese", "esperto inglese progetto", 0), (1, "esperto inglese", "esperto inglese progetto", 1), (2, "abc", "xyz", 0)], "k int, w string, t string, pos int")
    assert [(r.k, r.pos) for r in enrichment.best_match(pairs, "k", "w", "t", "pos").collect()] == [(1, 0)]
    out = spark.range(1).select(enrichment.document_text(F.lit("p" * 130), F.array(F.lit("a" * 50), F.lit("b")), 150).alias("t")).head().t
    assert out == ("p" * 130 + "\n\n" + "a" * 50)[:150]


def test_compare_and_listing(spark, tmp_path):
    a = spark.createDataFrame([("https://www.x.it/A/?q=1",), ("http://x.it/b",), ("",), (None,)], "url string")
    b = spark.createDataFrame([("x.it/a",), ("https://x.it/a",), ("https://y.it",)], "url string")
    r = compare.summary(compare.url_set(a), compare.url_set(b)).head()
    assert (r.n_left, r.n_right, r.common, r.only_left, r.only_right, r.uplift_pct) == (2, 2, 1, 1, 1, 50.0)
    assert compare.summary(compare.url_set(a), compare.url_set(b.limit(0))).head().uplift_pct is None
    rows = [{"fingerprint": "a", "first_seen": at(1), "ai_checked": at(2), "ai_bando": None}, {"fingerprint": "b", "first_seen": at(2), "ai_bando": False}, {"fingerprint": "c", "first_seen": at(3), "scadenza": day(9), "title": " A\n b"}, {"fingerprint": "d", "first_seen": at(4), "ai_checked": at(2), "ai_bando": True, "category": "digitale"}]
    f = findings(spark, rows)
    path = snapshots.write_snapshot(f, str(tmp_path), day(9))
    data = json.loads(open(path, encoding="utf-8").read())
    assert [x["fingerprint"] for x in data["findings"]] == ["d", "c"]
    assert (data["meta"]["aperti"], data["meta"]["esclusi_ai"], data["meta"]["doc_vuoti"]) == (1, 1, 1)
    assert snapshots.latest(str(tmp_path), day(20)) == path and snapshots.latest(str(tmp_path), dt.date(2026, 3, 1)) is None
    assert snapshots.read_findings(spark, path).count() == 2
    cards = {r.fingerprint: r for r in listing.cards(listing.snapshot(f, F.lit(day(9))), now()).collect()}
    assert (cards["c"].titolo, cards["c"].scade, cards["d"].ambito, cards["d"].titolo) == ("A b", "09 gen 2026", "Digitale", "(senza titolo)")


def test_attachments(spark):
    docx = io.BytesIO()
    with zipfile.ZipFile(docx, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:t>uno </w:t><w:t>due</w:t></w:p><w:p><w:t>tre</w:t></w:p></w:document>')
    rows = [(1, "", b"  <html><script>x</script><p>a  b</p>"), (2, "", b"PK\x03\x04broken"), (3, None, docx.getvalue()), (4, "", None), (5, "text/html", b"x \xff"), (6, "", b"%PDF-broken")]
    got = {r.n: r.t for r in spark.createDataFrame(rows, "n int, kind string, data binary").select("n", pages.attachment_text(F.col("kind"), F.col("data")).alias("t")).collect()}
    assert got == {1: "a b", 2: "", 3: "uno due\ntre", 4: "", 5: "x \ufffd", 6: ""}


def test_failures():
    url = urllib.error.URLError
    assert pages.failure(urllib.error.HTTPError("u", 503, "", {}, None))[0::2] == ("throttled", 503)
    assert pages.failure(urllib.error.HTTPError("u", 404, "", {}, None)) == ("final", "HTTPError 404", 404)
    assert pages.failure(url(ssl.SSLError("bad certificate")))[0] == "certificate"
    assert pages.failure(url(TimeoutError("timed out"))) == ("slow", "URLError timed out", None) and pages.failure(TimeoutError()) == ("slow", "TimeoutError read timed out", None)
    assert pages.failure(url("Name or service not known"))[0] == "final"


def test_bodies():
    assert pages.unpacked(pages.packed("abc"), "gzip") == b"abc"
    assert pages.unpacked(pages.packed("abcdef" * 500)[:40], "gzip").startswith(b"abc")
    assert pages.unpacked(b"raw", "gzip") == b"raw"
    assert pages.decoded("è".encode("latin-1"), "text/html; charset=latin-1") == "è"
