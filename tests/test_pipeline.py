"""Discovery and crawl end to end over a stored page table, and the command line."""

import datetime as dt
import json

from boardloom import __main__ as cli
from boardloom import pipeline
from boardloom.operators import enrichment

HOME = "https://www.s.it"
ALBO = HOME + "/albo-online/"
CALL = "Avviso pubblico per la selezione di un esperto esterno madrelingua"
PAGES = [
    (HOME, '<a href="/albo-online/">Albo online</a> wp-content'),
    (ALBO, f'<a href="/n/1">{CALL}</a>' + " " * 250),
    (HOME + "/n/1", "<p>" + "Si rende noto. " * 9 + "Le domande entro il 3/4/2026</p><a href='/uploads/avviso'>Avviso</a>"),
]


def test_runs(spark, tmp_path):
    csv = tmp_path / "r.csv"
    csv.write_text(f"CODICESCUOLA,REGIONE,SITOWEBSCUOLA,DENOMINAZIONESCUOLA\nB,LAZIO,{HOME},Due\nA,LAZIO,{HOME}/,Uno\nC,LAZIO,,Tre\nD,LAZIO,https://down.it,Quattro\nE,VENETO,x.it,Cinque\n")
    config = pipeline.Config(["lazio"], str(csv), str(tmp_path / "state"), str(tmp_path / "snap"), str(tmp_path / "rep.json"), str(tmp_path / "map.csv"))
    rows = [(u, True, 200, u, h, None) for u, h in PAGES] + [("https://down.it", False, None, None, None, "URLError gone")]
    table = spark.createDataFrame(rows, "url string, ok boolean, status int, final_url string, html string, error string")
    asked = []

    def source(urls):
        asked.append(urls)
        return table.join(urls, "url", "left_semi")

    report = pipeline.run_discovery(spark, config, source)
    assert (report["meta"]["scuole_totali"], report["meta"]["raggiungibili"], report["meta"]["trasparenza_trovata"]) == (4, 2, 2)
    assert report["esiti_discovery"] == {"ok": 2, "no_site_in_csv": 1, "URLError gone": 1}
    attachments = spark.createDataFrame([(HOME + "/uploads/avviso", "testo")], "url string, text string")
    path = pipeline.run_crawl(spark, config, table, dt.date(2026, 4, 1), attachments=attachments, reviewer=lambda t, a, c: json.dumps({"is_bando": True, "titolo": a[:6]}))
    data = json.loads(open(path).read())
    hit = next(f for f in data["findings"] if f["url"] == HOME + "/n/1")
    assert (hit["school_code"], hit["origin"], hit["scadenza"], hit["stato"], hit["titolo"]) == ("A", "archivio", "2026-04-03", "aperto", "Avviso")
    again = json.loads(open(pipeline.run_crawl(spark, config, table, dt.date(2026, 4, 5))).read())
    assert again["meta"]["nuovi_oggi"] == 0 and again["meta"]["scaduti"] == 1
    tables = pipeline.Tables(spark, config.state)
    assert [r.phase for r in tables.runs.read().orderBy("id").collect()] == ["discovery", "crawl", "crawl"]
    assert [r.code for r in tables.schools.read().where("first_crawled IS NOT NULL").collect()] == ["A"]
    cleared = json.loads(open(pipeline.run_crawl(spark, config, table, dt.date(2026, 4, 6), reset=True)).read())
    assert cleared["meta"]["nuovi_oggi"] == 2  # the link and the body of the list, which a review had hidden


def test_compare_command(spark, tmp_path, capsys):
    (tmp_path / "a.json").write_text(json.dumps({"findings": [{"url": "https://x.it/a"}, {"url": "https://x.it/b"}]}))
    (tmp_path / "b.json").write_text(json.dumps({"findings": [], "bandi": [{"url": "http://www.x.it/a/"}]}))
    cli.main(["compare", "--left", str(tmp_path / "a.json"), "--right", str(tmp_path / "b.json")], spark)
    out = capsys.readouterr().out
    assert "'common': 1" in out and "x.it/b" in out


def test_config(tmp_path):
    (tmp_path / "c.json").write_text('{"regions": ["x"], "threshold": 0.5, "other": 1}')
    told = pipeline.Config.read(str(tmp_path / "c.json"))
    assert (told.regions, told.threshold, told.subpages) == (["x"], 0.5, 3)
    (tmp_path / "d.json").write_text('{"_nota": 1, "regioni": ["y"], "anagrafe": {"csv_cache": "r.csv"}, "crawl": {"timeout": 7, "max_subpages": 2}, "ai": {"max_per_run": 400}}')
    told = pipeline.Config.read(str(tmp_path / "d.json"))
    assert (told.regions, told.registry, told.timeout, told.subpages, told.pending_reviews) == (["y"], "r.csv", 7, 2, 400)


def test_act_blocks(spark):
    one = '<div class="at-item">Esperto inglese corso</div><div class="at-item">Medico competente nomina</div></main>'
    two = '<a data-bs-target="#modalDetail-1">Esperto inglese corso</a><a data-bs-target="#modalDetail-2">Medico competente</a><div id="modalDetail-1">A</div><div id="modalDetail-2">B</div></body>'
    rows = [("a", "medico competente nomina", one), ("b", "medico competente", two), ("c", "altro", "x"), ("d", "zzz", one)]
    got = {r.fingerprint: r.block for r in enrichment.act_blocks(spark.createDataFrame(rows, "fingerprint string, title string, html string")).collect()}
    assert "Medico" in got["a"] and "inglese" not in got["a"]
    assert got["b"].startswith('id="modalDetail-2"') and got["b"].endswith("B</div>") and got["c"] == got["d"] == ""
