"""Registry of the core queries and their SQL.

Each query runs an operator over its whole tables. Where the tables lack an input (pages, registry deliveries),
it is derived from them by plain column expressions, alike in Spark and in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardloom import oracles
from boardloom.functions import dates, scoring, text, urls
from boardloom.functions.rules import EXPERTS
from boardloom.operators import compare, crawling, enrichment, listing, registry, reports, snapshot_diff, state
from boardloom.plans.work import spread, table

Query = Callable[[SparkSession, str], DataFrame]
AS_OF, NOW, CUT = oracles.AS_OF, oracles.NOW, oracles.CUT


def _as_of():
    return F.to_date(F.lit(AS_OF))



def _now() -> Column:
    return F.timestamp_micros(F.lit(NOW))


def _findings(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "findings")


def _micros(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as texts of microseconds, so that results compare exactly, NULL and time zone included."""
    return df.withColumns({n: F.unix_micros(n).cast("string") for n in names})


def url_clean(s: SparkSession, d: str) -> DataFrame:
    site = F.col("site_url")
    shapes = [site, F.upper(site), F.replace(site, F.lit("://"), F.lit("//")), F.replace(site, F.lit("://"), F.lit(":/")), F.concat(F.lit("https://"), F.replace(site, F.lit("://"), F.lit("//")))]
    shapes += [F.concat(F.lit(" "), F.replace(site, F.lit("https://www."), F.lit("www. ")), F.lit(".,")), F.concat(site, F.lit("/A B")), F.lit("Non Disponibile"), F.lit("-"), F.lit("//")]
    return table(s, d, "schools").select("code", F.posexplode(F.array(*shapes)).alias("n", "typed")).select("code", "n", urls.clean_url(F.col("typed")).alias("clean"))


def url_forms(s: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return spread(_findings(s, d).select("row_id", "url", "doc_url")).select(
        "row_id",
        urls.normalize_url(u).alias("normal"),
        urls.compare_key(u).alias("compared"),
        urls.site_key(u).alias("site"),
        urls.page_key(u).alias("page"),
        urls.root_of(urls.stripped(u)).alias("root"),
        urls.is_pdf(u).alias("pdf"),
        urls.safe_url(F.col("doc_url")).alias("safe"),
    )


def url_fingerprints(s: SparkSession, d: str) -> DataFrame:
    return spread(_findings(s, d).select("row_id", "url", "title")).select("row_id", urls.fingerprint(F.col("url"), F.col("title")).alias("fingerprint"))


def url_fallbacks(s: SparkSession, d: str) -> DataFrame:
    moved = F.replace(F.col("site_url"), F.lit(".edu.example"), F.lit(".gov.it"))
    rows = table(s, d, "schools").where("site_url IS NOT NULL").select("code", F.explode(F.array("site_url", moved)).alias("asked"))
    return rows.select("code", "asked", F.posexplode(urls.fallback_urls(F.col("asked"))).alias("place", "url"))


def url_joined(s: SparkSession, d: str) -> DataFrame:
    hrefs = F.array(F.lit("/albo/x?a=1#b"), F.lit("../y"), F.lit("z.html"), F.lit("?q=2"), F.lit("#top"), F.lit("//other.example/p"), F.lit("https://else.example/"), F.lit("./w/../v"))
    rows = table(s, d, "schools").where("trasparenza_url != ''").select("code", "trasparenza_url", F.posexplode(hrefs).alias("n", "href"))
    return rows.select("code", "n", urls.absolute(F.col("trasparenza_url"), F.col("href")).alias("url"))


def text_forms(s: SparkSession, d: str) -> DataFrame:
    rows = spread(_findings(s, d).select("row_id", "title", "province"))
    return rows.select("row_id", text.normalized(F.col("title")).alias("normal"), text.word_key(F.col("title")).alias("words"), text.title_case(F.col("province")).alias("place"), text.escaped(F.col("title")).alias("safe"))


def text_documents(s: SparkSession, d: str) -> DataFrame:
    body = text.visible_text(F.col("text"))
    return spread(table(s, d, "documents").select("doc_id", "text")).select("doc_id", text.is_noise_page(body).alias("noise"), text.snippet(body).alias("snippet"))


def _pages(s: SparkSession, d: str) -> DataFrame:
    """A small page per finding, with a script, a link to the notice and one to a list."""
    html = F.concat(
        F.lit("<html><head><script>var a = '<a href=\"/no\">no</a>';</script></head><body>\n<A class=\"x\" HREF=\""), urls.stripped(F.col("url")), F.lit('">'), F.col("title"),
        F.lit("</a> <a href='/albo/"), F.col("row_id").cast("string"), F.lit("#top'>Albo  <b>online</b></a></body></html>"),
    )
    return spread(_findings(s, d).select("row_id", "school_code", "url", "title", "source_page")).withColumn("html", html)


def page_links(s: SparkSession, d: str) -> DataFrame:
    found = _pages(s, d).select("row_id", F.explode(text.links(F.regexp_replace("html", r"(?is)<script\b.*?</script>", ""), F.lit("https://www.base.example/albo/"))).alias("l"))
    return found.select("row_id", "l.pos", "l.href", "l.text")


def page_texts(s: SparkSession, d: str) -> DataFrame:
    return _pages(s, d).select("row_id", text.visible_text(F.col("html")).alias("text"), text.platform(F.concat("url", F.coalesce("source_page", F.lit("")))).alias("platform"))


def link_ranks(s: SparkSession, d: str) -> DataFrame:
    rows = spread(_findings(s, d).select("row_id", "school_code", "url", "title"))
    told = rows.select("school_code", "row_id", text.is_listing(F.col("title"), F.col("url")).alias("listed"), text.listing_rank(urls.part(F.col("url"), "path"), F.col("title")).alias("rank"), enrichment.document_rank(F.col("title")).alias("doc_rank"))
    return registry.ranked(told.where("listed"), ["school_code"], [F.desc("rank"), F.col("row_id")], 3).select("school_code", "row_id", "rank", "doc_rank", "place")


def classify_titles(s: SparkSession, d: str) -> DataFrame:
    rows = spread(_findings(s, d).select("row_id", "title"))
    told = scoring.classify(rows, F.col("title"), F.col("title"), EXPERTS)
    return told.select("row_id", "c.score", "c.category", "c.is_match", "c.title_hit", F.array_join("c.signals", " ;; ").alias("signals"))


def classify_bodies(s: SparkSession, d: str) -> DataFrame:
    rows = spread(table(s, d, "documents").select("doc_id", "text"))
    told = scoring.classify(rows, F.col("text"), F.lit(""), EXPERTS, crawling.BODY_THRESHOLD, veto=False, require_strong=True)
    return told.select("doc_id", "c.score", "c.category", "c.is_match")


def category_counts(s: SparkSession, d: str) -> DataFrame:
    return classify_titles(s, d).groupBy("category").agg(F.count("*").alias("n"), F.count_if("is_match").alias("matches"))


def deadlines(s: SparkSession, d: str) -> DataFrame:
    rows = spread(table(s, d, "documents").select("doc_id", "text"))
    return rows.select("doc_id", dates.deadline(F.col("text")).alias("scadenza"))


def deadline_status(s: SparkSession, d: str) -> DataFrame:
    return _findings(s, d).groupBy(dates.status(F.col("scadenza"), _as_of()).alias("stato")).agg(F.count("*").alias("n"))


def notice_pages(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "schools").where("trasparenza_url != ''").select("code", "name", "region", "province", "trasparenza_url")


def sites_to_visit(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "schools").where("site_url != ''").select("code", "site_url")


def schools_sorted(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "schools").select("region", "province", "code", "name").orderBy("region", "province", "code")


def findings_newest(s: SparkSession, d: str) -> DataFrame:
    rows = _findings(s, d).select("row_id", "fingerprint", "first_seen").orderBy(F.desc("first_seen"), "fingerprint", "row_id")
    return _micros(rows, "first_seen")


def pending_deadlines(s: SparkSession, d: str) -> DataFrame:
    return _micros(state.pending(state.one_per_key(_findings(s, d).select("fingerprint", "first_seen", "scadenza_checked", "row_id"), "fingerprint", F.col("row_id")), "scadenza_checked", 500).select("fingerprint", "first_seen"), "first_seen")


def _pending(s: SparkSession, d: str, marker: str, most: int = 0) -> DataFrame:
    rows = state.one_per_key(_findings(s, d).select("fingerprint", "first_seen", marker, "row_id"), "fingerprint", F.col("row_id"))
    return _micros(state.pending(rows, marker, most).select("fingerprint", "first_seen"), "first_seen")


def pending_deadlines_all(s: SparkSession, d: str) -> DataFrame:
    return _pending(s, d, "scadenza_checked")  # max_per_run 0


def pending_reviews_run(s: SparkSession, d: str) -> DataFrame:
    return _pending(s, d, "ai_checked", 400)  # max_per_run 400


def pending_reviews(s: SparkSession, d: str) -> DataFrame:
    return _micros(state.pending(state.one_per_key(_findings(s, d).select("fingerprint", "first_seen", "ai_checked", "row_id"), "fingerprint", F.col("row_id")), "ai_checked").select("fingerprint", "first_seen"), "first_seen")


def registry_prefer_site(s: SparkSession, d: str) -> DataFrame:
    rows = _findings(s, d).select("school_code", F.col("row_id").alias("chosen"), "doc_url", F.col("row_id").alias("pos"))
    return registry.prefer_with_site(rows, "school_code", "doc_url", "pos")


def registry_regions(s: SparkSession, d: str) -> DataFrame:
    raw = table(s, d, "schools").select(F.col("code").alias("CODICESCUOLA"), F.col("name").alias("DENOMINAZIONESCUOLA"), F.lower("region").alias("REGIONE"), F.col("province").alias("PROVINCIA"), F.col("city").alias("DESCRIZIONECOMUNE"), F.col("site_url").alias("SITOWEBSCUOLA"), F.col("code").alias("pos"))
    return registry.registry(raw, "pos", ["Lombardia ", "veneto"]).drop("pos")


def sites_first(s: SparkSession, d: str) -> DataFrame:
    return registry.first_per_key(table(s, d, "schools").select("code", "site_url"), urls.site_key(F.col("site_url")), F.col("code"), "site")


def pages_lowest_code(s: SparkSession, d: str) -> DataFrame:
    return registry.first_per_key(table(s, d, "schools").select("code", "region", "trasparenza_url"), F.col("trasparenza_url"), F.col("code"), "page").select("page", "code", "region")


def siblings(s: SparkSession, d: str) -> DataFrame:
    schools = table(s, d, "schools").select("code", "site_url", "platform", "reachable")
    results = registry.first_per_key(schools, urls.site_key(F.col("site_url")), F.col("code"), "site").select("site", F.col("code").alias("first_code"), F.col("platform").alias("found_platform"))
    return registry.propagate(schools.select("code", "site_url"), urls.site_key(F.col("site_url")), results, "site").select("code", "site", "first_code", "found_platform")


def top_scores(s: SparkSession, d: str) -> DataFrame:
    rows = _findings(s, d).select("school_code", "row_id", "score")
    return registry.ranked(rows, ["school_code"], [F.desc("score"), F.col("row_id")], 3)


def best_hits(s: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.pmod("row_id", F.lit(3)) == 0, "page").otherwise("anchor")
    rows = _findings(s, d).select(F.col("school_code").alias("code"), urls.compare_key(F.col("url")).alias("url"), F.col("row_id").alias("seq"), kind.alias("kind"), F.col("row_id").cast("string").alias("title"), "category", F.round("score", 1).alias("score"))
    return crawling.best_hits(rows).select("code", "url", "title", "score", "kind")


def _split_findings(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    columns = ["fingerprint", "school_code", "title", "category", "score", "first_seen", "last_seen", "origin", "row_id"]
    rows = _findings(s, d).select(*columns)
    old = state.one_per_key(rows.where(F.col("first_seen") < F.timestamp_micros(F.lit(CUT))), "fingerprint", F.col("row_id"))
    return old, rows.where(F.col("first_seen") >= F.timestamp_micros(F.lit(CUT)))


def upsert_findings(s: SparkSession, d: str) -> DataFrame:
    old, new = _split_findings(s, d)
    out = state.insert_or_touch(old, new.drop("first_seen", "last_seen"), _now(), F.col("row_id"))
    return _micros(out.select("fingerprint", "row_id", "score", "first_seen", "last_seen", "origin", "is_new"), "first_seen", "last_seen")


def insert_only(s: SparkSession, d: str) -> DataFrame:
    old, new = _split_findings(s, d)
    return new.join(old, "fingerprint", "left_anti").select("fingerprint").distinct()


def touch_only(s: SparkSession, d: str) -> DataFrame:
    old, new = _split_findings(s, d)
    return old.join(new, "fingerprint", "left_semi").select("fingerprint")


def upsert_schools(s: SparkSession, d: str) -> DataFrame:
    schools = table(s, d, "schools")
    delivered = schools.where("region = 'LOMBARDIA'").select("code", F.upper("name").alias("name"), "region", "province", "city", F.lit("https://new.example").alias("site_url"))
    added = schools.where("region = 'VENETO'").select(F.concat(F.lit("N"), "code").alias("code"), *state.METADATA)
    out = state.upsert_schools(schools, delivered.unionByName(added), F.col("name"))
    return out.select("code", "name", "region", "site_url", "platform", "reachable")


def record_discovery(s: SparkSession, d: str) -> DataFrame:
    snap = table(s, d, "school_snapshots")
    key = F.upper(F.trim("code")).alias("code")
    last = snap.select(F.max("snapshot_date").alias("snapshot_date"))
    rows = snap.join(F.broadcast(last), "snapshot_date").select(key, F.max("trasparenza_url").over(_by_code()).alias("trasparenza_url"), F.max("platform").over(_by_code()).alias("platform"), F.max("reachable").over(_by_code()).alias("reachable")).distinct()
    found = rows.withColumn("resolved_url", F.lit(None).cast("string")).withColumn("discovery_note", F.lit("ok"))
    out = state.record_discovery(table(s, d, "schools"), found, _now())
    return _micros(out.select("code", "platform", "trasparenza_url", "reachable", "resolved_url", "discovery_note", "last_discovery"), "last_discovery")


def _by_code():
    from pyspark.sql import Window

    return Window.partitionBy(F.upper(F.trim("code")))


def mark_crawled(s: SparkSession, d: str) -> DataFrame:
    out = state.mark_crawled(table(s, d, "schools"), _findings(s, d).select(F.col("school_code").alias("code")), _now())
    return _micros(out.select("code", "first_crawled"), "first_crawled")


def _verdicts(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "finding_snapshots").groupBy(F.lower(F.trim("fingerprint")).alias("fingerprint"))
    return rows.agg(F.min("ai_bando").alias("ai_bando"), F.max(F.when(F.col("stato") != "scaduto", F.col("scadenza"))).alias("scadenza"), F.min("category").alias("profilo"))


def set_reviews(s: SparkSession, d: str) -> DataFrame:
    told = _verdicts(s, d).withColumn("titolo_pulito", F.lit("")).withColumn("doc_url", F.lit("https://doc.example"))
    out = state.set_reviews(_findings(s, d), told, _now())
    return _micros(out.select("row_id", "ai_bando", "scadenza", "ai_checked", "titolo_pulito", "profilo", "doc_url"), "ai_checked")


def set_deadlines(s: SparkSession, d: str) -> DataFrame:
    out = state.set_deadlines(_findings(s, d), _verdicts(s, d), _now())
    return _micros(out.select("row_id", "scadenza", "scadenza_checked"), "scadenza_checked")


def reset_reviews(s: SparkSession, d: str) -> DataFrame:
    rows, visible = state.reset_reviews(_findings(s, d))
    before = _findings(s, d).agg(F.count_if(visible).alias("reset"))
    return rows.agg(F.count("ai_checked").alias("checked"), F.count("ai_bando").alias("verdicts")).crossJoin(before)


def school_origin(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "schools").select("code", state.origin(F.col("first_crawled")).alias("origin"))


def next_run(s: SparkSession, d: str) -> DataFrame:
    return _micros(state.log_run(table(s, d, "runs"), _now(), "crawl", 10, 3), "started_at")


def snapshot_meta(s: SparkSession, d: str) -> DataFrame:
    return listing.snapshot_meta(_findings(s, d), _as_of())


def snapshot_rows(s: SparkSession, d: str) -> DataFrame:
    return listing.snapshot(_findings(s, d).select("row_id", "scadenza", "ai_checked", "ai_bando", "titolo_pulito"), _as_of()).select("row_id", "stato", "titolo")


def _listing(s: SparkSession, d: str) -> DataFrame:
    return listing.snapshot(_findings(s, d), _as_of())


def listing_status(s: SparkSession, d: str) -> DataFrame:
    return listing.status_cards(_listing(s, d))


def listing_facets(s: SparkSession, d: str) -> DataFrame:
    return listing.facets(_listing(s, d))


def listing_filtered(s: SparkSession, d: str) -> DataFrame:
    rows = listing.filtered(_listing(s, d), stato="ignota", category="madrelingua", words=" Liceo ")
    return listing.ordered(rows, "conf").select("row_id", "score")


def listing_count(s: SparkSession, d: str) -> DataFrame:
    return listing.result_count(listing.filtered(_listing(s, d), stato="ignota", category="madrelingua", words=" Liceo "), "ignota")


def listing_by_deadline(s: SparkSession, d: str) -> DataFrame:
    return listing.ordered(listing.filtered(_listing(s, d), region="VENETO"), "scad").select("row_id", "scadenza")


def listing_cards(s: SparkSession, d: str) -> DataFrame:
    rows = _listing(s, d)
    return listing.cards(rows.withColumn("fingerprint", F.col("row_id").cast("string")), _now()).withColumnRenamed("fingerprint", "row_key")


def _two_sources(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = _findings(s, d).select("url", "origin")
    return compare.url_set(rows.where("origin = 'nuovo'")), compare.url_set(rows.where("origin = 'archivio'"))


def compare_sides(s: SparkSession, d: str) -> DataFrame:
    return compare.sides(*_two_sources(s, d))


def compare_summary(s: SparkSession, d: str) -> DataFrame:
    return compare.summary(*_two_sources(s, d))


def compare_examples(s: SparkSession, d: str) -> DataFrame:
    return compare.examples(*_two_sources(s, d))


def discover_sites(s: SparkSession, d: str) -> DataFrame:
    schools = table(s, d, "schools")
    link = F.concat(F.lit("<html>"), F.coalesce("platform", F.lit("")), F.lit(' <a href="'), F.coalesce("trasparenza_url", F.lit("/")), F.lit('">Albo online</a></html>'))
    home = schools.where("site_url IS NOT NULL").groupBy(F.col("site_url").alias("url")).agg(F.max("reachable").alias("ok"), F.min(link).alias("html"))
    pages = home.select("url", "ok", F.lit(200).alias("status"), F.col("url").alias("final_url"), "html", F.when(~F.col("ok"), "URLError host unknown").alias("error"))
    return crawling.discover(schools.select(F.coalesce("site_url", F.lit("")).alias("site_url")), pages)


def crawl_notices(s: SparkSession, d: str) -> DataFrame:
    """A notice page per finding and the list that it links to, with a notice of its own."""
    site = F.lit("https://pages.example/")
    key = F.col("row_id").cast("string")
    rows = _pages(s, d).withColumn("page", F.concat(site, key))
    listed = rows.select(F.concat(site, F.lit("albo/"), key).alias("page"), F.concat(F.lit("<html><body><a href='/n/"), key, F.lit("'>"), F.col("title"), F.lit("</a></body></html>")).alias("html"))
    every = rows.select("page", "html").unionByName(listed)
    pages = every.select(F.col("page").alias("url"), F.lit(True).alias("ok"), F.lit(200).alias("status"), F.col("page").alias("final_url"), "html", F.lit(None).cast("string").alias("error"))
    hits, _ = crawling.crawl(rows.select(key.alias("code"), F.col("page").alias("trasparenza_url")), pages)
    return hits


def review_replies(s: SparkSession, d: str) -> DataFrame:
    reply = F.to_json(F.struct(F.col("ai_bando").alias("is_bando"), F.date_format("scadenza", "yyyy-MM-dd").alias("scadenza"), F.col("titolo_pulito").alias("titolo"), "profilo"))
    told = spread(_findings(s, d).select("row_id", "ai_bando", "scadenza", "titolo_pulito", "profilo")).select("row_id", enrichment.parsed_review(reply, F.lit("")).alias("v"))
    return told.select("row_id", "v.ai_bando", "v.scadenza", "v.titolo_pulito", "v.profilo")


def title_matches(s: SparkSession, d: str) -> DataFrame:
    rows = spread(_findings(s, d).where("titolo_pulito IS NOT NULL").select("row_id", "titolo_pulito", "title", "school_name", "profilo"))
    pairs = rows.select("row_id", "titolo_pulito", F.posexplode(F.array("title", "school_name", F.coalesce("profilo", F.lit("")))).alias("pos", "text"))
    return enrichment.best_match(pairs, "row_id", "titolo_pulito", "text", "pos").select("row_id", "pos", F.round("likeness", 6).alias("likeness"))


def _schools(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda s, d: f(table(s, d, "schools"))


def queries() -> dict[str, Query]:
    """Name and query of each core operator."""
    own = (
        url_clean, url_forms, url_fingerprints, url_fallbacks, url_joined, text_forms, text_documents, page_links, page_texts, link_ranks,
        classify_titles, classify_bodies, category_counts, deadlines, deadline_status, notice_pages, sites_to_visit, schools_sorted,
        findings_newest, pending_deadlines, pending_deadlines_all, pending_reviews, pending_reviews_run, registry_prefer_site, registry_regions, sites_first, pages_lowest_code, siblings,
        top_scores, best_hits, upsert_findings, insert_only, touch_only, upsert_schools, record_discovery, mark_crawled, set_reviews,
        set_deadlines, reset_reviews, school_origin, next_run, snapshot_meta, snapshot_rows, listing_status, listing_facets,
        listing_filtered, listing_count, listing_by_deadline, listing_cards, compare_sides, compare_summary, compare_examples, discover_sites,
        crawl_notices, review_replies, title_matches,
    )
    return {
        "p5_found": lambda s, d: snapshot_diff.all_changes(table(s, d, "finding_snapshots"), table(s, d, "school_snapshots")),
        **{f.__name__: f for f in own},
        "report_totals": _schools(reports.totals),
        "report_regions": _schools(reports.by_region),
        "report_platforms": _schools(reports.platforms),
        "report_notes": _schools(reports.notes),
        "report_groupings": _schools(reports.all_groupings),
        "report_common_notes": _schools(lambda t: reports.most_common(t, "discovery_note", "?")),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the core queries that SQL can express."""
    return oracles.oracle_sql()
