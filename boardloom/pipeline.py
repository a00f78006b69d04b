"""The two periodic runs, discovery and crawl, over versioned state and any page source."""

from __future__ import annotations

import datetime as dt
import json
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardloom.functions.dates import deadline
from boardloom.functions.text import visible_text
from boardloom.functions.urls import fingerprint, is_pdf, site_key
from boardloom.operators import crawling, enrichment, registry, reports, state
from boardloom.plans.work import durable
from boardloom.sources import snapshots


# Names of the settings in files, and of those that nothing here needs.
KEYS = {
    "regioni": "regions", "anagrafe.csv_url": "registry_url", "anagrafe.csv_cache": "registry", "db": "state", "snapshot_dir": "snapshots",
    "discovery_report": "report", "schools_map_csv": "map_csv", "crawl.timeout": "timeout", "crawl.workers": "parts",
    "crawl.classifier_threshold": "threshold", "crawl.max_subpages": "subpages", "scadenza.max_per_run": "pending", "ai.max_per_run": "pending_reviews",
}
UNUSED = ("crawl.discovery_pause", "scadenza.workers", "scadenza.timeout", "ai.enabled", "ai.model", "ai.workers", "ai.timeout", "ai.max_doc_chars")


@dataclass
class Config:
    """Settings of the runs. A file gives them by these names or in the sections of KEYS; other keys, but for notes, are warned of."""

    regions: list[str] = field(default_factory=list)
    registry: str = "registry.csv"
    state: str = "state"
    snapshots: str = "snapshots"
    report: str = "report.json"
    map_csv: str = "map.csv"
    threshold: float = 0.45
    subpages: int = 3
    pending: int = 0
    pending_reviews: int = 0
    registry_url: str = ""
    timeout: float = 10
    pause: float = 2.0
    parts: int = 48

    @classmethod
    def read(cls, path: str) -> Config:
        told, found = json.loads(Path(path).read_text(encoding="utf-8")), {}
        flat = [(f"{k}.{x}", y) for k, v in told.items() if isinstance(v, dict) for x, y in v.items()] + [(k, v) for k, v in told.items() if not isinstance(v, dict)]
        for key, value in flat:
            name = KEYS.get(key, key)
            if name in cls.__dataclass_fields__:
                found[name] = value
            elif not key.startswith("_") and key not in UNUSED:
                warnings.warn(f"{path}: unknown setting {key}", stacklevel=2)
        return cls(**found)


class Tables:
    """The three state tables of a folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.schools = state.Versions(spark, f"{folder}/schools", state.SCHOOLS)
        self.findings = state.Versions(spark, f"{folder}/findings", state.FINDINGS)
        self.runs = state.Versions(spark, f"{folder}/runs", state.RUNS)

    def log(self, phase: str, processed: int, hits: int) -> None:
        now = self.runs.read()
        self.runs.write(now.unionByName(state.log_run(now, F.current_timestamp(), phase, processed, hits)))


def run_discovery(spark: SparkSession, config: Config, pages: crawling.PageSource, limit: int = 0) -> dict:
    """Registry into state, one search per site, its outcome given to all schools of the site, report files."""
    tables = Tables(spark, config.state)
    rows = durable(registry.read_registry(spark, registry.cached_file(config.registry, config.registry_url), config.regions))
    rows = rows.orderBy("pos").limit(limit) if limit else rows
    delivered = rows.withColumnRenamed("website", "site_url")
    schools = durable(state.upsert_schools(tables.schools.read(), delivered, F.col("name")))
    firsts = registry.first_per_key(delivered.select("code", "site_url", "pos"), F.when(F.col("site_url") != "", site_key(F.col("site_url"))), F.col("pos"), "site")
    found = crawling.discover_again(firsts.select("site_url"), pages, pause=config.pause)
    per_site = firsts.select("site", "site_url").join(found, "site_url").drop("site_url", "method")
    results = registry.propagate(delivered.where("site_url != ''").select("code", "site_url"), site_key(F.col("site_url")), per_site, "site").drop("site", "site_url")
    none = delivered.where("site_url = ''").select("code", F.lit(False).alias("reachable"), F.lit("").alias("resolved_url"), F.lit("unknown").alias("platform"), F.lit("").alias("trasparenza_url"), F.lit("no_site_in_csv").alias("discovery_note"))
    tables.schools.write(state.record_discovery(schools, results.unionByName(none), F.current_timestamp()))
    current = tables.schools.read()
    report = reports.write_report(current, config.report, config.map_csv, dt.datetime.now(dt.UTC).isoformat())
    tables.log("discovery", rows.count(), report["meta"]["trasparenza_trovata"])
    return report


def run_crawl(
    spark: SparkSession,
    config: Config,
    pages: crawling.PageSource,
    day: dt.date,
    limit: int = 0,
    attachments: crawling.PageSource | None = None,
    reviewer: Callable[[str, str, str], str | None] | None = None,
    reset: bool = False,
    reset_reviews: bool = False,
) -> str:
    """Crawl each notice page once, upsert the hits, enrich what is pending, write the day's snapshot."""
    tables = Tables(spark, config.state)
    if reset:
        tables.findings.reset()
        tables.schools.write(tables.schools.read().withColumn("first_crawled", F.lit(None).cast("timestamp")))
    if reset_reviews:
        tables.findings.write(state.reset_reviews(tables.findings.read())[0])
    schools = tables.schools.read()
    targets = registry.first_per_key(schools.select("code", "trasparenza_url"), F.col("trasparenza_url"), F.col("code"), "page").orderBy("code")
    targets = (targets.limit(limit) if limit else targets).select("code", "trasparenza_url")
    hits, outcomes = crawling.crawl(targets, pages, threshold=config.threshold, most=config.subpages)
    hits, outcomes = durable(hits), durable(outcomes)
    known = schools.select("code", F.col("name").alias("school_name"), "province", "region", F.col("trasparenza_url").alias("source_page"), state.origin(F.col("first_crawled")).alias("origin"))
    batch = hits.join(known, "code").withColumn("fingerprint", fingerprint(F.col("url"), F.col("title"))).withColumnRenamed("code", "school_code").drop("kind")
    merged = durable(state.insert_or_touch(tables.findings.read(), batch, F.current_timestamp(), F.struct("school_code", "url")))
    told = merged.agg(F.count_if("is_new").alias("new"), F.count_if(F.col("is_new") & (F.col("origin") == "archivio")).alias("old")).head()
    tables.findings.write(merged.drop("is_new"))
    tables.schools.write(state.mark_crawled(schools, outcomes.where("ok"), F.current_timestamp()))
    total = hits.count()
    tables.log("crawl", outcomes.count(), total)
    checked = enrich(spark, config, tables, pages, attachments, reviewer)
    counters = {**checked, "scuole_crawlate": outcomes.count(), "hit_totali": total, "nuovi_oggi": told["new"], "nuove_pubblicazioni": told["new"] - told["old"]}
    return snapshots.write_snapshot(tables.findings.read(), config.snapshots, day, counters)


def enrich(spark: SparkSession, config: Config, tables: Tables, pages: crawling.PageSource, attachments: crawling.PageSource | None, reviewer: Callable | None) -> dict:
    """Deadlines and, with a reviewer, verdicts of the findings that were not checked yet; how many were checked and found.

    `attachments` is a table (url, text) or a function that gives one for a table of urls.
    """
    empty = spark.createDataFrame([], "url string, text string")
    texts_of = lambda urls: empty if attachments is None else crawling.lookup(attachments, urls)
    findings = tables.findings.read()
    todo = state.pending(findings, "scadenza_checked", config.pending).select("fingerprint", "url")
    asked = crawling.fetched(todo.where(~is_pdf(F.col("url"))).select("url").distinct(), "url", pages)
    read = durable(todo.join(asked, "url").where("ok").select("fingerprint", F.col("final_url").alias("page_url"), "html"))
    pdfs = todo.where(is_pdf(F.col("url"))).select("url").unionByName(enrichment.open_documents(read).select("url"))
    known = durable(texts_of(pdfs))
    direct = todo.where(is_pdf(F.col("url"))).join(known, "url").select("fingerprint", deadline(F.col("text")).alias("scadenza"))
    told = enrichment.deadlines(read, known).unionByName(direct)
    checked = durable(todo.select("fingerprint").join(told, "fingerprint", "left"))
    tables.findings.write(state.set_deadlines(findings, checked, F.current_timestamp()))
    counts = checked.agg(F.count("*").alias("scadenze_cercate"), F.count("scadenza").alias("scadenze_trovate")).head().asDict()
    if reviewer is None:
        return counts
    findings = tables.findings.read()
    todo = state.pending(findings, "ai_checked", config.pending_reviews).select("fingerprint", "url", "title", "category")
    asked = crawling.fetched(todo.where(~enrichment.is_document(F.col("url"))).select("url").distinct(), "url", pages).where("ok")
    page = todo.join(asked, "url", "left")
    block = enrichment.act_blocks(page.select("fingerprint", "title", F.coalesce("html", F.lit("")).alias("html")))
    scoped = page.join(block, "fingerprint").withColumn("scope", F.when(F.col("block") != "", F.col("block")).otherwise(F.coalesce("html", F.lit(""))))
    documents = enrichment.documents_of(scoped.select("fingerprint", F.coalesce("final_url", F.lit("")).alias("page_url"), F.col("scope").alias("html")))
    # a finding may be a document itself
    itself = todo.where(enrichment.is_document(F.col("url"))).select("fingerprint", F.col("url").alias("doc_url"), F.lit(1).alias("place"))
    documents = durable(documents.select("fingerprint", "doc_url", "place").unionByName(itself))
    texts = documents.join(texts_of(documents.select(F.col("doc_url").alias("url"))), F.col("doc_url") == F.col("url")).groupBy("fingerprint").agg(F.sort_array(F.collect_list(F.struct("place", "text"))).alias("parts"))
    firsts = documents.where("place = 1").select("fingerprint", "doc_url")
    whole = scoped.join(texts, "fingerprint", "left").withColumn("parts", F.coalesce(F.transform("parts", lambda p: p["text"]), F.array().cast("array<string>")))
    ready = whole.select("fingerprint", "title", "category", enrichment.document_text(visible_text(F.col("scope")), F.col("parts"), 12_000, F.col("block") != "").alias("text"))
    verdicts = durable(enrichment.reviewed(ready, reviewer))
    linked = verdicts.join(scoped.where("block != ''").join(firsts, "fingerprint").select("fingerprint", "doc_url"), "fingerprint", "left").withColumn("doc_url", F.coalesce("doc_url", F.lit("")))
    tables.findings.write(state.set_reviews(findings, linked, F.current_timestamp()))
    outcomes = linked.agg(F.count("*").alias("revisioni"), F.count_if("ai_bando").alias("bandi"), F.count_if(~F.col("ai_bando")).alias("non_bandi"), F.count_if(F.col("ai_bando").isNull()).alias("illeggibili"))
    return {**counts, **outcomes.head().asDict()}
