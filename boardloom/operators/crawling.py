"""Discovery of notice pages and crawling, as joins with a table of pages.

A page source is a table (url, ok, status, final_url, html, error) or a function that gives such a table for a table
of urls; see boardloom.sources.pages. Searches that try one address after another become an ordered list of
candidates, one join and the first success.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardloom.functions.rules import EXPERTS, RulePack
from boardloom.functions.scoring import classify
from boardloom.functions.text import SEARCH_PAGE, is_listing, links, listing_rank, platform, snippet, visible_text
from boardloom.functions.urls import fallback_urls, page_key, part, root_of, same_registrable, same_site
from boardloom.plans.work import durable, stored

# Paths to try by platform, marks of a notice page in an address, words in a link's text, and signs of
# hosts without a name or with too much load.
PATHS = {
    "agid_wordpress": ("/amministrazione-trasparente/", "/albo-online/", "/amministrazione-trasparente/bandi-di-gara-e-contratti/", "/albo-pretorio/"),
    "madisoft": ("/amministrazione-trasparente/", "/albo-online/"),
    "spaggiari": ("/amministrazione-trasparente/", "/albo-online/", "/albo-pretorio/"),
    "axios": ("/amministrazione-trasparente/", "/albo-online/", "/albo-pretorio/"),
    "wordpress_generic": ("/amministrazione-trasparente/", "/amministrazione-trasparente/bandi-di-gara-e-contratti/", "/albo-online/"),
    "generic": ("/amministrazione-trasparente/", "/albo-online/", "/albo-pretorio/", "/index.php/albo-pretorio"),
    "argo_software": ("/amministrazione-trasparente/",),
}
USUAL_PATHS = (
    "/amministrazione-trasparente/", "/albo-online/", "/amministrazione-trasparente/bandi-di-gara-e-contratti/", "/albo-pretorio/",
    "/trasparenza/", "/index.php/amministrazione-trasparente",
)
ADDRESS_MARKS = (
    "amministrazione-trasparente", "albo-pretorio", "albo-online", "albopretorio", "albo_pretorio", "/trasparenza", "bandi-di-gara",
    "bandi-di-concorso", "trasparenza-pa", "alboinfoline", "albopop", "/albo",
)
LINK_WORDS = (
    "albo pretorio", "albo online", "amministrazione trasparente", "bandi di gara", "bandi e concorsi", "avvisi", "bandi", "concorsi",
    "trasparenza", "albo", "gara", "incarichi", "bandi di concorso", "personale", "selezione", "reclutamento",
)
NO_NAME = ("name or service", "name resolution", "no address", "nodename")
THROTTLED = (429, 503, 509, 520, 521)
BODY_THRESHOLD, MIN_LINK = 0.70, 8
#: Paths that a platform may have to be tried with, at most.
MOST_PATHS = max(len({*own, *USUAL_PATHS}) for own in PATHS.values())
PAGE_COLUMNS = ("url", "ok", "status", "final_url", "html", "error")
PageSource = DataFrame | Callable[[DataFrame], DataFrame]


def lookup(pages: PageSource, urls: DataFrame) -> DataFrame:
    """The pages of the table, or what the function gives for the distinct `url`s."""
    return pages if isinstance(pages, DataFrame) else pages(urls.select("url").distinct())


def probe_paths(kind: Column) -> Column:
    """Paths to try on a platform, likeliest first, each once."""
    by_kind = F.create_map(*[x for k, ps in PATHS.items() for x in (F.lit(k), F.array(*[F.lit(p) for p in ps]))])
    usual = F.array(*[F.lit(p) for p in USUAL_PATHS])
    return F.array_distinct(F.concat(F.coalesce(F.element_at(by_kind, kind), usual), usual))


def fetched(requests: DataFrame, url: str, pages: PageSource) -> DataFrame:
    """Requests with the page of `url` or of its first alternative that answers; the error is the original's.

    Adds ok, status, final_url, html and error. `requests` must be unique by url. Alternatives are looked up only where the original fails; the
    winner is chosen from flags; its HTML is joined once. A page function is asked for alternatives only where the original fails, not on a
    host whose name doesn't resolve, and in a hurry where the original was slow or throttled.
    """
    asked = None
    if not isinstance(pages, DataFrame):
        first = durable(lookup(pages, requests.select(F.col(url).alias("url"))))
        bad = first.where("NOT ok").select("url", *[c.alias(n) for n, c in (("dns", no_name(F.col("error"))), ("hurry", slow_or_throttled(F.col("status"), F.col("error"))))])
        other = bad.select("url", "dns", "hurry", F.explode(fallback_urls(F.col("url"))).alias("other"))
        other = other.where(~F.col("dns") | ~same_registrable(F.col("url"), F.col("other")))
        wanted = other.groupBy(F.col("other").alias("url")).agg(F.bool_and("hurry").alias("hurry"))
        more = durable(pages(wanted.join(first.select("url"), "url", "left_anti")))
        pages = first.select(*PAGE_COLUMNS).unionByName(more.select(*PAGE_COLUMNS))
        # an alternative that wasn't asked for this request doesn't count, even if another request had it
        asked = other.select(F.col("url").alias(url), F.col("other").alias("__try"))
    answered = pages.where("ok").select(F.col("url").alias("__page"))
    down = requests.select(url).join(answered, F.col(url) == F.col("__page"), "left_anti")
    tries = down.select(url, F.posexplode(fallback_urls(F.col(url))).alias("__n", "__try"))
    if asked is not None:
        tries = tries.join(asked, [url, "__try"], "left_semi")
    best = tries.join(answered, F.col("__try") == F.col("__page")).groupBy(url).agg(F.min_by("__try", "__n").alias("__other"))
    won = requests.join(best, url, "left").withColumn("__won", F.coalesce("__other", url)).drop("__other")
    told = pages.where("ok").select(F.col("url").alias("__won"), F.lit(True).alias("__hit"), F.col("status").alias("__status"), F.col("final_url").alias("__final"), F.col("html").alias("__html"))
    errors = pages.where("NOT coalesce(ok, false)").select(F.col("url").alias(url), F.col("error").alias("__error"))
    full = won.join(told, "__won", "left").join(errors, url, "left")
    up = F.coalesce("__hit", F.lit(False))
    final = F.when(up, F.coalesce(F.nullif(F.col("__final"), F.lit("")), F.col("__won")))
    return full.select(
        *requests.columns, up.alias("ok"), F.col("__status").alias("status"), final.alias("final_url"), F.col("__html").alias("html"), F.when(~up, F.coalesce("__error", F.lit("unreachable"))).alias("error")
    )


def no_name(error: Column) -> Column:
    """Whether an error says that the host's name doesn't resolve."""
    return F.coalesce(F.lower(error), F.lit("")).rlike("|".join(NO_NAME))


def slow_or_throttled(status: Column, error: Column) -> Column:
    """Whether a request failed for lack of time or was turned away for the load."""
    return F.coalesce(F.lower(error), F.lit("")).contains("timed out") | F.coalesce(status.isin(*THROTTLED), F.lit(False))


def first_probes(probes: DataFrame, pages: PageSource) -> DataFrame:
    """(site_url, n, target) of the probes that lead to a page; of a page function, each site's probes are asked one after another until one does."""
    good = "ok AND status = 200 AND length(html) > 200"
    if isinstance(pages, DataFrame):
        return probes.join(pages.where(good).select(F.col("url").alias("target")), "target").select("site_url", "n", "target")
    probes, found = durable(probes), None
    for n in range(MOST_PATHS):
        now = probes.where(F.col("n") == n)
        if found is not None:
            now = now.join(found.select("site_url"), "site_url", "left_anti")
        here = lookup(pages, now.select(F.col("target").alias("url"))).where(good).select(F.col("url").alias("target"))
        more = now.join(here, "target").select("site_url", "n", "target")
        found = durable(more if found is None else found.unionByName(more))
    return found


def discover_again(sites: DataFrame, pages: PageSource, attempts: int = 4, pause: float = 2.0) -> DataFrame:
    """As discover(); sites of a page function that don't answer are tried again, after growing pauses, up to so many attempts."""
    found = durable(discover(sites, pages))
    for n in range(1, attempts if not isinstance(pages, DataFrame) else 1):
        down = found.where("NOT reachable")
        if down.isEmpty():
            break
        time.sleep(pause * n + random.random() * (pause > 0))
        found = durable(found.where("reachable").unionByName(discover(down.select("site_url"), pages)))
    return found


def discover(sites: DataFrame, pages: PageSource) -> DataFrame:
    """(site_url, reachable, resolved_url, platform, trasparenza_url, method, discovery_note) of each site.

    Stages: probing of known paths, marks in link addresses, words in link texts; the first success in
    this order is taken. Sites without an address aren't asked.
    """
    asked = sites.select("site_url").where("site_url != ''").distinct()
    home = fetched(asked, "site_url", pages).withColumn("platform", F.when(F.col("ok"), platform(F.col("html"))).otherwise("unknown"))
    up = home.where("ok").withColumn("base", root_of(F.col("final_url")))
    probes = up.select("site_url", F.posexplode(F.transform(probe_paths(F.col("platform")), lambda p: F.concat(F.col("base"), p))).alias("n", "target"))
    hits = first_probes(probes, pages).select("site_url", F.struct(F.lit(1).alias("stage"), "n", F.lit("path_probe").alias("method"), "target").alias("hit"))
    found = up.select("site_url", F.explode(links(F.col("html"), F.col("final_url"))).alias("l"))
    marked = F.lower(F.col("l.href")).rlike("|".join(ADDRESS_MARKS))
    worded = F.lower(F.col("l.text")).rlike("|".join(LINK_WORDS))
    linked = found.where(marked | worded).select(
        "site_url", F.struct(F.when(marked, 2).otherwise(3).alias("stage"), F.col("l.pos").alias("n"), F.when(marked, "link_href").otherwise("link_scan").alias("method"), F.col("l.href").alias("target")).alias("hit")
    )
    best = hits.unionByName(linked).groupBy("site_url").agg(F.min("hit").alias("hit"))
    note = F.when(~F.col("ok"), F.col("error")).when(F.col("hit").isNull(), "no_trasparenza_found").otherwise("ok")
    return home.join(best, "site_url", "left").select(
        "site_url",
        F.col("ok").alias("reachable"),
        F.coalesce("final_url", F.lit("")).alias("resolved_url"),
        "platform",
        F.coalesce("hit.target", F.lit("")).alias("trasparenza_url"),
        F.coalesce("hit.method", F.lit("")).alias("method"),
        note.alias("discovery_note"),
    )


def page_events(read: DataFrame, pack: RulePack = EXPERTS, threshold: float = 0.45) -> DataFrame:
    """(code, url, seq, kind, title, category, score): every scored link and body of the pages read.

    `read` has code, page_seq, page_url and html. Links are judged by their text with vetoes; a body
    needs a strong rule and a higher threshold.
    """
    base = read.select("code", "page_seq", "page_url", "html")
    anchors = base.select("code", "page_seq", F.explode(links(F.col("html"), F.col("page_url"))).alias("l"))
    anchors = anchors.where((F.length("l.text") >= MIN_LINK) & ~F.col("l.href").rlike(SEARCH_PAGE))
    anchors = classify(anchors, F.col("l.text"), F.col("l.text"), pack, threshold, only=True)
    a = anchors.select("code", F.col("l.href").alias("url"), F.struct("page_seq", F.lit(0).alias("k"), F.col("l.pos").alias("pos")).alias("seq"), F.lit("anchor").alias("kind"), F.substring("l.text", 1, 300).alias("title"), "c.category", "c.score")
    bodies = base.where(~F.col("page_url").rlike(SEARCH_PAGE)).withColumn("body", visible_text(F.col("html")))
    bodies = classify(bodies, F.col("body"), F.lit(""), pack, max(threshold, BODY_THRESHOLD), veto=False, require_strong=True, only=True)
    b = bodies.select("code", F.col("page_url").alias("url"), F.struct("page_seq", F.lit(1).alias("k"), F.lit(0).alias("pos")).alias("seq"), F.lit("page").alias("kind"), snippet(F.col("body")).alias("title"), "c.category", "c.score")
    return a.unionByName(b)


def best_hits(events: DataFrame) -> DataFrame:
    """One hit per (code, url): a page event counts only if it comes first; then the greater score, then the earlier."""
    run = Window.partitionBy("code", "url").orderBy("seq")
    counted = events.withColumn("__n", F.row_number().over(run)).where("kind = 'anchor' OR __n = 1")
    best = counted.groupBy("code", "url").agg(F.max_by(F.struct("title", "category", "score", "kind"), F.struct("score", -F.col("__n"))).alias("h"))
    return best.select("code", "url", "h.*")


def drill_targets(entries: DataFrame, most: int = 3) -> DataFrame:
    """(code, url, place): the likeliest sub-lists of each entry page, same site, each page once."""
    found = entries.select("code", "page_url", F.explode(links(F.col("html"), F.col("page_url"))).alias("l"))
    key = page_key(F.col("l.href"))
    listed = found.where(is_listing(F.col("l.text"), F.col("l.href")) & same_site(F.col("l.href"), F.col("page_url")) & (key != page_key(F.col("page_url"))))
    base = F.regexp_replace(F.col("l.href"), r"(?s)#.*$", "")
    ranked = listed.select("code", key.alias("key"), base.alias("url"), listing_rank(part(base, "path"), F.col("l.text")).alias("rank"), F.col("l.pos").alias("pos"))
    once = ranked.groupBy("code", "key").agg(F.min_by(F.struct("url", "rank", "pos"), "pos").alias("x")).select("code", "x.*")
    place = Window.partitionBy("code").orderBy(F.desc("rank"), "pos")
    return once.withColumn("place", F.row_number().over(place)).where(F.col("place") <= most).select("code", "url", "place")


def crawl(targets: DataFrame, pages: PageSource, pack: RulePack = EXPERTS, threshold: float = 0.45, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """(hits, outcomes) of reading each notice page and its likeliest sub-lists.

    `targets` has code and trasparenza_url. outcomes: (code, ok, note, pages). A failed sub-list is skipped.
    The pages read and the sub-lists are stored, for each is used several times.
    """
    asked = stored(fetched(targets.select("code", "trasparenza_url").where("trasparenza_url != ''"), "trasparenza_url", pages), "asked")
    entries = asked.where("ok").select("code", F.lit(0).alias("page_seq"), F.col("final_url").alias("page_url"), "html")
    drill = stored(drill_targets(entries, most), "drill")
    unique = fetched(drill.select("url").distinct().withColumnRenamed("url", "sub_url"), "sub_url", pages).where("ok")
    subs = stored(drill.join(unique, F.col("url") == F.col("sub_url")).select("code", F.col("place").alias("page_seq"), F.col("final_url").alias("page_url"), "html"), "subs")
    hits = best_hits(page_events(entries.unionByName(subs), pack, threshold))
    tried = drill.groupBy("code").agg(F.count("*").alias("subs"))
    outcomes = asked.join(tried, "code", "left").select("code", "ok", F.when(F.col("ok"), "ok").otherwise(F.col("error")).alias("note"), F.when(F.col("ok"), 1 + F.coalesce("subs", F.lit(0))).otherwise(0).cast("int").alias("pages"))
    return hits, outcomes
