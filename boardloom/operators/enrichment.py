"""Enrichment of findings: deadlines from pages and attachments, document choice, pluggable review."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardloom.functions.dates import deadline
from boardloom.functions.text import is_noise_page, links, visible_text, word_key
from boardloom.functions.urls import is_pdf

# Words of documents to read first and last, addresses of documents without .pdf, and the marks of an act's block and
# of the link that opens it.
READ_FIRST = r"(?i)avvis|band|selezion|decret|determin|incaric|reclutam"
READ_LAST = r"(?i)modul|domand|allegat|\bcv\b|privacy|informativa|liberatoria"
DOCUMENT = r"(?i)/documenti/|/sdg\d|[?&]download|/download|/allegat|/uploads?/|/file/|attachment"
BLOCK = r'(?is)class="[^"]*at-item[^"]*".*?(?=class="[^"]*at-item|</main|</body|\z)'
BOX_LINK = r'(?is)data-bs-target="#modalDetail-(\d+)"[^>]*>(.*?)</a>'
LEAST_LIKENESS = 0.35
REVIEW = "is_bando string, scadenza string, titolo string, profilo string"


def is_document(url: Column) -> Column:
    """Whether an address leads to a document."""
    return is_pdf(url) | url.rlike(DOCUMENT)


def document_rank(text: Column) -> Column:
    """1 for a likely call, -1 for forms and notices, by the link's text."""
    return F.when(text.rlike(READ_FIRST), 1).otherwise(0) - F.when(text.rlike(READ_LAST), 1).otherwise(0)


@F.pandas_udf(T.DoubleType())
def likeness(wanted: pd.Series, text: pd.Series) -> pd.Series:
    """Likeness of a title and a text: matching runs of characters and shared words of five letters and more.

    Both are word keys. This ratio has no counterpart among Spark's functions.
    """

    def one(a: str | None, b: str | None) -> float:
        a, b = a or "", b or ""
        long = [w for w in a.split() if len(w) > 4]
        shared = sum(w in b for w in long) / len(long) if long else 0.0
        return 0.4 * SequenceMatcher(None, a[:80], b[:300]).ratio() + 0.6 * shared

    return pd.Series([one(a, b) for a, b in zip(wanted, text, strict=True)])


def best_match(pairs: DataFrame, key: str, wanted: str, text: str, pos: str) -> DataFrame:
    """The row of each key whose text is most like the wanted title, the first of equal ones; none below the least."""
    plain = F.regexp_replace(F.col(text), r"<[^>]+>", " ")
    told = pairs.withColumn("likeness", likeness(word_key(F.col(wanted)), word_key(plain)))
    best = told.groupBy(key).agg(F.max_by(F.struct(*[c for c in told.columns if c != key]), F.struct("likeness", -F.col(pos))).alias("b"))
    return best.select(key, "b.*").where(F.col("likeness") >= LEAST_LIKENESS)


def blocks(html: Column) -> Column:
    """The entries of an index page; empty unless there are two."""
    found = F.regexp_extract_all(html, F.lit(BLOCK), F.lit(0))
    return F.when(F.size(found) >= 2, found).otherwise(F.array().cast("array<string>"))


def act_blocks(read: DataFrame) -> DataFrame:
    """(fingerprint, block): of an index page, the part about the act whose title is wanted; '' where none is.

    `read` has fingerprint, title and html. Entries are listed one after another, or as links that open a
    box of their own; either needs two entries at least.
    """
    listed = read.select("fingerprint", "title", F.posexplode(blocks(F.col("html"))).alias("pos", "block"))
    first = best_match(listed, "fingerprint", "title", "block", "pos").select("fingerprint", "block")
    rest = read.where(F.size(blocks(F.col("html"))) == 0)
    ids, texts = (F.regexp_extract_all("html", F.lit(BOX_LINK), F.lit(i)) for i in (1, 2))
    boxes = rest.select("fingerprint", "title", "html", F.arrays_zip(ids.alias("box"), texts.alias("text")).alias("b")).where(F.size("b") >= 2)
    named = boxes.select("fingerprint", "title", "html", F.posexplode("b").alias("pos", "b")).select("fingerprint", "title", "html", "pos", "b.box", "b.text")
    chosen = best_match(named, "fingerprint", "title", "text", "pos")
    box = F.call_function("regexp_extract", "html", F.concat(F.lit('(?s)id="modalDetail-'), "box", F.lit(r'".*?(?=id="modalDetail-|</body|\z)')), F.lit(0))
    found = first.unionByName(chosen.select("fingerprint", box.alias("block")))
    return read.select("fingerprint").join(found, "fingerprint", "left").select("fingerprint", F.coalesce("block", F.lit("")).alias("block"))


def documents_of(read: DataFrame, most: int = 3) -> DataFrame:
    """(fingerprint, doc_url, place): the documents of each page to read first, in stable order of rank."""
    found = read.select("fingerprint", F.explode(links(F.col("html"), F.col("page_url"))).alias("l")).where(is_document(F.col("l.href")))
    order = Window.partitionBy("fingerprint").orderBy(document_rank(F.col("l.text")).desc(), "l.pos")
    return found.select("fingerprint", F.col("l.href").alias("doc_url"), F.row_number().over(order).alias("place")).where(F.col("place") <= most)


def open_documents(read: DataFrame, most: int = 3) -> DataFrame:
    """(fingerprint, url, place): the first PDFs linked from pages without a deadline in their text."""
    open_pages = read.where(deadline(visible_text(F.col("html"))).isNull())
    found = open_pages.select("fingerprint", F.explode(links(F.col("html"), F.col("page_url"))).alias("l")).where(is_pdf(F.col("l.href")))
    order = Window.partitionBy("fingerprint").orderBy("l.pos")
    return found.select("fingerprint", F.col("l.href").alias("url"), F.row_number().over(order).alias("place")).where(F.col("place") <= most)


def deadlines(read: DataFrame, attachments: DataFrame, most: int = 3) -> DataFrame:
    """(fingerprint, scadenza): from the page's text, else from the first PDF that tells one.

    `read` has fingerprint, page_url and html, `attachments` url and text. Only pages without a deadline in
    their text are joined with attachments.
    """
    paged = read.withColumn("scadenza", deadline(visible_text(F.col("html"))))
    pdfs = open_documents(read, most)
    told = pdfs.join(attachments, "url").withColumn("scadenza", deadline(F.col("text"))).where("scadenza IS NOT NULL")
    first = told.groupBy("fingerprint").agg(F.min_by("scadenza", "place").alias("late"))
    return paged.join(first, "fingerprint", "left").select("fingerprint", F.coalesce("scadenza", "late").alias("scadenza"))


def document_text(page_text: Column, parts: Column, limit: int, isolated: Column | None = None) -> Column:
    """Page text and attachments joined until the limit is passed, then cut to it.

    A login or error page doesn't count, unless the text is the isolated part of an index page.
    """
    noise = is_noise_page(page_text)
    start = F.when(noise if isolated is None else noise & ~isolated, F.array().cast("array<string>")).otherwise(F.array(page_text))
    size = lambda a: F.aggregate(a, F.lit(0), lambda n, x: n + F.length(x))
    joined = F.aggregate(parts, start, lambda acc, x: F.when(size(acc) > limit, acc).otherwise(F.array_append(acc, x)))
    return F.substring(F.regexp_replace(F.array_join(joined, "\n\n"), "\n{3,}", "\n\n"), 1, limit)


def parsed_review(reply: Column, text: Column) -> Column:
    """struct<ai_bando, scadenza, titolo_pulito, profilo> of a reviewer's JSON reply about a readable text.

    A missing verdict is a no; a deadline must be a valid ISO date; a yes without one gets the deadline the
    text announces. A reply that isn't JSON gives NULL: the finding stays pending.
    """
    r = F.from_json(reply, REVIEW)
    yes = F.lower(F.coalesce(r["is_bando"], F.lit("false"))).isin("true", "1")
    iso = F.trim(r["scadenza"])
    due = F.when(iso.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(iso, "yyyy-MM-dd"))
    valid = F.get_json_object(reply, "$").isNotNull()
    told = F.struct(
        yes.alias("ai_bando"),
        F.coalesce(due, F.when(yes, deadline(text))).alias("scadenza"),
        F.substring(F.trim(F.coalesce(r["titolo"], F.lit(""))), 1, 160).alias("titolo_pulito"),
        F.substring(F.trim(F.coalesce(r["profilo"], F.lit(""))), 1, 60).alias("profilo"),
    )
    return F.when(valid, told)


def reviewed(pending: DataFrame, reviewer: Callable[[str, str, str], str | None]) -> DataFrame:
    """(fingerprint, ai_bando, scadenza, titolo_pulito, profilo) by a pluggable reviewer (text, title, category).

    `pending` has fingerprint, title, category and text. An empty text has no verdict; a reviewer's None leaves
    the finding out, so that it is tried again.
    """

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            replies = [reviewer(t, a, c) if t else "" for t, a, c in zip(pdf["text"], pdf["title"], pdf["category"], strict=True)]
            yield pdf[["fingerprint", "text"]].assign(reply=replies)

    told = pending.select("fingerprint", "title", "category", "text").mapInPandas(ask, "fingerprint string, text string, reply string").where("reply IS NOT NULL")
    parsed = told.withColumn("v", parsed_review(F.col("reply"), F.col("text"))).where("reply = '' OR v IS NOT NULL")
    return parsed.select("fingerprint", "v.ai_bando", "v.scadenza", F.coalesce("v.titolo_pulito", F.lit("")).alias("titolo_pulito"), F.coalesce("v.profilo", F.lit("")).alias("profilo"))
