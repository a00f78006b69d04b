"""The published listing: which findings are shown, filters, facets, order and display fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardloom.functions.dates import days_ago, shown, status
from boardloom.functions.text import collapsed, escaped, title_case
from boardloom.functions.urls import safe_url

# Names of the categories as shown.
LABELS = {
    "generico": "Generico", "madrelingua": "Madrelingua", "psicologo": "Psicologo", "coding": "Coding", "robotica": "Robotica",
    "digitale": "Digitale", "sicurezza": "Sicurezza / RSPP", "formazione": "Formazione", "dm219": "DM 219",
    "pon_progettista_collaudatore": "PON progettista/collaudatore",
}


def _filled(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def label(c: Column) -> Column:
    """Shown name of a category; the category itself where there is none."""
    names = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    return F.coalesce(F.element_at(names, c), c)


def field_shown() -> Column:
    """Role, else the category's name, else a dash."""
    return F.coalesce(_filled("profilo"), F.nullif(label(F.col("category")), F.lit("")), F.lit("—"))


def title_shown() -> Column:
    """Reviewed title, else the collapsed title, else a stand-in."""
    return F.coalesce(_filled("titolo_pulito"), F.nullif(collapsed(F.col("title")), F.lit("")), F.lit("(senza titolo)"))


def rejected() -> Column:
    """A review said it isn't a call."""
    return F.col("ai_bando").eqNullSafe(F.lit(False))


def unreadable() -> Column:
    """A review ran but had nothing to read."""
    return F.col("ai_checked").isNotNull() & F.col("ai_bando").isNull()


def visible(findings: DataFrame) -> DataFrame:
    """Findings that are published; ones without a review stay."""
    return findings.where(~rejected() & ~unreadable())


def snapshot(findings: DataFrame, as_of: Column) -> DataFrame:
    """Published findings with stato on a day, and titolo where a reviewed one exists."""
    return visible(findings).withColumn("stato", status(F.col("scadenza"), as_of)).withColumn("titolo", _filled("titolo_pulito"))


def snapshot_meta(findings: DataFrame, as_of: Column) -> DataFrame:
    """Counters of a snapshot, in one pass."""
    hidden = rejected() | unreadable()
    state = status(F.col("scadenza"), as_of)
    return findings.agg(
        *[F.count_if(~hidden & (state == s)).alias(name) for s, name in (("aperto", "aperti"), ("scaduto", "scaduti"), ("ignota", "scadenza_ignota"))],
        F.count_if(rejected()).alias("esclusi_ai"),
        F.count_if(~rejected() & unreadable()).alias("doc_vuoti"),
        F.count_if(F.coalesce("origin", F.lit("nuovo")) == "archivio").alias("da_archivio"),
    )


def status_cards(listing: DataFrame) -> DataFrame:
    """Findings per stato over everything published, whatever filter is set."""
    return listing.groupBy("stato").agg(F.count("*").alias("n"))


def facets(listing: DataFrame) -> DataFrame:
    """Distinct categories and regions to choose from."""
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in ("category", "region")])).alias("f")
    return listing.select(values).select("f.*").where("value IS NOT NULL").distinct()


def filtered(listing: DataFrame, stato: str = "", category: str = "", region: str = "", words: str = "") -> DataFrame:
    """Rows that pass the filters set; `words` is looked for in school, title, field and region."""
    rows = listing
    for c, v in (("stato", stato), ("category", category), ("region", region)):
        rows = rows.where(F.col(c) == v) if v else rows
    hay = F.lower(F.concat_ws(" ", "school_name", title_shown(), field_shown(), "region"))
    return rows.where(hay.contains(words.lower().strip())) if words.strip() else rows


def result_count(listing: DataFrame, stato: str = "") -> DataFrame:
    """(n, label): how many rows the filters leave, in words, with the stato that is filtered by."""
    n = F.count("*")
    named = F.concat(n.cast("string"), F.when(n == 1, " bando").otherwise(" bandi"), F.lit(f" · stato: {stato}" if stato else ""))
    return listing.agg(n.alias("n"), named.alias("label"))


def ordered(listing: DataFrame, by: str = "recent") -> DataFrame:
    """By score, by deadline (none last) or by first sight; ties by fingerprint."""
    order = {"conf": F.coalesce("score", F.lit(0.0)).desc(), "scad": F.col("scadenza").asc_nulls_last(), "recent": F.col("first_seen").desc_nulls_last()}[by]
    return listing.orderBy(order, "fingerprint")


def cards(listing: DataFrame, now: Column) -> DataFrame:
    """What a card shows."""
    return listing.select(
        "fingerprint",
        "stato",
        (F.coalesce("origin", F.lit("nuovo")) == "nuovo").alias("is_new"),
        escaped(title_shown()).alias("titolo"),
        escaped(F.col("school_name")).alias("scuola"),
        escaped(title_case(F.col("province"))).alias("provincia"),
        escaped(field_shown()).alias("ambito"),
        shown(F.col("scadenza")).alias("scade"),
        F.floor(F.coalesce("score", F.lit(0.0)) * 100 + 0.5).cast("bigint").alias("pct"),
        safe_url(F.coalesce(_filled("doc_url"), F.col("url"))).alias("href"),
        days_ago(F.col("first_seen"), now).alias("scoperto"),
    )
