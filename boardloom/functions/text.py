"""Text and page functions: links, visible text, normal forms, display forms."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardloom.functions.urls import absolute, stripped

_SPACE = r"(?U)\s+"
_TAG = r"<[^>]+>"
_LINK = r"""(?is)<a\b[^>]*href=["']([^"']+)["'][^>]*>(.*?)</a>"""
# Words of login and error pages, and of pages that list notices.
NOISE_PAGE = (
    r"(?i)(entra con spid|accedi con spid|autenticazione|area riservata|effettua(re)? (il )?login|sessione scaduta"
    r"|access denied|pagina non trovata|errore 40\d|404 not found|forbidden)"
)
LISTING_WORDS = (
    "bandi di gara", "bandi di concorso", "bandi e gare", "bandi e concorsi", "albo pretorio", "albo online", "albo-pretorio", "albo-online",
    "avvisi", "bandi", "concorsi", "contratti", "gare", "esperti esterni", "selezioni", "incarichi",
)
SEARCH_PAGE = r"(?i)(/cerca\b|/search\b|/ricerca\b|[?&](cerca|search|s)=|/tag/|/category/|/categoria/)"
LISTING_PATH = r"(?i)albo|band[oi]|avvis|concors|gare|contratt|selezion|incaric|esperti"
LISTING_NOISE = r"(?i)titolari di incaric|premi e concors"
SNIPPET_WORDS = ("esperto esterno", "esperti esterni", "esperto madrelingua", "esperto")


@F.pandas_udf(T.StringType())
def _without_accents(texts: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks: the one form Spark has no function for."""
    return texts.map(lambda t: t if t is None or t.isascii() else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)))


def normalized(c: Column) -> Column:
    """Lower case, no accents, words broken over lines joined, white space collapsed; NULL becomes ''."""
    t = F.lower(_without_accents(F.coalesce(c, F.lit(""))))
    return stripped(F.regexp_replace(F.regexp_replace(t, r"(?U)-\s*\n\s*", ""), _SPACE, " "))


def collapsed(c: Column) -> Column:
    """White space collapsed to single spaces, none outside."""
    return stripped(F.regexp_replace(F.coalesce(c, F.lit("")), _SPACE, " "))


def links(html: Column, base: Column) -> Column:
    """array<struct<pos, href, text>> of a page's links in document order, addresses absolute; entities are kept."""
    hrefs, texts = F.regexp_extract_all(html, F.lit(_LINK), F.lit(1)), F.regexp_extract_all(html, F.lit(_LINK), F.lit(2))
    found = F.transform(F.arrays_zip(hrefs.alias("h"), texts.alias("t")), lambda x, i: F.struct(i.alias("pos"), absolute(base, x["h"]).alias("href"), collapsed(F.regexp_replace(x["t"], _TAG, " ")).alias("text")))
    return F.filter(found, lambda x: x["href"].isNotNull())


def visible_text(html: Column) -> Column:
    """Text of a page without scripts, styles and tags; entities are kept."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1>", " ")
    return collapsed(F.regexp_replace(bare, _TAG, " "))


def is_noise_page(text: Column) -> Column:
    """Whether a visible text is a login or error page, or next to nothing."""
    t = stripped(text)
    return (F.length(t) < 120) | F.substring(t, 1, 1500).rlike(NOISE_PAGE)


def looks_like_html(kind: Column, data: Column) -> Column:
    """Whether bytes are HTML or XML rather than a PDF."""
    head = F.lower(F.regexp_replace(F.decode(F.substring(data, 1, 2048), "ISO-8859-1"), r"^\s+", ""))
    page = F.coalesce(kind, F.lit("")).contains("html") | head.startswith("<") | F.substring(head, 1, 512).rlike("<html|<!doctype")
    return F.when(head.startswith("%pdf"), False).otherwise(page)


def is_listing(text: Column, href: Column) -> Column:
    """Whether a link leads to a list of notices."""
    return F.lower(F.concat(text, F.lit(" "), href)).rlike("|".join(LISTING_WORDS))


def listing_rank(path: Column, text: Column) -> Column:
    """2 for a promising path, minus 2 for a noisy menu text."""
    return F.when(path.rlike(LISTING_PATH), 2).otherwise(0) - F.when(text.rlike(LISTING_NOISE), 2).otherwise(0)


def snippet(body: Column, before: int = 90, after: int = 170, otherwise: int = 300) -> Column:
    """Text around the first of the telling words that occurs, in their order of weight; else the beginning."""
    low = F.lower(body)
    around = []
    for word in SNIPPET_WORDS:
        at = F.instr(low, word)
        start = F.greatest(at - before, F.lit(1))
        around.append(F.when(at > 0, stripped(body.substr(start, at + after - start))))
    return F.coalesce(*around, F.substring(body, 1, otherwise))


def platform(html: Column) -> Column:
    """Publishing platform of a home page by the first rule whose marks it carries."""
    h = F.lower(html)
    # Marks and names of the platforms.
    return (
        F.when(h.rlike("wp-content|wp-includes"), F.when(h.rlike("amministrazione-trasparente|trasparenza"), "agid_wordpress").otherwise("wordpress_generic"))
        .when(h.rlike("argosoft|scuolanext"), "argo_software")
        .when(h.rlike("madisoft|nuvola"), "madisoft")
        .when(h.rlike("spaggiari|scuola&territorio|scuola e territorio"), "spaggiari")
        .when(h.contains("axios"), "axios")
        .otherwise("generic")
    )


def word_key(c: Column) -> Column:
    """Lower-case words separated by single spaces."""
    return stripped(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\W+", " "))


def escaped(c: Column) -> Column:
    """Text with the five characters of HTML escaped; NULL becomes ''."""
    out = F.coalesce(c.cast("string"), F.lit(""))
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def title_case(c: Column) -> Column:
    """Lower case with a capital after every ASCII non-word character, as in place names with hyphens."""
    parts = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[A-Za-z0-9_]+|[^A-Za-z0-9_]+"), F.lit(0))
    capital = F.transform(parts, lambda p: F.when(p.rlike("^[A-Za-z0-9_]"), F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))).otherwise(p))
    return F.array_join(capital, "")
