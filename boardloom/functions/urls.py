"""URL forms as JVM-side column expressions.

The engine knows several canonical forms, each for another purpose; they are kept apart on purpose. Splitting is
done by one regular expression that, unlike parse_url, fails on no input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
# Entries that stand for a missing site, and parameters that don't identify a document.
MISSING_SITES = ("NON DISPONIBILE", "N.D.", "ND", "-", "//")
NOISE_PARAMETERS = (
    "sid", "sessid", "phpsessid", "jsessionid", "tag", "cerca", "cerca_sito", "search", "s",
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid",
)


#: All characters of white space. Trimming by list takes linear time, which a pattern anchored at the end doesn't.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def stripped(c: Column) -> Column:
    """Text without outer white space of any kind; NULL becomes ''."""
    return F.btrim(F.coalesce(c, F.lit("")), F.lit(SPACE))


def part(url: Column, name: str) -> Column:
    """scheme, netloc, path, query or fragment of a URL; '' where there is none."""
    return F.regexp_extract(url, _PARTS, ["scheme", "netloc", "path", "query", "fragment"].index(name) + 1)


def _no_www(host: Column) -> Column:
    return F.regexp_replace(host, r"^www\.", "")


def clean_url(c: Column) -> Column:
    """A site as it was typed into a registry, made usable: scheme mended, host in lower case; '' if none is meant."""
    typed = stripped(c)
    u = F.replace(typed, F.lit(" "), F.lit(""))
    u = F.regexp_replace(u, r"(?i)^https?://(?=https?[:/])", "")
    u = F.regexp_replace(u, r"(?i)^(https?)//", "$1://")
    u = F.regexp_replace(u, r"(?i)^(https?):/(?!/)", "$1://")
    u = F.when(u.rlike(r"(?i)^https?://"), u).otherwise(F.concat(F.lit("https://"), u))
    shape = r"(?is)^(https?://)([^/]+)(.*)$"
    host = F.regexp_replace(F.lower(F.regexp_extract(u, shape, 2)), r"[.,;]+$", "")
    mended = F.when(u.rlike(shape), F.concat(F.lower(F.regexp_extract(u, shape, 1)), host, F.regexp_extract(u, shape, 3))).otherwise(u)
    return F.when((typed == "") | F.upper(typed).isin(*MISSING_SITES), "").otherwise(mended)


def normalize_url(c: Column) -> Column:
    """URL of a document without fragment, session and tracking parameters, closing slashes; parameters sorted.

    Values are percent-decoded and encoded again. A value whose percent signs don't decode is taken as it is.
    """
    url = F.regexp_replace(stripped(c), r"[\t\r\n]", "")
    pairs = F.transform(F.split(part(url, "query"), "&"), lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1).alias("v")))
    told = F.transform(pairs, lambda p: F.struct(_decoded(p["k"]).alias("k"), _decoded(p["v"]).alias("v")))
    kept = F.filter(told, lambda p: (p["v"] != "") & ~F.lower(p["k"]).isin(*NOISE_PARAMETERS))
    query = F.array_join(F.transform(F.array_sort(kept), lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")
    scheme, netloc = F.lower(part(url, "scheme")), F.lower(part(url, "netloc"))
    path = F.regexp_replace(part(url, "path"), r"/+\z", "")
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when(netloc != "", F.concat(F.lit("//"), netloc)).otherwise(""),
        F.when((netloc != "") & (path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )


def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def _encoded(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def compare_key(c: Column) -> Column:
    """Key to compare two sets of documents: host without www. and path, in lower case; port kept."""
    url = F.lower(stripped(c))
    return F.concat(_no_www(part(url, "netloc")), F.regexp_replace(part(url, "path"), r"/+\z", ""))


def host_of(netloc: Column) -> Column:
    """Host without user, port and www., in lower case."""
    return _no_www(F.substring_index(F.substring_index(F.lower(netloc), "@", -1), ":", 1))


def site_key(c: Column) -> Column:
    """Key of a site: host and path; different schools on a shared platform stay apart by their path."""
    url = F.when(F.contains(c, F.lit("://")), c).otherwise(F.concat(F.lit("http://"), c))
    return F.concat(host_of(part(url, "netloc")), F.lower(F.regexp_replace(part(url, "path"), r"/+\z", "")))


def page_key(c: Column) -> Column:
    """A page within one crawl: the URL without fragment and closing slashes."""
    return F.regexp_replace(F.regexp_replace(c, r"(?s)#.*$", ""), r"/+\z", "")


def root_of(c: Column) -> Column:
    """scheme://netloc of a URL; https where the scheme is missing."""
    scheme = F.lower(part(c, "scheme"))
    return F.concat(F.when(scheme == "", "https").otherwise(scheme), F.lit("://"), part(c, "netloc"))


def toggle_www(netloc: Column) -> Column:
    """A host with www. instead of without, and the other way round."""
    bare = netloc.substr(F.lit(5), F.length(netloc))
    return F.when(F.lower(netloc).startswith("www."), bare).otherwise(F.concat(F.lit("www."), netloc))


def fallback_urls(c: Column) -> Column:
    """Addresses to try when `c` doesn't answer, likeliest first: .edu.it for .gov.it, other scheme, www."""
    scheme, netloc = F.lower(part(c, "scheme")), part(c, "netloc")
    path = F.when(part(c, "path") == "", "/").otherwise(part(c, "path"))
    other = F.when(scheme == "https", "http").otherwise("https")
    moved = F.concat(netloc.substr(F.lit(1), F.length(netloc) - 7), F.lit(".edu.it"))

    def at(s: Column, n: Column) -> Column:
        return F.when(n != "", F.concat(s, F.lit("://"), n, path))

    migrated = F.when(F.lower(netloc).endswith(".gov.it"), F.array(at(scheme, moved), at(other, moved), at(scheme, toggle_www(moved))))
    usual = F.array(at(other, netloc), at(scheme, toggle_www(netloc)), at(other, toggle_www(netloc)))
    every = F.concat(F.coalesce(migrated, F.array().cast("array<string>")), usual)
    return F.array_remove(F.array_distinct(F.filter(every, lambda u: u.isNotNull())), c)


def same_site(a: Column, b: Column) -> Column:
    """Whether two URLs have the same, non-empty netloc apart from www."""
    x, y = (_no_www(F.lower(part(u, "netloc"))) for u in (a, b))
    return (x == y) & (x != "")


def same_registrable(a: Column, b: Column) -> Column:
    """Whether two URLs have the same host apart from www., user and port."""
    return host_of(part(a, "netloc")) == host_of(part(b, "netloc"))


def fingerprint(url: Column, content: Column) -> Column:
    """Identity of a finding: 32 hex digits of the SHA-256 of normalised URL and content."""
    return F.substring(F.sha2(F.concat(normalize_url(url), F.lit("|"), F.coalesce(content, F.lit(""))), 256), 1, 32)


def safe_url(c: Column) -> Column:
    """The URL if it is http(s), else '#'."""
    return F.when(F.coalesce(c, F.lit("")).rlike(r"(?i)^https?://"), c).otherwise("#")


def is_pdf(c: Column) -> Column:
    """Whether a URL's path ends in .pdf."""
    return F.lower(F.regexp_replace(c, r"(?s)[?#].*$", "")).endswith(".pdf")


def absolute(base: Column, href: Column) -> Column:
    """`href` as an absolute URL (RFC 3986), dot segments removed; NULL for what can't be joined."""
    scheme, netloc, path = part(base, "scheme"), part(base, "netloc"), part(base, "path")
    root = F.concat(scheme, F.lit("://"), netloc)
    tail = F.regexp_extract(href, r"(?s)^[^?#]*(.*)$", 1)
    own = part(href, "path")
    folder = F.regexp_replace(path, "[^/]*$", "")
    merged = F.when(own.startswith("/"), own).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), own))
    return (
        F.when(F.trim(href) == "", base)
        .when(part(href, "scheme") != "", href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, r"(?s)#.*$", ""), F.when(href == "#", "").otherwise(href)))
        .when(href.startswith("?"), F.concat(root, path, href))
        .otherwise(F.concat(root, _no_dots(merged), tail))
    )


def _no_dots(path: Column) -> Column:
    """Path without . and .. segments."""
    steps = F.split(path, "/")
    walked = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)).when(x == ".", acc).otherwise(F.array_append(acc, x)),
    )
    closing = F.when(F.element_at(steps, -1).isin(".", ".."), F.lit("/")).otherwise("")
    return F.when(path.contains("/."), F.concat(F.array_join(walked, "/"), closing)).otherwise(path)
