"""Page sources: a stored table of pages, or HTTP through the Python data source API."""

from __future__ import annotations

import gzip
import io
import random
import re
import ssl
import time
import urllib.error
import urllib.request
import zipfile
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from http.client import HTTPResponse
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardloom.functions.text import looks_like_html, visible_text
from boardloom.functions.urls import host_of, part

PAGE = "url string, ok boolean, status int, final_url string, html string, error string, elapsed double"
MAX_PAGE, MAX_BYTES = 900_000, 6_000_000
# Statuses of throttling, and how often each kind of failure is tried again.
RETRY = {403, 429, 503, 509}
AGAIN = {"throttled": 3, "slow": 1, "certificate": 1}
ATTACHMENT = "url string, ok boolean, kind string, data binary"


def stored(spark: SparkSession, path: str) -> DataFrame:
    """Pages kept as parquet."""
    return spark.read.parquet(path)


def unpacked(raw: bytes, encoding: str) -> bytes:
    """Body by its content encoding; as much as can be read of a broken one, else the raw bytes."""
    kinds = {"gzip": [31], "deflate": [zlib.MAX_WBITS, -zlib.MAX_WBITS]}
    for name, windows in kinds.items():
        if name in (encoding or "").lower():
            for bits in windows:
                stream = zlib.decompressobj(bits)
                try:
                    return stream.decompress(raw) + stream.flush()
                except zlib.error:
                    continue
    return raw


def decoded(raw: bytes, content_type: str) -> str:
    """Text of a body by the charset named, UTF-8 otherwise; bad bytes are replaced."""
    named = re.search(r"charset=([\w-]+)", content_type or "")
    try:
        return raw.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        return raw.decode("utf-8", "replace")


def failure(e: Exception) -> tuple[str, str, int | None]:
    """(kind, text, status) of a failed request; kind is throttled, slow, certificate or final."""
    if isinstance(e, urllib.error.HTTPError):
        return "throttled" if e.code in RETRY else "final", f"HTTPError {e.code}", e.code
    cause = e.reason if isinstance(e, urllib.error.URLError) else e
    name = type(e).__name__
    if isinstance(cause, ssl.SSLError) and "timed out" not in str(cause):
        return "certificate", f"{name} {cause}", None
    if isinstance(cause, TimeoutError) or "timed out" in str(cause).lower():
        return "slow", f"{name} {'read timed out' if isinstance(e, TimeoutError) else cause}", None
    return "final", f"{name} {cause}", None


def asked(url: str, timeout: float, accept: str, read: Callable[[HTTPResponse], tuple], patient: bool = True, agent: str = "boardloom") -> tuple[tuple | None, str | None, int | None]:
    """(what `read` makes of the reply, error, status): failures are tried again by their kind (AGAIN), bad certificates without checking them."""
    tried: Counter = Counter()
    request = urllib.request.Request(url, headers={"User-Agent": agent, "Accept": accept, "Accept-Encoding": "gzip, deflate"})
    while True:
        unchecked = ssl._create_unverified_context() if tried["certificate"] else None
        try:
            with urllib.request.urlopen(request, timeout=timeout, context=unchecked) as reply:
                return read(reply), None, reply.status
        except Exception as e:  # a broken page must not end the job
            kind, error, status = failure(e)
        if tried[kind] >= AGAIN.get(kind, 0) or not patient and kind != "certificate":
            return None, error, status
        if kind == "throttled":
            time.sleep(2 ** tried[kind] + random.random())
        elif kind == "slow":
            time.sleep(0.5 + random.random() / 2)
        tried[kind] += 1


def get(url: str, timeout: float = 10, patient: bool = True) -> tuple:
    """One page as a row of PAGE."""
    began = time.time()

    def read(reply: HTTPResponse) -> tuple:
        body = unpacked(reply.read(MAX_PAGE), reply.headers.get("Content-Encoding", ""))
        return reply.geturl(), decoded(body, reply.headers.get("Content-Type", ""))

    got, error, status = asked(url, timeout, "text/html,application/xhtml+xml,*/*", read, patient)
    return (url, got is not None, status, *(got or (None, None)), error, time.time() - began)


def get_bytes(url: str, timeout: float = 12) -> tuple:
    """One attachment as a row of ATTACHMENT: as much as MAX_BYTES of it, and its content type."""

    def read(reply: HTTPResponse) -> tuple:
        return (reply.headers.get_content_type() or "").lower(), unpacked(reply.read(MAX_BYTES), reply.headers.get("Content-Encoding", ""))

    got, _, _ = asked(url, timeout, "application/pdf,*/*", read)
    return (url, got is not None, *(got or ("", b"")))


def _per_host(urls: DataFrame, columns: list, parts: int, one: Callable, schema: str) -> DataFrame:
    """Rows that `one` gives for distinct requests; one host lives in one task, so it is asked one page at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in schema.split(", ")]
        for pdf in frames:
            yield pd.DataFrame([one(*r) for r in pdf.itertuples(index=False)], columns=names)

    wanted = urls.select(*columns).where("url IS NOT NULL").distinct()
    return wanted.repartition(parts, host_of(part(F.col("url"), "netloc"))).mapInPandas(run, schema)


def fetch(urls: DataFrame, url: str, parts: int, timeout: float = 10) -> DataFrame:
    """Pages of the distinct URLs. Where `urls` has a true `hurry`, the page gets half the time and one try."""
    hurry = F.col("hurry") if "hurry" in urls.columns else F.lit(False)
    one = lambda u, fast: get(u, max(3, timeout // 2) if fast else timeout, not fast)
    return _per_host(urls, [F.col(url).alias("url"), hurry.alias("hurry")], parts, one, PAGE)


def attachments(urls: DataFrame, url: str, parts: int, timeout: float = 12) -> DataFrame:
    """(url, text) of the attachments of the distinct URLs, '' for what can't be had or read."""
    got = _per_host(urls, [F.col(url).alias("url")], parts, lambda u: get_bytes(u, timeout), ATTACHMENT)
    return got.select("url", attachment_text(F.col("kind"), F.col("data")).alias("text"))


def attachment_text(kind: Column, data: Column) -> Column:
    """Text of attachment bytes by what they are: HTML, DOCX or else PDF; '' for what can't be read."""
    page = visible_text(F.make_valid_utf8(data.cast("string")))
    zipped = F.substring(data, 1, 4) == F.unhex(F.lit("504B0304"))
    document = F.when(zipped, docx_text(data)).otherwise(F.lit(""))
    return F.when(looks_like_html(kind, data), page).when(document != "", document).otherwise(F.coalesce(pdf_text(data), F.lit("")))


@F.pandas_udf(T.StringType())
def pdf_text(data: pd.Series) -> pd.Series:
    """Text of the first eight pages of PDFs; '' where no reader is installed."""
    try:
        from pypdf import PdfReader
    except ImportError:
        return pd.Series([""] * len(data))

    def one(blob: bytes | None) -> str:
        try:
            return "\n".join(page.extract_text() or "" for page in PdfReader(io.BytesIO(blob or b"")).pages[:8])
        except Exception:  # pypdf raises whatever a broken file leads it to
            return ""

    return data.map(one)


@F.pandas_udf(T.StringType())
def docx_text(data: pd.Series) -> pd.Series:
    """Paragraphs of DOCX files, one a line; '' for other archives."""
    space = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"

    def one(blob: bytes | None) -> str:
        try:
            with zipfile.ZipFile(io.BytesIO(blob or b"")) as archive, archive.open("word/document.xml") as part_file:
                paragraphs = ElementTree.parse(part_file).iter(f"{space}p")
                return "\n".join(" ".join("".join(t.text or "" for t in p.iter(f"{space}t")).split()) for p in paragraphs).strip()
        except (KeyError, OSError, zipfile.BadZipFile, ElementTree.ParseError):
            return ""

    return data.map(one)


def packed(text: str) -> bytes:
    """gzip of a text; used by tests and by stored pages."""
    return gzip.compress(text.encode())
