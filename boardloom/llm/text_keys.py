"""Canonical forms shared by the duplicate operators, as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boardloom.functions.urls import stripped

WORD = r"[\p{L}\p{N}]+"


def words(c: Column) -> Column:
    """Words of a text: runs of letters and digits, case folded (upper, then lower); NULL gives []."""
    return F.coalesce(F.regexp_extract_all(F.lower(F.upper(c)), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def url_key(c: Column) -> Column:
    """URL without letter case, outer white space, closing slash of the path and order of parameters."""
    bare = F.lower(stripped(c))
    path = F.regexp_replace(F.regexp_extract(bare, r"^([^?#]*)", 1), "/$", "")
    query = F.regexp_extract(bare, r"^[^?#]*\?([^#]*)", 1)
    return F.concat_ws("\u0001", path, F.array_join(F.array_sort(F.split(query, "&")), "&"), F.regexp_extract(bare, r"^[^#]*(#.*)$", 1))
