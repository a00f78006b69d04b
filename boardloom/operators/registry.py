"""Registry of sites: tolerant CSV reading and its de-duplication."""

from __future__ import annotations

import os
import urllib.request
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boardloom.functions.urls import clean_url, stripped

# Header names of the registry, in order of preference.
HEADERS = {
    "code": ("codicescuola", "codiceistitutoriferimento", "codicemeccanografico"),
    "name": ("denominazionescuola", "denominazioneistitutoriferimento"),
    "region": ("regione", "descrizioneregione"),
    "province": ("provincia", "descrizioneprovincia", "siglaprovincia"),
    "city": ("descrizionecomune", "comune"),
    "website": ("sitowebscuola", "sitoweb", "indirizzowebscuola"),
}


def delimiter(first_line: str) -> str:
    """The first of , ; | and tab that occurs in a header line."""
    return next((d for d in ",;|\t" if d in first_line), ",")


def resolve_headers(columns: list[str]) -> dict[str, str]:
    """Logical name to real column; of columns that read alike the last wins. Code and region must be there."""
    plain = {re.sub(r"[^a-z0-9]", "", c.lower()): c for c in columns}
    found = {name: plain[a] for name, aliases in HEADERS.items() for a in reversed(aliases) if a in plain}
    if not {"code", "region"} <= found.keys():
        raise ValueError(f"registry schema not recognised: {columns}")
    return found


def read_registry(spark: SparkSession, path: str, regions: list[str]) -> DataFrame:
    """Schools of the regions named, cleaned, one row per code, in the file's order (column `pos`)."""
    first = spark.read.text(path).limit(1).collect()
    header = first[0][0].lstrip("﻿") if first else ""
    raw = spark.read.csv(path, header=True, sep=delimiter(header), multiLine=True, quote='"', escape='"')
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    return registry(raw.withColumn("__pos", F.monotonically_increasing_id()), "__pos", regions)


def registry(raw: DataFrame, pos: str, regions: list[str]) -> DataFrame:
    """Registry rows of any header spelling as code, name, region, province, city, website, pos."""
    real = resolve_headers([c for c in raw.columns if c != pos])
    region = F.upper(stripped(F.col(f"`{real['region']}`")))

    def field(name: str) -> Column:
        return stripped(F.col(f"`{real[name]}`")) if name in real else F.lit("")

    site = clean_url(F.col(f"`{real['website']}`")) if "website" in real else F.lit("")
    chosen = raw.where(region.isin([r.strip().upper() for r in regions]))
    rows = chosen.select(field("code").alias("code"), field("name").alias("name"), region.alias("region"), field("province").alias("province"), field("city").alias("city"), site.alias("website"), F.col(pos).alias("pos"))
    return prefer_with_site(rows.where("code != ''"), "code", "website", "pos")


def prefer_with_site(rows: DataFrame, key: str, site: str, pos: str) -> DataFrame:
    """One row per key: the first one with a site, else the first; it takes the place of the key's first row.

    The choice is an aggregate, not a window, so a key with any number of rows is combined before the shuffle.
    """
    missing = F.coalesce(F.col(site), F.lit("")) == ""
    best = rows.groupBy(key).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in (key, pos)]), F.struct(missing, F.col(pos))).alias("__row"), F.min(pos).alias(pos))
    return best.select(*[F.col(c) if c in (key, pos) else F.col(f"__row.`{c}`").alias(c) for c in rows.columns])


def first_per_key(rows: DataFrame, key: Column, order: Column, key_name: str) -> DataFrame:
    """Representatives: the row of the smallest `order` of each key; rows of an empty key are left out."""
    keyed = rows.withColumn(key_name, key).where(F.coalesce(F.col(key_name), F.lit("")) != "")
    best = keyed.groupBy(key_name).agg(F.min_by(F.struct(*rows.columns), order).alias("__row"))
    return best.select(key_name, "__row.*")


def propagate(schools: DataFrame, key: Column, results: DataFrame, key_name: str) -> DataFrame:
    """The result of each site given to all its schools; `results` is unique by key_name."""
    return schools.withColumn(key_name, key).join(results, key_name)


def ranked(rows: DataFrame, by: list[str], order: list[Column], most: int) -> DataFrame:
    """The first `most` rows of each group."""
    place = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(place)).where(F.col("place") <= most)


def cached_file(path: str, url: str | None = None) -> str:
    """The path of a registry file; if it isn't there, or empty, it is fetched from `url` first and appears when it is complete."""
    if url and not (os.path.exists(path) and os.path.getsize(path) > 0):
        os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
        urllib.request.urlretrieve(url, f"{path}.part")
        os.replace(f"{path}.part", path)
    return path
