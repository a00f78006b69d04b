"""Grouped statistics of the discovery, as tables and as the two report files."""

from __future__ import annotations

import csv
import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAP_COLUMNS = ("code", "name", "region", "province", "city", "platform", "reachable", "trasparenza_url", "discovery_note")


def found(c: str = "trasparenza_url") -> Column:
    """Whether a school has a notice page; NULL and '' mean none."""
    return F.coalesce(F.col(c), F.lit("")) != ""


def percent(a: Column, b: Column) -> Column:
    """100 a / b to one decimal, 0 where b is 0."""
    return F.when(b == 0, 0.0).otherwise(F.round(100 * a / b, 1))


def named(c: str, otherwise: str) -> Column:
    """A group's name, with a stand-in for NULL and ''."""
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(otherwise))


def _counts() -> list[Column]:
    return [F.count("*").alias("totale"), F.count_if("reachable").alias("raggiungibili"), F.count_if(found()).alias("trasparenza")]


def _with_percent(df: DataFrame) -> DataFrame:
    return df.withColumn("raggiungibili_pct", percent(F.col("raggiungibili"), F.col("totale"))).withColumn("trasparenza_pct", percent(F.col("trasparenza"), F.col("totale")))


def totals(schools: DataFrame) -> DataFrame:
    """Schools, reachable ones and ones with a notice page, with percentages."""
    return _with_percent(schools.agg(*_counts()))


def by_region(schools: DataFrame) -> DataFrame:
    """The same per region."""
    return _with_percent(schools.groupBy(named("region", "?").alias("region")).agg(*_counts()))


def platforms(schools: DataFrame) -> DataFrame:
    """Reachable schools per platform."""
    return schools.where("reachable").groupBy(named("platform", "unknown").alias("platform")).agg(F.count("*").alias("n"))


def notes(schools: DataFrame) -> DataFrame:
    """Schools per outcome of the discovery."""
    return schools.groupBy(named("discovery_note", "?").alias("note")).agg(F.count("*").alias("n"))


def most_common(schools: DataFrame, c: str, otherwise: str) -> DataFrame:
    """Values by falling frequency; ties by the first school in (region, province, code) order."""
    first = F.min(F.struct("region", "province", "code"))
    return schools.groupBy(named(c, otherwise).alias("value")).agg(F.count("*").alias("n"), first.alias("__first")).orderBy(F.desc("n"), "__first").select("value", "n")


def all_groupings(schools: DataFrame) -> DataFrame:
    """Totals, regions, platforms and notes in one pass with grouping sets."""
    named_rows = schools.select(named("region", "?").alias("region"), F.when(F.col("reachable"), named("platform", "unknown")).otherwise("-").alias("platform"), named("discovery_note", "?").alias("note"), "reachable", found().alias("found"))
    sets = [[], [F.col("region")], [F.col("platform")], [F.col("note")]]
    out = named_rows.groupingSets(sets, "region", "platform", "note").agg(F.grouping_id().alias("gid"), F.count("*").alias("totale"), F.count_if("reachable").alias("raggiungibili"), F.count_if("found").alias("trasparenza"))
    return out.select("region", "platform", "note", F.col("gid").cast("int").alias("gid"), "totale", "raggiungibili", "trasparenza")


def write_report(schools: DataFrame, report_path: str, csv_path: str, generated: str) -> dict:
    """Write the report (JSON) and the map (CSV); groups are few, the map is streamed row by row."""
    total = totals(schools).head()
    report = {
        "meta": {
            "generato": generated,
            "scuole_totali": total["totale"],
            "raggiungibili": total["raggiungibili"],
            "raggiungibili_pct": total["raggiungibili_pct"],
            "trasparenza_trovata": total["trasparenza"],
            "trasparenza_pct": total["trasparenza_pct"],
        },
        "per_regione": {r["region"]: {k: v for k, v in r.asDict().items() if k != "region"} for r in by_region(schools).orderBy("region").collect()},
        "piattaforme": {r["value"]: r["n"] for r in most_common(schools.where("reachable"), "platform", "unknown").collect()},
        "esiti_discovery": {r["value"]: r["n"] for r in most_common(schools, "discovery_note", "?").collect()},
    }
    Path(report_path).parent.mkdir(parents=True, exist_ok=True)
    Path(report_path).write_text(json.dumps(report, indent=2, ensure_ascii=False), encoding="utf-8")
    with open(csv_path, "w", newline="", encoding="utf-8") as out:
        lines = csv.writer(out)
        lines.writerow(MAP_COLUMNS)
        for row in schools.select(*MAP_COLUMNS[:6], F.col("reachable").cast("int"), *MAP_COLUMNS[7:]).orderBy("region", "province", "code").toLocalIterator():
            lines.writerow(row)
    return report
