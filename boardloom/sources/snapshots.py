"""Dated snapshots as JSON: writing, finding the latest and reading."""

from __future__ import annotations

import datetime as dt
import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from boardloom.operators.listing import snapshot, snapshot_meta


def write_snapshot(findings: DataFrame, folder: str, day: dt.date, counters: dict | None = None) -> str:
    """Write one file per day, over an earlier one of the day; rows are streamed, newest first."""
    from pyspark.sql import functions as F

    as_of = F.lit(day)
    meta = {"date": day.isoformat(), **(counters or {}), **snapshot_meta(findings, as_of).head().asDict()}
    rows = snapshot(findings, as_of).orderBy(F.col("first_seen").desc_nulls_last(), "fingerprint")
    path = Path(folder) / f"snapshot-{day.isoformat()}.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", encoding="utf-8") as out:
        out.write('{"meta": ' + json.dumps(meta, ensure_ascii=False) + ', "findings": [')
        for i, line in enumerate(rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator()):
            out.write(("," if i else "") + "\n" + line["j"])
        out.write("\n]}\n")
    return str(path)


def latest(folder: str, today: dt.date, days: int = 24) -> str | None:
    """The newest snapshot of the last days, or None."""
    found = {}
    for p in Path(folder).glob("snapshot-*.json") if Path(folder).is_dir() else ():
        if m := re.fullmatch(r"snapshot-(\d{4}-\d{2}-\d{2})\.json", p.name):
            day = dt.date.fromisoformat(m[1])
            if today - dt.timedelta(days=days) <= day <= today:
                found[day] = str(p)
    return found[max(found)] if found else None


def read_findings(spark: SparkSession, path: str) -> DataFrame:
    """The findings of a snapshot file."""
    from pyspark.sql import functions as F

    return spark.read.json(path, multiLine=True).select(F.explode("findings").alias("f")).select("f.*")
