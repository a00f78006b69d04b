"""Versioned state: upserts and updates as joins that give a new version; nothing is changed in place."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _TS = T.StringType(), T.TimestampType()
SCHOOLS = T.StructType(
    [T.StructField(c, _S) for c in ("code", "name", "region", "province", "city", "site_url", "resolved_url", "platform", "trasparenza_url")]
    + [T.StructField("reachable", T.BooleanType()), T.StructField("last_discovery", _TS), T.StructField("discovery_note", _S), T.StructField("first_crawled", _TS)]
)
FINDINGS = T.StructType(
    [T.StructField(c, _S) for c in ("fingerprint", "school_code", "school_name", "province", "region", "title", "url", "category")]
    + [T.StructField("score", T.DoubleType()), T.StructField("source_page", _S), T.StructField("first_seen", _TS), T.StructField("last_seen", _TS), T.StructField("origin", _S)]
    + [T.StructField("scadenza", T.DateType()), T.StructField("scadenza_checked", _TS), T.StructField("ai_checked", _TS), T.StructField("ai_bando", T.BooleanType())]
    + [T.StructField(c, _S) for c in ("titolo_pulito", "profilo", "doc_url")]
)
RUNS = T.StructType([T.StructField("id", T.LongType()), T.StructField("started_at", _TS), T.StructField("phase", _S), T.StructField("processed", T.LongType()), T.StructField("hits", T.LongType())])
METADATA = ("name", "region", "province", "city", "site_url")


def evolved(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with the columns of `schema` it lacks, as NULL; running it again changes nothing."""
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in df.columns])


def one_per_key(batch: DataFrame, key: str, order: Column) -> DataFrame:
    """The first row of each key, combined before the shuffle; a join with repeated keys would fan out."""
    best = batch.groupBy(key).agg(F.min_by(F.struct(*[c for c in batch.columns if c != key]), order).alias("__row"))
    return best.select(key, "__row.*").select(*batch.columns)


def insert_or_touch(state: DataFrame, batch: DataFrame, now: Column, order: Column) -> DataFrame:
    """Findings after a batch: new fingerprints come in, known ones only get a new last_seen.

    `batch` has the columns of a finding known at sight; origin defaults to 'nuovo'. The result has is_new.
    """
    incoming = one_per_key(batch, "fingerprint", order)
    b = {c: f"b_{c}" for c in incoming.columns}
    joined = state.join(incoming.withColumnsRenamed(b).withColumn("__in", F.lit(True)), F.col("fingerprint") == F.col("b_fingerprint"), "full_outer")
    new = F.col("fingerprint").isNull()
    stamped = {"first_seen": now, "last_seen": now, "origin": F.coalesce(F.col("b_origin") if "origin" in b else F.lit(None), F.lit("nuovo"))}
    out = []
    for c in state.columns:
        fresh = stamped.get(c, F.col(b[c]) if c in b else F.lit(None))
        kept = F.when(F.col("__in"), now).otherwise(F.col(c)) if c == "last_seen" else F.col(c)
        out.append(F.when(new, fresh).otherwise(kept).alias(c))
    return joined.select(*out, new.alias("is_new"))


def upsert_schools(state: DataFrame, registry: DataFrame, order: Column) -> DataFrame:
    """Schools after a registry delivery: metadata from the delivery, what was discovered is kept."""
    incoming = one_per_key(registry.select("code", *METADATA), "code", order)
    joined = state.join(incoming.withColumnsRenamed({c: f"b_{c}" for c in METADATA}).withColumnRenamed("code", "b_code"), F.col("code") == F.col("b_code"), "full_outer")
    delivered = F.col("b_code").isNotNull()
    out = []
    for c in state.columns:
        if c == "code":
            out.append(F.coalesce("code", "b_code").alias(c))
        elif c in METADATA:
            out.append(F.when(delivered, F.col(f"b_{c}")).otherwise(F.col(c)).alias(c))
        elif c == "reachable":
            out.append(F.coalesce(c, F.lit(False)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def updated(state: DataFrame, changes: DataFrame, key: str, values: dict[str, str]) -> DataFrame:
    """State with the columns named in `values` overwritten, NULL included, where a change has the key.

    `values` maps a column of the state to a column of `changes`, which is unique by key.
    """
    side = changes.select(F.col(key).alias("__key"), *[F.col(v).alias(f"__{c}") for c, v in values.items()])
    joined = state.join(side, F.col(key) == F.col("__key"), "left")
    hit = F.col("__key").isNotNull()
    return joined.select(*[F.when(hit, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in state.columns])


def record_discovery(schools: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """Schools with the outcome of a discovery and its time."""
    columns = ("resolved_url", "platform", "trasparenza_url", "reachable", "discovery_note")
    stamped = results.withColumn("last_discovery", now)
    return updated(schools, stamped, "code", {c: c for c in (*columns, "last_discovery")})


def mark_crawled(schools: DataFrame, crawled: DataFrame, now: Column) -> DataFrame:
    """Schools with first_crawled set where it is NULL and the code was crawled."""
    marks = crawled.select(F.col("code").alias("__key")).distinct().withColumn("__now", now)
    joined = schools.join(marks, F.col("code") == F.col("__key"), "left")
    return joined.select(*[F.coalesce(c, F.col("__now")).alias(c) if c == "first_crawled" else F.col(c) for c in schools.columns])


def set_deadlines(findings: DataFrame, found: DataFrame, now: Column) -> DataFrame:
    """Findings with the deadlines found (NULL too) and the check marked."""
    return updated(findings, found.withColumn("__at", now), "fingerprint", {"scadenza": "scadenza", "scadenza_checked": "__at"})


def set_reviews(findings: DataFrame, reviews: DataFrame, now: Column) -> DataFrame:
    """Findings with review verdicts; a review overwrites the deadline even with NULL, '' becomes NULL."""
    texts = ("titolo_pulito", "profilo", "doc_url")
    plain = reviews.select("fingerprint", "ai_bando", "scadenza", *[F.nullif(F.col(c), F.lit("")).alias(c) for c in texts]).withColumn("__at", now)
    return updated(findings, plain, "fingerprint", {"ai_bando": "ai_bando", "scadenza": "scadenza", "ai_checked": "__at", **{c: c for c in texts}})


def reset_reviews(findings: DataFrame) -> tuple[DataFrame, Column]:
    """Findings with the visible reviews (no verdict or a positive one) taken back, and the condition."""
    visible = F.col("ai_bando").isNull() | F.col("ai_bando")
    return findings.withColumn("ai_checked", F.when(~visible, F.col("ai_checked"))).withColumn("ai_bando", F.when(~visible, F.col("ai_bando"))), visible


def origin(first_crawled: Column) -> Column:
    """archivio for the first crawl of a school, nuovo afterwards; from the state before the run."""
    return F.when(first_crawled.isNull(), "archivio").otherwise("nuovo")


def pending(rows: DataFrame, marker: str, most: int = 0) -> DataFrame:
    """Rows not marked yet, newest first; 0 means all."""
    todo = rows.where(F.col(marker).isNull()).orderBy(F.desc("first_seen"), "fingerprint")
    return todo.limit(most) if most else todo


class Versions:
    """A table as a folder of numbered parquet versions; a version is written whole, then read."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType) -> None:
        self.spark, self.folder, self.schema = spark, folder, schema

    def latest(self) -> int:
        """Number of the last complete version, 0 if there is none."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return 0
        numbers = [int(m[1]) for s in fs.listStatus(path) if (m := re.fullmatch(r"v(\d+)", s.getPath().getName())) and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return max(numbers, default=0)

    def read(self) -> DataFrame:
        """The last version, with columns it lacks; empty where there is none."""
        n = self.latest()
        return evolved(self.spark.read.parquet(f"{self.folder}/v{n:06d}"), self.schema) if n else self.spark.createDataFrame([], self.schema)

    def write(self, df: DataFrame) -> int:
        """Write the next version and give its number."""
        n = self.latest() + 1
        df.write.mode("overwrite").parquet(f"{self.folder}/v{n:06d}")
        return n

    def reset(self) -> int:
        """An empty next version."""
        return self.write(self.spark.createDataFrame([], self.schema))


def log_run(runs: DataFrame, started: Column, phase: str, processed: int, hits: int) -> DataFrame:
    """One row to append to the log of runs."""
    last = runs.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last"))
    return last.select((F.col("last") + 1).alias("id"), started.alias("started_at"), F.lit(phase).alias("phase"), F.lit(processed).cast("bigint").alias("processed"), F.lit(hits).cast("bigint").alias("hits"))
