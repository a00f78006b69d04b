"""Duplicates hidden by formatting differences (problem 2).

Every record becomes a canonical key: school, sorted words of the title, canonical url. Records are
range-partitioned by the key's hash and sorted externally by (hash, full key, id); each range is then
scanned once and adjacent records are compared by their full keys. A run gives one representative, the
smallest id, and its exact number of copies.

Skew: a group of copies may hold a third of all rows. Keys that are frequent in a hash sample of the
rows get their rows dealt over all ranges (salted by id), so that their run comes in slices; only the slice
heads, at most (frequent keys x ranges) rows, are merged afterwards. The sample steers the placement
alone; every row is compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardloom.llm.text_keys import url_key, words
from boardloom.plans.work import durable, spread, width

SAMPLE = 64


def finding_key() -> Column:
    """Canonical key of a finding; NULL and '' of title or url are the same, a NULL school is its own school."""
    school = F.coalesce(F.col("school_code"), F.lit("\u0000"))
    return F.concat_ws("\u0002", school, F.array_join(F.array_sort(words(F.col("title"))), " "), url_key(F.col("url")))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adjacent comparison over one sorted range: (id, head, hot, key hash) of each row of a run."""
    last_key, last_head = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, ids = batch.column("key"), batch.column("id").to_numpy()
        fresh = np.ones(len(ids), dtype=bool)
        fresh[1:] = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
        fresh[0] = last_key is None or key[0].as_py() != last_key
        at = np.maximum.accumulate(np.where(fresh, np.arange(len(ids)), -1))
        head = np.where(at >= 0, ids[np.maximum(at, 0)], last_head if last_head is not None else 0)
        last_key, last_head = key[len(ids) - 1].as_py(), int(head[-1])
        hot = batch.column("hot").to_numpy(zero_copy_only=False)
        keep = hot | (head != ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[keep]), pa.array(head[keep]), pa.array(hot[keep]), batch.column("h1").filter(pa.array(keep)), batch.column("h2").filter(pa.array(keep))],
            names=["id", "head", "hot", "h1", "h2"],
        )


def copies(df: DataFrame, id_col: str, key: Column) -> DataFrame:
    """(kept, id) of every record that isn't the smallest id of its group of equal keys.

    `id_col` is a unique bigint. Defined cases: empty table - no rows; exactly equal records are copies;
    other columns, whatever their names, are ignored; keys of any length are compared in full.
    """
    ranges = width(df.sparkSession)
    keyed = df.select(F.col(id_col).alias("id"), key.alias("key"))
    hashed = keyed.withColumn("h1", F.xxhash64("key")).withColumn("h2", F.xxhash64(F.lit(7), F.col("key")))
    sample = hashed.where(F.pmod(F.xxhash64(F.lit(3), F.col("id")), F.lit(SAMPLE)) == 0).groupBy("h1").count()
    # a key is frequent if it would fill a quarter of a range; at most 4 x ranges keys can be
    rows = [(r["h1"], r["count"]) for r in sample.where("count > 8").orderBy(F.desc("count")).limit(8 * ranges).collect()]
    total = sum(n for _, n in rows) and sample.agg(F.sum("count")).head()[0]
    frequent = [h for h, n in rows if n * 4 * ranges > total]
    hot = F.col("h1").isin(frequent) if frequent else F.lit(False)
    place = F.when(hot, F.pmod(F.xxhash64("h1", "id"), F.lit(ranges))).otherwise(F.shiftrightunsigned("h1", 40) * ranges / F.lit(1 << 24))
    runs = hashed.withColumn("hot", hot).repartitionById(ranges, place.cast("int")).sortWithinPartitions("h1", "key", "id")
    found = runs.select("id", "key", "hot", "h1", "h2").mapInArrow(_scan, "id bigint, head bigint, hot boolean, h1 bigint, h2 bigint")
    if not frequent:
        return found.select(F.col("head").alias("kept"), "id")
    found = durable(found)
    heads = found.where("hot").groupBy("h1", "h2").agg(F.min("head").alias("kept"))
    merged = found.where("hot").join(F.broadcast(heads), ["h1", "h2"]).select("kept", "id").where("kept != id")
    return found.where("NOT hot").select(F.col("head").alias("kept"), "id").unionByName(merged)


def finding_copies(findings: DataFrame) -> DataFrame:
    """(kept_row_id, row_id) of the formatting copies in findings."""
    found = copies(spread(findings.select("row_id", "school_code", "title", "url")), "row_id", finding_key())
    return found.select(F.col("kept").alias("kept_row_id"), F.col("id").alias("row_id"))


def finding_groups(findings: DataFrame) -> DataFrame:
    """(kept_row_id, copies): one record per group of copies with its exact number of rows, singles included."""
    # each row counts for itself, each copy for the row that is kept and not for itself
    own = findings.select(F.col("row_id").alias("kept_row_id"), F.lit(1).alias("n"), F.lit(False).alias("gone"))
    moved = F.array(F.struct(F.col("kept_row_id"), F.lit(1).alias("n"), F.lit(False).alias("gone")), F.struct(F.col("row_id").alias("kept_row_id"), F.lit(0).alias("n"), F.lit(True).alias("gone")))
    every = own.unionByName(finding_copies(findings).select(F.inline(moved)))
    return every.groupBy("kept_row_id").agg(F.sum("n").alias("copies"), F.bool_or("gone").alias("gone")).where("NOT gone").drop("gone")
