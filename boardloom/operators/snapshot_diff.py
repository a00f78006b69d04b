"""What changed between consecutive full snapshots (problem 5).

Snapshots are kept range-partitioned and sorted by key: a new one is reduced to one row per key, shuffled once and
written; those before are never shuffled or sorted again. A merge of two snapshots gives each range to one task, which walks
both sorted files with two cursors, a row group of each at a time, compares the columns and emits typed changes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardloom.functions.urls import SPACE
from boardloom.plans import ranges
from boardloom.plans.work import width, work_folder

#: What stands for the NULL key in files.
_NONE = "\u0000"


def trimmed(c: Column) -> Column:
    """Value without outer white space of any kind (NULL stays NULL)."""
    return F.btrim(c, F.lit(SPACE))


def latest_per_key(df: DataFrame, date: str, key: Column, version: str, compared: dict[str, Column]) -> DataFrame:
    """One row per (snapshot, rec_key): the one with the greatest `version`; snapshot is the date as text.

    Ties are broken by the greatest compared values, so the result doesn't depend on row order; a NULL
    version counts as the oldest. The partial aggregate runs before the shuffle, so a key that holds a
    third of all rows leaves each map task as one row.
    """
    columns = [F.col(version).alias("__version"), *[c.alias(n) for n, c in compared.items()]]
    rows = df.where(F.col(date).isNotNull()).select(F.col(date).cast("string").alias("snapshot"), F.coalesce(key, F.lit(_NONE)).alias("rec_key"), F.struct(*columns).alias("__row"))
    best = rows.groupBy("snapshot", "rec_key").agg(F.max("__row").alias("__row"))
    return best.select("snapshot", "rec_key", *[F.col(f"__row.{n}").alias(n) for n in compared])


class Snapshots:
    """Snapshots of one table in a folder of storage that all executors share, by key range, sorted by key's hash and key."""

    def __init__(self, spark: SparkSession, folder: str, compared: Sequence[str], bits: int | None = None, group: int = ranges.GROUP) -> None:
        self.spark, self.folder, self.compared, self.group = spark, folder, list(compared), group
        self.bits = bits or ranges.bits_for(spark)

    def add(self, current: DataFrame) -> None:
        """Keep one or more new snapshots, as latest_per_key() gives them."""
        hashed = current.withColumn("h", F.xxhash64("rec_key"))
        ranges.write(hashed.withColumn("place", ranges.place(F.col("h"), self.bits)), self.folder, ["h", "rec_key"], ("snapshot",), self.group, "append")

    def changes(self, dates: Sequence[str]) -> DataFrame:
        """(snapshot_date, rec_key, change) between every two neighbours of `dates`, which are in order."""
        paths = [f"{self.folder}/snapshot={d}" for d in dates]
        runs = ranges.Runs(paths, "h", ["h", "rec_key", *self.compared])
        count = (1 << self.bits) * max(len(dates) - 1, 0)
        tasks = self.spark.range(0, count, 1, max(1, min(count, width(self.spark)))).select(F.col("id").alias("task"))
        return tasks.mapInArrow(_merge(runs, list(dates), self.compared), "snapshot_date string, rec_key string, change string")


def _blocks(old: Iterator[pa.RecordBatch], new: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, pa.Table]]:
    """Stretches of two runs sorted by h that cover the same keys: both cursors stop at the smaller of the last hashes read."""
    sources, heads, open_ = [old, new], [None, None], [True, True]
    while True:
        for n in (0, 1):
            while open_[n] and (heads[n] is None or not heads[n].num_rows):
                batch = next(sources[n], None)
                open_[n] = batch is not None
                heads[n] = pa.Table.from_batches([batch]) if open_[n] else heads[n]
        if heads[0] is None and heads[1] is None:
            return
        # rows of the last hash may go on in the next row group, so a run that isn't at its end keeps them
        limits = [h.column("h")[-1].as_py() if h is not None and h.num_rows else None for h in heads]
        bounds = [x for x, more in zip(limits, open_, strict=True) if x is not None and more]
        if not bounds:
            yield tuple(h if h is not None else other.schema.empty_table() for h, other in zip(heads, reversed(heads), strict=True))
            return
        limit = min(bounds)
        cut = [0 if h is None else int(np.searchsorted(h.column("h").to_numpy(), limit)) for h in heads]
        if not any(cut):  # nothing but rows of this hash: read on
            n = limits.index(limit) if open_[limits.index(limit)] else 1 - limits.index(limit)
            batch = next(sources[n], None)
            open_[n] = batch is not None
            if open_[n]:
                heads[n] = pa.concat_tables([heads[n], pa.Table.from_batches([batch])])
            continue
        schema = next(h for h in heads if h is not None).schema
        yield tuple(h.slice(0, c) if h is not None else schema.empty_table() for h, c in zip(heads, cut, strict=True))
        heads = [h.slice(c) if h is not None else None for h, c in zip(heads, cut, strict=True)]


def _merge(runs: ranges.Runs, dates: list[str], compared: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in (t for b in batches for t in b.column("task").to_pylist()):
            at, pair = divmod(task, len(dates) - 1)
            for old, new in _blocks(runs.scan(pair, at), runs.scan(pair + 1, at)):
                sides = pa.array(np.repeat(np.array([0, 1], np.int8), [old.num_rows, new.num_rows]))
                rows = pa.concat_tables([old, new]).append_column("side", sides)
                rows = rows.sort_by([(c, "ascending") for c in ("h", "rec_key", "side")]).combine_chunks()
                side = rows.column("side").to_numpy()
                a, b = rows.slice(0, max(rows.num_rows - 1, 0)), rows.slice(min(1, rows.num_rows))
                equal = lambda c, a=a, b=b: pc.fill_null(pc.equal(a.column(c), b.column(c)), False)
                pair_next = np.zeros(rows.num_rows + 1, bool)  # whether a row and the one before it are of one key
                pair_next[1:-1] = np.asarray(equal("rec_key"))
                other = np.zeros(rows.num_rows, bool)
                for c in compared:
                    none = pc.and_(pc.is_null(a.column(c)), pc.is_null(b.column(c)))
                    other[1:] |= ~np.asarray(pc.or_(equal(c), none))
                change = np.full(rows.num_rows, "", object)
                change[(side == 0) & ~pair_next[1:]] = "removed"
                change[(side == 1) & ~pair_next[:-1]] = "added"
                change[(side == 1) & pair_next[:-1] & other] = "changed"
                keep = change != ""
                keys = rows.column("rec_key").filter(pa.array(keep)).combine_chunks()
                keys = pc.if_else(pc.equal(keys, _NONE), pa.scalar(None, pa.string()), keys)
                told = [pa.array([dates[pair + 1]] * int(keep.sum()), pa.string()), keys, pa.array(change[keep].tolist(), pa.string())]
                yield pa.RecordBatch.from_arrays(told, names=["snapshot_date", "rec_key", "change"])

    return run


def snapshot_changes(df: DataFrame, date: str, key: Column, version: str, compared: dict[str, Column]) -> DataFrame:
    """(snapshot_date, rec_key, change) for every two consecutive dates; change is added, removed or changed.

    Defined cases: rows without a date belong to no snapshot; NULL is a key of its own; NULL equals NULL
    in a compared column; the first snapshot yields nothing; an empty table yields no rows. The distinct
    dates, one per delivery, are the only thing the driver sees.
    """
    dates = [r[0] for r in df.select(F.col(date).cast("string").alias("d")).where("d IS NOT NULL").distinct().orderBy("d").collect()]
    kept = Snapshots(df.sparkSession, work_folder(df.sparkSession, "snapshots"), list(compared))
    kept.add(latest_per_key(df, date, key, version, compared))
    return kept.changes(dates)


def finding_changes(df: DataFrame) -> DataFrame:
    """Changes of finding_snapshots: key fingerprint in lower case, compared by last_seen to the microsecond."""
    return snapshot_changes(df, "snapshot_date", F.lower(trimmed(F.col("fingerprint"))), "last_seen", {"last_seen": F.unix_micros("last_seen")})


def school_changes(df: DataFrame) -> DataFrame:
    """Changes of school_snapshots: key code in upper case, compared by trimmed trasparenza_url, NULL equal to ''."""
    url = F.coalesce(trimmed(F.col("trasparenza_url")), F.lit(""))
    return snapshot_changes(df, "snapshot_date", F.upper(trimmed(F.col("code"))), "last_discovery", {"trasparenza_url": url})


def all_changes(findings: DataFrame, schools: DataFrame) -> DataFrame:
    """(tab, snapshot_date, rec_key, change) of both snapshot tables."""
    parts = [("finding_snapshots", finding_changes(findings)), ("school_snapshots", school_changes(schools))]
    first, second = [d.select(F.lit(t).alias("tab"), "snapshot_date", "rec_key", "change") for t, d in parts]
    return first.unionByName(second)
