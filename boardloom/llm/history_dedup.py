"""Deduplicating new batches against all history (problem 3).

Multi-key sorted-neighbourhood runs. A record's words are ordered by rarity; if two titles differ by at most
three words, their rarest 3 + l words have at least l in common, so each combination of l of these words,
with the school, is a sort key and every such pair has a sort key in common. The history is kept as runs
sorted by sort key in persisted key ranges. A batch becomes one more sorted run; each of its records is compared with
the window of records that have the same sort key, for which only the row groups around that key are
read. Runs are merged when several of a size have gathered, each level into the next.

Records with equal words at one school are one group, of which only the earliest is kept: an equal title is
known by its group alone, and windows hold different titles only. A key of more than WINDOW titles is full: its
records get keys of more words (the next level) instead, which are persisted as well, so every record is
signed once a level. Full keys of the last level are compared in blocks, of which known rows come out, not pairs.
"""

from __future__ import annotations

import itertools
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.accumulators import Accumulator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boardloom.llm.text_keys import words
from boardloom.plans import ranges
from boardloom.plans.work import exists, file_system, remove, spread, width, work_folder

#: Words that may differ, words per key by level, titles of a window, and titles of a block of the last level.
DIFFER, LEVELS, WINDOW, BLOCK = 3, (2, 3, 4), 64, 512
#: A word is frequent from one in so many rows; their number is bounded by that share.
FREQUENT = 2_000
#: So many runs of one level are merged into one of the next.
FAN = 4
_MIX, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)
_SHORT = "\u0001"
RECORD = "g bigint, g2 bigint, ts bigint, row_id bigint, fresh boolean, school bigint, text string"
_SETS = ["g", "g2", "ts", "row_id", "fresh", "text"]


def _mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """Hash of a and b, in this order."""
    x = (a.astype(np.uint64) ^ (np.asarray(b).astype(np.uint64) + _GOLD)) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def records(findings: DataFrame) -> DataFrame:
    """(row_id, ts, fresh, school, text): what the operator needs of findings; text is the sorted words.

    A NULL first_seen counts as the earliest time, a NULL school as a school of its own, a NULL title as one
    without words.
    """
    ts = F.coalesce(F.unix_micros("first_seen"), F.lit(-(2**62)))
    fresh = F.coalesce(F.col("origin"), F.lit("nuovo")) != "archivio"
    text = F.array_join(F.array_sort(words(F.col("title"))), " ")
    return findings.select("row_id", ts.alias("ts"), fresh.alias("fresh"), F.xxhash64(F.coalesce("school_code", F.lit("\u0000"))).alias("school"), text.alias("text"))


def frequent_words(rows: DataFrame) -> DataFrame:
    """(w, place): hashes of the frequent words, from rare to frequent, counted over all rows of `rows`."""
    found = rows.select(F.explode(F.array_distinct(F.split("text", " "))).alias("word")).groupBy("word").count()
    floor = max(2, rows.count() // FREQUENT)
    return found.where(F.col("count") >= floor).select(F.xxhash64("word").alias("w"), F.row_number().over(Window.orderBy("count", "word")).alias("place"))


def _grouped(rows: DataFrame) -> DataFrame:
    """A row for each group of a record: its words at its school and, up to DIFFER words, the short titles of the school."""
    n = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", " ")))
    texts = F.when(n <= DIFFER, F.array("text", F.lit(_SHORT))).otherwise(F.array("text"))
    every = rows.select("ts", "row_id", "fresh", "school", F.explode(texts).alias("text"))
    return every.select(F.xxhash64("school", "text").alias("g"), F.xxhash64(F.lit(7), "school", "text").alias("g2"), "ts", "row_id", "fresh", "school", "text")


def _known(ids: list[int]) -> pa.RecordBatch:
    """Rows that are told to be known; hashes of their ids spread them."""
    row = np.array(ids, np.int64)
    told = {"g": pa.array(_mix(row.view(np.uint64), np.uint64(3)).view(np.int64)), "row_id": pa.array(row), "known": pa.array(np.ones(len(row), bool))}
    types = {"g": pa.int64(), "g2": pa.int64(), "ts": pa.int64(), "row_id": pa.int64(), "fresh": pa.bool_(), "school": pa.int64(), "text": pa.string(), "known": pa.bool_()}
    return pa.RecordBatch.from_arrays([told.get(c, pa.nulls(len(row), t)) for c, t in types.items()], names=list(types))


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups collapse before the shuffle: of each only rows that are the earliest so far go on, the others are known."""
    seen: dict[tuple[int, int], tuple[int, int, bool]] = {}
    for batch in batches:
        keep, known = [], []
        columns = [batch.column(c).to_pylist() for c in ("g", "g2", "ts", "row_id", "fresh")]
        for i, (g, g2, t, r, f) in enumerate(zip(*columns, strict=True)):
            old = seen.get((g, g2))
            if old is None or (t, r) < old[:2]:
                if old is not None and old[2]:
                    known.append(old[1])
                seen[g, g2] = (t, r, f)
                keep.append(i)
            elif f and (t, r) != old[:2]:
                known.append(r)
        if len(seen) > 400_000:
            seen.clear()
        rows = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.zeros(len(keep), bool))], names=[*rows.schema.names, "known"])
        if known:
            yield _known(known)


def _settle(sets: ranges.Runs):
    """Groups of a batch, sorted, against the groups of the history: new earliest rows, and rows that are known by their group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first = None, None
        for batch in batches:
            told = batch.filter(batch.column("known"))
            batch = batch.filter(pa.array(~np.asarray(batch.column("known").to_numpy(zero_copy_only=False))))
            if told.num_rows:
                yield told.drop_columns(["place"])
            g, at = batch.column("g").to_numpy(), batch.column("place").to_numpy()
            old: dict[tuple[int, int], tuple[int, int, bool]] = {}
            for one in np.unique(at):
                for _, rows in sets.find(int(one), np.unique(g[at == one])):
                    for a, b, *row in zip(*(rows.column(c).to_pylist() for c in ("g", "g2", "ts", "row_id", "fresh")), strict=True):
                        old[a, b] = min(old.get((a, b), tuple(row)), tuple(row))
            keep, known = [], []
            for i, (a, b, t, r, f) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("g", "g2", "ts", "row_id", "fresh")), strict=True)):
                if (a, b) != last:
                    last, first, there = (a, b), (t, r), old.get((a, b))
                    if there is None or (t, r) < there[:2]:
                        keep.append(i)
                        if there is not None and there[2]:
                            known.append(there[1])
                    else:
                        first = there[:2]
                if f and (t, r) > first:
                    known.append(r)
            yield batch.take(pa.array(keep, pa.int64())).drop_columns(["place"])
            if known:
                yield _known(known)

    return run


def _ordered(batch: pa.RecordBatch, rank_of: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes (repeats made distinct) and offsets, each row's words from rare to frequent."""
    lists = batch.column("toks")
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = lists.value_lengths().to_numpy()
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((flat, row))
    flat, row = flat[order], row[order]
    rank = np.zeros(len(flat), np.int64)
    if len(rank_of):
        at = np.minimum(np.searchsorted(rank_of, flat), len(rank_of) - 1)
        rank = np.where(rank_of[at] == flat, ranks[at], 0)
    first = np.ones(len(flat), bool)
    first[1:] = (flat[1:] != flat[:-1]) | (row[1:] != row[:-1])
    index = np.arange(len(flat))
    again = index - np.maximum.accumulate(np.where(first, index, 0))
    tok = np.where(again > 0, _mix(flat.view(np.uint64), again.astype(np.uint64)).view(np.int64), flat)
    return tok[np.lexsort((tok, rank, row))], np.concatenate([[0], np.cumsum(sizes)])


def _sign(frequent: np.ndarray, level: int):
    """(key, g): the sort keys of each record, of `level` words."""
    by_hash = np.argsort(frequent)
    rank_of, ranks = frequent[by_hash], by_hash + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tok, offsets = _ordered(batch, rank_of, ranks)
            n = np.diff(offsets)
            school, g = batch.column("school").to_numpy().view(np.uint64), batch.column("g").to_numpy()
            place = offsets[:-1, None] + np.arange(DIFFER + level)[None, :]
            there = np.arange(DIFFER + level)[None, :] < n[:, None]
            pre = np.where(there, tok[np.minimum(place, max(len(tok) - 1, 0))] if len(tok) else 0, 0).view(np.uint64)
            keys, ids = [], []
            # two titles of at most 3 + few words may share as few as `few` words; those have keys of their own
            for few in range(1, level + 1):
                fits = np.ones(len(n), bool) if few == level else n <= DIFFER + few
                for combo in itertools.combinations(range(DIFFER + few), few):
                    ok = fits & there[:, combo[-1]]
                    key = school[ok] if few == level else _mix(school[ok], np.uint64(10 + few))
                    for c in combo:
                        key = _mix(key, pre[ok, c])
                    keys.append(key.view(np.int64))
                    ids.append(g[ok])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))], names=["key", "g"])

    return run


PAIR, FULL, LAST = 0, 1, 2


def _windows(keys: ranges.Runs, own: int, window: int, last: bool):
    """Windows around the keys of the newest run: (kind, a, b) is a pair to compare, a record of a full key, or, on the last level, a member b of the full key a."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, key, ids = (batch.column(c).to_numpy() for c in ("place", "key", "g"))
            for one in np.unique(at):
                k, a = key[at == one], ids[at == one]
                wanted = np.unique(k)
                found = [(rows.column("key").to_numpy(), rows.column("g").to_numpy(), np.full(len(rows), n == own)) for n, rows in keys.find(int(one), wanted)]
                hk, hg, mine = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.lexsort((~mine, hg, hk))  # a record of the newest run comes before itself in the history
                hk, hg, mine = hk[order], hg[order], mine[order]
                new = np.ones(len(hk), bool)
                new[1:] = (hk[1:] != hk[:-1]) | (hg[1:] != hg[:-1])
                hk, hg, mine = hk[new], hg[new], mine[new]
                low, high = np.searchsorted(hk, k), np.searchsorted(hk, k, "right")
                full = high - low > window
                sizes = np.where(full, 0, high - low)
                left = np.repeat(a, sizes)
                right = hg[np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())]
                out = [(PAIR, np.minimum(left, right)[left != right], np.maximum(left, right)[left != right])]
                if full.any():
                    before = np.concatenate([[0], np.cumsum(~mine)])
                    for x, y in {*zip(low[full].tolist(), high[full].tolist(), strict=True)}:
                        if last:
                            out.append((LAST, np.full(y - x, hk[x]), hg[x:y]))
                        else:  # records that came before the key was full go on now, once
                            members = hg[x:y] if before[y] - before[x] <= window else hg[x:y][mine[x:y]]
                            out.append((FULL, members, members))
                for kind, x, y in out:
                    if len(x):
                        pairs = np.unique(np.stack([x, y]), axis=1)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(pairs.shape[1], kind, np.int8)), pa.array(pairs[0]), pa.array(pairs[1])], names=["kind", "a", "b"])

    return run


def _attach(sets: ranges.Runs, by: str, keep: list[str]):
    """The columns `keep` of each row with what the history holds of the group in column `by`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, g = batch.column("place").to_numpy(), batch.column(by).to_numpy()
            for one in np.unique(at):
                mine = np.flatnonzero(at == one)
                tables = [rows for _, rows in sets.find(int(one), np.unique(g[mine]))]
                if not tables:
                    continue
                rows = pa.concat_tables(tables)
                rows = rows.take(pa.array(np.argsort(rows.column("g").to_numpy(), kind="stable"))).combine_chunks()
                have = rows.column("g").to_numpy()
                low, high = np.searchsorted(have, g[mine]), np.searchsorted(have, g[mine], "right")
                left = pa.array(np.repeat(mine, high - low))
                right = np.repeat(low - np.concatenate([[0], np.cumsum(high - low)[:-1]]), high - low) + np.arange((high - low).sum())
                rows = rows.take(pa.array(right)).combine_chunks()
                told = [rows.column(c).combine_chunks() for c in ("ts", "row_id", "fresh", "text")]
                if rows.num_rows:
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).take(left) for c in keep), *told], names=[*keep, "ts", "row_id", "fresh", "text"])

    return run


def near(a: Counter, b: Counter) -> bool:
    """Whether two word multisets differ by at most DIFFER words added, dropped or replaced."""
    if abs(a.total() - b.total()) > DIFFER:
        return False
    return max(a.total(), b.total()) - (a & b).total() <= DIFFER


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fresh later row of each pair of titles that are near copies."""
    for batch in batches:
        out, bag, before = [], Counter(), None
        for t, r, f, text, t2, r2, f2, text2 in zip(*(batch.column(c).to_pylist() for c in ("ts_b", "row_b", "fresh_b", "text_b", "ts", "row_id", "fresh", "text")), strict=True):
            if (f if (t, r) > (t2, r2) else f2) and (t, r) != (t2, r2):
                if text != before:
                    bag, before = Counter(text.split(" ")), text
                if near(bag, Counter(text2.split(" "))):
                    out.append(max((t, r), (t2, r2))[1])
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["row_id"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Known rows of full keys of the last level: each block's rows, which come first, against all rows of its key."""
    block, held = None, []
    for batch in batches:
        out = []
        for k, n, own, t, r, f, text in zip(*(batch.column(c).to_pylist() for c in ("key", "block", "own", "ts", "row_id", "fresh", "text")), strict=True):
            if block != (k, n):
                block, held = (k, n), []
            bag = Counter(text.split(" "))
            if own:
                if f:
                    held.append(((t, r), bag))
                continue
            gone = {i for i, (at, mine) in enumerate(held) if (t, r) < at and near(bag, mine)}
            out += [held[i][0][1] for i in gone]
            held = [x for i, x in enumerate(held) if i not in gone]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["row_id"])


class HistoryIndex:
    """Persisted sorted runs of everything accepted, in key ranges, to check batches against.

    `folder` lies in storage shared by all executors. A manifest in it, replaced by a new one at each step, names
    the runs that count, so an index can be opened again and a broken step leaves only files that nobody reads.
    The words' order is set from the first batch and kept: it has to be common to all runs, not right. `bytes_read`
    counts what lookups read.
    """

    def __init__(self, spark: SparkSession, folder: str, bits: int | None = None, group: int = ranges.GROUP) -> None:
        self.spark, self.folder = spark, folder
        self.bytes_read: Accumulator = spark.sparkContext.accumulator(0)
        found = self._manifests()
        if found:
            self.state = json.loads(self._text(f"{folder}/manifest-{found[-1]:09d}.json"))
        else:
            self.state = {"version": 0, "bits": bits or ranges.bits_for(spark), "group": group, "runs": []}
        self._order: np.ndarray | None = None

    @property
    def runs(self) -> list[dict]:
        """Name and level of each run that counts."""
        return self.state["runs"]

    def _manifests(self) -> list[int]:
        if not exists(self.spark, self.folder):
            return []
        system, at = file_system(self.spark, self.folder)
        names = [str(f.getPath().getName()) for f in system.listStatus(at)]
        return sorted(int(n[9:18]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def _text(self, path: str) -> str:
        system, at = file_system(self.spark, path)
        stream = system.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _commit(self, runs: list[dict]) -> None:
        """Write the next manifest beside the last one and give it its name when it is complete."""
        self.state = {**self.state, "version": self.state["version"] + 1, "runs": runs}
        path = f"{self.folder}/manifest-{self.state['version']:09d}.json"
        system, part = file_system(self.spark, f"{path}.part")
        stream = system.create(part, True)
        stream.write(bytearray(json.dumps(self.state).encode()))
        stream.close()
        if not system.rename(part, file_system(self.spark, path)[1]):
            raise OSError(f"{path} is there already: another writer uses this index")
        for old in self._manifests()[:-2]:
            remove(self.spark, f"{self.folder}/manifest-{old:09d}.json")

    def _new_run(self) -> str:
        """A name that no run has, finished or not."""
        system, at = file_system(self.spark, self.folder)
        names = [str(f.getPath().getName()) for f in system.listStatus(at)] if exists(self.spark, self.folder) else []
        taken = [int(n[4:]) for n in names if n.startswith("run-")]
        return f"run-{max(taken, default=-1) + 1:09d}"

    def _table(self, what: str, names: list[str], key: str, columns: list[str]) -> ranges.Runs:
        return ranges.Runs([f"{self.folder}/{n}/{what}" for n in names], key, columns, self.bytes_read)

    def _frequent(self, batch: DataFrame | None) -> np.ndarray:
        """Hashes of the frequent words, from rare to frequent."""
        path = f"{self.folder}/order"
        if self._order is None:
            if batch is not None and not exists(self.spark, f"{path}/_SUCCESS"):
                frequent_words(batch).write.mode("overwrite").parquet(path)
            self._order = self.spark.read.parquet(path).orderBy("place").toPandas()["w"].to_numpy(np.int64)
        return self._order

    def _placed(self, df: DataFrame, key: str) -> DataFrame:
        return df.withColumn("place", ranges.place(F.col(key), self.state["bits"]))

    def accept(self, batch: DataFrame) -> DataFrame:
        """(row_id) of the fresh rows that are known now; the batch, as records() gives it, becomes a new run.

        A row is known if an earlier row, of the history or of the batch, is a copy or near copy. Defined cases: equal
        times go by row_id; titles of up to three words are near copies of each other; repeated rows are copies, a
        row that comes again under its own row_id is not; a late row is checked against what is earlier than it, and
        rows accepted before that it makes known come out too, some of them perhaps again; an empty batch gives no rows.
        """
        frequent = self._frequent(batch)
        name = self._new_run()
        found, names = f"{self.folder}/found-{name[4:]}", [r["name"] for r in self.runs]
        sets = self._table("sets/known=false", names, "g", _SETS)
        signed = self._placed(_grouped(batch).mapInArrow(_collapse, f"{RECORD}, known boolean"), "g")
        runs = signed.repartition(width(self.spark), "place").sortWithinPartitions("place", "g", "g2", "ts", "row_id")
        settled = self._placed(runs.mapInArrow(_settle(sets), f"{RECORD}, known boolean"), "g")
        ranges.write_sorted(settled, f"{self.folder}/{name}/sets", ["g", "g2"], ("known",), self.state["group"])
        own = self._of_run(name, "sets", RECORD)
        told = [own.where("known").select("row_id")]
        names.append(name)
        members = own.where(F.col("known").eqNullSafe(False) & (F.col("text") != _SHORT)).select("g", "school", "text")
        for level in LEVELS:
            keys, windows = f"keys{level}", f"{self.folder}/{name}/windows{level}"
            signed = members.select("g", "school", F.transform(F.split("text", " "), lambda w: F.xxhash64(w)).alias("toks")).mapInArrow(_sign(frequent, level), "key bigint, g bigint")
            ranges.write(self._placed(signed, "key"), f"{self.folder}/{name}/{keys}", ["key", "g"], group=self.state["group"])
            own = self._of_run(name, keys, "key bigint, g bigint")
            seen = own.mapInArrow(_windows(self._table(keys, names, "key", ["key", "g"]), len(names) - 1, WINDOW, level == LEVELS[-1]), "kind tinyint, a bigint, b bigint")
            seen.write.partitionBy("kind").parquet(windows)
            told += self._compared(windows, names)
            if not exists(self.spark, f"{windows}/kind={FULL}"):
                break
            full = self.spark.read.schema("a bigint, b bigint").parquet(f"{windows}/kind={FULL}").select(F.col("a").alias("g"))
            members = self._look_up(full, "g", [], names, ["school"], once=True)
        every = told[0]
        for more in told[1:]:
            every = every.unionByName(more)
        every.write.mode("overwrite").parquet(found)
        self._commit([*self.runs, {"name": name, "level": 0}])
        for level in LEVELS:
            remove(self.spark, f"{self.folder}/{name}/windows{level}")
        remove(self.spark, f"{self.folder}/{name}/sets/known=true")
        self.compact()
        return self.spark.read.schema("row_id bigint").parquet(found).distinct()

    def _of_run(self, name: str, what: str, schema: str) -> DataFrame:
        """A table of one run, as Spark reads it."""
        parts = "known boolean, place int" if what == "sets" else "place int"
        path = f"{self.folder}/{name}/{what}"
        return self.spark.read.schema(f"{schema}, {parts}").parquet(path)

    def _look_up(self, df: DataFrame, by: str, keep: list[str], names: list[str], more: list[str] | None = None, once: bool = False) -> DataFrame:
        """The rows of the history for the groups in column `by`, each beside the columns `keep`; `once` looks equal rows up once."""
        kinds = dict(df.dtypes)
        dealt = self._placed(df, by).repartition(width(self.spark), "place")
        if once:  # rows of one place lie together, so this needs no shuffle of its own
            dealt = dealt.groupBy("place", *df.columns).agg(F.lit(None)).select("place", *df.columns)
        dealt = dealt.sortWithinPartitions("place", by)
        if more:  # columns of the group itself, each group once
            sets = self._table("sets/known=false", names, "g", ["g", *more, "text"])
            return dealt.mapInArrow(_members(sets), "g bigint, school bigint, text string").dropDuplicates(["g", "text"])
        sets = self._table("sets/known=false", names, "g", _SETS)
        return dealt.mapInArrow(_attach(sets, by, keep), ", ".join([f"{c} {kinds[c]}" for c in keep] + ["ts bigint, row_id bigint, fresh boolean, text string"]))

    def _compared(self, windows: str, names: list[str]) -> list[DataFrame]:
        """Known rows among the pairs of the windows, and of full keys of the last level."""
        out = []
        if exists(self.spark, f"{windows}/kind={PAIR}"):
            pairs = self.spark.read.schema("a bigint, b bigint").parquet(f"{windows}/kind={PAIR}")
            with_b = self._look_up(pairs, "b", ["a"], names, once=True).withColumnsRenamed({"ts": "ts_b", "row_id": "row_b", "fresh": "fresh_b", "text": "text_b"})
            both = self._look_up(with_b, "a", ["ts_b", "row_b", "fresh_b", "text_b"], names)
            out.append(both.mapInArrow(_later, "row_id bigint"))
        if exists(self.spark, f"{windows}/kind={LAST}"):
            members = self.spark.read.schema("a bigint, b bigint").parquet(f"{windows}/kind={LAST}").distinct()
            sized = members.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
            rows = self._look_up(members.withColumnRenamed("a", "key").join(sized.withColumnRenamed("a", "key"), "key"), "b", ["key", "blocks"], names)
            own = rows.withColumn("own", F.lit(True)).withColumn("block", F.pmod(F.xxhash64("row_id"), F.col("blocks")))
            every = rows.withColumn("own", F.lit(False)).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            dealt = own.unionByName(every).repartition(width(self.spark), "key", "block").sortWithinPartitions("key", "block", F.desc("own"), "ts", "row_id")
            out.append(dealt.mapInArrow(_blocks, "row_id bigint"))
        return out

    def compact(self, fan: int | None = None) -> None:
        """Merge runs of one level into one of the next wherever `fan` of them (FAN) have gathered; the old files go.

        Each range is merged by one task without a shuffle. Of a group the earliest row stays, of a key each group once.
        """
        fan = fan or FAN
        while True:
            levels = Counter(r["level"] for r in self.runs)
            level = min((n for n, c in levels.items() if c >= fan), default=None)
            if level is None:
                return
            old = [r["name"] for r in self.runs if r["level"] == level]
            name, count = self._new_run(), 1 << self.state["bits"]
            places = self.spark.range(0, count, 1, min(count, width(self.spark))).select(F.col("id").cast("int").alias("place"))
            merged = places.mapInArrow(_merged(self._table("sets/known=false", old, "g", [*_SETS, "school"]), ["g", "g2"], ["ts", "row_id"]), f"place int, {RECORD}")
            ranges.write_sorted(merged, f"{self.folder}/{name}/sets/known=false", ["g", "g2"], group=self.state["group"])
            for n in LEVELS:
                have = [r for r in old if exists(self.spark, f"{self.folder}/{r}/keys{n}")]
                if have:
                    keys = places.mapInArrow(_merged(self._table(f"keys{n}", have, "key", ["key", "g"]), ["key", "g"], []), "place int, key bigint, g bigint")
                    ranges.write_sorted(keys, f"{self.folder}/{name}/keys{n}", ["key", "g"], group=self.state["group"])
            self._commit([*[r for r in self.runs if r["level"] != level], {"name": name, "level": level + 1}])
            for r in old:
                remove(self.spark, f"{self.folder}/{r}")

    def drop_runs(self) -> None:
        """Remove the runs; what accept() found stays readable."""
        for r in self.runs:
            remove(self.spark, f"{self.folder}/{r['name']}")
        self._commit([])


def _members(sets: ranges.Runs):
    """(g, school, text) of the groups looked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, g = batch.column("place").to_numpy(), batch.column("g").to_numpy()
            for one in np.unique(at):
                for _, rows in sets.find(int(one), np.unique(g[at == one])):
                    yield from rows.select(["g", "school", "text"]).to_batches()

    return run


def _merged(runs: ranges.Runs, key: list[str], first_by: list[str]):
    """Each place with the rows of its range of all runs, merged by key; of equal keys the first by `first_by`.

    Ranges of several runs are walked side by side, as far as the slowest has been read, so memory holds a row group a run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at in (p for b in batches for p in b.column("place").to_pylist()):
            sources = [runs.scan(n, at) for n in range(len(runs.paths))]
            heads: list[pa.Table | None] = [None] * len(sources)
            while True:
                for n, source in enumerate(sources):
                    while heads[n] is None or not heads[n].num_rows:
                        batch = next(source, None)
                        if batch is None:
                            heads[n] = None
                            break
                        heads[n] = pa.Table.from_batches([batch])
                live = [h for h in heads if h is not None]
                if not live:
                    break
                # up to here every run has shown all it has
                limit = min(h.column(key[0])[-1].as_py() for h in live)
                taken = []
                for n, h in enumerate(heads):
                    if h is not None:
                        cut = int(np.searchsorted(h.column(key[0]).to_numpy(), limit, "right"))
                        more = h.num_rows == cut
                        taken.append(h.slice(0, cut))
                        heads[n] = h.slice(cut)
                        while more:  # the same key may go on in the next batch
                            batch = next(sources[n], None)
                            if batch is None:
                                break
                            rest = pa.Table.from_batches([batch])
                            cut = int(np.searchsorted(rest.column(key[0]).to_numpy(), limit, "right"))
                            taken.append(rest.slice(0, cut))
                            heads[n] = rest.slice(cut)
                            more = rest.num_rows == cut
                rows = pa.concat_tables(taken)
                rows = rows.sort_by([(c, "ascending") for c in [*key, *first_by]]).combine_chunks()
                parts = [rows.column(c).to_numpy() for c in key]
                new = np.ones(rows.num_rows, bool)
                new[1:] = np.any([x[1:] != x[:-1] for x in parts], axis=0)
                rows = rows.filter(pa.array(new)).add_column(0, "place", pa.array(np.full(int(new.sum()), at, np.int32)))
                names = ["place", "g", "g2", "ts", "row_id", "fresh", "school", "text"] if "text" in rows.column_names else ["place", "key", "g"]
                yield from rows.select(names).combine_chunks().to_batches()

    return run


def load_of() -> F.Column:
    """The load of a record: the month it was first seen in; the earliest for rows without a time."""
    return F.date_format(F.timestamp_micros(F.greatest("ts", F.lit(0))), "yyyyMM").cast("int")


def known_findings(findings: DataFrame) -> DataFrame:
    """(row_id) of the findings, not from the archive, whose notice was known at their school before.

    A backlog is caught up in loads of a month of first_seen, each accepted by a HistoryIndex made for this run in the shared
    folder; the days of a load are checked against the history and against each other, as they would be one by one.
    """
    spark = findings.sparkSession
    folder = work_folder(spark, "history")
    rows = records(spread(findings.select("row_id", "first_seen", "origin", "school_code", "title")))
    rows.withColumn("load", load_of()).write.partitionBy("load").option("compression", "zstd").parquet(f"{folder}/arrivals")
    schema = "row_id bigint, ts bigint, fresh boolean, school bigint, text string"
    arrivals = spark.read.schema(f"{schema}, load int").parquet(f"{folder}/arrivals")
    index = HistoryIndex(spark, f"{folder}/index")
    for load in sorted(r["load"] for r in arrivals.select("load").distinct().collect()):
        index.accept(arrivals.where(F.col("load") == load).drop("load"))
    index.drop_runs()
    remove(spark, f"{folder}/arrivals")
    if not index.state["version"] > 1:
        return spark.createDataFrame([], "row_id bigint")
    return spark.read.schema("row_id bigint").parquet(f"{folder}/index/found-*").distinct()


