"""Sorted key ranges in shared storage: written by Spark, looked up and merged by tasks.

A table is cut into 2^bits ranges of a bigint key (its highest bits) and sorted by key in each. Row groups are
small, and their statistics say which keys they span, so a task that looks for some keys reads the row
groups around these keys and nothing else, however long the range has grown.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.accumulators import Accumulator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardloom.plans.work import width

#: Bytes of a row group before compression.
GROUP = 1 << 18


def bits_for(spark: SparkSession) -> int:
    """Bits of the key that give at least one range for each shuffle partition."""
    return max(1, (width(spark) - 1).bit_length())


def place(key: Column, bits: int) -> Column:
    """The range of a bigint key."""
    return F.shiftrightunsigned(key, 64 - bits).cast("int")


def write(df: DataFrame, path: str, order: list[str], parts: tuple[str, ...] = (), group: int = GROUP, mode: str = "errorifexists") -> None:
    """Write the rows of df, which has a column `place`, by `parts` and place, sorted by `order` in each."""
    write_sorted(df.repartition(width(df.sparkSession), *parts, "place"), path, order, parts, group, mode)


def write_sorted(df: DataFrame, path: str, order: list[str], parts: tuple[str, ...] = (), group: int = GROUP, mode: str = "errorifexists") -> None:
    """As write(), for rows of which each place already lies in one partition."""
    out = df.sortWithinPartitions(*parts, "place", *order)
    out.write.mode(mode).partitionBy(*parts, "place").option("compression", "zstd").option("parquet.block.size", str(group)).parquet(path)


def located(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a folder and the path in it."""
    bare = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(bare) if "://" in bare else (fs.LocalFileSystem(), bare)


class Runs:
    """The sorted runs of one table, as tasks see them; `read` counts the bytes of the row groups that are read."""

    def __init__(self, paths: list[str], key: str, columns: list[str], read: Accumulator | None = None) -> None:
        self.paths, self.key, self.columns, self.read = paths, key, columns, read

    def files(self, run: int, at: int) -> list[pq.ParquetFile]:
        """The files of one range of one run."""
        system, root = located(self.paths[run])
        found = system.get_file_info(fs.FileSelector(f"{root}/place={at}", allow_not_found=True))
        return [pq.ParquetFile(system.open_input_file(f.path)) for f in sorted(found, key=lambda f: f.path) if f.is_file and f.base_name.endswith(".parquet")]

    def find(self, at: int, wanted: np.ndarray) -> Iterator[tuple[int, pa.Table]]:
        """(run, rows) with a key among the sorted `wanted`, which all lie in range `at`."""
        for run in range(len(self.paths)):
            for file in self.files(run, at):
                groups = file.metadata
                column = groups.schema.names.index(self.key)
                for n in range(groups.num_row_groups):
                    told = groups.row_group(n).column(column).statistics
                    low, high = np.searchsorted(wanted, told.min), np.searchsorted(wanted, told.max, "right")
                    if low == high:
                        continue
                    if self.read is not None:
                        self.read.add(groups.row_group(n).total_byte_size)
                    rows = file.read_row_group(n, self.columns)
                    key = rows.column(self.key).to_numpy()
                    near = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
                    hit = wanted[near] == key
                    if hit.any():
                        yield run, rows.filter(pa.array(hit))
                file.close()

    def scan(self, run: int, at: int) -> Iterator[pa.RecordBatch]:
        """All rows of a range of a run, in order if the range is one file."""
        for file in self.files(run, at):
            yield from file.iter_batches(columns=self.columns)
            file.close()
