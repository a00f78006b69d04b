"""Plan helpers shared by the operators: reading, spreading, durable cuts, work folders and size-checked joins."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def width(spark: SparkSession) -> int:
    """Number of shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """Deal rows over all cores when the input has fewer files than cores.

    A parquet file with one row group is read by one task however it is split; CPU-heavy work on it
    would use one core. Inputs with enough files pass through without a shuffle; the names stay in the JVM.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df._jdf.inputFiles()) >= cores else df.repartition(cores)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data: what the session names in spark.checkpoint.dir.

    Only a local master may do without the setting, as in tests on one machine; it gets a temporary folder.
    Anywhere else executors couldn't read each other's files there, so the call fails.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", "")
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or _temporary())
    return context.getCheckpointDir()


def _temporary() -> str:
    """A temporary folder that goes with the process."""
    folder = tempfile.mkdtemp(prefix="boardloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder of its own for the tables of one run, in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder (survives the loss of executors)."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a compressed table in the shared folder; for wide rows, such as pages."""
    path = work_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """Hadoop's file system of a path, and the path for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    system, at = file_system(spark, path)
    system.delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, at = file_system(spark, path)
    return system.exists(at)


def join_small(left: DataFrame, right: DataFrame, on: str, how: str = "inner", max_rows: int = 100_000, salts: int = 16) -> DataFrame:
    """Join a large side, which may be skewed on `on`, with a side that is unique on `on`.

    `right` is counted first: up to `max_rows` rows it is broadcast; beyond that both sides are shuffled
    on the key and a salt, so that one hot key is dealt over `salts` tasks and `right` is copied per salt.
    """
    if right.limit(max_rows + 1).count() <= max_rows:
        return left.join(F.broadcast(right), on, how)
    salted = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = left.withColumn("__salt", (F.rand(17) * salts).cast("int"))
    return dealt.join(salted, [on, "__salt"], how).drop("__salt")
