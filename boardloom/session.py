"""Session factory used by the tests, the bench and the command line."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and Arrow transfer; `conf` overrides."""
    builder = SparkSession.builder.master(master).appName("boardloom")
    for key, value in {**DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to the executors' Python workers, once per context, through Spark's own file server.

    Functions sent to workers refer to the package by name; without this it would have to be installed on, or
    in the search path of, every machine.
    """
    context = spark.sparkContext
    if not getattr(context, "_boardloom_shipped", False):
        root = Path(__file__).resolve().parent
        if root.is_dir():  # not itself inside an archive
            archive = Path(tempfile.mkdtemp(prefix="boardloom-")) / "boardloom.zip"
            with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
                for path in sorted(root.rglob("*.py")):
                    out.write(path, Path("boardloom") / path.relative_to(root))
            context.addPyFile(str(archive))
        context._boardloom_shipped = True
    return spark
