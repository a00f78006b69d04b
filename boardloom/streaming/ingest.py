"""Structured Streaming: findings arriving as files are upserted batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from boardloom.operators.state import Versions, insert_or_touch


def upsert_stream(spark: SparkSession, incoming: str, schema: T.StructType, state: Versions, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Upsert every new file in `incoming` into the versioned state.

    A batch that is run again after a failure only touches what it inserted before.
    """

    def apply(batch: DataFrame, _: int) -> None:
        now = F.current_timestamp()
        state.write(insert_or_touch(state.read(), batch, now, F.struct("school_code", "url")).drop("is_new"))

    stream = spark.readStream.schema(schema).json(incoming).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if once else stream).start()


def arrivals_per_day(findings: DataFrame, late: str = "7 days") -> DataFrame:
    """Findings per school and day of first sight; rows later than the watermark are dropped by the engine."""
    return findings.withWatermark("first_seen", late).groupBy(F.window("first_seen", "1 day").alias("day"), "school_code").agg(F.count("*").alias("n"))
