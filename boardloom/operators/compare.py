"""Set comparison of the documents of two sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardloom.functions.urls import compare_key


def url_set(rows: DataFrame, url: str = "url") -> DataFrame:
    """Distinct comparison keys; rows without a URL are left out."""
    return rows.where(F.coalesce(F.col(url), F.lit("")) != "").select(compare_key(F.col(url)).alias("key")).distinct()


def read_urls(spark: SparkSession, path: str, key: str = "findings") -> DataFrame:
    """Rows of a JSON object's list `key`; of its list `bandi` where that is missing or empty."""
    data = spark.read.json(path, multiLine=True)
    for name in (key, "bandi"):
        if name in data.columns:
            rows = data.select(F.explode(name).alias("x")).select("x.*")
            if not rows.isEmpty():
                return rows
    return spark.createDataFrame([], "url string")


def sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """(key, side): both, left or right, by one shuffle for all three sets."""
    marked = left.select("key", F.lit(1).alias("s")).unionAll(right.select("key", F.lit(2).alias("s")))
    which = marked.groupBy("key").agg(F.sum("s").alias("s"))
    return which.select("key", F.when(F.col("s") == 3, "both").when(F.col("s") == 1, "left").otherwise("right").alias("side"))


def summary(left: DataFrame, right: DataFrame) -> DataFrame:
    """Sizes of both sets, of the three parts, and the uplift of left over right in percent (NULL if right is empty)."""
    c = sides(left, right).agg(*[F.count_if(F.col("side") == s).alias(s) for s in ("both", "left", "right")])
    n_left, n_right = F.col("both") + F.col("left"), F.col("both") + F.col("right")
    uplift = F.when(n_right > 0, F.round(100 * F.col("left") / F.greatest(n_right, F.lit(1)), 0))
    return c.select(n_left.alias("n_left"), n_right.alias("n_right"), F.col("both").alias("common"), F.col("left").alias("only_left"), F.col("right").alias("only_right"), uplift.alias("uplift_pct"))


def examples(left: DataFrame, right: DataFrame, most: int = 15) -> DataFrame:
    """The first keys, in order, that only the left set has: a bounded report."""
    return left.join(right, "key", "left_anti").orderBy("key").limit(most)
