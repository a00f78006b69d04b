"""python -m boardloom discover|crawl|compare: the runs over HTTP, and the comparison of two result files."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from boardloom import pipeline, session
from boardloom.operators import compare
from boardloom.sources import pages


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    """The command line."""
    top = argparse.ArgumentParser(prog="boardloom")
    sub = top.add_subparsers(dest="what", required=True)
    for name in ("discover", "crawl"):
        p = sub.add_parser(name)
        p.add_argument("--config", default="config.json")
        p.add_argument("--limit", type=int, default=0)
        p.add_argument("--parts", type=int, default=48)
    sub.choices["crawl"].add_argument("--reset", action="store_true")
    sub.choices["crawl"].add_argument("--reset-reviews", action="store_true")
    p = sub.add_parser("compare")
    p.add_argument("--left", required=True)
    p.add_argument("--right", required=True)
    return top.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    """Run one command."""
    told = arguments(argv)
    spark = session.ship(spark or session.build())
    if told.what == "compare":
        left, right = compare.url_set(compare.read_urls(spark, told.left)), compare.url_set(compare.read_urls(spark, told.right, "bandi"))
        print(compare.summary(left, right).head().asDict())
        print(*[r.key for r in compare.examples(left, right).collect()], sep="\n")
        return
    config = pipeline.Config.read(told.config)

    def source(urls: DataFrame) -> DataFrame:
        return pages.fetch(urls, "url", told.parts, config.timeout)

    def documents(urls: DataFrame) -> DataFrame:
        return pages.attachments(urls, "url", told.parts)

    if told.what == "discover":
        print(pipeline.run_discovery(spark, config, source, told.limit)["meta"])
    else:
        print(pipeline.run_crawl(spark, config, source, dt.datetime.now(dt.UTC).date(), told.limit, documents, reset=told.reset, reset_reviews=told.reset_reviews))


if __name__ == "__main__":
    main()
