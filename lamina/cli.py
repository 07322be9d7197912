"""Command line: documents from recorded answers, for one document or a folder of them.

python -m lamina.cli process --pages P --answers A --output O [--doc ID] [--preset NAME | --config FILE]
python -m lamina.cli batch --pages P --answers A --output O [--resume] [--buckets N]
python -m lamina.cli query NAME --data DIR [--output O]
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config, pipeline
from .operators import quality
from .session import ship
from .sources import files, sinks


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lamina")
    sub = top.add_subparsers(dest="command", required=True)
    for name in ("process", "batch"):
        p = sub.add_parser(name)
        for a in ("--pages", "--answers", "--output"):
            p.add_argument(a, required=True)
        p.add_argument("--preset")
        p.add_argument("--config")
        p.add_argument("--device")
        p.add_argument("--dtype")
        if name == "process":
            p.add_argument("--doc", type=int)
        else:
            p.add_argument("--resume", action="store_true")
            p.add_argument("--buckets", type=int, help="Parquet in so many folders instead of a folder per document")
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--data", required=True)
    q.add_argument("--output")
    return top


def settings(args: argparse.Namespace) -> config.Settings:
    own = {k: v for k in ("device", "dtype") if (v := getattr(args, k, None))}
    return config.replace(config.load(args.config, args.preset), **own).validate()


def failures(pages: DataFrame) -> DataFrame:
    """doc_id, error of documents with a page that could not be rendered or has no markup."""
    told = F.col("error") if "error" in pages.columns else F.lit(None).cast("string")
    broken = told.isNotNull() | F.col("raw_response").isNull()
    return pages.where(broken).groupBy("doc_id").agg(F.min(F.coalesce(told, F.lit("a page has no markup"))).alias("error"))


def batch(pages: DataFrame, recorded: DataFrame, output: str, resume: bool, buckets: int | None) -> int:
    """Writes the documents that are outstanding; a broken one fails alone. 1 when one failed or nothing was to be done."""
    spark, began = pages.sparkSession, time.time()
    if resume:
        try:
            done = spark.read.parquet(output) if buckets else spark.read.text(output)
            pages = files.outstanding(pages, done)
        except Exception as e:  # nothing written yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
    failed = failures(pages)
    results = pages.select("doc_id").distinct().join(failed, "doc_id", "left").select("doc_id", F.when(F.col("error").isNull(), "success").otherwise("failed").alias("status"), "error")
    results.write.mode("overwrite").parquet(output.rstrip("/") + "_results")
    results = spark.read.parquet(output.rstrip("/") + "_results")
    count, broken = results.count(), results.where("status = 'failed'").count()
    if not count:
        return 1
    found = pipeline.documents(pages.join(failed, "doc_id", "left_anti"), recorded)
    sinks.in_buckets(found, output, buckets) if buckets else sinks.by_document(found, output)
    timed = results.withColumn("elapsed", F.lit((time.time() - began) / count))  # documents run side by side: each has its share of the batch's time
    sinks.summary(quality.batch_summary(timed), output.rstrip("/") + "_summary")
    return int(broken > 0)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0, or 1 when a document failed or there was nothing to do."""
    args = parser().parse_args(argv)
    spark = ship(spark or SparkSession.builder.appName("lamina").getOrCreate())
    if args.command == "query":
        from .plans import catalog

        found = catalog.QUERIES[args.name](spark, args.data)
        found.write.mode("overwrite").parquet(args.output) if args.output else found.show(50, truncate=False)
        return 0
    settings(args)
    pages, recorded = spark.read.parquet(args.pages), spark.read.parquet(args.answers)
    if args.command == "process":
        if args.doc is not None:
            pages = pages.where(F.col("doc_id") == args.doc)
        found = pipeline.documents(pages, recorded.join(pages.select("doc_id").distinct(), "doc_id", "left_semi"))
        sinks.by_document(found, args.output)
        return 0 if not pages.isEmpty() else 1
    return batch(pages, recorded, args.output, args.resume, args.buckets)


if __name__ == "__main__":
    sys.exit(main())
