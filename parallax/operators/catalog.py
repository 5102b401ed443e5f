"""What is covered, and what still waits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reader_counts(entries: DataFrame, least: int = 0) -> DataFrame:
    return entries.groupBy("reader").agg(F.count_distinct("key").alias("n_books")).where(F.col("n_books") >= least)


def source_counts(truth: DataFrame) -> DataFrame:
    return truth.groupBy(F.coalesce("source", F.lit("unknown")).alias("source")).agg(F.count("*").alias("n_books"))


def needs_arbitration(entries: DataFrame, truth: DataFrame, rejected: DataFrame) -> DataFrame:
    """Documents with a reading, and neither truth nor rejection."""
    return entries.select("key").distinct().join(truth, "key", "left_anti").join(rejected, "key", "left_anti")


def needs_decision(manifest: DataFrame, truth: DataFrame, held_out: DataFrame, rejected: DataFrame) -> DataFrame:
    """Documents that are neither held out nor rejected, and have no truth or a stale one."""
    fresh = truth.where(~F.coalesce("stale", F.lit(False)))
    return manifest.select("key").join(held_out, "key", "left_anti").join(rejected, "key", "left_anti").join(fresh, "key", "left_anti")


def status(manifest: DataFrame, entries: DataFrame, truth: DataFrame, rejected: DataFrame, held_out: DataFrame) -> DataFrame:
    """(metric, n_books): the coverage of the manifest's documents, each counted once. truth: key, source."""

    def marked(keys: DataFrame, name: str) -> DataFrame:
        return keys.select("key").distinct().withColumn(name, F.lit(True))

    source = truth.groupBy("key").agg(F.coalesce(F.min("source"), F.lit("unknown")).alias("source"))
    books = manifest.select("key").distinct().join(source, "key", "left")
    for keys, name in ((entries, "read"), (rejected, "rejected"), (held_out, "held_out")):
        books = books.join(marked(keys, name), "key", "left")
    known, read, out = F.col("source").isNotNull(), F.col("read").isNotNull(), F.col("rejected").isNotNull()
    metrics = {
        "books": F.lit(True),
        "truth": known,
        "gated": F.col("source") == "bulk_gate",
        "arbitrated": F.col("source") == "agent_arbitration",
        "read": read,
        "awaiting arbitration": read & ~known & ~out,
        "rejected": out,
        "held out": F.col("held_out").isNotNull(),
    }
    counts = books.agg(*(F.count_if(c).alias(m) for m, c in metrics.items()))
    return counts.unpivot([], list(metrics), "metric", "n_books")
