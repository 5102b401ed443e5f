"""The gate: documents whose readers agree, and their merged entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LEAST = 0.90


def passed(rates: DataFrame, least: float = LEAST) -> DataFrame:
    return rates.withColumn("passed", (F.col("rate") >= least) & F.col("near"))


def best_pair(gated: DataFrame) -> DataFrame:
    """The passing pair of highest rate of each document; of equal ones the first by name."""
    rank = F.row_number().over(W.partitionBy("key").orderBy(F.desc("rate"), "side_a", "side_b"))
    return gated.where("passed").withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def outcomes(entries: DataFrame, best: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """(key, passed, reason) of every document: of the manifest if it is given, else of those with entries."""
    readings = entries.groupBy("key").agg(F.count_distinct("reader").alias("readings"))
    if manifest is not None:
        readings = manifest.select("key").distinct().join(readings, "key", "left").select("key", F.coalesce("readings", F.lit(0)).alias("readings"))
    out = readings.join(best.select("key", F.lit(True).alias("ok")), "key", "left")
    reason = F.when(F.col("readings") == 0, "no_entries").when(F.col("readings") < 2, "single_reading_only").when(F.col("ok"), "ok").otherwise("below_threshold")
    return out.select("key", F.coalesce("ok", F.lit(False)).alias("passed"), reason.alias("reason"))


def merge(entries: DataFrame, best: DataFrame, parts: DataFrame) -> DataFrame:
    """(key, position, title, authors, page, skip) of the documents that pass: a's matched entries, then those of one
    side only, ordered by page (without one last), number and label, and else as they stood. A matched entry has a's
    authors, or b's if a names none."""
    chosen = parts.join(best.select("key", "side_a", "side_b"), ["key", "side_a", "side_b"])
    reader = F.when(F.col("kind") == "only_b", F.col("side_b")).otherwise(F.col("side_a"))
    rank = F.when(F.col("kind") == "matched", 0).when(F.col("kind") == "only_a", 1).otherwise(2)
    theirs = entries.select("key", F.col("reader").alias("side_b"), F.col("ordinal").alias("j"), F.col("authors").alias("b_authors"))
    chosen = chosen.join(theirs, ["key", "side_b", "j"], "left")
    picked = chosen.select("key", F.when(F.col("kind") == "matched", F.col("b_authors")).alias("b_authors"), reader.alias("reader"), F.coalesce("i", "j").alias("ordinal"), rank.alias("side"))
    full = picked.join(entries, ["key", "reader", "ordinal"])
    order = W.partitionBy("key").orderBy(F.col("page").isNull(), F.coalesce("page_val", F.lit(0)), F.coalesce("page", F.lit("")), "side", "ordinal")
    return full.select("key", F.row_number().over(order).alias("position"), "title", F.when(F.size("authors") > 0, F.col("authors")).otherwise(F.coalesce("b_authors", "authors")).alias("authors"), "page", "skip")
