"""Readings gated as their files arrive: the incremental form of the gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parallax.operators import align, gate
from parallax.sources import files

BUCKETS = 256  # folders that a batch's readings are dealt to by key


def watch(spark: SparkSession, source: str, folder: str, least: float = gate.LEAST) -> StreamingQuery:
    """Gates what has come to the source since the last call; folder holds readings, decisions and the checkpoint."""
    raw = spark.readStream.schema(files.READING).option("multiLine", True).option("pathGlobFilter", "*.json").json(source)
    out = files.named(raw).writeStream.foreachBatch(lambda batch, number: decide(batch, number, folder, least))
    return out.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()


def decide(batch: DataFrame, number: int, folder: str, least: float = gate.LEAST) -> None:
    """Stores a batch's readings, and decides anew on the documents that it touches.

    Each batch has folders of its own, which a repeated one overwrites, so a batch counts once however often it is
    tried. Of several readings of a document by one reader the newest counts. Only the touched documents' buckets are
    scanned, and only they are aligned.
    """
    spark = batch.sparkSession
    dealt = batch.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int"))
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/readings/batch={number}")
    schema = dealt.withColumn("batch", F.lit(number).cast("long")).schema
    held = spark.read.schema(schema).option("basePath", f"{folder}/readings").parquet(f"{folder}/readings/batch=*")
    touched = held.where(F.col("batch") == number).select("bucket", "key").distinct()
    newest = F.row_number().over(W.partitionBy("key", "reader").orderBy(F.desc("batch"), F.desc("generated_at")))
    now = held.where(F.col("batch") <= number).join(touched, ["bucket", "key"], "left_semi").withColumn("_n", newest).where("_n = 1")
    entries = files.exploded(now, "key", "reader")
    matched = align.align(align.candidates(entries, entries, ordered=True))
    best = gate.best_pair(gate.passed(align.rates(entries, matched, align.readers(entries)), least))
    decided = gate.outcomes(entries, best, touched).join(best.select("key", "side_a", "side_b", "rate"), "key", "left")
    decided.write.mode("overwrite").parquet(f"{folder}/decisions/batch={number}")


def decisions(spark: SparkSession, folder: str) -> DataFrame:
    """(key, passed, reason, side_a, side_b, rate): the latest decision on each document."""
    held = spark.read.parquet(f"{folder}/decisions")
    latest = F.row_number().over(W.partitionBy("key").orderBy(F.desc("batch")))
    return held.withColumn("_n", latest).where("_n = 1").drop("_n", "batch")
