"""A dump of records scanned as its files arrive; keys taken once are known in every later run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parallax.operators import backlog, registry
from parallax.sources import files

RECORD = f"position LONG, {files.RECORD}"
SCANNED = "position LONG, key STRING, skipped STRING, batch LONG"


def watch(spark: SparkSession, source: str, folder: str, held: DataFrame) -> StreamingQuery:
    """Scans what has come to the source since the last call. folder keeps the results and the checkpoint; held: keys
    that were acquired by other means."""
    raw = spark.readStream.schema(RECORD).json(source)
    out = raw.writeStream.foreachBatch(lambda batch, number: decide(batch, number, folder, held))
    return out.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()


def decide(batch: DataFrame, number: int, folder: str, held: DataFrame) -> None:
    """Why each record of a batch is skipped, or null if it is taken.

    The state is the keys that earlier batches took. A batch looks only at those before it and overwrites its own
    results, so it counts once however often it is tried. position is the dump's order, across batches.
    """
    spark = batch.sparkSession
    rows = registry.manifest_entries(batch, "CC0-1.0", "library", "position")
    known = held.select("key")
    if number > 0:
        known = known.union(scanned(spark, folder).where((F.col("batch") < number) & F.col("skipped").isNull()).select("key"))
    backlog.scan_reasons(rows, known).write.mode("overwrite").parquet(f"{folder}/scanned/batch={number}")


def scanned(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCANNED).option("basePath", f"{folder}/scanned").parquet(f"{folder}/scanned")
