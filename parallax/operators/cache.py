"""A read-through cache of registry answers: confirmed ones stay, failed requests are asked again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parallax.functions.text import book_doi

FOUND, EMPTY, FAILED = "found", "empty", "failed"
CAP = 100  # items of an answer; one that has as many may be incomplete

SCHEMA = "isbn string, status string, doi string, n_items long, fetched_at timestamp"


def to_fetch(wanted: DataFrame, cache: DataFrame, force: bool = False) -> DataFrame:
    """The distinct isbn to be asked for: those the cache hasn't, confirmed misses being held, too; all if forced."""
    asked = wanted.where(F.coalesce("isbn", F.lit("")) != "").select("isbn").distinct()
    return asked if force else asked.join(cache, "isbn", "left_anti")


def answers(asked: DataFrame, items: DataFrame, failed: DataFrame, fetched_at) -> DataFrame:
    """What asking gives, in the cache's columns: items of the registry, none of them, or a failure (isbn in failed).

    items: isbn, ordinal, type, DOI. doi is that of the first item that is a book.
    """
    listed = items.groupBy("isbn").agg(F.sort_array(F.collect_list(F.struct("ordinal", "type", "DOI"))).alias("items"))
    out = asked.join(listed, "isbn", "left").join(failed.select("isbn", F.lit(True).alias("failed")).distinct(), "isbn", "left")
    status = F.when(F.col("failed"), FAILED).when(F.col("items").isNull(), EMPTY).otherwise(FOUND)
    known = F.col("failed").isNull()
    return out.select("isbn", status.alias("status"), F.when(known, book_doi(F.col("items"))).alias("doi"), F.when(known, F.coalesce(F.size("items"), F.lit(0))).otherwise(0).cast("long").alias("n_items"), F.lit(fetched_at).cast("timestamp").alias("fetched_at"))


def capped(found: DataFrame) -> DataFrame:
    """Answers that may be incomplete."""
    return found.where(F.col("n_items") >= CAP).select("isbn", "n_items")


def write(fetched: DataFrame, folder: str, batch: int) -> None:
    """Adds a batch of answers, without the failed; the same batch written again replaces itself."""
    fetched.where(F.col("status") != FAILED).write.mode("overwrite").parquet(f"{folder}/batch={batch}")


def read(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """The newest answer for each isbn, of the batches before one if it is given. A folder that isn't there yet is an
    empty cache."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(f"{SCHEMA}, batch int").option("basePath", folder).parquet(folder)
    if before is not None:
        rows = rows.where(F.col("batch") < before)  # folders of later batches aren't read
    newest = F.row_number().over(W.partitionBy("isbn").orderBy(F.desc("batch"), F.desc("fetched_at")))
    return rows.withColumn("_n", newest).where("_n = 1").drop("_n", "batch")


def read_through(wanted: DataFrame, folder: str, batch: int, fetch, force: bool = False) -> DataFrame:
    """Answers for all that is wanted: held ones, and what fetch(isbns) gives for the others, which is stored.

    fetch takes the isbn to ask for and returns the cache's columns. Failures are answered, but not stored. A batch
    sees those before it, so one that is repeated, as after a failure, asks for the same and changes nothing.
    """
    spark = wanted.sparkSession
    write(fetch(to_fetch(wanted, read(spark, folder, batch), force)), folder, batch)
    return wanted.select("isbn").distinct().join(read(spark, folder), "isbn", "left").withColumn("status", F.coalesce("status", F.lit(FAILED)))
