"""What is still to be done, and the writes that do it: inserts that don't clobber, deletes, updates where found."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def needs_backfill(manifest: DataFrame, truth: DataFrame) -> DataFrame:
    """Documents with truth and without a DOI."""
    return manifest.where("coalesce(doi, '') = ''").join(truth.select("key"), "key", "left_semi").select("key")


def active(models: list[str], manifest: DataFrame, skipped: DataFrame) -> DataFrame:
    """(key, model) to be asked: every document with every endpoint's model, but for the skip list's pairs."""
    return manifest.select("key", F.explode(F.array(*map(F.lit, models))).alias("model")).join(skipped, ["key", "model"], "left_anti")


def missing(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """(key, model, kind) that the cache hasn't in that very kind."""
    return wanted.join(cached, ["key", "model", "kind"], "left_anti")


def inserted(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The table with those new rows whose keys it hasn't; of new rows with equal keys one goes in."""
    return table.unionByName(new.dropDuplicates(keys).join(table, keys, "left_anti").select(*table.columns))


def removed(table: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return table.join(gone, keys, "left_anti")


def updated(table: DataFrame, found: DataFrame, key: str, column: str) -> DataFrame:
    """The table with a column's new values where there are any."""
    new = found.select(key, F.col(column).alias("_new"))
    return table.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def truth_entry(entries: DataFrame) -> DataFrame:
    """key, source, verified, entries (title, authors, printed_page_number, skip, in order) as truth is stored."""
    entry = F.struct("ordinal", "title", "authors", F.col("page").alias("printed_page_number"), "skip")
    listed = entries.groupBy("key").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    return listed.select("key", F.lit("bulk_gate").alias("source"), F.lit(False).alias("verified"), F.transform("entries", lambda e: e.dropFields("ordinal")).alias("entries"))


def write_batch(rows: DataFrame, folder: str, batch: int, by: str | None = None) -> None:
    """Writes nested rows (readings, truth) as a batch of a table, by a column's values if it is given.

    Rows without entries are never written. A batch goes in whole or not at all, and one that is written again replaces itself.
    """
    writer = rows.where(F.size("entries") > 0).write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(f"{folder}/batch={batch}")


def newest(spark: SparkSession, folder: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The table's rows, of equal keys those of the latest batch."""
    rows = spark.read.schema(StructType([*schema.fields, StructField("batch", IntegerType())])).option("basePath", folder).parquet(f"{folder}/batch=*")
    last = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("batch")))
    return rows.withColumn("_n", last).where("_n = 1").select(*schema.names)


def scan_reasons(rows: DataFrame, held: DataFrame) -> DataFrame:
    """(position, key, skipped): why a record of a dump isn't taken, in the dump's order; null for one that is.

    rows: position, key, fits, toc_download_url. The first record of a key that fits, has an address and isn't among
    the held keys is taken.
    """
    known = rows.join(held.select("key", F.lit(True).alias("held")).dropDuplicates(["key"]), "key", "left")
    usable = known.where("fits and toc_download_url is not null and held is null").groupBy("key").agg(F.min("position").alias("first"))
    had = F.coalesce("held", F.lit(False)) | F.coalesce(F.col("first") < F.col("position"), F.lit(False))
    reason = F.when(~F.col("fits"), "no matching type/toc").when(had, "already acquired").when(F.col("toc_download_url").isNull(), "no toc url")
    return known.join(usable, "key", "left").select("position", "key", reason.alias("skipped"))


def first_todo(eligible: DataFrame, order: str, most: int, files: DataFrame) -> DataFrame:
    """Of the first documents in the manifest's order those that have a file: the limit comes first, so fewer may be left."""
    return eligible.orderBy(order).limit(max(most, 0)).join(files.select("key"), "key", "left_semi").select("key")
