"""Readings and truth held against a registry's chapters, and what neither covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parallax.functions import records, text
from parallax.operators import align, metrics


def manifest_entries(found: DataFrame, license: str, license_source: str, *carried: str) -> DataFrame:
    """Bibliographic records as entries of a manifest, with whether they fit in one; carried columns stay.

    A title that is missing is empty; other fields that are missing are null.
    """
    key = text.record_key(F.col("isbn"), F.col("id"))
    return found.select(
        *carried,
        records.matches(F.col("type"), F.col("tableOfContents")).alias("fits"),
        key.alias("key"),
        F.coalesce("title", F.lit("")).alias("title"),
        records.language(F.col("language")).alias("language"),
        "doi",
        records.toc_url(F.col("tableOfContents")).alias("toc_download_url"),
        records.api_url(F.col("id")).alias("lobid_url"),
        F.concat(key, F.lit(".pdf")).alias("filename"),
        F.lit(license).alias("license"),
        F.lit(license_source).alias("license_source"),
    )


def chapters(items: DataFrame) -> DataFrame:
    """(key, ordinal, title, authors, page) of the items that are chapters."""
    found = items.select("key", "ordinal", records.chapter(F.struct(*items.columns)).alias("c")).where("c is not null")
    return found.select("key", "ordinal", "c.title", "c.authors", "c.page")


def covered(entries: DataFrame, least: int = 3) -> DataFrame:
    """Documents with at least so many chapters whose page is known."""
    return entries.groupBy("key").agg(F.count("page").alias("n")).where(F.col("n") >= least).select("key")


def page_sorted(entries: DataFrame) -> DataFrame:
    """Ordinals by page (unknown last), number, label, and else as they stood."""
    order = W.partitionBy("key", "reader").orderBy(F.col("page").isNull(), F.coalesce("page_val", F.lit(0)), F.coalesce("page", F.lit("")), "ordinal")
    return entries.withColumn("ordinal", F.row_number().over(order))


def evaluate(books: DataFrame, given: DataFrame, registry: DataFrame) -> DataFrame:
    """key, tp, fp, fn, precision, recall, f1 of every book; entries to skip don't count as given."""
    a, b = page_sorted(given.where("not skip").join(books, "key", "left_semi")), page_sorted(registry.join(books, "key", "left_semi"))
    tp = align.align(align.candidates(a, b)).groupBy("key").agg(F.count("*").alias("tp"))
    n = lambda e, name: e.groupBy("key").agg(F.count("*").alias(name))
    counted = books.join(n(a, "n_a"), "key", "left").join(n(b, "n_b"), "key", "left").join(tp, "key", "left").na.fill(0, ["n_a", "n_b", "tp"])
    return metrics.scores(counted.select("key", "tp", (F.col("n_b") - F.col("tp")).alias("fp"), (F.col("n_a") - F.col("tp")).alias("fn")))
