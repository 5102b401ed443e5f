"""Rows and blocks of reports, ready to be written out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(share: Column) -> Column:
    """A share as whole percent, halves to even."""
    return F.concat(F.bround(share * 100).cast("int"), F.lit("%"))


def signed(value: Column) -> Column:
    return F.format_string("%+.2f", value)


def entry_line(page: Column, title: Column) -> Column:
    """A listed entry: its page, or ? if unknown, to the right of four places; a longer one in full."""
    shown = F.coalesce(page, F.lit("?"))
    return F.concat(F.lit("    p."), F.when(F.length(shown) < 4, F.lpad(shown, 4, " ")).otherwise(shown), F.lit("  "), title)


def kind_label(kind: Column, model: Column) -> Column:
    """How a reading was made, and by which model; a kind that isn't known stands for itself."""
    return F.concat(F.when(kind == "text", "text (OCR'd)").otherwise(kind), F.lit(": "), model)


def page_blocks(pages: DataFrame, key: str, order: str, content: str) -> DataFrame:
    """(key, block): a document's pages in order, each under a line with its number from 1, with empty lines between.

    Pages of one place in the order stand by their content; null content is empty.
    """
    listed = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(content, F.lit("")).alias("c"))))
    block = F.transform(listed, lambda p, i: F.concat(F.lit("--- Page "), i + 1, F.lit(" ---\n"), p["c"]))
    return pages.groupBy(key).agg(F.array_join(block, "\n\n").alias("block"))


def book_rows(evaluated: DataFrame, manifest: DataFrame) -> DataFrame:
    """Evaluated documents as report rows: by falling F1, then by title in lower case, then key.

    manifest: key, title, toc_download_url. A document without a title there, or an empty one, stands by its key.
    """
    named = evaluated.join(manifest.select("key", F.col("title").alias("_title"), "toc_download_url"), "key", "left")
    name = F.coalesce(F.when(F.col("_title") != "", F.col("_title")), F.col("key").cast("string"))
    known = F.coalesce("_title", F.col("key").cast("string"))  # an empty title sorts as one
    rows = named.orderBy(F.desc("f1"), F.lower(known), "key")
    return rows.select("key", name.alias("name"), "toc_download_url", *(percent(F.col(c)).alias(c) for c in ("precision", "recall", "f1")), "tp", "fp", "fn")


def records_of(keys: DataFrame, found: DataFrame) -> DataFrame:
    """Each key with its record's columns, null where there is none; of several records the first by position."""
    first = found.groupBy("key").agg(F.min_by(F.struct(*(c for c in found.columns if c != "key")), "position").alias("record"))
    return keys.join(first, "key", "left")
