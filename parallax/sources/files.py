"""Readers for document-shaped inputs: nested JSON files, JSON lines, key lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parallax.functions.pages import page_key, parse_page

ENTRY = "STRUCT<title STRING, authors ARRAY<STRING>, printed_page_number STRING, source_page_index INT, printed_roman BOOLEAN, skip BOOLEAN>"
READING = f"generated_at DOUBLE, duration_seconds DOUBLE, kind STRING, entries ARRAY<{ENTRY}>"
TRUTH = f"entries ARRAY<{ENTRY}>, verified BOOLEAN, source STRING, fetched_at STRING"
MANIFEST = "toc_only BOOLEAN, books ARRAY<STRUCT<filename STRING, title STRING, language STRING, doi STRING, toc_download_url STRING, license STRING, license_source STRING, lobid_url STRING>>"
RECORD = "id STRING, type ARRAY<STRING>, title STRING, isbn ARRAY<STRING>, doi STRING, language ARRAY<STRUCT<id STRING, label STRING>>, tableOfContents ARRAY<STRUCT<label STRING, id STRING>>, publication ARRAY<STRUCT<startDate STRING, dateStatement STRING>>"


def exploded(nested: DataFrame, *carried: str) -> DataFrame:
    """A row for each entry, with its place; a missing skip counts as false, missing authors as none."""
    out = nested.select(*carried, F.posexplode("entries").alias("pos", "e"))
    page = F.col("e.printed_page_number")
    return out.select(*carried, (F.col("pos") + 1).alias("ordinal"), F.col("e.title").alias("title"), F.coalesce("e.authors", F.array().cast("array<string>")).alias("authors"), page.alias("page"), parse_page(page).alias("page_val"), page_key(page).alias("page_key"), F.coalesce("e.skip", F.lit(False)).alias("skip"))


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return named(spark.read.schema(READING).option("multiLine", True).json(f"{folder}/*.json"))


def named(raw: DataFrame) -> DataFrame:
    """Readings of files <key>.<reader>.json; the key ends at the first dot. kind is vision where it isn't given."""
    name = F.col("_metadata.file_name")
    return raw.select(F.regexp_extract(name, r"^([^.]*)\.(.*)\.json$", 1).alias("key"), F.regexp_extract(name, r"^([^.]*)\.(.*)\.json$", 2).alias("reader"), F.coalesce("kind", F.lit("vision")).alias("kind"), "generated_at", "duration_seconds", "entries")


def _is_stale() -> Column:
    """Made by the gate before entries had a skip flag; what can't be read isn't."""
    return F.coalesce((F.col("source") == "bulk_gate") & (F.size("entries") > 0) & F.exists("entries", lambda e: e["skip"].isNull()), F.lit(False))


def truth(spark: SparkSession, folder: str) -> DataFrame:
    """Files <key>.expected.json. stale: see _is_stale(); readable: whether the file holds JSON of the schema."""
    raw = spark.read.schema(f"{TRUTH}, _corrupt STRING").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(f"{folder}/*.expected.json")
    key = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.expected\.json$", 1)
    return raw.select(key.alias("key"), "verified", "source", "entries", _is_stale().alias("stale"), F.col("_corrupt").isNull().alias("readable"))


def truth_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same from lines `key<tab>JSON`, many to a file; a line that can't be read keeps its key."""
    parts = F.split("value", "\t", 2)
    raw = spark.read.text(path).select(F.get(parts, 0).alias("key"), F.from_json(F.get(parts, 1), f"{TRUTH}, _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("t"))
    flat = raw.select("key", "t.verified", "t.source", "t.entries", F.col("t._corrupt").alias("_corrupt"))
    return flat.select("key", "verified", "source", "entries", _is_stale().alias("stale"), F.col("_corrupt").isNull().alias("readable"))


def corpora(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders under root that hold a manifest.json, in order; none if there is no root."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*/manifest.json")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(f.getPath().getParent().getName() for f in found)


def corpus(spark: SparkSession, root: str, name: str, create: bool = False) -> str:
    """The folder of a corpus. One without a manifest is an error that tells which there are, unless it is to be made."""
    if not create and name not in (known := corpora(spark, root)):
        raise ValueError(f"no corpus named {name!r} under {root}; available: {', '.join(known) or 'none'}")
    return f"{root}/{name}"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    books = spark.read.schema(MANIFEST).option("multiLine", True).json(path).select(F.inline("books"))
    return books.withColumn("key", F.regexp_replace("filename", r"\.[^.]*$", ""))


def records(spark: SparkSession, path: str) -> DataFrame:
    """A dump of JSON lines, gzip or plain. A gzip file is one split, so rows are dealt again after the filter."""
    kept = spark.read.schema(RECORD).json(path).where(F.array_contains("type", "EditedVolume") & (F.size("tableOfContents") > 0))
    return kept.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def keys(spark: SparkSession, path: str) -> DataFrame:
    """(key, position): one key a line, in the order of their first lines; blank lines and # comments don't count."""
    lines = spark.read.text(path).select(F.trim("value").alias("key"), F.monotonically_increasing_id().alias("line"))
    first = lines.where("key <> '' and not startswith(key, '#')").groupBy("key").agg(F.min("line").alias("line"))
    return first.orderBy("line").select("key", F.row_number().over(W.orderBy("line")).alias("position"))
