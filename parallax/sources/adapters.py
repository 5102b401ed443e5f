"""The given tables as readings, truth and registry records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parallax.functions.pages import page_key, parse_page


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_pages(entries: DataFrame) -> DataFrame:
    return entries.withColumns({"page_val": parse_page(F.col("page")), "page_key": page_key(F.col("page")), "authors": F.array().cast("array<string>")})


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem and part as entries: an order is a document, the return flag its reader, the line number its page."""
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    roman = F.element_at(F.array(*map(F.lit, ("i", "ii", "iii", "iv", "v", "vi", "vii"))), F.col("l_linenumber"))
    number = F.col("l_linenumber").cast("string")
    kind = F.col("l_suppkey") % 5
    page = F.when(kind == 0, number).when(kind == 1, F.concat(F.lit("0"), number)).when(kind == 2, roman).when(kind == 3, F.upper(roman))
    order = W.partitionBy("l_orderkey", "l_returnflag").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_linestatus", "l_shipdate")
    return with_pages(line.select(F.col("l_orderkey").alias("key"), F.col("l_returnflag").alias("reader"), F.row_number().over(order).alias("ordinal"), F.col("p_name").alias("title"), page.alias("page"), (F.col("l_linestatus") == "F").alias("skip")))


def perturbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that mostly agree: those of reader A, and as B the same with a rule for each row: one in twenty each
    with a chapter number, one with the word, one with a word that looks like a number before the title, and one with
    the page unread. A names the authors of every other entry, B those of all."""
    base = readings(spark, sf_dir).where("reader = 'A'").select("key", "reader", "ordinal", "title", "page", "skip")
    rule = (F.col("key") * 31 + F.col("ordinal") * 7) % 20
    title = F.when(rule == 3, F.concat(F.lit("3 "), "title")).when(rule == 7, F.concat(F.lit("Chapter 4: "), "title")).when(rule == 9, F.concat(F.lit("I "), "title")).otherwise(F.col("title"))
    other = base.select("key", F.lit("B").alias("reader"), "ordinal", title.alias("title"), F.when(rule != 5, F.col("page")).alias("page"), "skip")
    named = with_pages(base.unionByName(other))
    author = F.array(F.concat("reader", F.lit(" author "), "ordinal"))
    return named.withColumn("authors", F.when((F.col("reader") == "B") | (F.col("ordinal") % 2 == 0), author).otherwise(F.col("authors")))


def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reader A's entries, and as B the same with the last word of a title as the title and the whole as its variant, as
    where a title's last line is all that was captured."""
    base = readings(spark, sf_dir).where("reader = 'A'").select("key", "ordinal", "title", "page", "skip")
    none = F.lit(None).cast("array<string>")
    last = base.select("key", F.lit("B").alias("reader"), "ordinal", F.element_at(F.split("title", " "), -1).alias("title"), "page", "skip", F.array("title").alias("title_variants"))
    return with_pages(base.withColumns({"reader": F.lit("A"), "title_variants": none}).unionByName(last))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders: those that are filled have arbitrated truth, open ones gated truth, others none."""
    source = F.when(F.col("o_orderstatus") == "F", "agent_arbitration").when(F.col("o_orderstatus") == "O", "bulk_gate")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), source.alias("source")).where("source is not null")


def registry_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem and part as a registry's raw items: reader A's lines, some with the page glued to the title, some with a
    subtitle, and some that are books."""
    line = table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_linestatus", "l_shipdate")
    number = F.col("l_linenumber").cast("string")
    title = F.when(F.col("l_suppkey") % 7 == 0, F.concat(number, "p_name")).otherwise(F.col("p_name"))
    author = lambda given, family: F.struct(given.alias("given"), family.alias("family"))
    return line.select(
        F.col("l_orderkey").alias("key"),
        F.row_number().over(order).alias("ordinal"),
        F.when(F.col("l_partkey") % 11 == 0, F.when(F.col("l_partkey") % 2 == 0, "monograph").otherwise("edited-book")).otherwise("book-chapter").alias("type"),
        F.concat(F.lit("10.1/"), "l_partkey").alias("DOI"),
        F.when(F.col("l_partkey") % 13 == 0, F.array().cast("array<string>")).otherwise(F.array(title)).alias("title"),
        F.when(F.col("l_partkey") % 5 == 0, F.array(F.lit("in short"))).alias("subtitle"),
        F.array(author(F.lit("Ann"), F.concat(F.lit("N"), number)), author(F.lit("Bo"), F.lit(None).cast("string"))).alias("author"),
        F.when(F.col("l_suppkey") % 9 != 0, F.concat(number, F.lit("-"), F.col("l_linenumber") + 9)).alias("page"),
    )
