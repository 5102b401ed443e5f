"""Rows of text from placed words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from parallax.operators.streams import folded


def anchors(tokens: DataFrame, page: str = "page", tolerance: float = 8.0) -> DataFrame:
    """(page, band, own, before): the place of the row that begins in a band of a page, if one does, and of the last
    row that began above the band.

    A row begins at the first place that lies further than the tolerance below the beginning of the row before.
    So a band no higher than the tolerance holds one beginning at most, and of its words only their distinct places count.
    Behind a gap over the tolerance a row always begins: there a page is cut into parts, which are gone
    through apart from each other, band by band.
    """
    bands = tokens.groupBy(page, F.floor(F.col("vpos") / _height(tolerance)).alias("band")).agg(F.sort_array(F.collect_set("vpos")).alias("places"))
    line = W.partitionBy(page).orderBy("band")  # a row a band
    first, last = F.get("places", F.lit(0)), F.element_at("places", -1)
    cut = F.coalesce(first - F.lag(last).over(line) > tolerance, F.lit(True))
    parts = bands.withColumn("part", F.sum(cut.cast("int")).over(line))
    schema = StructType([tokens.schema[page], StructField("band", LongType()), StructField("own", DoubleType()), StructField("before", DoubleType())])
    schema[0].name = page

    def step(rows):
        anchor = None
        for key, _, band, places in rows:
            own = places[0] if anchor is None else next((p for p in places if p - anchor > tolerance), None)
            yield key, band, own, anchor
            anchor = anchor if own is None else own

    return folded(parts, [page, "part"], ["band"], step, schema)


def _height(tolerance: float) -> float:
    """The greatest power of two up to the tolerance, by which division is exact."""
    height = 1.0
    while height > tolerance:
        height /= 2
    while 2 * height <= tolerance:
        height *= 2
    return height


def row_clusters(tokens: DataFrame, page: str = "page", tolerance: float = 8.0) -> DataFrame:
    """(page, row, content): words within the tolerance of a row's first one, in reading order.

    tokens: page, vpos, hpos, content. Words without a vpos are left out. A page may hold any number of words: they are
    dealt by bands of its height (see anchors), and only a row's own words come together.
    """
    words = tokens.where(F.col("vpos").isNotNull()).withColumn("vpos", F.col("vpos").cast("double"))
    begun = anchors(words, page, tolerance)
    number = F.row_number().over(W.partitionBy(page).orderBy("own"))
    rows = begun.where("own is not null").select(page, F.col("own").alias("anchor"), number.alias("row"))
    placed = words.withColumn("band", F.floor(F.col("vpos") / _height(tolerance))).join(begun, [page, "band"])
    placed = placed.withColumn("anchor", F.when(F.col("own") <= F.col("vpos"), F.col("own")).otherwise(F.col("before")))
    line = F.sort_array(F.collect_list(F.struct("hpos", "vpos", "content")))
    text = placed.groupBy(page, "anchor").agg(F.array_join(F.transform(line, lambda x: x["content"]), " ").alias("content"))
    return text.join(rows, [page, "anchor"]).select(page, "row", "content")
