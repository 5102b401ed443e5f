"""Stratified samples of exact size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def allocation(strata: DataFrame, size: int, by: list[str]) -> DataFrame:
    """Each stratum's share of a sample: size * n / total, rounded half to even, and at most n."""
    counts = strata.groupBy(*by).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy(F.lit(0)))  # a row for each stratum, so few
    return counts.withColumn("_total", total).select(*by, "n", F.least("n", F.bround(size * F.col("n") / F.col("_total")).cast("long")).alias("share"))


def stratified(items: DataFrame, size: int, by: list[str], key: str, seed: int = 20260815) -> DataFrame:
    """size items (or all): each stratum's share in an order given by a hash, then trimmed or filled in that order."""
    shares = allocation(items, size, by)
    draw = F.xxhash64(F.lit(seed), F.col(key))
    rank = F.row_number().over(W.partitionBy(*by).orderBy(draw, key))
    # no row behind `size` others of its stratum is drawn; each task leaves those out before the window
    drawn = items.withColumn("_rank", rank).where(F.col("_rank") <= size).join(shares.select(*by, "share"), by)
    return drawn.orderBy(F.col("_rank") > F.col("share"), draw, key).limit(size).select(key, *by)


def draw(key, seed: int = 20260815):
    """A row's place in a uniform random order that the seed and the key alone decide."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def uniform(items: DataFrame, size: int, key: str, seed: int = 20260815) -> DataFrame:
    """size rows of items (all if there are fewer, none if size is negative): those least by draw().

    Each task keeps its size least, of which the least stay, so the same rows are drawn however the table is
    partitioned. key should be unique; of equal keys any rows may be drawn.
    """
    return items.orderBy(draw(key, seed), key).limit(max(size, 0))


def spot_check(truth: DataFrame, size: int, accepted: DataFrame, seed: int = 20260815) -> DataFrame:
    """sampled, accepted, precision of the gate: of size documents whose truth nobody has verified (verified is false; null
    doesn't count), the share that is in accepted (key). precision is null if there is nothing to sample."""
    sample = uniform(truth.where("verified = false").select("key"), size, "key", seed)
    judged = sample.join(accepted.select("key", F.lit(True).alias("ok")).distinct(), "key", "left")
    return judged.agg(F.count("*").alias("sampled"), F.count("ok").alias("accepted")).withColumn("precision", F.try_divide("accepted", "sampled"))
