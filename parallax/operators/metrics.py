"""Precision, recall and agreement beyond chance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def share(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def scores(counted: DataFrame) -> DataFrame:
    """precision, recall and f1 from tp, fp, fn; 0 where there is nothing to divide by."""
    p, r = share(F.col("tp"), F.col("tp") + F.col("fp")), share(F.col("tp"), F.col("tp") + F.col("fn"))
    return counted.withColumns({"precision": p, "recall": r}).withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def pairwise(rates: DataFrame) -> DataFrame:
    return rates.groupBy(F.col("side_a").alias("model_a"), F.col("side_b").alias("model_b")).agg(F.avg("rate").alias("mean_agreement"), F.count("*").alias("n_books"))


def macro(evaluated: DataFrame, by: str) -> DataFrame:
    return evaluated.groupBy(by).agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.count("*").alias("n_books"))


def overall(evaluated: DataFrame) -> DataFrame:
    """One row of means over all documents, 0 where there is none, as a report shows them; mean_f1 is null there, as a
    bound is held against it."""
    shown = (F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in ("precision", "recall", "f1"))
    return evaluated.agg(*shown, F.avg("f1").alias("mean_f1"), F.count("*").alias("n_books"))


def rank_pairs(agreement: DataFrame, accuracy: DataFrame) -> DataFrame:
    """Reader pairs by the weaker one's F1 less the agreement beyond chance; unscored() has the pairs without both F1."""
    a = accuracy.select(F.col("model").alias("model_a"), F.col("f1").alias("f1_a"))
    b = accuracy.select(F.col("model").alias("model_b"), F.col("f1").alias("f1_b"))
    out = agreement.join(a, "model_a").join(b, "model_b").withColumnRenamed("mean_agreement", "observed_agreement")
    out = out.withColumn("expected_agreement", F.col("f1_a") * F.col("f1_b") + (1 - F.col("f1_a")) * (1 - F.col("f1_b")))
    beyond = (F.col("observed_agreement") - F.col("expected_agreement")) / (1 - F.col("expected_agreement"))
    out = out.withColumn("kappa", F.when(F.col("expected_agreement") >= 1, F.lit(0.0)).otherwise(beyond))
    return out.withColumn("score", F.least("f1_a", "f1_b") - F.greatest(F.lit(0.0), "kappa")).orderBy(F.desc("score"), "model_a", "model_b")


def unscored(agreement: DataFrame, accuracy: DataFrame) -> DataFrame:
    """The reader pairs that rank_pairs() can't score, as one of them has no F1."""
    known = accuracy.where("f1 is not null").select("model").distinct()
    a = known.select(F.col("model").alias("model_a"), F.lit(True).alias("has_a"))
    b = known.select(F.col("model").alias("model_b"), F.lit(True).alias("has_b"))
    return agreement.join(a, "model_a", "left").join(b, "model_b", "left").where("has_a is null or has_b is null").drop("has_a", "has_b")


def accuracy_table(models: DataFrame, accuracy: DataFrame) -> DataFrame:
    """Every model with its place by F1; those without one last, equal ones by name."""
    place = F.row_number().over(W.orderBy(F.desc(F.coalesce("f1", F.lit(-1.0))), "model"))
    return models.select("model").distinct().join(accuracy, "model", "left").withColumn("place", place)
