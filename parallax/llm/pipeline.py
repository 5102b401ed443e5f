"""From raw documents to packed sequences, stage by stage.

Stages decide on rows, not on ids: a row is kept or goes by what it holds itself, whatever other rows have its id. Nulls
are allowed in every column; an empty table passes through. Texts may have any length and are never cut for reading. Ties
are decided as the operators say: of equally likely languages the first by name, of near copies the document of least id
and then of least text hash, of equal passages the one that starts first.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallax.llm import jaccard, language, packing, rules, suffixes
from parallax.llm.common import Scratch, fold


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, and those of no learned language (a share under one half)."""
    return language.known(docs, language.learn(docs, fold("doc_id", 4) != 2, public_tokenizers.path("piece_bpe_32k.model")))


def by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the quality rules don't keep."""
    return rules.kept_rows(docs, Scratch(spark, "rules"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies one document: of least id, then of least text hash; equal rows are one."""
    return jaccard.one_of_each(docs, Scratch(spark, "jaccard"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that also start earlier; parts of a character left at a cut go, and so do documents left empty."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    left = suffixes.remove_repeats(rows, Scratch(spark, "suffixes"), carry=("_row",), as_text=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("_row.text"))
    cut = left.withColumn("_text", text).where((F.col("_text") != "") | (F.col("n_removed") == 0))
    new = {"text": F.col("_text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("_text").cast("long")).otherwise(F.col("_row.n_chars"))}
    return cut.select(*(new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the documents left."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", by_language),
    ("rules", by_rules),
    ("near copies", one_of_each),
    ("repeats", without_repeats),
    ("packing", packed),
]

#: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each one's rows are written, and read again as the next one's."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return docs
