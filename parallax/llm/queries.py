"""The registered queries of this subpackage, one for each numbered operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallax.llm import bytebpe, html, jaccard, language, ordermin, packing, pipeline, quality, ranked, rules, sql, store, suffixes, turns, vectors
from parallax.llm.common import Scratch, fold

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    space = quality.learn(docs, labels, fold("doc_id", 5) != 0)
    return quality.score(docs, space).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.digests(*store.write(documents(spark, sf_dir), WORD_BPE, Scratch(spark, "op2")))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.learn(docs, fold("doc_id", 4) != 2, PIECES)
    return language.predict(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.remove_repeats(documents(spark, sf_dir), Scratch(spark, "op4"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Scratch(spark, "op5"))


def op6_bytebpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(bytebpe.encode(documents(spark, sf_dir), BYTE_RANKS, public_tokenizers.PATTERN))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(documents(spark, sf_dir), Scratch(spark, "op8")).drop("lang", "source")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(documents(spark, sf_dir), Scratch(spark, "op9"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), BYTE_BPE)


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), Scratch(spark, "op11"))


def op12_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"), Scratch(spark, "op12"))


def op13_ordermin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.fingerprints(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_store": op2_store,
        "op3_language": op3_language,
        "op4_suffixes": op4_suffixes,
        "op5_vectors": op5_vectors,
        "op6_bytebpe": op6_bytebpe,
        "op7_html": op7_html,
        "op8_rules": op8_rules,
        "op9_jaccard": op9_jaccard,
        "op10_packing": op10_packing,
        "op11_search": op11_search,
        "op12_turns": op12_turns,
        "op13_ordermin": op13_ordermin,
        "pipeline": pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLE_SQL)
