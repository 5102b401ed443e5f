"""Order-preserving alignment of two readings of the same documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parallax.functions import similarity
from parallax.functions.text import normalize_title
from parallax.operators.streams import folded

SIDE = ["ordinal", "title", "page", "page_key", "page_val", "skip"]


def readers(entries: DataFrame) -> DataFrame:
    """Pairs of readers of the same document, the first by name being a; each reading has at least one entry."""
    who = entries.select("key", "reader").distinct()
    other = who.select("key", F.col("reader").alias("side_b"))
    return who.withColumnRenamed("reader", "side_a").join(other, "key").where("side_a < side_b")


def candidates(a: DataFrame, b: DataFrame, ordered: bool = False) -> DataFrame:
    """(key, side_a, side_b, i, j, score, near) of entries that may match.

    a and b: key, reader, ordinal, title, authors, page_key. Entries with pages match on equal page keys and a title
    score of 70 or more; those without a page only with each other, by near identity. The page is part of the join's
    key, so no pair is scored whose pages differ; each pair of titles is scored once. ordered: only readers in the
    order of their names, as where a and b are the same. Where a side has a column title_variants (an array, may be
    null), the score is the best of all its titles with all of the other's; near identity is of the titles alone.
    """
    wide = "title_variants" in a.columns or "title_variants" in b.columns

    def titles(d):
        if not wide:
            return F.col("title")
        variants = F.col("title_variants") if "title_variants" in d.columns else F.lit(None)
        return F.concat(F.array("title"), F.coalesce(variants, F.array().cast("array<string>")))

    def side(d, n, o):
        strict = F.lower(normalize_title(F.col("title"), F.col("authors")))
        return d.select("key", F.coalesce("page_key", F.lit("-")).alias("at"), F.col("reader").alias(f"side_{n}"), F.col("ordinal").alias(o), titles(d).alias(f"title_{n}"), strict.alias(f"strict_{n}"))

    met = side(a, "a", "i").join(side(b, "b", "j"), ["key", "at"]).where("side_a < side_b" if ordered else "side_a <> side_b")
    names = ["title_a", "title_b", "strict_a", "strict_b"]
    scored = met.select(*names).distinct()
    scored = _best_of_variants(scored, names) if wide else scored.withColumn("score", similarity.title_score(F.col("title_a"), F.col("title_b")))
    scored = scored.withColumn("strict", similarity.token_sort_ratio(F.col("strict_a"), F.col("strict_b")))
    scored = met.join(scored, names)
    ok = F.when(F.col("at") == "-", F.col("strict") >= similarity.NEAR).otherwise(F.col("score") >= similarity.MATCH)
    return scored.where(ok).select("key", "side_a", "side_b", "i", "j", F.when(F.col("at") == "-", F.col("strict")).otherwise(F.col("score")).alias("score"), (F.col("strict") >= similarity.NEAR).alias("near"))


def _best_of_variants(met: DataFrame, names: list[str]) -> DataFrame:
    """met, whose title_a and title_b are arrays, with the best score of their titles; each pair of titles is scored once."""
    ways = met.withColumn("x", F.explode("title_a")).withColumn("y", F.explode("title_b"))
    scores = ways.select("x", "y").distinct().withColumn("score", similarity.title_score(F.col("x"), F.col("y")))
    return ways.join(scores, ["x", "y"]).groupBy(*names).agg(F.max("score").alias("score"))


def align(found: DataFrame) -> DataFrame:
    """The greedy alignment: (key, side_a, side_b, i, j, near).

    In a's order, each entry takes the best candidate behind the last one taken; of equal scores the last wins. Two
    readings' candidates are gone through one at a time, in order, so readings may have any length.
    """
    names = ["key", "side_a", "side_b"]

    def step(rows):
        last, now, best = 0, None, None
        for *own, i, _, j, near in rows:
            if i != now:
                if best:
                    yield best
                    last = best[4]
                now, best = i, None
            if j > last:  # in order of score and j
                best = (*own, i, j, near)
        if best:
            yield best

    schema = StructType([*(found.schema[c] for c in [*names, "i", "j", "near"])])
    return folded(found.select(*names, "i", "score", "j", "near"), names, ["i", "score", "j"], step, schema)


def diff(entries: DataFrame, matched: DataFrame, pairs: DataFrame) -> DataFrame:
    """(key, side_a, side_b, kind, i, j): matched pairs, and the entries that only one side has."""
    a = pairs.join(entries.select("key", F.col("reader").alias("side_a"), F.col("ordinal").alias("i")), ["key", "side_a"])
    b = pairs.join(entries.select("key", F.col("reader").alias("side_b"), F.col("ordinal").alias("j")), ["key", "side_b"])
    names = ["key", "side_a", "side_b"]
    out = matched.select(*names, F.lit("matched").alias("kind"), "i", "j")
    out = out.unionByName(a.join(matched, [*names, "i"], "left_anti").select(*names, F.lit("only_a").alias("kind"), "i", F.lit(None).cast("int").alias("j")))
    return out.unionByName(b.join(matched, [*names, "j"], "left_anti").select(*names, F.lit("only_b").alias("kind"), F.lit(None).cast("int").alias("i"), "j"))


def rates(entries: DataFrame, matched: DataFrame, pairs: DataFrame) -> DataFrame:
    """For each pair of readings: entries of both, matched ones, the share of the longer, and if all are near identical."""
    size = entries.groupBy("key", "reader").agg(F.count("*").alias("n"))
    names = ["key", "side_a", "side_b"]
    hits = matched.groupBy(*names).agg(F.count("*").alias("matched"), F.bool_and("near").alias("near"))
    out = pairs.join(size.select("key", F.col("reader").alias("side_a"), F.col("n").alias("n_a")), ["key", "side_a"]).join(size.select("key", F.col("reader").alias("side_b"), F.col("n").alias("n_b")), ["key", "side_b"])
    out = out.join(hits, names, "left").withColumns({"matched": F.coalesce("matched", F.lit(0)), "near": F.coalesce("near", F.lit(True))})
    return out.withColumn("rate", F.col("matched") / F.greatest("n_a", "n_b"))
