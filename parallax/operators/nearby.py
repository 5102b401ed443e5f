"""Near-identical titles that share no key: candidates by places of equal pieces, then exact scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallax.functions import similarity
from parallax.functions.text import normalize_title

LONGEST_PIECE = 12


def _apart(a: Column, b: Column) -> Column:
    """The most insertions and deletions that lie between near-identical strings of these lengths."""
    return F.floor((a + b) * (100 - int(similarity.NEAR)) / 100).cast("int")


def _partner(n: Column, longest: bool) -> Column:
    """The greatest (or least) length that a string near-identical to one of length n can have."""
    part = 100 - int(similarity.NEAR)
    return (F.floor(n * (100 + part) / (100 - part)) if longest else F.ceil(n * (100 - part) / (100 + part))).cast("int")


def _piece(n: Column) -> Column:
    """How long the pieces of a string of length n are: as long as one more fit than there can be edits, and so one at
    least stands unchanged in any near-identical string."""
    return F.least(F.lit(LONGEST_PIECE), F.floor(n / (_apart(n, _partner(n, True)) + 1)).cast("int"))


def strict(rows: DataFrame, title: str, authors: str | None = None) -> Column:
    """The string by which near identity is judged: of a title in strict form, lower case, its words sorted."""
    names = F.col(authors) if authors else F.array().cast("array<string>")
    return similarity.sorted_tokens(F.lower(normalize_title(F.col(title), names)))


def near_identical(a: DataFrame, b: DataFrame, title: str = "title", authors: str | None = None) -> DataFrame:
    """All columns of a and b (whose names must differ but for title and authors) and score: rows of near-identical titles.

    Each string of b is cut into one piece more than edits may lie between it and a near-identical one, so that one piece
    at least is the same there, displaced by no more than the number of edits. Pieces of b meet all pieces of
    a's strings of the same length; lengths and displacement leave the candidates, which are scored. No pair is lost. Let
    b be the larger side: it sends a row for each 9 or so of its characters, a one for each character. Each
    distinct string is cut once. Titles of under 3 characters, nulls and those that are empty in strict form match nothing.
    """
    drop = [c for c in (title, authors) if c]
    a_rows = a.withColumn("strict_a", strict(a, title, authors)).where((F.length(F.trim(title)) >= 3) & (F.col("strict_a") != "")).drop(*drop)
    b_rows = b.withColumn("strict_b", strict(b, title, authors)).where((F.length(F.trim(title)) >= 3) & (F.col("strict_b") != "")).drop(*drop)
    a_texts = a_rows.select("strict_a").distinct().withColumns({"id_a": F.xxhash64("strict_a"), "n_a": F.length("strict_a")})
    b_texts = b_rows.select("strict_b").distinct().withColumns({"id_b": F.xxhash64("strict_b"), "n_b": F.length("strict_b")})
    span = a_texts.agg(_partner(F.min("n_a"), False).alias("least"), _partner(F.max("n_a"), True).alias("most"))
    b_texts = b_texts.join(F.broadcast(span), (F.col("n_b") >= F.col("least")) & (F.col("n_b") <= F.col("most"))).drop("least", "most")

    lengths = F.array_distinct(F.transform(F.sequence(_partner(F.col("n_a"), False), _partner(F.col("n_a"), True)), _piece))
    a_pieces = a_texts.withColumn("q", F.explode(lengths)).where("q <= n_a").withColumn("at_a", F.explode(F.sequence(F.lit(1), F.col("n_a") - F.col("q") + 1)))
    a_pieces = a_pieces.select("id_a", "n_a", "at_a", F.substring(F.col("strict_a"), F.col("at_a"), F.col("q")).alias("piece"))
    q = _piece(F.col("n_b"))
    numbers = F.sequence(F.lit(0), _apart(F.col("n_b"), _partner(F.col("n_b"), True)))
    b_pieces = b_texts.withColumn("q", q).withColumn("at_b", F.explode(F.transform(numbers, lambda k: k * F.col("q") + 1)))
    b_pieces = b_pieces.select("id_b", "n_b", "at_b", F.substring(F.col("strict_b"), F.col("at_b"), F.col("q")).alias("piece"))

    apart = _apart(F.col("n_a"), F.col("n_b"))
    near = (F.abs(F.col("n_a") - F.col("n_b")) <= apart) & (F.abs(F.col("at_a") - F.col("at_b")) <= apart)
    met = a_pieces.join(b_pieces, "piece").where(near).select("id_a", "id_b").distinct()
    scored = met.join(a_texts.select("id_a", "strict_a"), "id_a").join(b_texts.select("id_b", "strict_b"), "id_b")
    scored = scored.withColumn("score", similarity.ratio_of(F.col("strict_a"), F.col("strict_b"))).where(F.col("score") >= similarity.NEAR)
    return a_rows.join(scored.select("strict_a", "strict_b", "score"), "strict_a").join(b_rows, "strict_b").drop("strict_a", "strict_b")
