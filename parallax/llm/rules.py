"""Quality rules with thresholds that follow each language and source; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import Scratch

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
#: The metrics held against adaptive fences, and how far a fence stands above the upper quartile at the least: a guard
#: for groups without any spread.
METRICS = {"symbols": 0.01, "dup_lines": 0.01, "repeats": 0.01, "word_length": 0.1, "capitals": 0.01}
#: Most sound texts have none of these, and those that have some differ widely: the quartiles are of values over zero.
WHERE_ANY = {"dup_lines", "repeats"}
#: A sketch of fewer values gives way to one of more groups.
LEAST_VALUES = 20
LEAST_WORDS = 50


def repeated_words(words: Column) -> Column:
    """Number of words in 3-word windows that occur twice or more in the array.

    Windows are compared by 64-bit hash. Only where two hashes are equal are they sorted with their places; a place
    whose neighbour in that order has the same hash is repeated, and covers three words.
    """
    n = F.size(words)
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)))).otherwise(F.array().cast("array<bigint>"))

    def count(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.element_at(F.transform(F.array(placed), covered), 1)

    def covered(s: Column) -> Column:
        last = F.size(s) - 1
        same = lambda e, k: ((k > 0) & (F.get(s, k - 1)["h"] == e["h"])) | ((k < last) & (F.get(s, k + 1)["h"] == e["h"]))
        places = F.array_sort(F.transform(F.filter(s, same), lambda e: e["i"]))
        start = F.struct(F.lit(-3).alias("before"), F.lit(0).alias("n"))
        step = lambda a, p: F.struct(p.alias("before"), (a["n"] + F.least(F.lit(3), p - a["before"])).alias("n"))
        return F.aggregate(places, start, step, lambda a: a["n"])

    one = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), count(h)).otherwise(F.lit(0))
    return F.element_at(F.transform(F.array(windows), one), 1)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", carry: bool = False) -> DataFrame:
    """The counts of each whole text; a null text has no words. carry: the whole row as `row`, too."""
    row = ["row"] if carry else []
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).cast("string").alias("text"), *([F.struct(*docs.columns).alias("row")] if carry else []))
    cut = base.select(
        *row,
        "doc_id",
        "lang",
        "source",
        F.filter(F.split(text, SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
    )
    return cut.select(
        *row,
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_capitals",
    )


def with_metrics(counts: DataFrame) -> DataFrame:
    per = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    return counts.withColumns(
        {
            "symbols": per("n_symbols", "word_chars"),
            "dup_lines": per("n_dup_lines", "n_lines"),
            "repeats": per("n_repeat_words", "n_words"),
            "word_length": per("word_chars", "n_words"),
            "capitals": per("n_capitals", "word_chars"),
        }
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fences(measured: DataFrame, scratch: Scratch, spread: float = 6.0, accuracy: int = 10_000) -> DataFrame:
    """A row for each (lang, source) with a document that passes the base rules: the upper fence of each metric.

    The quartiles come from mergeable quantile sketches over the documents that pass the base rules; sketches are built
    where the rows lie and merged after, so a hot group is no larger than another. They are taken of each (lang,
    source), each lang, each source and all. A fence is the upper quartile plus spread times the distance between the
    quartiles: the first of these levels with LEAST_VALUES values gives the quartile (else all), and the first such
    whose quartiles differ gives the distance, which counts as the metric's own guard at the least.
    """
    sound = measured.where(~base_failed())
    of = lambda m: F.when(F.col(m) > 0, F.col(m)) if m in WHERE_ANY else F.col(m)
    quartiles = [F.percentile_approx(of(m), [0.25, 0.75], accuracy).alias(m) for m in METRICS]
    sketched = sound.cube("lang", "source").agg(F.grouping_id().alias("level"), *quartiles, *(F.count(of(m)).alias(f"n_{m}") for m in METRICS))
    sketched = scratch.save(sketched, "quartiles")
    level = lambda k: sketched.where(F.col("level") == k).select(F.col("lang").alias(f"lang_{k}"), F.col("source").alias(f"source_{k}"), *(F.col(c).alias(f"{c}_{k}") for m in METRICS for c in (m, f"n_{m}")))
    own, lang, source, whole = (level(k) for k in range(4))  # grouping_id: 1 leaves the source out, 2 the language
    own = own.join(lang, own["lang_0"].eqNullSafe(lang["lang_1"]), "left").join(source, own["source_0"].eqNullSafe(source["source_2"]), "left").crossJoin(whole)

    def fence(m: str, guard: float) -> Column:
        low, high = ([F.get(f"{m}_{k}", F.lit(i)) for k in range(4)] for i in (0, 1))
        enough = [F.col(f"n_{m}_{k}") >= LEAST_VALUES for k in range(3)] + [F.lit(True)]
        quartile = F.coalesce(*(F.when(e, h) for e, h in zip(enough, high)), F.lit(0.0))
        distance = F.coalesce(*(F.when(e & (h > a), h - a) for e, a, h in zip(enough, low, high)), F.lit(0.0))
        return (quartile + F.greatest(spread * distance, F.lit(guard))).alias(f"most_{m}")

    return own.select(F.col("lang_0").alias("g_lang"), F.col("source_0").alias("g_source"), *(fence(m, guard) for m, guard in METRICS.items()))


def judge(docs: DataFrame, scratch: Scratch, spread: float = 6.0, **columns: str) -> DataFrame:
    """doc_id, the counts, base_failed and kept for every document.

    base_failed: under 50 words, or over half of the words in repeated windows. kept: not base_failed, and no metric
    above the fence of its language and source (null is a group of its own). Repeated ids are judged row by row; an
    empty table gives no rows; other columns are not read. The counts are taken once and written to the shared folder.
    """
    return _judged(features(docs, **columns), scratch, spread).select(*COLUMNS, "lang", "source")


def kept_rows(docs: DataFrame, scratch: Scratch, spread: float = 6.0, **columns: str) -> DataFrame:
    """The rows that judge() keeps, with all their columns; they lie beside their counts, so nothing is joined by id."""
    return _judged(features(docs, carry=True, **columns), scratch, spread).where("kept").select("row.*")


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def _judged(found: DataFrame, scratch: Scratch, spread: float) -> DataFrame:
    counts = scratch.save(found, "counts")
    measured = with_metrics(counts)
    limits = fences(measured, scratch, spread)
    joined = measured.join(limits, measured["lang"].eqNullSafe(limits["g_lang"]) & measured["source"].eqNullSafe(limits["g_source"]), "left")
    base = base_failed()
    within = F.lit(True)
    for m in METRICS:
        within = within & F.coalesce(F.col(m) <= F.col(f"most_{m}"), F.lit(False))
    return joined.withColumns({"base_failed": base, "kept": ~base & within})
