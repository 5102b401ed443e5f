from pyspark.sql import functions as F

from parallax.operators import align, gate, layout, metrics, sampling
from parallax.sources.adapters import with_pages


def entries(spark, **readings):
    rows = [("k", reader, i + 1, t, p, False) for reader, es in readings.items() for i, (t, p) in enumerate(es)]
    return with_pages(spark.createDataFrame(rows, "key string, reader string, ordinal int, title string, page string, skip boolean"))


def matched(df):
    return sorted((r["i"], r["j"]) for r in align.align(align.candidates(df, df).where("side_a < side_b")).collect())


def test_pages_and_titles(spark):
    assert matched(entries(spark, a=[("Appendix", "R42"), ("Vorwort", "VII"), ("Eins", "07")], b=[("Appendix", "r42"), ("Vorwort", "vii"), ("Eins", "7")])) == [(1, 1), (2, 2), (3, 3)]
    assert matched(entries(spark, a=[("Titel", "9"), ("Ende", None)], b=[("Titel", "11"), ("Ende", "331")])) == []


def test_variants_of_a_title_count(spark):
    rows = [("k", "a", 1, "und Verantwortung", "9", ["Einleitung: Endlichkeit und Verantwortung"]), ("k", "a", 2, "Ende", "11", None), ("k", "b", 1, "Von der Endlichkeit: Einleitung", "9", ["Endlichkeit und Verantwortung, Einleitung"]), ("k", "b", 2, "Schluss", "11", ["Ende"])]
    df = with_pages(spark.createDataFrame(rows, "key string, reader string, ordinal int, title string, page string, title_variants array<string>"))
    assert matched(df) == [(1, 1), (2, 2)]
    assert matched(df.drop("title_variants")) == []


def test_order_is_kept(spark):
    assert matched(entries(spark, a=[("Erster", "9"), ("Zweiter", "40")], b=[("Zweiter", "40"), ("Erster", "9")])) == [(1, 2)]


def test_of_equal_scores_the_last_wins(spark):
    assert matched(entries(spark, a=[("Titel", "9")], b=[("Titel", "9"), ("Titel", "9")])) == [(1, 2)]


def test_without_pages_titles_must_be_near_identical(spark):
    assert matched(entries(spark, a=[("Einleitung", None)], b=[("Einleitung", None)])) == [(1, 1)]
    assert matched(entries(spark, a=[("Einleitung:", None)], b=[("Einleitung: Endlichkeit und Verantwortung", None)])) == []


def rated(df):
    pairs = align.readers(df)
    m = align.align(align.candidates(df, df).where("side_a < side_b"))
    return pairs, m, gate.passed(align.rates(df, m, pairs))


def test_gate_and_merge(spark):
    ten = [(f"Kapitel {'abcdefghij'[i] * 4}", str(10 * (i + 1))) for i in range(10)]
    df = entries(spark, a=ten, b=[*ten[:9], ("Anderes", "101")])
    pairs, m, gated = rated(df)
    row = gated.first()
    assert (row["matched"], row["passed"]) == (9, True)
    merged = gate.merge(df, gate.best_pair(gated), align.diff(df, m, pairs)).orderBy("position").collect()
    assert [r["page"] for r in merged] == [p for _, p in ten] + ["101"]


def test_metrics(spark):
    rows = metrics.scores(spark.createDataFrame([(1, 0, 1), (0, 0, 0)], "tp long, fp long, fn long")).collect()
    assert round(rows[0]["f1"], 6) == round(2 / 3, 6) and rows[1]["f1"] == 0.0
    agreement = spark.createDataFrame([("a", "b", 0.68, 5), ("c", "d", 0.58, 5), ("e", "e2", 1.0, 1)], "model_a string, model_b string, mean_agreement double, n_books long")
    accuracy = spark.createDataFrame([("a", 0.8), ("b", 0.8), ("c", 0.9), ("d", 0.6), ("e", 1.0), ("e2", 1.0)], "model string, f1 double")
    got = {r["model_a"]: (round(abs(r["kappa"]), 6), round(r["score"], 6)) for r in metrics.rank_pairs(agreement, accuracy).collect()}
    assert got == {"a": (0.0, 0.8), "c": (0.0, 0.6), "e": (0.0, 1.0)}


def test_rows_are_anchored(spark):
    tokens = spark.createDataFrame([(1, 100.0, 5.0, "9"), (1, 102.0, 1.0, "Einleitung"), (1, 107.0, 9.0, "x"), (1, 109.0, 1.0, "y")], "page int, vpos double, hpos double, content string")
    assert [r["content"] for r in layout.row_clusters(tokens).orderBy("row").collect()] == ["Einleitung 9 x", "y"]


def test_samples(spark):
    items = spark.range(100).select(F.col("id").alias("key"), F.when(F.col("id") < 80, "x").otherwise("y").alias("s"))
    got = sampling.stratified(items, 50, ["s"], "key")
    assert {r["s"]: r["count"] for r in got.groupBy("s").count().collect()} == {"x": 40, "y": 10}
    assert sampling.stratified(items.limit(5), 50, ["s"], "key").count() == 5
