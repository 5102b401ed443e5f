"""Near-identical titles, folds over sorted rows, the registry's cache, spot checks, reports, incremental scans."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from parallax.functions import similarity
from parallax.operators import align, backlog, cache, layout, metrics, nearby, report, sampling
from parallax.sources import files
from parallax.streaming import scan


def test_no_near_identical_pair_is_lost(spark):
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdeß") for _ in range(draw.randint(1, 9)))
    base = [" ".join(word() for _ in range(draw.choice([1, 1, 2, 3, 8, 30, 60]))) for _ in range(60)]

    def edited(t):
        chars = list(t)
        for _ in range(draw.randint(0, max(1, len(t) // 10))):
            at = draw.randrange(len(chars) + 1)
            chars[at : at + draw.randint(0, 1)] = draw.choice(["", "x", " "])
        return "".join(chars)

    a = [(i, t) for i, t in enumerate(base)] + [(900, None), (901, "  "), (902, "ab"), (903, "(only this)")]
    b = [(i, edited(draw.choice(base))) for i in range(500)] + [(900, None), (901, ""), (902, "ab"), (903, "(only this)"), (904, base[0]), (904, base[0])]
    left, right = spark.createDataFrame(a, "a long, title string"), spark.createDataFrame(b, "b long, title string")
    key = lambda rows, name: [(r[0], r[1]) for r in rows.select(name, nearby.strict(rows, "title").alias("s"), "title").where("length(trim(title)) >= 3 and s <> ''").collect()]
    want = sorted((i, j, round(similarity.ratio(x, y), 6)) for i, x in key(left, "a") for j, y in key(right, "b") if similarity.ratio(x, y) >= 95)
    got = nearby.near_identical(left, right)
    assert sorted((r["a"], r["b"], round(r["score"], 6)) for r in got.collect()) == want and len(want) > 100
    assert nearby.near_identical(left.limit(0), right).count() == 0 == nearby.near_identical(left, right.limit(0)).count()


def rows_of(words, tolerance):
    anchor, rows = None, []
    for v, h, c in sorted(words):
        if anchor is None or v - anchor > tolerance:
            anchor = v
            rows.append([])
        rows[-1].append((h, v, c))
    return [" ".join(c for *_, c in sorted(r)) for r in rows]


@pytest.mark.parametrize("tolerance", [8.0, 10.0, 0.3])
def test_rows_of_words(spark, tolerance):
    draw = random.Random(1)
    words = [(p, draw.choice([draw.uniform(-300, 900), float(draw.randint(0, 60) * 4)]) * (tolerance / 8), draw.random(), f"w{k}") for p in (1, 2, None) for k in range(400)]
    got = layout.row_clusters(spark.createDataFrame(words, "page long, vpos double, hpos double, content string").where("page is not null"), "page", tolerance)
    by = {p: [r["content"] for r in sorted(got.where(F.col("page") == p).collect(), key=lambda r: r["row"])] for p in (1, 2)}
    assert by == {p: rows_of([w[1:] for w in words if w[0] == p], tolerance) for p in (1, 2)}


def test_a_page_of_a_million_words(spark):
    n = 1_000_000
    words = spark.range(n).select(F.lit(1).alias("page"), (F.col("id") * 7919 % 5_000_000 / 100.0).alias("vpos"), F.col("id").cast("double").alias("hpos"), F.lit("x").alias("content"))
    got = layout.row_clusters(words).agg(F.count("*"), F.max("row"), F.sum((F.length("content") + 1) / 2)).first()
    values = sorted({i * 7919 % 5_000_000 / 100.0 for i in range(n)})
    anchor, rows = None, 0
    for v in values:
        if anchor is None or v - anchor > 8:
            anchor, rows = v, rows + 1
    assert tuple(got) == (rows, rows, n)


def test_long_readings_are_aligned_entry_by_entry(spark):
    n = 100_000
    found = spark.range(n).select(F.lit("k").alias("key"), F.lit("A").alias("side_a"), F.lit("B").alias("side_b"), (F.col("id") + 1).cast("int").alias("i"), (F.col("id") + 1).cast("int").alias("j"), F.lit(80.0).alias("score"), F.lit(True).alias("near"))
    assert align.align(found).agg(F.count("*"), F.sum(F.abs(F.col("i") - F.col("j")))).first()[:] == (n, 0)


def test_alignment_takes_the_best_behind_the_last(spark):
    rows = [("k", "A", "B", 1, 2, 70.0, False), ("k", "A", "B", 1, 3, 70.0, True), ("k", "A", "B", 2, 1, 99.0, True), ("k", "A", "B", 3, 9, 71.0, False), ("k", "A", "B", 3, 4, 80.0, True), ("l", "A", "B", 1, 1, 90.0, True)]
    found = spark.createDataFrame(rows, "key string, side_a string, side_b string, i int, j int, score double, near boolean")
    assert sorted(map(tuple, align.align(found).collect())) == [("k", "A", "B", 1, 3, True), ("k", "A", "B", 3, 4, True), ("l", "A", "B", 1, 1, True)]


def test_registry_cache(spark, tmp_path):
    folder = f"{tmp_path}/cache"
    items = spark.createDataFrame([("1", 1, "book-chapter", "c"), ("1", 2, "monograph", "d")], "isbn string, ordinal int, type string, DOI string")
    wanted = spark.createDataFrame([("1",), ("2",), ("3",), ("3",), (None,), ("",)], "isbn string")
    asked = []

    def fetch(failing, day):
        def ask(isbns):
            asked.append(sorted(r["isbn"] for r in isbns.collect()))
            return cache.answers(isbns, items, spark.createDataFrame([(f,) for f in failing], "isbn string"), day)

        return ask

    got = lambda out: {r["isbn"]: (r["status"], r["doi"], r["n_items"]) for r in out.where("isbn <> ''").collect()}
    first = got(cache.read_through(wanted, folder, 1, fetch(["3"], "2026-01-01")))
    assert first == {"1": ("found", "d", 2), "2": ("empty", None, 0), "3": ("failed", None, None)}
    for _ in range(2):
        second = got(cache.read_through(wanted, folder, 2, fetch([], "2026-01-02")))
        assert second == {**first, "3": ("empty", None, 0)}
    forced = cache.read_through(wanted, folder, 3, fetch(["1"], "2026-01-03"), force=True)
    assert got(forced) == second and asked == [["1", "2", "3"], ["3"], ["3"], ["1", "2", "3"]]
    assert {r["isbn"]: r["fetched_at"].date() for r in cache.read(spark, folder).collect()} == {"1": datetime.date(2026, 1, 1), "2": datetime.date(2026, 1, 3), "3": datetime.date(2026, 1, 3)}
    assert cache.capped(spark.createDataFrame([("a", 99), ("b", 100)], "isbn string, n_items long")).count() == 1


def test_a_spot_check_draws_the_same_however_a_table_is_dealt(spark):
    truth = spark.createDataFrame([(k, [False, True, None][k % 3]) for k in range(900)], "key long, verified boolean")
    drawn = [{r["key"] for r in sampling.uniform(truth.where("verified = false").repartition(p), 40, "key").collect()} for p in (1, 3, 7)]
    assert drawn[0] == drawn[1] == drawn[2] and len(drawn[0]) == 40 and all(k % 3 == 0 for k in drawn[0])
    check = lambda n, seed=1: tuple(sampling.spot_check(truth, n, truth.where("key % 2 = 0"), seed).first())
    assert check(10**6) == (300, 150, 0.5) and check(-5) == (0, 0, None) and check(50)[0] == 50 and check(50, 1) != check(50, 2)
    counts = [0] * 10
    for seed in range(200):
        for r in sampling.uniform(truth.where("key < 10"), 3, "key", seed).collect():
            counts[r["key"]] += 1
    assert sum(counts) == 600 and 35 < min(counts) and max(counts) < 90


def test_files_that_break_off_are_not_stale(spark, tmp_path):
    for name, text in {"a": '{"source": "bulk_gate", "entries": [{"title": "x"}]}', "b": '{"source": "bulk_gate", "entries": [{"tit', "c": '{"source": "bulk_gate", "entries": []}', "d": '{"entries": [{"title": "x"}]}'}.items():
        (tmp_path / f"{name}.expected.json").write_text(text)
    got = {r["key"]: (r["readable"], r["stale"]) for r in files.truth(spark, str(tmp_path)).collect()}
    assert got == {"a": (True, True), "b": (False, False), "c": (True, False), "d": (True, False)}


def test_corpora(spark, tmp_path):
    for name in ("one", "two", "three"):
        (tmp_path / name).mkdir()
    for name in ("one", "two"):
        (tmp_path / name / "manifest.json").write_text("{}")
    assert files.corpora(spark, str(tmp_path)) == ["one", "two"] and files.corpora(spark, f"{tmp_path}/none") == []
    assert files.corpus(spark, str(tmp_path), "one").endswith("/one") and files.corpus(spark, str(tmp_path), "new", create=True).endswith("/new")
    with pytest.raises(ValueError, match="available: one, two"):
        files.corpus(spark, str(tmp_path), "three")


def test_report_rows_are_in_order(spark):
    scored = spark.createDataFrame([("a", 0.5, 0.25, 0.5, 1, 1, 3), ("b", 1.0, 1.0, 1.0, 2, 0, 0), ("c", 0.5, 0.5, 0.5, 1, 1, 1), ("d", 0.5, 0.5, 0.5, 1, 1, 1)], "key string, precision double, recall double, f1 double, tp int, fp int, fn int")
    manifest = spark.createDataFrame([("a", "Zebra", "u"), ("b", "B", None), ("c", "apple", None)], "key string, title string, toc_download_url string")
    rows = report.book_rows(scored, manifest).collect()
    assert [(r["key"], r["name"], r["recall"]) for r in rows] == [("b", "B", "100%"), ("c", "apple", "50%"), ("d", "d", "50%"), ("a", "Zebra", "25%")]
    line = spark.createDataFrame([("7", "T"), (None, "T"), ("xxviii", "T")], "page string, title string")
    assert [r[0] for r in line.select(report.entry_line(F.col("page"), F.col("title"))).collect()] == ["    p.   7  T", "    p.   ?  T", "    p.xxviii  T"]
    kinds = spark.createDataFrame([("vision",), ("text",), ("audio",)], "kind string")
    assert [r[0] for r in kinds.select(report.kind_label(F.col("kind"), F.lit("m/1"))).collect()] == ["vision: m/1", "text (OCR'd): m/1", "audio: m/1"]


def test_two_deliveries_equal_one(spark, tmp_path):
    toc = [{"id": "http://x"}]
    rows = [{"position": p, "id": f"http://r/{k}", "type": ["EditedVolume"] if p != 3 else ["Book"], "isbn": [k], "tableOfContents": toc if p != 4 else [{"id": "/no"}]} for p, k in enumerate(["a", "b", "a", "c", "d", "held", "d", "b", "c"])]
    held = spark.createDataFrame([("held",)], "key string")
    for name, part in (("1", rows[:5]), ("2", rows[5:])):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{name}.json").write_text("\n".join(json.dumps(r) for r in part))
        scan.watch(spark, f"{tmp_path}/in", f"{tmp_path}/out", held).awaitTermination()
    again = spark.read.schema(scan.RECORD).json(f"{tmp_path}/in/2.json")
    scan.decide(again, 1, f"{tmp_path}/out", held)  # a batch that is tried once more
    got = {r["position"]: r["skipped"] for r in scan.scanned(spark, f"{tmp_path}/out").collect()}
    had, wrong, none = "already acquired", "no matching type/toc", "no toc url"
    assert got == {0: None, 1: None, 2: had, 3: wrong, 4: none, 5: had, 6: None, 7: had, 8: None}


def test_batches_replace_and_skip_what_is_empty(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "key string, entries array<string>, reader string")
    backlog.write_batch(rows(("a", ["x"], "A"), ("b", [], "A"), ("c", ["y"], "B")), str(tmp_path), 1, "reader")
    for _ in range(2):
        backlog.write_batch(rows(("a", ["z", "z"], "A")), str(tmp_path), 2, "reader")
    got = sorted(map(tuple, backlog.newest(spark, str(tmp_path), rows(("a", [], "A")).schema, ["key", "reader"]).collect()))
    assert got == [("a", ["z", "z"], "A"), ("c", ["y"], "B")]
    todo = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "place int, key string")
    assert [r["key"] for r in backlog.first_todo(todo, "place", 2, todo.where("key <> 'a'")).collect()] == ["b"]


def test_means_of_nothing(spark):
    none = spark.createDataFrame([], "key long, precision double, recall double, f1 double")
    assert tuple(metrics.overall(none).first()) == (0.0, 0.0, 0.0, None, 0)
