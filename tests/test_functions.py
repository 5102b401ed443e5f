import random

import pytest
from pyspark.sql import functions as F

from parallax.functions import pages, similarity, text


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").select("i", f(F.col("v")).alias("r"))
    return [r[1] for r in sorted(rows.collect())]


def test_parse_page(spark):
    given = ["vii", "xlix", "li", "iiii", "mm", "07", "VII", "word", "", None, "²", "L", "R42"]
    assert column(spark, given, pages.parse_page) == [7, 49, None, None, None, 7, 7, None, None, None, None, 50, None]


def test_page_key_is_the_three_way_test(spark):
    rng = random.Random(7)
    given = ["R42", "r42", "VII", "vii", "07", "7", "ß", "ss", "L", "50"] + ["".join(rng.choices("ivxR47ßsS", k=rng.randint(1, 3))) for _ in range(150)]
    keys, numbers = column(spark, given, pages.page_key), column(spark, given, pages.parse_page)
    for a, ka, na in zip(given, keys, numbers):
        for b, kb, nb in zip(given, keys, numbers):
            assert (ka == kb) == (a == b or (na is not None and na == nb) or a.casefold() == b.casefold()), (a, b)


def test_normalize_page(spark):
    given = ["12.7", "12", "true", "-1", '"-1"', '" x "', '""', "null"]
    assert column(spark, given, lambda c: pages.normalize_page(F.parse_json(c))) == ["12", "12", None, None, "-1", "x", None, None]


def test_normalize_title(spark):
    rows = [("3. Kant: Ethik", ["Kant"], "Ethik"), ("Ethik - Kant", ["Kant"], "Ethik"), ("Ethik (Kant)", ["Kant"], "Ethik"), ("„Wort“", [], '"Wort"'), ("Titel (1999).", None, "Titel"), ("Floating", [], "Floating")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(rows)], "i int, t string, a array<string>")
    got = [r[1] for r in sorted(df.select("i", text.normalize_title(F.col("t"), F.col("a"))).collect())]
    assert got == [r[2] for r in rows]


def test_answers(spark):
    assert column(spark, ["```json\n[1]\n```", "[1]"], text.without_fence) == ["[1]", "[1]"]
    assert column(spark, ["x [1, [2]] y", "] [", "none"], text.array_span) == ["[1, [2]]", None, None]


def test_fields(spark):
    assert column(spark, ["978-3-16-148410-0 x", "3-16-148410-x; y", "z"], text.normalize_isbn) == ["9783161484100", "316148410X", None]
    assert column(spark, ["12-20", " -4", "7"], text.first_page) == ["12", None, "7"]


def test_ratios():
    assert round(similarity.ratio("einleitung:", "einleitung: endlichkeit und verantwortung"), 2) == 42.31
    assert similarity.ratio("", "") == 100.0
    assert similarity.partial_ratio("ein interview", "ein interview ss m onen") == 100.0
    assert similarity.partial_ratio("", "x") == 0.0


@pytest.mark.parametrize("seed", range(3))
def test_common_against_the_table(seed):
    rng = random.Random(seed)
    for _ in range(60):
        a, b = ("".join(rng.choices("abc ", k=rng.randint(0, 12))) for _ in "ab")
        row = [0] * (len(b) + 1)
        for x in a:
            old, row = row, [0]
            for j, y in enumerate(b):
                row.append(max(old[j + 1], row[j], old[j] + (x == y)))
        assert similarity.common(a, b) == row[-1]


def test_titles_lose_numbers_and_chapter_words_only(spark):
    from parallax.functions import text

    cases = {"Chapter 1: Ethics": "Ethics", "2: Ethics": "Ethics", "Kapitel 3.1 Ethik": "Ethik", "Capítulo 4. Casas": "Casas", "I Robot": "I Robot", "C Major": "C Major", "1.4 Revenues": "Revenues", "„Ruhe“ (Übersetzt).": '"Ruhe"', "3) x": "3) x"}
    rows = spark.createDataFrame([(k, [""]) for k in cases], "t string, a array<string>")
    assert {r[0]: r[1] for r in rows.select("t", text.normalize_title(F.col("t"), F.col("a"))).collect()} == cases


def test_records(spark):
    from parallax.functions import records

    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(records.model_of(F.lit("--x 1 --model=lab/m.2 --y"))) == "lab/m.2" and one(records.model_of(F.lit("--x"))) is None
    assert one(records.file_part(F.lit("lab/m"))) == "lab__m"
    assert one(records.answer_entries(F.lit("[{"))) is None and one(records.answer_entries(F.lit("none"))) is None
    got = one(records.answer_entries(F.lit('```\n[{"title": 1234, "skip": "false", "printed_page_number": 7.0}, {"title": null}, [1]]\n```')))
    assert [tuple(r) for r in got] == [("1234", [], "7", True)]


def test_partial_ratio_passes_over_no_better_part():
    draw = random.Random(8)
    for _ in range(3_000):
        letters = draw.choice(["ab", "abcdef ", "aß日 "])
        a, b = ("".join(draw.choice(letters) for _ in range(draw.randint(0, n))) for n in (9, 22))
        b = b[:5] + a + b[5:] if draw.random() < 0.2 else b
        short, long = sorted((a, b), key=len)
        ways = [(short, long)] + [(long, short)] * (len(a) == len(b))
        parts = [similarity.ratio(x, y[max(0, i) : i + len(x)]) for x, y in ways for i in range(1 - len(x), len(y))]
        assert similarity.partial_ratio(a, b) == (max(parts) if short else 100.0 * (not long)), (a, b)
