"""Predictions and votes against brute force; odd rows of the operators that score or extract; invalid UTF-8."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from parallax.llm import bytebpe, html, jaccard, language, ordermin, packing, quality, queries, store, turns
from parallax.llm.common import Scratch

DOCS = "doc_id long, text string, lang string, score double, id string"


def prose(seed, lang, n):
    draw = random.Random(seed)
    words = {"de": "der die das und nicht größe straße haus ist ein über wald".split(), "en": "the of and not house is a over wood stone they with".split(), "fr": "le la et pas maison est une sur bois été avec où".split()}[lang]
    return " ".join(draw.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def train(spark):
    rows = [(k, prose(k, ("de", "en", "fr")[k % 3], 20), ("de", "en", "fr")[k % 3]) for k in range(90)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def model(train):
    return language.learn(train, F.lit(True), queries.PIECES)


def all_ways(word, model, k):
    """The sum over all segmentations, one by one."""
    if not word:
        return 1.0
    total = 0.0
    for j in range(1, min(len(word), model.longest) + 1):
        row = model.table.get(word[:j], len(model.table) if j == 1 else None)
        if row is not None:
            total += model.shares[row, k] / language.SCALE**j * all_ways(word[j:], model, k)
    return total


def predicted(text, model, evidence=10):
    words = language.LETTERS.findall((text or "").lower())
    if not words:
        return "und", 0.0
    logs = [sum(math.log(all_ways(language.LEAD + w, model, k)) for w in words) for k in range(len(model.langs))]
    best = max(range(len(logs)), key=lambda k: (logs[k], -k))
    return model.langs[best], 1 / sum(math.exp((x - logs[best]) * min(len(words), evidence) / len(words)) for x in logs)


def test_predictions_equal_all_segmentations(spark, model):
    texts = [prose(500 + k, ("de", "en", "fr")[k % 3], k % 7 + 1) for k in range(30)] + [None, "", "12 !", "ÜBER", "xyz qqq", "été"]
    rows = [(k, t, "no", 1.0, "clash") for k, t in enumerate(texts)] + [(None, texts[0], None, None, None)] * 2
    got = language.predict(spark.createDataFrame(rows, DOCS), model).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, score = predicted(texts[r["doc_id"] or 0], model)
        assert r["lang_pred"] == lang and np.isclose(r["score"], score)
    assert language.predict(spark.createDataFrame([], DOCS), model).count() == 0


def test_no_word_is_left_out_of_the_fit():
    rows = [("x", " ".join(f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyzäöüß")), ("x", "zq" * 200)]
    own = language.fit(rows, queries.PIECES)
    words = [w for _, t in rows for w in t.split()]
    for w in random.Random(2).sample(words, 20):
        assert all(own.table.get(c) is None or own.shares[own.table[c], 0] > 0 for c in w)
    times = np.array([1.0, 3.0, 2.0])
    table = {"▁a": 0, "a": 1, "b": 2, "ab": 3, "▁": 4}
    shares = np.array([0.1, 0.2, 0.3, 0.1, 0.2, 0.05])
    lengths = np.array([2, 1, 1, 2, 1, 1])
    counts = language.expected(["ab", "ba", "ab" * 40], times, shares * language.SCALE**lengths, table)
    want = np.zeros(6)

    def ways(word):
        if not word:
            yield [], 1.0
            return
        for j in range(1, 3):
            p = table.get(word[:j], 5 if j == 1 else None)
            if p is not None and j <= len(word):
                for rest, q in ways(word[j:]):
                    yield [p, *rest], shares[p] * q

    for word, n in zip(["▁ab", "▁ba"], times):
        found = list(ways(word))
        whole = sum(q for _, q in found)
        for cut, q in found:
            for p in cut:
                want[p] += n * q / whole
    short = language.expected(["ab", "ba"], times[:2], shares * language.SCALE**lengths, table)
    assert np.allclose(short, want) and (counts >= short - 1e-9).all() and np.isclose((counts - short) @ lengths, 2.0 * 81)


def test_votes_equal_brute_force(spark):
    good, bad = "A calm sentence with some words, and more {}.", "@@ ## {} !! $$ %% ^^ &&"
    draw = random.Random(3)
    texts = [(good, bad)[k % 2].format(draw.randint(0, 999)) * draw.randint(1, 6) for k in range(120)]
    rows = [(k, t, "x", 0.5, "clash") for k, t in enumerate(texts)] + [(500, None, None, None, None), (501, "", None, None, None), (502, "long " * 50_000, None, None, None), (None, texts[0], None, None, None)] + [(7, texts[7], "again", None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(k, 1 - k % 2, 0) for k in range(80)] + [(3, 1, 0), (None, 1, 0), (9, None, 0)], "doc_id long, quality int, toxic int")
    space = quality.learn(docs, labels, F.lit(True))
    got = quality.score(docs, space, k=15, power=4.0).collect()
    assert len(got) == len(rows) and quality.score(docs.limit(0), space).count() == 0
    by_id = {i: t for i, t, *_ in rows}
    for r in got:
        own = space.place(np.stack([quality.terms(by_id[r["doc_id"]])]))[0].astype(np.float64)
        cosines = np.array([v.astype(np.float64) @ own for v in space.vectors])
        near = np.argsort(-cosines, kind="stable")[:15]
        weight = np.maximum(cosines[near], 0) ** 4
        want = (weight @ space.labels[near]) / weight.sum() if weight.sum() > 0 else space.labels.mean()
        assert abs(r["score"] - want) < 0.02, (r, want)


def test_pages(spark):
    page = "<body><nav><a href=x>Menu</a></nav><div><p>One sentence, with marks; and more of it.</p></div></body>"
    long = "<body>" + "<div><p>Some words, and a mark. </p></div>" * 20_000
    rows = [(1, "u", page, "clash"), (1, "u", page, "clash"), (None, None, None, None), (2, "u", long, "x"), (3, "u", "<font>" * 30_000 + "deep, here.", None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(html.extract(frame).collect(), key=lambda r: r["page_id"] or 0)
    assert [r["n_chars"] for r in got] == [0, 41, 41, 20_000 * 25 - 2, 11] and html.extract(frame.limit(0)).count() == 0


def test_ratios_decide_where_names_say_nothing():
    """Of blocks that no list of names drops, those go whose path has no characters outside links."""
    draw = random.Random(4)
    text = lambda: " ".join(draw.choice(["word", "river", "stone"]) for _ in range(60)) + ", and so on; it ends here."
    for _ in range(50):
        body = [text() for _ in range(draw.randint(3, 9))]
        teasers = "".join(f"<section><a href=x>Item {k}</a></section>" for k in range(30))
        page = f"<body><section class=x1>{teasers}</section><section class=x2>{''.join(f'<p>{t}</p>' for t in body)}</section></body>"
        assert html.content(html.blocks(page)) == body


def test_bytes_that_are_not_utf8_are_read(spark):
    docs = spark.sql("select 1L as doc_id, concat('one two three ', cast(unhex('ff41fe') as string), ' four five') as text, 'x' as lang, cast(null as string) as source, 1L as page_id, 'u' as url, cast(unhex('3c703e61ff') as string) as html union all select 2L, 'plain text of five words', 'x', null, 2L, 'u', '<p>b'")
    scratch = Scratch(spark, "test")
    assert packing.pack(docs, queries.BYTE_BPE).count() >= 2
    assert store.digests(*store.write(docs, queries.WORD_BPE, scratch)).count() == 2
    assert bytebpe.encode(docs, queries.BYTE_RANKS, public_tokenizers.PATTERN).count() == 2
    assert jaccard.join(docs, scratch).count() == 2 == jaccard.one_of_each(docs, scratch).count()
    assert [r["text"] for r in html.extract(docs).orderBy("page_id").collect()] == ["a�", "b"]
    own = language.learn(docs, F.lit(True), queries.PIECES)
    assert language.predict(docs, own).count() == 2 == language.known(docs, own, least=0.0).count()
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert quality.score(docs, quality.learn(docs, labels, F.lit(True))).count() == 2
    assert ordermin.fingerprints(docs).count() == 2
    talk = docs.selectExpr("doc_id as conv_id", "1L as turn", "'user' as role", "text")
    assert turns.repair_damaged(talk, scratch).count() == 2


def test_no_bytes_to_encode(spark):
    none = spark.createDataFrame([], DOCS)
    assert bytebpe.digests(bytebpe.encode(none, queries.BYTE_RANKS, public_tokenizers.PATTERN)).count() == 0
    assert zlib.crc32(b"") == 0
