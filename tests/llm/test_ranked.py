"""Ranked search against sums over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from parallax.llm import ranked
from parallax.llm.common import Scratch

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    found = [(i, Counter(terms(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, n_terms = len(found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c in found:
            m = 75 + 25 * c.total() * n_docs // n_terms
            w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in c}
            score = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def random_tables(seed, n):
    draw = random.Random(seed)
    word = lambda: f"w{int(draw.paretovariate(0.6)) % 300}"
    docs = [(i, " ".join(word() for _ in range(draw.choice([0, 1, 5, 40, 400])))) for i in range(n)]
    docs += [(None, "no id w3 w9"), (None, "no id w3 w9"), (5, "an id again w3"), (7, None), (8, ""), (9, "?! --   Ünï w1-W1")] + docs[:10]
    items = [(i, " ".join(word() for _ in range(draw.randint(1, 30)))) for i in range(20)] + [(1, "w3 w3 w9"), (1, "w3 w3 w9"), (1, "w4"), (None, "W3"), (30, None), (31, " "), (32, "nowhere")]
    return docs, items


@pytest.mark.parametrize("shard, query_bytes", [(ranked.SHARD, ranked.QUERY_BYTES), (700, 400)])
def test_rank(spark, monkeypatch, shard, query_bytes):
    monkeypatch.setattr(ranked, "SHARD", shard)
    monkeypatch.setattr(ranked, "QUERY_BYTES", query_bytes)
    docs, items = random_tables(1, 400)
    frame = spark.createDataFrame([(*d, 1, "clash") for d in docs], "doc_id long, text string, score int, query_id string").repartition(3)
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int")
    got = [tuple(r) for r in ranked.rank(frame, asked, Scratch(spark, "test"), 7).collect()]
    assert sorted(got, key=str) == brute(docs, items, 7)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a")], "item_id long, text string")
    rank = lambda d, q: ranked.rank(d, q, Scratch(spark, "test")).count()
    assert (rank(docs.limit(0), asked), rank(docs, asked.limit(0)), rank(docs, asked)) == (0, 0, 1)


def test_invalid_utf8(spark):
    docs = spark.sql("select 1L as doc_id, cast(unhex('ff4120422061') as string) as text")
    asked = spark.createDataFrame([(1, "b")], "item_id long, text string")
    assert ranked.rank(docs, asked, Scratch(spark, "test")).count() == 1


def test_search_stops_early_and_keeps_ties():
    rng = np.random.default_rng(4)
    for _ in range(40):
        n = int(rng.integers(1, 3000))
        held = [np.unique(rng.zipf(1.3, 12) % 40) for _ in range(n)]
        counts = [rng.integers(1, 4, len(h)) for h in held]
        lengths = rng.integers(12, 15, n)
        shard = ranked.Shard(np.arange(n), lengths, np.concatenate(held), np.concatenate(counts), np.array([len(h) for h in held]), n, int(lengths.sum()))
        asked, weights = np.unique(rng.integers(0, 45, 6)), rng.integers(0, 900, 6)
        weights = weights[: len(asked)]
        want = np.zeros(n, np.int64)
        for d in range(n):
            m = 75 + 25 * lengths[d] * n // int(lengths.sum())
            for t, c in zip(held[d], counts[d]):
                if t in asked:
                    want[d] += weights[asked == t][0] * (10**9 * c // (1000 * c + 12 * m))
        top = np.lexsort((np.arange(n), -want))[:5]
        top = top[want[top] > 0]
        docs, scores = shard.best(asked, weights, 5, first=2)
        assert docs.tolist() == top.tolist() and scores.tolist() == want[top].tolist()
