"""The pipeline's stages against brute force, with null, repeated and identical rows; the join's groups and null ids."""

import random
import re

import corpus_pipeline
import pytest
from parallax.llm import jaccard, language, packing, pipeline, queries, rules
from parallax.llm.common import Scratch, fold

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, data string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "pipe")


def shingles(text):
    w = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def linked(a, b):
    return bool(a) and 100 * len(a & b) >= 75 * len(a | b)


def grouped(sets):
    group = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def words(n, seed):
    draw = random.Random(seed)
    return [f"w{draw.randrange(10**6)}" for _ in range(n)]


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_links_of_rows_without_id(spark, scratch):
    base = words(60, 1)
    rows = [(None, " ".join(base)), (5, " ".join(base[:-2])), (6, " ".join(base[2:])), (None, None), (9, "")]
    got = as_rows(jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), scratch))
    assert got == sorted([(None, 56, 5), (5, 54, 5), (6, 54, 5), (None, 0, None), (9, 0, 9)], key=repr)


def test_asks_grow_with_the_group(spark, scratch):
    """A group of near copies is searched without a row for each of its pairs."""
    sizes = {}
    for n in (100, 400):
        draw, base = random.Random(n), words(200, 2)
        rows = []
        for k in range(n):
            own = list(base)
            for at in draw.sample(range(200), 5):
                own[at] = f"v{draw.randrange(10**6)}"
            rows.append((k, " ".join(own)))
        s = Scratch(spark, f"grow-{n}")
        got = {r[0]: r[2] for r in as_rows(jaccard.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), s))}
        group = grouped([shingles(t) for _, t in rows])
        least = {}
        for k, g in enumerate(group):
            least.setdefault(g, k)
        assert got == {k: least[g] for k, g in enumerate(group)}
        sizes[n] = sum(spark.read.parquet(f"{s.root}/pairs-{k}").count() for k in range(jaccard.ORDERS)) + spark.read.parquet(f"{s.root}/asked").count()
    assert sizes[400] < 8 * sizes[100]


def test_stages(spark):
    sample = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(90).collect()
    rows = [(*r, 1.0, "x", None) for r in sample]
    good = next(r for r in sample if len(WORD.findall(r["text"] or "")) > 120)
    bad = "###  %%% $$$ " * 30
    rows += [(None, bad, "en", "web", 1, None, None, None), (None, good["text"] + " end", "en", None, 1, 0.1, "a", "b")]
    rows += [(good["doc_id"], bad, None, "web", 1, None, None, None), (8_000, good["text"], None, None, None, None, None, None), (8_000, good["text"], None, None, None, None, None, None), (None, None, None, None, None, None, None, None), (8_001, "", "en", "web", 0, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)

    model = language.learn(docs, fold("doc_id", 4) != 2, queries.PIECES)
    texts = [r["text"] for r in docs.select("text").distinct().collect()]
    said = {texts[r["doc_id"]]: (r["lang_pred"], r["score"]) for r in language.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    first = pipeline.by_language(spark, docs, "")
    assert first.columns == docs.columns and as_rows(first) == [r for r in as_rows(docs) if said[r[1]][0] != "und" and said[r[1]][1] >= 0.5]

    verdicts = rules.judge(docs, Scratch(spark, "v"), id_col="text").selectExpr("doc_id as text", "lang", "source", "kept").collect()
    kept = {(r["text"], r["lang"], r["source"]) for r in verdicts if r["kept"]}
    second = pipeline.by_rules(spark, docs, "")
    assert as_rows(second) == [r for r in as_rows(docs) if (r[1], r[2], r[3]) in kept]
    ids = [r["doc_id"] for r in second.collect()]
    assert all(r["text"] != bad for r in second.collect()) and ids.count(8_000) == 2

    third = as_rows(pipeline.one_of_each(spark, docs, ""))
    before = as_rows(docs)
    group = grouped([shingles(r[1]) for r in before])
    want = []
    for g in set(group):
        members = [r for r, x in zip(before, group) if x == g]
        want.append(min((r[0] is None, r[0] or 0) for r in members))
    assert sorted((r[0] is None, r[0] or 0) for r in third) == sorted(want) and set(third) <= set(before)

    docs3 = spark.createDataFrame(third, SCHEMA)
    cut = as_rows(pipeline.without_repeats(spark, docs3, ""))
    seen, left = set(), []
    for r in sorted(third, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (r[1] or "").encode()
        out = bytearray(len(b))
        for i in range(len(b) - 99):
            w = b[i : i + 100]
            if w in seen:
                out[i : i + 100] = b"\1" * 100
            seen.add(w)
        text = bytes(x for x, o in zip(b, out) if not o).decode("utf-8", "ignore")
        if not any(out):
            left.append(r)
        elif text:
            left.append((r[0], text, *r[2:4], len(text), *r[5:]))
    null_ids = [r for r in third if r[0] is None]
    if len(null_ids) < 2:  # rows of one id are ordered by their texts' checksums
        assert cut == sorted(left, key=repr)

    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_run(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), docs.schema)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").sum("length").collect()
    alone = packing.pack(docs, queries.BYTE_BPE).groupBy("doc_id").sum("length").collect()
    assert sorted(map(tuple, pieces)) == sorted(map(tuple, alone)) and len(pieces) == docs.count()
