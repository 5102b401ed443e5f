"""Each operator on small tables that hold the awkward cases, held against brute force."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parallax.llm import bytebpe, html, jaccard, language, packing, quality, queries, rules, store, suffixes, vectors
from parallax.llm.common import Scratch, components

LONG = " ".join(f"wort{i * 7919 % 1000} the of and" for i in range(6000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))
TEXTS = [
    (1, PASSAGE + " one tail here"), (2, PASSAGE + " one tail here"), (3, PASSAGE + " one tail there"), (4, None), (5, ""), (6, "short"), (7, "short"),
    (8, "a b c d e"), (9, LONG), (10, "Größe straße  über\n\nalles\t!"), (11, "x " + PASSAGE + " y"), (None, "no id at all"), (13, "same row"), (13, "same row"),
    (14, "line\nline\nline\n \nother " * 20), (15, "aaaa" * 100), (16, "###*** $$ %% && || <<>>" * 5),
]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "de" if i and i % 2 else None, "s", 0, "clash", 1) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, key int")


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


def keyed(df):
    return sorted(df.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    def of(path):
        t = Tokenizer.from_file(path)
        return lambda x: np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4")

    return of


def test_packing(docs, library):
    encode = library(queries.BYTE_BPE)
    want = {i: encode(t) for i, t in TEXTS}
    got = packing.pack(docs, queries.BYTE_BPE, group_tokens=5000).collect()
    for r in got:
        ids = want[r["doc_id"]]
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    assert sum(r["length"] for r in got) == sum(len(want[i]) for i, _ in TEXTS)
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0
    assert packing.pack(docs.limit(0), queries.BYTE_BPE).count() == 0


def test_store(docs, library, scratch):
    encode = library(queries.WORD_BPE)
    chunks, recipes, manifest = store.write(docs, queries.WORD_BPE, scratch)
    got = sorted(store.digests(chunks, recipes, manifest).collect(), key=lambda r: r["start"])
    start = 0
    for r, (i, t) in zip(got, sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0)), strict=True):
        ids = encode(t)
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    whole = {r["start"]: bytes(r["ids"]) for r in store.ids(chunks, recipes).collect()}
    assert sum(len(b) // 2 for b in whole.values()) == start == manifest.agg(F.sum("n_tokens")).first()[0]
    assert chunks.count() == chunks.select("digest").distinct().count()


def test_byte_pairs(docs):
    import base64

    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.BYTE_RANKS, "rb"))}
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bytebpe.digests(bytebpe.encode(docs, queries.BYTE_RANKS, P.PATTERN)).collect():
        texts = {t or "" for i, t in TEXTS if i == r["doc_id"]}
        assert r["decoded_sha256"] in {hashlib.sha256(t.encode()).hexdigest() for t in texts}
        assert r["ids_sha256"] in {hashlib.sha256(np.array(e.encode_ordinary(t), "<u4").tobytes()).hexdigest() for t in texts}


def test_suffixes(docs, scratch):
    rows = sorted({(i, t or "") for i, t in TEXTS}, key=lambda x: (x[0] is not None, x[0] or 0))
    seen, want = set(), {}
    for i, t in rows:
        b = t.encode()
        mark = np.zeros(len(b) + 1, int)
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                mark[p : p + 100] = 1
            seen.add(b[p : p + 100])
        want[i] = bytes(c for c, m in zip(b, mark) if not m)
    got = suffixes.remove_repeats(docs, scratch)
    assert got.count() == len(TEXTS)
    for r in got.collect():
        assert bytes(r["kept"]) == want[r["doc_id"]] and r["n_removed"] == r["n_bytes"] - len(want[r["doc_id"]])
    assert suffixes.remove_repeats(docs.limit(0), scratch).count() == 0


def test_jaccard(docs, scratch):
    sets = {}
    for i, t in TEXTS:
        w = WORD.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    group = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    low = min(x for x in (group[a], group[b]) if x is not None) if (group[a], group[b]) != (None, None) else None
                    group[a] = group[b] = low
    for r in jaccard.join(docs, scratch).collect():
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), group[r["doc_id"]]), r
    assert jaccard.join(docs.limit(0), scratch).count() == 0


def test_t_occurrence_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(60):
        query = np.unique(rng.integers(0, 80, 60).astype(np.uint64))
        near = [np.setdiff1d(np.append(query, rng.integers(80, 99, 3).astype(np.uint64)), rng.choice(query, rng.integers(0, 14))) for _ in range(30)]
        partners = [np.unique(p) for p in near] + [np.unique(rng.integers(0, 80, rng.integers(1, 60)).astype(np.uint64)) for _ in range(20)]
        want = [k for k, p in enumerate(partners) if 100 * len(np.intersect1d(query, p)) >= 75 * len(np.union1d(query, p))]
        assert jaccard.Inverted(partners).search(query).tolist() == want


def test_rules(docs, scratch):
    got = rules.judge(docs, scratch).drop("lang", "source")
    assert got.count() == len(TEXTS)
    for r in got.collect():
        t = next(t for i, t in TEXTS if i == r["doc_id"]) or ""
        w = WORD.findall(t)
        n = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {k + j for k in range(len(w) - 2) if n[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(w) < 50 or 2 * len(covered) > len(w)) and not (r["base_failed"] and r["kept"])


def test_vectors(spark, scratch):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, base[:20] + 0.05 * rng.normal(size=(20, 64)), base[:5]]))]
    rows += [(100, None), (101, [0.0] * 64), (102, [float("nan")] * 64), (103, [1.0, None]), (None, base[0].tolist()), (104, []), (105, [1.0, 2.0]), (106, [2.0, 4.0])]
    got = {r["vec_id"]: r for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), scratch).collect()}
    assert len(got) == len(rows)
    ok = [(i, np.array(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    for i, v in ok:
        near = [j for k, (j, u) in enumerate(ok) if len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.9]
        assert got[i]["n_links"] == len(near) - 1
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i for i in (100, 101, 102, 103, 104))
    assert got[80]["component_id"] == 0 and not got[80]["kept"] and got[0]["kept"]


def test_components(spark, scratch):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), scratch).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_language(spark):
    de, en = "der hund und die katze sind nicht im haus", "the dog and the cat are not in the house"
    train = spark.createDataFrame([(i, (de, en)[i % 2], ("de", "en")[i % 2]) for i in range(20)] + [(30, None, "de"), (31, "x", None)], "doc_id long, text string, lang string")
    model = language.learn(train, F.lit(True), queries.PIECES)
    rows = [(1, "die katze"), (2, "THE CAT"), (3, None), (4, "12 !"), (None, "und nicht"), (6, "a" * 500)]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4, None)] == ["de", "en", "und", "und", "de"] and all(0 <= s <= 1 for _, s in got.values())


def test_forward_sum_is_over_all_segmentations():
    m = language.Model(["x"], {"▁a": 0, "b": 1, "▁ab": 2, "▁": 3, "a": 4}, np.array([[0.1], [0.2], [0.05], [0.3], [0.1], [0.01]]) * language.SCALE ** np.array([[2], [1], [3], [1], [1], [1]]))
    want = np.log(0.1 * 0.2 + 0.05 + 0.3 * 0.1 * 0.2)
    assert np.isclose(language.Scorer(m).words(["ab"])[0, 0], want) and np.isclose(language.Scorer(m).long("▁ab")[0], want)


def test_quality(spark):
    good, bad = "A calm sentence with some words, and more.", "@@ ## !! $$ %% ^^ &&"
    rows = [(i, (good, bad)[i % 2] * (1 + i % 5)) for i in range(60)]
    docs = spark.createDataFrame([*rows, (100, None), (101, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)] + [(50, None)], "doc_id long, quality int")
    got = {r[0]: r[1] for r in quality.score(docs, quality.learn(docs, labels, F.lit(True))).collect()}
    assert got[58] > 0.9 and got[59] < 0.1 and 0 <= got[100] <= 1 and 0 <= got[101] <= 1


def test_html(spark):
    page = '<html><head><title>no</title></head><body><nav><a href=x>Menu</a></nav><div class="ad">Buy!</div><article><h1>Head &amp; more</h1><p>One,\n two.<p><b>Three<br>four.</b><script>var x="</p>";</script></article><div class="comments"><p>Nice, really.</p></div><footer>(c)</footer>'
    rows = [(1, "u", page), (2, None, None), (None, "u", ""), (4, "u", "<p>plain, text."), (5, "u", "< 3 <b")]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1][0] == "Head & more\n\nOne, two.\n\nThree four." and got[2] == ("", 0) and got[None] == ("", 0) and got[4][0] == "plain, text." and got[1][1] == len(got[1][0])


def test_words_and_their_punctuation_are_encoded_as_the_library_does():
    import random

    import numpy as np

    from parallax.llm.queries import WORD_BPE
    from parallax.llm.vocab import PieceEncoder

    draw = random.Random(5)
    texts = ["", " ", "İstanbul. aİ. x", "don't. it's!?", "a\tb. \tc.", "x'. <|endoftext|>.", "가. 日本語。", "a</w>. ß!)", "A̸. ≠", "é. \xe9"]
    texts += ["".join(draw.choice("aBZé́İßσ.,;:!?)\"' \n\t'sT1²<>​-") for _ in range(draw.randint(0, 30))) for _ in range(2_000)]
    own = PieceEncoder(WORD_BPE, False)
    ids, edges = own.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [e.ids for e in own.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
