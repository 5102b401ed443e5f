"""What a review found missing, held against brute force or the library."""

import collections
import math
import random
import re

import pytest

from parallax.llm import html, jaccard, rules, vectors
from parallax.llm.common import Scratch


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


def _metrics(text):
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if n[tuple(words[k : k + 3])] > 1 for j in range(3)}
    chars = sum(map(len, words))
    found = {"symbols": len(re.findall(r"[#*$%&|<>]", text)) / chars, "dup_lines": (len(lines) - len(set(lines))) / len(lines), "repeats": len(covered) / len(words), "word_length": chars / len(words), "capitals": len(re.findall("[A-Z]", text)) / chars}
    return found, len(words) < 50 or 2 * len(covered) > len(words)


def test_rules_follow_the_spread_of_sound_texts(spark, scratch):
    draw = random.Random(8)
    word = lambda n: "".join(draw.choice("abcdefghij") for _ in range(max(1, n)))

    def text(mean, symbols=0, words=80):
        parts = [word(round(draw.gauss(mean, 2))) for _ in range(words)] + ["#"] * symbols
        draw.shuffle(parts)
        return "A" + " ".join(parts)

    rows = [("en", "web", text(5)) for _ in range(60)] + [("en", "books", text(5)) for _ in range(40)] + [("de", "web", text(8)) for _ in range(40)]
    rows += [("en", "web", text(11)), ("de", "web", text(3)), ("de", "web", text(14)), ("en", "web", text(5, 6))]  # 11 is far for en alone
    rows += [("en", "tiny", text(5)), ("en", "tiny", text(5, 9)), (None, "web", text(11)), (None, None, text(5, 9))]  # fewer rows than have a quartile
    rows += [("en", "junk", text(5, 10, words=30)) for _ in range(50)] + [("en", "junk", text(5)), ("en", "junk", text(5, 9))]  # most fail the base rules
    rows += [("en", "web", "\n".join([text(5, words=9)] * 2 + [text(5, words=9) for _ in range(10)])) for _ in range(5)]
    measured = [_metrics(t) for _, _, t in rows]

    def fence(m, lang, source):
        distance = quartile = None
        for same in (lambda r: r[:2] == (lang, source), lambda r: r[0] == lang, lambda r: r[1] == source, lambda r: True):
            values = sorted(f[m] for r, (f, base) in zip(rows, measured) if not base and same(r) and (f[m] > 0 or m not in ("dup_lines", "repeats")))
            if values and (len(values) >= 20 or same(("none", "none", ""))):
                low, high = (values[math.ceil(q * len(values)) - 1] for q in (0.25, 0.75))
                quartile = high if quartile is None else quartile
                distance = high - low if distance is None and high > low else distance
        return (quartile or 0) + max(6 * (distance or 0), {"word_length": 0.1}.get(m, 0.01))

    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string")
    got = {r["doc_id"]: r["kept"] for r in rules.judge(docs, scratch).collect()}
    want = {i: not base and all(f[m] <= fence(m, *r[:2]) for m in f) for i, (r, (f, base)) in enumerate(zip(rows, measured))}
    assert got == want
    assert not any(got[i] for i in (140, 143, 145, 147, 199)) and all(got[i] for i in (141, 144, 198))


def test_long_lists_of_unlinked_variants_are_split(spark, scratch, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST", 16, raising=False)
    draw = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for i in range(150):  # variants that share passages at indexes around and below 0.75, and some links
        own = [f"w{i // 3 if i % 5 else i}x{k}" for k in range(draw.randint(6, 14))]
        texts.append(" ".join(own[:3] + passage[: draw.randint(50, 60)] + own[3:]))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    assert 1 < len(set(group)) < len(texts)
    largest = []
    save = scratch.save

    def spied(df, name, *args, **more):
        out = save(df, name, *args, **more)
        if name == "lists":
            by = [c for c in ("token", "block") if c in out.columns]
            largest.append(out.groupBy(*by).count().agg({"count": "max"}).first()[0])
        return out

    monkeypatch.setattr(scratch, "save", spied)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), scratch).collect()}
    assert got == dict(enumerate(group))
    assert largest[0] <= 40


def test_end_tags_may_be_left_out():
    text = lambda page: html.content(html.blocks(page))
    assert text("<html><head><title>t</title><body><article><h1>Head</h1><p>One, two.</article>") == ["Head", "One, two."]
    assert text("<head><meta charset=x><style>p {}</style><p>One, two.<p>Three.") == ["One, two.", "Three."]
    assert text("<head><title>t</title>Bare text, here.") == ["Bare text, here."]
    assert text("<head><script>1</script><template><p>no</p></template></head><p>One, two.") == ["One, two."]
    found = html.blocks("<table><thead><tr><th>a<th>b<tbody><tr><td>c<td>d<tr><td>e</table>")
    assert [found.path(b[0]) for b in found] == ["/table/thead/tr/th"] * 2 + ["/table/tbody/tr/td"] * 3


def test_main_text_without_or_beside_an_article():
    text = lambda page: html.content(html.blocks(page))
    long = "A long text, with marks; it goes on, and on, until it ends. " * 8
    long = long.strip()
    nav = "<div><a href=a>One place</a> <a href=b>Another place</a></div>"
    assert text(f"<body>{nav}<div id=content><div><h2>Title</h2></div><div><p>{long}</p></div></div>") == ["Title", long]
    assert text(f"<body>{nav}<div><div><div><h2>Title</h2></div></div><section><p>{long}</section><section><p>Short, too.</section><div>Caption</div></div>") == ["Title", long, "Short, too.", "Caption"]
    assert text(f"<body>{nav}<div><table><tr><td>Name<td>Number<tr><td>{long}<td>7</table></div>") == ["Name", "Number", long, "7"]
    assert text(f"<body>{nav}<div><div>Title</div><p>{long}</p></div><article><h3>Teaser</h3><p>Read this, too.</p></article>") == ["Title", long]
    assert text(f"<body>{nav}<p>Few words, no more.</p><article><h1>Head</h1><p>{long}</p></article>") == ["Head", long]
    assert text(f"<body>{nav}<div><div>Title</div><div><p>{long}</div>{nav}<div><p>{long}</div></div>") == ["Title", long, long]


def test_names_in_an_article_mark_by_all_their_words():
    text = lambda page: html.content(html.blocks(page))
    kept = '<article><h2 id="share-prices">Share prices</h2><section class="social-history"><p>One, two.</p></section>{}</article>'
    for name in ("ad", "ad-slot", "comment-list", "shareButtons", "x social-links", "reader-x comments"):
        assert text(kept.format(f'<div class="{name}"><p>Not this, at all.</p></div>')) == ["Share prices", "One, two."], name
    assert text(kept.format("<div class='search-theory'><p>Three, four.</p></div>")) == ["Share prices", "One, two.", "Three, four."]


def test_broken_tags_take_linear_time():
    import time

    start = time.monotonic()
    for broken in ("<" + "a" * 500_000, "<a " * 200_000, '<a "' * 200_001, '<a b="x> ' * 2001):
        assert html.blocks("<p>ok</p>" + broken)[0][3] == "ok"
    assert time.monotonic() - start < 20
    assert html.content(html.blocks("<p>1 < 2, and a <b")) == ["1 < 2, and a <b"]


@pytest.mark.parametrize("width", [64, 384, 768, 5000])
def test_recall_at_the_least_cosine_follows_no_width(width):
    import numpy as np

    draw = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    a = unit(draw.normal(size=(300, width)))
    e = draw.normal(size=(300, width))
    b = 0.9 * a + np.sqrt(1 - 0.81) * unit(e - (e * a).sum(1, keepdims=True) * a)
    x, y = vectors.buckets(a), vectors.buckets(b)
    met = ((x[:, :, 0, None] == y).any(2) | (y[:, :, 0, None] == x).any(2)).any(1)
    assert met.mean() >= 0.94


def test_vectors_of_several_widths_in_one_table(spark, scratch):
    import numpy as np

    draw = np.random.default_rng(6)
    rows, links = [], {}
    for width in (1, 8, 64, 300, 5000):
        for _ in range(4):
            v = draw.normal(size=width)
            first = len(rows)
            rows += [(first, v.tolist()), (first + 1, (v + 0.01 * draw.normal(size=width) / width**0.5 * np.linalg.norm(v)).tolist()), (first + 2, (3 * v).tolist())]
    x = [np.array(v) / np.linalg.norm(v) for _, v in rows]
    for i, p in enumerate(x):
        links[i] = sum(len(p) == len(q) and float(p @ q) >= 0.9 for q in x) - 1
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), scratch).collect()}
    assert got == links


def test_added_tokens_are_encoded_as_the_library_does():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from parallax.llm.queries import BYTE_BPE, WORD_BPE
    from parallax.llm.vocab import PieceEncoder

    for path, spaces_count in ((BYTE_BPE, True), (WORD_BPE, False)):
        library = Tokenizer.from_file(path)
        strings = [t.content for t in library.get_added_tokens_decoder().values()]
        assert strings
        texts = ["plain words, here", "", None, "a<|endoftext|>b", *(f"a{s}b c" for s in strings), *(f"x {s.upper()} y\n{s}" for s in strings)]
        ids, edges = PieceEncoder(path, spaces_count).encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_short_lists_are_looked_at_together(monkeypatch):
    """What may link in 20,000 lists, as pair by pair, in calls that follow the longest list and not their number."""
    import numpy as np

    draw = np.random.default_rng(9)
    lengths = np.append(draw.integers(1, 9, 20_000), [64, 65, 300])
    token = np.repeat(np.arange(len(lengths)), lengths)
    block = np.where(token % 50 == 1, 2 << 16 | draw.integers(0, 2, len(token)), 0).astype(np.int32)
    key = draw.integers(0, 3000, len(token))
    size = (key % 40 + 1).astype(np.int32)
    pos = draw.integers(0, size // 4 + 1).astype(np.int32)
    order = np.lexsort((key, size, block, token))
    token, block, key, size, pos = (c[order] for c in (token, block, key, size, pos))
    calls, can = [], jaccard._can
    monkeypatch.setattr(jaccard, "_can", lambda *c: calls.append(1) or can(*c))
    at, keep = jaccard._may_link(token, block, key, size, pos)
    assert 0 < len(calls) < 64
    first = {}
    for k, row in enumerate(zip(token.tolist(), block.tolist(), key.tolist())):
        first.setdefault(row, k)
    assert at.tolist() == sorted(first.values())
    lists = collections.defaultdict(list)
    for k in at.tolist():
        lists[int(token[k]), int(block[k])].append(k)
    want = set()
    for (_, part), own in lists.items():
        if part:
            want.update(own)
        elif len(own) <= 64:
            for i, a in enumerate(own):
                for b in own[i + 1 :]:
                    small, large = sorted((int(size[a]), int(size[b])))
                    least = -(-3 * (small + large) // 7)
                    lead = min((int(size[x]), int(pos[x])) for x in (a, b))[1]
                    if 4 * small >= 3 * large and min(size[a] - pos[a], size[b] - pos[b]) >= least and lead <= small - -(-6 * small // 7):
                        want |= {a, b}
        else:
            want.update(x for a, b in zip(own, own[1:]) if 4 * size[a] >= 3 * size[b] for x in (a, b))
    assert set(at[keep].tolist()) == want


def test_sets_go_once_their_links_are_found(spark):
    """What the near copies' stage wrote of whole sets doesn't stand beside the next stage's files."""
    import os

    own = Scratch(spark, "sets")
    words = [f"w{k}" for k in range(40)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:-1])), (3, "other words")], "doc_id long, text string")
    kept = jaccard.one_of_each(docs, own)
    assert own.tables == [] and not [d for d in os.listdir(own.root) if d.startswith("scratch_")]
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_words_met_before_are_not_encoded_again(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    from parallax.llm import vocab
    from parallax.llm.queries import BYTE_BPE, WORD_BPE

    texts = [["one two, Three", "zürich (four)", ""], ["Two one three!", "x2 one\nzürich", None], ["five six seven eight nine", "one six"]]
    for path, spaces_count in ((BYTE_BPE, True), (WORD_BPE, False)):
        library = Tokenizer.from_file(path)
        for most in (1 << 19, 6, 2):
            monkeypatch.setattr(vocab, "KNOWN", most)
            own = vocab.PieceEncoder(path, spaces_count)
            asked, letters = [], own._letters
            monkeypatch.setattr(own, "_letters", lambda words, lead: asked.extend((w, lead) for w in words.to_pylist()) or letters(words, lead))
            for batch in texts:
                ids, edges = own.encode(pa.array(batch))
                assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [library.encode(t or "", add_special_tokens=False).ids for t in batch]
            assert most < 1 << 19 or len(asked) == len(set(asked)) > 0
