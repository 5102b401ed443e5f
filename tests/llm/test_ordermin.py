"""Order Min Hash against the same in plain Python, and what it is for."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from parallax.llm import ordermin as o

M64 = (1 << 64) - 1


def h64(parts, seed=42):
    for p in parts:
        seed = xxhash.xxh64_intdigest(p, seed)
    return seed


def long(x):
    return (x & M64).to_bytes(8, "little")


def brute(text):
    u = text.encode("utf-32-be")
    grams = [u[i : i + 4 * o.GRAM] for i in range(0, max(1, len(u) - 4 * o.GRAM + 1), 4)] if text else []
    mers = [h64([g]) >> 1 >> o.PLACE for g in grams]  # bin, class, rank
    seen, bins = Counter(), defaultdict(list)
    for place, m in enumerate(mers):
        kind, n = m >> o.RANK & (1 << o.CLASS) - 1, seen[m]
        seen[m] += 1
        if n:
            d = h64([long(m), n.to_bytes(4, "little")]) >> 1 >> o.PLACE
            m = d >> o.RANK + o.CLASS << o.RANK + o.CLASS | kind << o.RANK | d & (1 << o.RANK) - 1
        bins[m >> o.RANK + o.CLASS].append((m & (1 << o.RANK + o.CLASS) - 1, place))
    out = []
    for b in range(o.BINS):
        value = 0
        for place in sorted(p for _, p in sorted(bins[b])[: o.PICKED]):
            value = h64([long(value), long(mers[place])])
        out.append(f"{value & 0xFFFFFFFF:08x}" if bins[b] else o.NONE)
    return "".join(out)


def near(a, b):
    cut = lambda f: [f[i : i + 8] for i in range(0, len(f), 8)]
    used = [(x, y) for x, y in zip(cut(a), cut(b)) if (x, y) != (o.NONE, o.NONE)]
    return 1.0 if a == b else sum(x == y for x, y in used) / len(used)


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(["the", "river", "of", "Größe", "and", "日本", "a", "stone", "😀"]) + str(draw.randint(0, 40)) for _ in range(n))


TEXTS = ["", None, "short", "exactly8", "nine char", "ab" * 3000, "a" * 500, *(prose(k, 10 * k * k) for k in range(1, 14)), prose(3, 90), prose(90, 6000)]


@pytest.mark.parametrize("partitions", ["4", "40"])
def test_fingerprints(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    rows = [(k * 7 % 23, t) for k, t in enumerate(TEXTS)] + [(500, "same row here")] * 2 + [(None, "no id"), (None, "no id either, but longer")]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, fingerprint string, bucket int").repartition(3)
    got = [r.asDict() for r in o.fingerprints(frame).collect()]
    spark.conf.set("spark.sql.shuffle.partitions", before)
    draw = lambda t: h64([t.encode()]) >> 1
    order = sorted([(i, t or "") for i, t in rows], key=lambda r: (r[0] is not None, r[0] or 0, draw(r[1])), reverse=True)
    want = []
    for (i, t), (_, after) in zip(order, [*order[1:], order[0]]):
        third = len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        f, e, a = brute(t), brute(edited), brute(after)
        want.append({"doc_id": i, "n_chars": len(t), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(), "fingerprint": f, "edited_fingerprint": e, "near_edited": near(f, e), "near_next": near(f, a)})
    assert sorted(got, key=str) == sorted(want, key=str)


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(3, "abcdefghij" * 9)], "doc_id long, text string")
    row = o.fingerprints(one).first()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(("abcdefghij" * 6 + "abcdefghij" * 3).encode()).hexdigest()
    assert o.fingerprints(one.limit(0)).count() == 0


def test_an_id_that_most_rows_share_is_dealt_over_buckets(spark):
    rows = [(None if k % 3 else k, prose(k, 6)) for k in range(600)]
    led = o.with_next(spark.createDataFrame(rows, "doc_id long, text string"), {})
    pairs = {(r["text"], r["next_text"]) for r in led.collect()}
    draw = lambda t: h64([t.encode()]) >> 1
    order = [t for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, draw(r[1])), reverse=True)]
    assert pairs == set(zip(order, [*order[1:], order[0]]))


def test_likeness_follows_the_order_of_a_text(spark):
    base = prose(5, 900)
    half = len(base) // 2
    draw = random.Random(1)
    some = list(base)
    for i in draw.sample(range(len(base)), len(base) // 100):
        some[i] = "#"
    rows = [("same", base), ("typos", "".join(some)), ("halves", base[half:] + base[:half]), ("other", prose(6, 900))]
    frame = spark.createDataFrame([(n, base, t) for n, t in rows], "name string, a string, b string")
    got = dict(frame.select("name", o.likeness(o.fingerprint(F.col("a")), o.fingerprint(F.col("b")))).collect())
    assert got["same"] == 1.0 and got["other"] < 0.1 < got["typos"] and 0.1 < got["halves"] < 0.9


def test_no_python_workers_in_the_plan(spark):
    frame = o.fingerprints(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
