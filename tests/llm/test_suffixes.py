"""Repeated rows, texts that share a checksum, and texts of several units, held against brute force."""

import hashlib
import os
import zlib

import numpy as np
import pytest

from parallax.llm import suffixes
from parallax.llm.common import Scratch

DIR = "/root/testdata/sf0.001"


def brute(rows, depth=100):
    """What is left of each of the distinct (id, text): in order of id, then of the MD5 as two signed numbers."""
    half = lambda t, a: int.from_bytes(hashlib.md5(t.encode()).digest()[a : a + 8], "big", signed=True)
    seen, left = set(), {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, half(r[1], 0), half(r[1], 8))):
        b = t.encode()
        mark = np.zeros(len(b) + 1, np.int64)
        for p in range(len(b) - depth + 1):
            w = b[p : p + depth]
            if w in seen:
                mark[p] += 1
                mark[min(p + depth, len(b))] -= 1
            seen.add(w)
        cover = np.cumsum(mark)[: len(b)] > 0
        left[i, t] = bytes(np.frombuffer(b, np.uint8)[~cover])
    return left


def words(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"{chr(97 + a)}{b}" for a, b in zip(rng.integers(0, 26, n), rng.integers(0, 99999, n)))


def left_of(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    kept = suffixes.remove_repeats(docs.selectExpr("doc_id", "text", "text as whole"), Scratch(spark, "test"), carry=("whole",))
    return sorted(((r["doc_id"], r["whole"], bytes(r["kept"])) for r in kept.collect()), key=str)


def expected(rows):
    left = brute(rows)
    return sorted(((i, t, left[i, t]) for i, t in rows), key=str)


def test_repeated_rows_are_one_document(spark):
    shared = words(0, 30)
    rows = [(1, words(1, 60)), (2, words(2, 20) + shared + words(3, 20)), (3, shared), (None, words(4, 50)), (None, shared + words(5, 9))]
    assert left_of(spark, rows * 3) == expected(rows * 3)


def test_texts_of_one_checksum_are_told_apart(spark):
    base, tail, seen = words(6, 40), words(7, 40), {}
    salt = lambda n: hashlib.md5(str(n).encode()).hexdigest()
    for n in range(300_000):
        seen[zlib.crc32(f"{base} {salt(n)}".encode())] = f"{base} {salt(n)}"
    other = next(x for n in range(1 << 20) if zlib.crc32((x := f"{tail} {salt(n)}").encode()) in seen)
    twin = seen[zlib.crc32(other.encode())]
    assert zlib.crc32(other.encode()) == zlib.crc32(twin.encode()) and other != twin
    rows = [(None, twin), (None, other), (4, twin), (4, other), (9, twin[:150])]
    assert left_of(spark, rows) == expected(rows)


def test_a_text_of_several_units(spark):
    long = words(9, 700_000)
    assert len(long) > suffixes.UNIT
    again = long[: suffixes.UNIT - 40][-300:] + long[suffixes.UNIT - 40 :][:300]
    rows = [(1, long), (2, "start#" + again + "#end"), (3, words(10, 9) + "#" + long[-400:])]
    got = {i: kept for i, _, kept in left_of(spark, rows)}
    assert got[1] == long.encode() and got[2] == b"start##end" and got[3] == (words(10, 9) + "#").encode()


@pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the given tables")
def test_a_table_twice_over_loses_what_the_table_does(spark):
    plain = spark.read.parquet(f"{DIR}/documents.parquet")
    take = lambda d: {r["doc_id"]: r["n_removed"] for r in suffixes.remove_repeats(d, Scratch(spark, "test")).select("doc_id", "n_removed").collect()}
    once = take(plain)
    twice = suffixes.remove_repeats(plain.union(plain), Scratch(spark, "test")).select("doc_id", "n_removed").collect()
    assert len(twice) == 2 * len(once) and all(once[r["doc_id"]] == r["n_removed"] for r in twice)
