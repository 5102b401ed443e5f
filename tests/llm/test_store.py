"""The content-addressed store: empty tables, forced cuts, the manifest, ids that don't fit."""

import hashlib

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from parallax.llm import packing, queries, store
from parallax.llm.common import Scratch

SCHEMA = "doc_id long, text string, root string, part string"


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "store")


def test_empty_table(spark, scratch):
    parts = store.write(spark.createDataFrame([], SCHEMA), queries.WORD_BPE, scratch)
    assert store.digests(*parts).count() == 0 and parts[2].where("part is null").count() == 1
    assert packing.pack(spark.createDataFrame([], SCHEMA), queries.BYTE_BPE).count() == 0


def test_forced_cut_and_tree():
    same = np.full(5000, 7, np.uint32)
    assert max(np.diff([0, *store.cuts(same)])) <= store.MOST and store.cuts(same)[-1] == 5000
    for n in range(9):
        digests = [hashlib.sha256(bytes([k])).digest() for k in range(n)]
        tree = store.Tree()
        for d in digests:
            tree.add(d)
        assert tree.root() == store.merkle(b"".join(digests))


def test_manifest_is_held_against_what_is_read(spark, scratch):
    docs = spark.createDataFrame([(k, f"some words of text {k}", "x", "y") for k in range(30)] + [(None, None, None, None), (3, "", None, None)], SCHEMA)
    chunks, recipes, manifest = store.write(docs, queries.WORD_BPE, scratch)
    assert store.digests(chunks, recipes, manifest).count() == 32
    with pytest.raises(ValueError, match="manifest"):
        store.digests(chunks, recipes.where("doc_id <> 5"), manifest)
    with pytest.raises(ValueError, match="root"):
        store.digests(chunks, recipes, manifest.withColumn("root", F.when(F.col("part").isNull(), F.lit(b"0")).otherwise(F.col("root"))))


def test_ids_must_fit(spark, scratch):
    docs = spark.createDataFrame([(1, "words", None, None)], SCHEMA)
    with pytest.raises(PythonException, match="65,535"):
        store.write(docs, queries.WORD_BPE, scratch, end_id=70_000)


def test_tail_goes_on_to_the_next_group(spark):
    docs = spark.createDataFrame([(k, "word and " * (k % 300 + 1), None, None) for k in range(400)], SCHEMA).coalesce(1)
    sizes = [r["n"] for r in packing.pack(docs, queries.BYTE_BPE, group_tokens=10_000).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
    assert sum(n < 2048 for n in sizes) <= 11 and all(n & (n - 1) == 0 for n in sizes)


def test_costs_are_balanced():
    rests = [(k, 0, 1 + 37 * k % 500) for k in range(400)]
    left = packing.withheld(rests, 2048)
    filled = packing.balance(rests, 2048, 1.0, 1 / 2048)
    costs = [sum(n + n * n / 2048 for _, _, n in pieces) for pieces in filled]
    assert all(sum(n for _, _, n in pieces) == 2048 for pieces in filled)
    assert max(costs) < 1.25 * min(costs) and sum(n for _, _, n in left) < 2048
