"""Readers of document-shaped files, and the writes of the backlog."""

import gzip
import json

import pytest

from parallax.operators import backlog, gate
from parallax.sources import files


@pytest.fixture
def folder(tmp_path):
    def put(name, value):
        (tmp_path / name).write_text(json.dumps(value))

    put("1.lab.m-1.json", {"generated_at": 1.0, "entries": [{"title": "One", "printed_page_number": "vii"}, {"title": "Two", "authors": ["A"], "skip": True}]})
    put("2.other.json", {"kind": "text", "entries": []})
    put("1.expected.json", {"source": "bulk_gate", "verified": False, "entries": [{"title": "One"}]})
    put("2.expected.json", {"source": "bulk_gate", "verified": None, "entries": [{"title": "One", "skip": False}]})
    put("3.expected.json", {"source": "agent_arbitration", "entries": [{"title": "One"}]})
    put("manifest.json", {"toc_only": True, "books": [{"filename": "97-1.pdf", "title": "T", "doi": "10.1/x"}, {"filename": "b.c.pdf"}]})
    (tmp_path / "keys.txt").write_text("b\n# no\n\na\nb\n c \n")
    with gzip.open(tmp_path / "dump.jsonl.gz", "wt") as f:
        for r in ({"id": "1", "type": ["EditedVolume"], "tableOfContents": [{"id": "http://x"}]}, {"id": "2", "type": ["Book"], "tableOfContents": [{"id": "http://x"}]}, {"id": "3", "type": ["EditedVolume"], "tableOfContents": []}):
            f.write(json.dumps(r) + "\n")
    return str(tmp_path)


def test_readers(spark, folder):
    read = spark.read.schema(files.READING).option("multiLine", True).json([f"{folder}/1.lab.m-1.json", f"{folder}/2.other.json"])
    named = {r["key"]: r for r in files.named(read).collect()}
    assert (named["1"]["reader"], named["1"]["kind"], named["2"]["reader"], named["2"]["kind"]) == ("lab.m-1", "vision", "other", "text")
    rows = [tuple(r) for r in files.exploded(files.named(read), "key").select("ordinal", "title", "authors", "page_val", "skip").orderBy("ordinal").collect()]
    assert rows == [(1, "One", [], 7, False), (2, "Two", ["A"], None, True)]
    assert {r["key"]: r["stale"] for r in files.truth(spark, folder).collect()} == {"1": True, "2": False, "3": False}
    assert [r["key"] for r in files.truth(spark, folder).where("verified = false").collect()] == ["1"]
    assert {r["key"] for r in files.manifest(spark, f"{folder}/manifest.json").collect()} == {"97-1", "b.c"}
    assert [r["id"] for r in files.records(spark, f"{folder}/dump.jsonl.gz").collect()] == ["1"]
    assert [tuple(r) for r in files.keys(spark, f"{folder}/keys.txt").orderBy("position").collect()] == [("b", 1), ("a", 2), ("c", 3)]


def test_writes(spark):
    held = spark.createDataFrame([("a", 1), ("b", 2)], "key string, n int")
    new = spark.createDataFrame([("b", 9), ("c", 3), ("c", 3)], "key string, n int")
    assert sorted(map(tuple, backlog.inserted(held, new, ["key"]).collect())) == [("a", 1), ("b", 2), ("c", 3)]
    assert sorted(map(tuple, backlog.removed(held, new, ["key"]).collect())) == [("a", 1)]
    assert sorted(map(tuple, backlog.updated(held, new.limit(1), "key", "n").collect())) == [("a", 1), ("b", 9)]


def test_a_document_without_entries_gets_a_reason(spark):
    entries = spark.createDataFrame([("x", "A")], "key string, reader string")
    best = spark.createDataFrame([], "key string")
    manifest = spark.createDataFrame([("x",), ("y",)], "key string")
    assert {r["key"]: r["reason"] for r in gate.outcomes(entries, best, manifest).collect()} == {"x": "single_reading_only", "y": "no_entries"}
