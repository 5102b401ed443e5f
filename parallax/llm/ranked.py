"""Ranked search: the best documents for each query by sums of impacts, found by the Best Position Algorithm."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from parallax.llm.common import Scratch, slices, table_of, trimmed

#: Bytes that part terms become spaces, capitals small letters.
_PARTS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
PLAIN = bytes(32 if b in _PARTS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
QUERY_BYTES = 2 << 20  # of the queries' texts that are searched for at once
SHARD = 2_000_000  # postings that a task holds at once
NO_ID = 2**63 - 1  # a null id comes behind all others

POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"
_found_schema = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: bytes | None) -> list[bytes]:
    """A text's terms in order: runs of ASCII letters and digits and of all that isn't ASCII."""
    return (text or b"").translate(PLAIN).split()


class Shard:
    """Impact lists of some documents: for each term its documents by falling impact, and the same by document."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, terms: np.ndarray, counts: np.ndarray, per_doc: np.ndarray, n_docs: int, n_terms: int):
        """ids and lengths of the documents, in order of id; their postings, per_doc of them to each; n_docs and n_terms
        of the whole collection."""
        self.ids = ids
        doc = np.repeat(np.arange(len(ids), dtype=np.int64), per_doc)
        norm = np.repeat(100 - 25 + 25 * lengths * n_docs // max(n_terms, 1), per_doc)
        impact = 1_000_000_000 * counts // (1000 * counts + 12 * norm)
        order = np.lexsort((doc, terms))
        terms, self.by_doc, self.impact_by_doc = terms[order], doc[order].astype(np.int32), impact[order]
        falling = np.lexsort((self.by_doc, -self.impact_by_doc, terms))
        self.by_impact, self.impact = self.by_doc[falling], self.impact_by_doc[falling]
        self.place = np.empty(len(order), np.int32)  # where an entry by document stands among all by impact
        self.place[falling] = np.arange(len(order), dtype=np.int32)
        self.terms, starts = np.unique(terms, return_index=True)
        self.starts = np.append(starts, len(terms))

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, first: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """The k documents (places in ids) of highest score above 0 and their scores; of equal scores the least ids.

        All lists are read from the top in step; each new document's impacts are looked up in every list, which marks
        its places there as seen, too. A document not yet seen has no more in a list than what stands at the first
        place not seen: once the sum of these is less than the k-th score, no other can follow; one that is equal could.
        """
        at = np.searchsorted(self.terms, terms)
        known = np.flatnonzero((at < len(self.terms)) & (weights > 0))
        known = known[self.terms[at[known]] == terms[known]]
        lows, highs, weights = self.starts[at[known]], self.starts[at[known] + 1], weights[known]
        seen = [np.zeros(h - l + 1, bool) for l, h in zip(lows, highs)]
        position = [0] * len(known)
        met = np.zeros(len(self.ids), bool)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, first
        while True:
            fresh = [self.by_impact[l + depth : min(h, l + depth + step)] for l, h in zip(lows, highs)]
            new = np.unique(np.concatenate(fresh)) if fresh else np.zeros(0, np.int32)
            new = new[~met[new]]
            met[new] = True
            score = np.zeros(len(new), np.int64)
            bound = 0
            for j, (low, high, weight) in enumerate(zip(lows, highs, weights)):
                own = self.by_doc[low:high]
                there = np.searchsorted(own, new)
                there[there == len(own)] = 0
                has = np.flatnonzero(own[there] == new)
                entry = there[has] + low
                score[has] += weight * self.impact_by_doc[entry]
                seen[j][self.place[entry] - low] = True
                position[j] += int(np.argmin(seen[j][position[j] :]))  # the last place, behind the list, is never seen
                bound += int(weight * self.impact[low + position[j]]) if position[j] < high - low else 0
            docs, scores = np.append(docs, new), np.append(scores, score)
            top = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[top], scores[top]
            if not bound or len(docs) == k and bound < scores[-1]:
                break
            depth, step = depth + step, 2 * step
        above = scores > 0
        return docs[above], scores[above]


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """doc_id, number of terms, and the vocabulary's terms with their counts, of documents with a term."""

    @trimmed
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in slices(batches, "text"):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if all_terms := terms_of(text):
                    found = Counter(map(number, all_terms))
                    found.pop(None, None)
                    rows.append((doc, len(all_terms), list(found), list(found.values())))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "n", "terms", "counts"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(count, POSTINGS)


def rank(docs: DataFrame, queries: DataFrame, scratch: Scratch, k: int = 20, id_col: str = "doc_id", text_col: str = "text", query_col: str = "item_id", query_text: str = "text") -> DataFrame:
    """query_col, rank, doc_id, score: each query's k best documents.

    A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))) and its impact in a document 10^9 tf div (1000 tf + 12 m),
    where m = 100 - 25 + 25 n N div L; all documents count for N, L and df, in all their length.

    Every document goes against all queries, in blocks of queries of about QUERY_BYTES of text, so what a task is told is
    bounded. For each block the documents' postings of the block's terms are written once; a task searches its
    documents by shards, and sends k of each for a query at the most, of which the best stay.

    Null texts have no terms; documents and queries without one give no rows. Every row counts as a document, repeated
    ones too; of equal scores the least id comes first, null last. Queries equal in id and text are one; of one id
    with several texts each has its own ranking. Other columns are not read.
    """
    asked = queries.select(F.col(query_col).alias("query_id"), F.col(query_text).cast("string").cast("binary").alias("query")).where("length(query) > 0").distinct()
    size = asked.agg(F.sum(F.length("query"))).first()[0] or 0
    blocks = 1 + size // QUERY_BYTES
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id", "query"), F.lit(blocks)).cast("int"))
    found = names = None
    for b in range(blocks):
        own = asked.where(F.col("block") == b).collect()
        part = _block(docs, [bytes(q["query"]) for q in own], scratch, b, k, id_col, text_col)
        ids = docs.sparkSession.createDataFrame([(b, i, q["query_id"]) for i, q in enumerate(own)], StructType([StructField("block", IntegerType()), StructField("query", IntegerType()), asked.schema["query_id"]]))
        found, names = (part, ids) if found is None else (found.union(part), names.union(ids))
    place = F.row_number().over(W.partitionBy("block", "query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = found.withColumn("rank", place).where(F.col("rank") <= k)
    return best.join(names, ["block", "query"]).select(F.col("query_id").alias(query_col), "rank", "doc_id", "score")


def _block(docs: DataFrame, queries: list[bytes], scratch: Scratch, block: int, k: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    counted = [Counter(terms_of(q)) for q in queries]
    vocabulary: dict[bytes, int] = {}
    for c in counted:
        for term in c:
            vocabulary.setdefault(term, len(vocabulary))
    lists = scratch.save(postings(docs, vocabulary, id_col, text_col), f"postings-{block}")
    n_docs, n_terms = lists.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = lists.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weights = np.zeros(len(vocabulary), np.int64)
    for term, w in df.select("term", weight).collect():  # a row for each term of the block
        weights[term] = w
    wanted = []
    for c in counted:
        numbers = np.array([vocabulary[t] for t in c], np.int64)
        wanted.append((numbers, weights[numbers] * np.array(list(c.values()), np.int64)))

    @trimmed
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def best() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            ids = table.column("doc_id").to_numpy() if not table.column("doc_id").null_count else table.column("doc_id").fill_null(NO_ID).to_numpy()
            table = table.take(pa.array(np.argsort(ids, kind="stable")))
            terms, counts = (table.column(c).combine_chunks() for c in ("terms", "counts"))
            flat = lambda a: a.flatten().to_numpy().astype(np.int64)
            per_doc = pa.compute.list_value_length(terms).to_numpy()
            shard = Shard(np.sort(ids, kind="stable"), table.column("n").to_numpy(), flat(terms), flat(counts), per_doc, n_docs, n_terms)
            for query, (numbers, weight) in enumerate(wanted):
                docs, scores = shard.best(numbers, weight, k)
                if len(docs):
                    found = shard.ids[docs]
                    yield table_of(_found_schema, query=np.full(len(docs), query, np.int32), doc_id=pa.array(found, mask=found == NO_ID), score=scores)

        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column("terms").flatten())
            if size >= SHARD:
                yield from best()
                held, size = [], 0
        if size:
            yield from best()

    found = lists.select("doc_id", "n", "terms", "counts").where(F.size("terms") > 0).mapInArrow(search, "query int, doc_id long, score long")
    return found.select(F.lit(block).alias("block"), "query", "doc_id", "score")
