"""Quality by the votes of nearest labelled neighbours in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import slices, text_of, trimmed

#: Terms: 9^3 triples of character classes, 512 hashed byte pairs, and 32 marks of repetition.
CLASSES, PAIRS, MARKS = 9, 512, 32
TERMS = CLASSES**3 + PAIRS + MARKS
BLOCK = 512  # documents to a product


def _class_table() -> np.ndarray:
    """Byte to class: white space, line end, lower, upper, digit, stop, symbol, bracket or quote, beyond ASCII."""
    table = np.full(256, 6, np.int64)
    for c in range(256):
        s = chr(c)
        if c >= 128:
            table[c] = 8
        elif s == "\n":
            table[c] = 1
        elif s.isspace():
            table[c] = 0
        elif s.islower():
            table[c] = 2
        elif s.isupper():
            table[c] = 3
        elif s.isdigit():
            table[c] = 4
        elif s in ".,;:!?":
            table[c] = 5
        elif s in "()[]{}\"'":
            table[c] = 7
    return table


_CLASS = _class_table()


def terms(text: str | None) -> np.ndarray:
    """Term counts of a whole text, as logarithms of shares; zeros for one without characters."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    out = np.zeros(TERMS, np.float32)
    if not len(data):
        return out
    data = np.append(data, np.full(max(0, 3 - len(data)), 10, np.uint8))
    c = _CLASS[data]
    out[: CLASSES**3] = np.bincount(c[:-2] * CLASSES**2 + c[1:-1] * CLASSES + c[2:], minlength=CLASSES**3)
    low = data | np.uint8(32)
    pair = (low[:-1].astype(np.uint32) * np.uint32(2_654_435_761) + low[1:].astype(np.uint32) * np.uint32(40_503)) >> np.uint32(16)
    out[CLASSES**3 : CLASSES**3 + PAIRS] = np.bincount(pair % PAIRS, minlength=PAIRS)
    out = np.log1p(out * np.float32(1000 / len(data)))
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    same = sum(map(str.__eq__, words, words[1:]))
    shares = (1 - len(set(zip(words, words[1:], words[2:]))) / max(1, len(words) - 2), same / max(1, len(words)), 1 - len(set(lines)) / max(1, len(lines)), min(1.0, np.log1p(len(words)) / 10))
    for k, share in enumerate(shares):
        lo = CLASSES**3 + PAIRS + 8 * k
        out[lo + min(7, int(8 * max(0.0, share)))] = 4.0
        out[lo] += 40.0 * share if k < 3 else 0.0
    return out


class Space:
    """The fitted space: term weights, the projection, and the labelled vectors with their labels."""

    def __init__(self, idf: np.ndarray, axes: np.ndarray, vectors: np.ndarray, labels: np.ndarray):
        self.idf, self.axes, self.vectors, self.labels = idf, axes, vectors, labels

    def place(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors; zero for a text without terms."""
        x = (counts * self.idf) @ self.axes
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return (x / np.where(norm > 0, norm, 1)).astype(np.float32)

    def score(self, vectors: np.ndarray, k: int, power: float) -> np.ndarray:
        """Share of label 1 among the k nearest labelled vectors, weighted by a power of the similarity.

        All the products of a block of documents with all labelled vectors are taken. With no similar neighbour, as for
        an empty text, the score is the share of label 1 among all.
        """
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        out = np.full(len(vectors), prior)
        k = min(k, len(self.labels))
        for lo in range(0, len(vectors), BLOCK) if k else ():
            cosine = vectors[lo : lo + BLOCK] @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 0.0) ** power
            total = weight.sum(1)
            votes = (weight * self.labels[near]).sum(1)
            out[lo : lo + BLOCK] = np.where(total > 0, votes / np.where(total > 0, total, 1), prior)
        return np.clip(out, 0.0, 1.0)


def fit(rows: list[tuple[str | None, int]], dims: int = 48) -> Space:
    """The space of labelled texts: log counts by idf, and the leading axes of their spread."""
    counts = np.stack([terms(t) for t, _ in rows]) if rows else np.zeros((0, TERMS), np.float32)
    idf = np.log((1 + len(rows)) / (1 + (counts > 0).sum(0))).astype(np.float32) + np.float32(1)
    x = (counts * idf).astype(np.float64)
    _, axes = np.linalg.eigh(x.T @ x)
    space = Space(idf, axes[:, ::-1][:, :dims].astype(np.float32), np.zeros((0, dims), np.float32), np.array([y for _, y in rows], np.float32))
    space.vectors = space.place(counts)
    return space


def learn(docs: DataFrame, labels: DataFrame, train, most: int = 4096, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Space:
    """Fits on at most `most` labelled training ids, those of least hash; no more than one row of each reaches the driver.

    Of repeated ids the larger label and the first text in order count.
    """
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & train).groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(most)
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")).join(F.broadcast(chosen), "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text"))
    return fit([(r["_text"], r["_y"]) for r in sorted(rows.collect(), key=lambda r: r["_id"])])


def score(docs: DataFrame, space: Space, k: int = 15, power: float = 4.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every whole text, null and empty ones included.

    The space is broadcast; its size is bounded by the sample (4,096 vectors of 48 floats by default). Repeated and
    null ids pass through; equal similarities count as they come in the sample's order; an empty table gives no rows;
    other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(space)

    @trimmed
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            scores = np.zeros(len(texts))
            for lo in range(0, len(texts), BLOCK):
                counts = np.stack([terms(t) for t in texts[lo : lo + BLOCK]])
                scores[lo : lo + BLOCK] = held.value.score(held.value.place(counts), k, power)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).mapInArrow(rows, "doc_id long, score double")
