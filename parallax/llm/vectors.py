"""Near-duplicate vectors: cross-polytope hashing, multiprobe buckets, verified pairs."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import Scratch, components, partitions, runs, sorted_groups, table_of, trimmed

PROBES = 3  # buckets of a vector in each: its own, and the two that differ in one of the two hashes
BLOCK = 2048  # rows of a bucket that meet in one task; larger buckets are met block by block


def tables(d: int) -> int:
    """Independent hash tables for vectors of a padded width: near vectors meet less often in one the wider they are."""
    return 6 + max(0, 3 * (d.bit_length() - 7) // 2)


@functools.cache
def _signs(d: int) -> np.ndarray:
    return np.random.default_rng((20260803, d)).choice([-1.0, 1.0], (tables(d), 2, 3, d))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the width is a power of 2."""
    x = x.copy()
    h, d = 1, x.shape[1]
    while h < d:
        v = x.reshape(len(x), d // (2 * h), 2, h)
        a, b = v[:, :, 0].copy(), v[:, :, 1].copy()
        v[:, :, 0], v[:, :, 1] = a + b, a - b
        h *= 2
    return x


def buckets(x: np.ndarray) -> np.ndarray:
    """(vectors, tables, PROBES): the buckets of unit vectors, the own one first.

    A hash turns the vector by three rounds of random signs and a Hadamard transform; its value is the nearest signed
    axis. A bucket is named by two hashes; a probe has the second nearest axis of one of them.
    """
    d = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, d - x.shape[1])))
    signs = _signs(d)
    out = np.zeros((len(x), len(signs), PROBES), np.int64)
    for t in range(len(signs)):
        near = []
        for k in range(2):
            y = x
            for r in range(3):
                y = hadamard(y * signs[t, k, r])
            size = np.abs(y)
            rows = np.arange(len(y))
            first = size.argmax(1)
            size[rows, first] = -1.0
            second = size.argmax(1)
            near.append([2 * first + (y[rows, first] < 0), 2 * second + (y[rows, second] < 0)])
        for p, (i, j) in enumerate(((0, 0), (1, 0), (0, 1))):
            out[:, t, p] = near[0][i] * 2 * d + near[1][j]
    return out


def _matrix(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and their buckets, of rows of equal width."""
    x = np.stack([np.frombuffer(b, np.float64) for b in batch.column("vector").to_pylist()])
    return x / np.linalg.norm(x, axis=1, keepdims=True), np.stack([np.frombuffer(b, np.int64) for b in batch.column("buckets").to_pylist()]).reshape(len(x), -1, PROBES)


def _components(pairs_a: np.ndarray, pairs_b: np.ndarray, n: int) -> np.ndarray:
    """Smallest row number reachable, for n rows of one block."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[pairs_a], label[pairs_b])
        np.minimum.at(label, pairs_a, low)
        np.minimum.at(label, pairs_b, low)
        label = label[label]
        if (label == before).all():
            return label


def near_duplicates(vectors: DataFrame, scratch: Scratch, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Rows link when found with a cosine of at least `least`, computed in double precision. Null vectors, those with a
    null or non-finite component, and zero vectors link with nothing; vectors of different widths are not compared.
    Equal vectors are one class from the start. A class is indexed in its own bucket of each table and looks into its
    probes; a bucket's pairs are met block by block, and only counts of links and one edge for each vector to its
    block's component leave a block. A pair counts in the first table in which it meets. A null id is never the
    smallest where another is there; an empty table gives no rows; other columns are not read.
    """
    n = partitions(vectors.sparkSession)

    @trimmed
    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, data = [], []
            for v in batch.column("v").to_pylist():
                x = None if not v or None in v else np.array(v, np.float64)
                if x is None or not np.isfinite(x).all() or not x.any():
                    keys.append(None)
                    data.append(None)
                else:
                    data.append((x / np.abs(x).max() + 0.0).tobytes())  # scaled, so that no square is lost
                    keys.append(int.from_bytes(hashlib.blake2b(data[-1], digest_size=8).digest(), "little", signed=True))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(keys, pa.int64()), pa.array(data, pa.binary())], names=["vec_id", "key", "vector"])

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = scratch.save(rows.mapInArrow(keyed, "vec_id long, key long, vector binary"), "rows")
    valid = rows.where("key is not null")
    classes = scratch.save(valid.groupBy("key").agg(F.count("*").alias("size"), F.min("vec_id").alias("least"), F.first("vector").alias("vector")), "classes")

    @trimmed
    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            width = np.array([len(v) for v in batch.column("vector").to_pylist()])
            for w in np.unique(width):
                part = batch.filter(pa.array(width == w))
                x = np.stack([np.frombuffer(v, np.float64) for v in part.column("vector").to_pylist()])
                b = buckets(x / np.linalg.norm(x, axis=1, keepdims=True))
                m = part.num_rows
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("size"), part.column("vector"), pa.array([r.tobytes() for r in b], pa.binary()), pa.array([int(w)] * m, pa.int32())], names=["key", "size", "vector", "buckets", "width"])

    indexed = scratch.save(classes.select("key", "size", "vector").mapInArrow(hashed, "key long, size long, vector binary, buckets binary, width int"), "indexed")

    @trimmed
    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if m:
                b = [np.frombuffer(v, np.int64) for v in batch.column("buckets").to_pylist()]
                at = np.repeat(np.arange(m), [len(v) for v in b])
                slot = np.concatenate([np.arange(len(v)) for v in b])
                yield pa.RecordBatch.from_arrays([pa.array(batch.column("key").to_numpy()[at]), pa.array(batch.column("width").to_numpy()[at]), pa.array((slot // PROBES).astype(np.int32)), pa.array(np.concatenate(b)), pa.array((slot % PROBES > 0).astype(np.int32))], names=["key", "width", "tab", "bucket", "probe"])

    places = scratch.save(indexed.select("key", "width", "buckets").mapInArrow(spread, "key long, width int, tab int, bucket long, probe int"), "places")
    at = ["width", "tab", "bucket"]
    sizes = places.groupBy(*at).agg(F.count("*").alias("n"), F.sum(1 - F.col("probe")).alias("own")).where("own > 0 and n > 1")
    sizes = sizes.select(*at, F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    met = places.join(sizes, at).withColumn("salt", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    met = met.withColumn("other", other).select("key", *at, "salt", F.least("salt", "other").alias("i"), F.greatest("salt", "other").alias("j"), F.col("probe"))
    met = met.join(indexed.select("key", "size", "vector", "buckets"), "key")

    @trimmed
    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["width", "tab", "bucket", "i", "j"], most=20_000):
            names = {c: t.column(c).to_numpy() for c in ("key", "size", "width", "tab", "bucket", "salt", "i", "j", "probe")}
            starts = np.append(runs([names[c] for c in ("width", "tab", "bucket", "i", "j")]), t.num_rows)
            out: list[tuple[np.ndarray, ...]] = []
            for lo, hi in zip(starts, starts[1:]):
                own = np.flatnonzero(names["probe"][lo:hi] == 0)
                if hi - lo < 2 or not len(own):
                    continue
                x, b = _matrix(t.slice(lo, hi - lo))
                salt = names["salt"][lo:hi]
                a, c = np.nonzero(x[own] @ x.T >= least)
                a = own[a]
                # both in their own bucket: once; over two blocks: only pairs across them
                ok = (names["probe"][lo:hi][c] == 1) | (a < c)
                if names["i"][lo] != names["j"][lo]:
                    ok &= salt[a] != salt[c]
                a, c = a[ok], c[ok]
                tab, bucket = int(names["tab"][lo]), int(names["bucket"][lo])
                first = np.ones(len(a), bool)
                for k in range(tab):
                    first &= ~((b[a, k, 0, None] == b[c, k]).any(1) | (b[c, k, 0, None] == b[a, k]).any(1))
                # in this table: by the smaller of the two own buckets, if each looks into the other's
                both = (b[a, tab] == b[c, tab, 0, None]).any(1)
                first &= ~both | (bucket == np.minimum(b[a, tab, 0], b[c, tab, 0]))
                a, c = a[first], c[first]
                if len(a):
                    key, size = names["key"][lo:hi], names["size"][lo:hi]
                    links = np.bincount(a, size[c], hi - lo) + np.bincount(c, size[a], hi - lo)
                    label = _components(a, c, hi - lo)
                    some = np.flatnonzero(links)
                    out.append((key[some], links[some].astype(np.int64), key[label[some]]))
            if out:
                key, links, root = (np.concatenate(c) for c in zip(*out))
                yield table_of(_found, key=key, links=links, root=root)

    found = met.repartition(n, *at, "i", "j").sortWithinPartitions(*at, "i", "j", "probe", "key").mapInArrow(blocks, "key long, links long, root long")
    found = scratch.save(found, "found")
    scratch.drop("places")
    linked = found.groupBy("key").agg(F.sum("links").alias("links"))
    joined = components(found.where("key <> root"), scratch, "key", "root")
    placed = classes.select("key", "size", "least").join(linked, "key", "left").join(joined.withColumnRenamed("node", "key"), "key", "left")
    placed = placed.select("key", "least", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "key").alias("component"))
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = scratch.save(placed.join(names, "component").select("key", "n_links", "component_id"), "named")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    result = rows.select("vec_id", "key").join(named, "key", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"))
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


_found = pa.schema([("key", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
