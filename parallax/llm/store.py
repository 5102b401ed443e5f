"""Content-addressed store of token ids: unique chunks, document recipes, Merkle roots."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parallax.llm.common import Scratch, partitions, slices, table_of, text_of, trimmed
from parallax.llm.vocab import encoder

LEAST, MASK, MOST = 64, 255, 2048  # of a chunk's ids; a cut wherever the rolling hash's low 8 bits are 0
WINDOW = 16
TEXT = 8 << 20  # bytes of text that a task encodes at once
SEEN = 200_000  # digests that a task remembers, so as not to send a chunk twice

STAGED = "kind string, digest binary, doc_id long, n_tokens long, data binary, lengths binary"
MANIFEST = "part int, n_docs long, n_tokens long, root binary"
STAGED_ARROW = pa.schema([("kind", pa.string()), ("digest", pa.binary()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("data", pa.binary()), ("lengths", pa.binary())])

_gear = np.random.default_rng(20260801).integers(1, 2**63, 65_536, dtype=np.uint64)


def cuts(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of an id stream.

    The rolling hash covers the last 16 ids, so an edit moves only the cuts near it. It is summed by doubling: windows
    of 2, 4, 8 and 16 ids from two windows of half the width.
    """
    h = _gear[ids & 0xFFFF]
    width = 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint64(width)
        width *= 2
    marks = np.flatnonzero((h >> np.uint64(40)) & np.uint64(MASK) == 0) + 1
    ends, last = [], 0
    for m in [*marks.tolist(), len(ids)]:
        while m - last > MOST:
            last += MOST
            ends.append(last)
        if m - last >= LEAST or (m == len(ids) and m > last):
            ends.append(m)
            last = m
    return ends


def merkle(digests: bytes, width: int = 32) -> bytes:
    """Root of the binary hash tree over the digests; an odd one rises unchanged."""
    level = [digests[i : i + width] for i in range(0, len(digests), width)]
    while len(level) > 1:
        pairs = [hashlib.sha256(b"\1" + level[i] + level[i + 1]).digest() for i in range(0, len(level) - 1, 2)]
        level = pairs + level[len(level) & ~1 :]
    return hashlib.sha256(b"\2" + (level[0] if level else b"")).digest()


class Tree:
    """The root of merkle() over digests that come one by one; holds one node for each level."""

    def __init__(self):
        self.levels: list[bytes | None] = []

    def add(self, digest: bytes) -> None:
        for k, left in enumerate(self.levels):
            if left is None:
                self.levels[k] = digest
                return
            self.levels[k] = None
            digest = hashlib.sha256(b"\1" + left + digest).digest()
        self.levels.append(digest)

    def root(self) -> bytes:
        right = None
        for left in self.levels:
            if left is not None:
                right = left if right is None else hashlib.sha256(b"\1" + left + right).digest()
        return hashlib.sha256(b"\2" + (right or b"")).digest()


def part_roots(recipes: DataFrame) -> DataFrame:
    """part, n_docs, n_tokens, root: the Merkle root over the roots of each part's documents in order."""

    @trimmed
    def roots(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree, docs, tokens = None, Tree(), 0, 0
        for batch in batches:
            for part, n, root in zip(*(batch.column(c).to_pylist() for c in ("part", "n_tokens", "root"))):
                if part != now and now is not None:
                    yield table_of(_manifest, part=[now], n_docs=[docs], n_tokens=[tokens], root=[tree.root()])
                    tree, docs, tokens = Tree(), 0, 0
                now = part
                tree.add(root)
                docs, tokens = docs + 1, tokens + n
        if now is not None:
            yield table_of(_manifest, part=[now], n_docs=[docs], n_tokens=[tokens], root=[tree.root()])

    ordered = recipes.select("part", "start", "n_tokens", "root").repartition(partitions(recipes.sparkSession), "part").sortWithinPartitions("part", "start", "root")
    return ordered.mapInArrow(roots, "part int, n_docs long, n_tokens long, root binary")


_manifest = pa.schema([("part", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("root", pa.binary())])


def whole_root(manifest: DataFrame) -> bytes:
    """The store's one root, over the parts' roots; a part is a partition of a shuffle, so there are few."""
    tree = Tree()
    for r in manifest.where("part is not null").select("part", "root").orderBy("part").toLocalIterator():
        tree.add(bytes(r["root"]))
    return tree.root()


def verify(recipes: DataFrame, manifest: DataFrame) -> None:
    """Holds recipes as read against the manifest, and the manifest against its own root; raises if they differ."""
    own = part_roots(recipes)
    listed = manifest.where("part is not null")
    both = own.select("part", F.col("root").alias("found"), F.col("n_docs").alias("docs"), F.col("n_tokens").alias("tokens")).join(listed, "part", "full")
    wrong = both.where(~(F.col("found").eqNullSafe(F.col("root")) & F.col("docs").eqNullSafe(F.col("n_docs")) & F.col("tokens").eqNullSafe(F.col("n_tokens")))).select("part").first()
    if wrong is not None:
        raise ValueError(f"part {wrong['part']} of the store isn't what its manifest says")
    top = manifest.where("part is null").first()
    if top is None or bytes(top["root"]) != whole_root(manifest):
        raise ValueError("the manifest's root isn't that of its parts")


def write(docs: DataFrame, vocabulary: str, scratch: Scratch, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Encodes documents and stores their ids; returns the tables (chunks, recipes, manifest), read back from files.

    chunks: a row for each distinct chunk (digest: sha256 of its ids as little-endian unsigned 16-bit integers, data).
    recipes: a row for each document in ascending id order (nulls first, ties by root): part, start, n_tokens,
    digests and lengths of its chunks, and their Merkle root. manifest: a row for each part with the Merkle root over its
    documents' roots, and one with a null part, the root over the parts'. A null text counts as empty, and holds end_id
    alone; a very long one is encoded whole and cut as any other; equal rows keep a recipe each; an empty table gives
    empty tables and a manifest of one row; other columns are not read. Ids over 65,535 raise an error.

    A task sends a chunk once, so a chunk that a third of the documents share arrives at most once from each task.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    @trimmed
    def stage(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in slices(batches, "text", TEXT):
            rows: list[tuple] = []
            flat, edges = encoder(vocabulary, False).encode(batch.column("text"), end_id)
            if len(flat) and flat.max() > 0xFFFF:
                raise ValueError("ids over 65,535 don't fit the store's 16 bits")
            edges = edges.tolist()
            for doc, lo, hi in zip(batch.column("id").to_pylist(), edges, edges[1:]):
                ids = flat[lo:hi]
                small = ids.astype("<u2").tobytes()
                digests, lengths, start = [], [], 0
                for stop in cuts(ids):
                    data = small[2 * start : 2 * stop]
                    digest = hashlib.sha256(data).digest()
                    digests.append(digest)
                    lengths.append(stop - start)
                    start = stop
                    if digest not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(digest)
                        rows.append(("chunk", digest, None, None, data, None))
                joined = b"".join(digests)
                rows.append(("recipe", merkle(joined), doc, hi - lo, joined, np.array(lengths, "<u4").tobytes()))
                if len(rows) > 20_000:
                    yield table_of(STAGED_ARROW, **dict(zip(STAGED_ARROW.names, zip(*rows))))
                    rows = []
            if rows:
                yield table_of(STAGED_ARROW, **dict(zip(STAGED_ARROW.names, zip(*rows))))

    @trimmed
    def once(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            keep = []
            for kind, digest in zip(batch.column("kind").to_pylist(), batch.column("digest").to_pylist()):
                keep.append(kind != "chunk" or digest != last)
                last = digest if kind == "chunk" else None
            yield batch.filter(pa.array(keep, pa.bool_()))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).mapInArrow(stage, STAGED)
    deal = F.when(F.col("kind") == "chunk", F.xxhash64("digest")).otherwise(F.xxhash64("doc_id", "digest"))
    staged = rows.repartition(n, deal).sortWithinPartitions("kind", "digest").mapInArrow(once, STAGED)
    staged = scratch.save(staged, "staged", by="kind", schema=STAGED)
    chunks = staged.where("kind = 'chunk'").select("digest", "data")
    recipes = (
        staged.where("kind = 'recipe'")
        .select("doc_id", F.col("digest").alias("root"), "n_tokens", F.col("data").alias("digests"), "lengths")
        .repartitionByRange(n, "doc_id", "root")
        .sortWithinPartitions("doc_id", "root")
        .withColumn("part", F.spark_partition_id())
    )
    recipes = scratch.save(recipes, "recipes")
    # ids before a document: those of earlier parts (one row a part) plus those before it in its own
    totals = recipes.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    before = totals.select("part", F.coalesce(F.sum("ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    inside = F.sum("n_tokens").over(W.partitionBy("part").orderBy("doc_id", "root").rowsBetween(W.unboundedPreceding, -1))
    recipes = recipes.withColumn("inside", F.coalesce(inside, F.lit(0))).join(F.broadcast(before), "part").select("part", "doc_id", (F.col("earlier") + F.col("inside")).alias("start"), "n_tokens", "digests", "lengths", "root")
    recipes = scratch.save(recipes, "placed")
    scratch.drop("recipes")
    parts = scratch.save(part_roots(recipes), "parts", schema=MANIFEST)
    top = spark.createDataFrame([(None, None, None, whole_root(parts))], MANIFEST)
    manifest = parts.union(top)
    manifest = scratch.save(manifest, "manifest", schema=MANIFEST)
    return chunks, recipes, manifest


_POLY = np.uint32(0xEDB88320)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of polynomials over GF(2) modulo crc32's, bits reflected."""
    p = np.zeros(np.broadcast(a, b).shape, np.uint32)
    b = b.copy()
    for k in range(31, -1, -1):
        p ^= np.where(a >> np.uint32(k) & np.uint32(1), b, np.uint32(0))
        b = (b >> np.uint32(1)) ^ np.where(b & np.uint32(1), _POLY, np.uint32(0))
    return p


def shifted(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """What a part's crc32 adds (by exclusive or) to the crc32 of a whole in which n_bytes follow the part."""
    power = np.full(len(crc), 1 << 31, np.uint32)
    square = np.array([1 << 30], np.uint32)
    for _ in range(3):
        square = _times(square, square)
    for k in range(int(n_bytes.max(initial=0)).bit_length()):
        power = np.where(n_bytes >> k & 1, _times(square, power), power)
        square = _times(square, square)
    return _times(power, crc.astype(np.uint32))


def digests(chunks: DataFrame, recipes: DataFrame, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 of all its ids as 32-bit integers.

    Every chunk read is held against its sha256, every recipe against its Merkle root, and all of these against the
    manifest. A chunk's crc32 is taken once,
    where the chunk lies; only crc32s and lengths are shuffled, and a document's crc32 is the exclusive or of its
    chunks' shifted ones.
    """

    verify(recipes, manifest)

    @trimmed
    def of_chunks(batches):
        for batch in batches:
            crc, size = [], []
            for digest, data in zip(batch.column("digest").to_pylist(), batch.column("data").to_pylist()):
                if hashlib.sha256(data).digest() != digest:
                    raise ValueError(f"chunk {digest.hex()} is damaged")
                wide = np.frombuffer(data, "<u2").astype("<u4").tobytes()
                crc.append(zlib.crc32(wide))
                size.append(len(wide))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(crc, pa.int64()), pa.array(size, pa.int64())], names=["digest", "crc", "size"])

    @trimmed
    def of_recipes(batches):
        for batch in batches:
            out: list[tuple] = []
            for doc, start, n, joined, lengths, root in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "n_tokens", "digests", "lengths", "root"))):
                sizes = np.frombuffer(lengths, "<u4").astype(np.int64)
                if merkle(joined) != root or sizes.sum() != n:
                    raise ValueError(f"the recipe of {doc} is damaged")
                after = n - np.cumsum(sizes)
                out += [(doc, start, n, joined[32 * i : 32 * i + 32], 4 * int(a), 4 * int(s)) for i, (a, s) in enumerate(zip(after, sizes))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()))], names=["doc_id", "start", "n_tokens", "digest", "after", "own"])

    @trimmed
    def terms(batches):
        for batch in batches:
            if batch.num_rows:
                get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
                if batch.column("crc").null_count or (get("own") != get("size")).any():
                    raise ValueError("a recipe names a chunk that is missing or of another length")
                term = shifted(get("crc"), get("after")).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(term)], names=["doc_id", "start", "n_tokens", "term"])

    crcs = chunks.select("digest", "data").mapInArrow(of_chunks, "digest binary, crc long, size long")
    refs = recipes.mapInArrow(of_recipes, "doc_id long, start long, n_tokens long, digest binary, after long, own long")
    joined = refs.join(crcs, "digest", "left").mapInArrow(terms, "doc_id long, start long, n_tokens long, term long")
    return joined.groupBy("doc_id", "start", "n_tokens").agg(F.bit_xor("term").alias("ids_crc32"))


def ids(chunks: DataFrame, recipes: DataFrame) -> DataFrame:
    """The documents' whole id streams, rebuilt from the files: doc_id, start, ids (16-bit, little-endian)."""

    @trimmed
    def steps(batches):
        for batch in batches:
            out = [(d, s, i, j[32 * i : 32 * i + 32]) for d, s, j in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "digests"))) for i in range(len(j) // 32)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["doc_id", "start", "step", "digest"])

    @trimmed
    def whole(batches):
        now, doc, parts = None, None, []

        def one():
            return pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([now], pa.int64()), pa.array([b"".join(parts)], pa.binary())], names=["doc_id", "start", "ids"])

        for batch in batches:
            for d, s, data in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "data"))):
                if s != now:
                    if now is not None:
                        yield one()
                    now, doc, parts = s, d, []
                parts.append(data)
        if now is not None:
            yield one()

    # a document's start is its own: each holds its end id at the least
    parts = recipes.mapInArrow(steps, "doc_id long, start long, step long, digest binary").join(chunks, "digest")
    ordered = parts.repartition(partitions(recipes.sparkSession), "start").sortWithinPartitions("start", "step")
    return ordered.mapInArrow(whole, "doc_id long, start long, ids binary")
