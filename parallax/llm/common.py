"""What the operators of this subpackage share: scratch tables, Arrow batches, sorted streams, components."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Scratch:
    """Tables in the folder that the cluster shares (spark.checkpoint.dir), for cutting lineage.

    A table written here survives the loss of executors. drop() frees one that is no longer read; whatever is left
    goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            base = tempfile.mkdtemp(prefix="spark-")  # one machine, as in tests
        self.root = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.tables: list[str] = []
        atexit.register(self.clear)

    def save(self, df: DataFrame, name: str, by: str | None = None, schema: str | None = None, small: bool = False) -> DataFrame:
        """Writes df and reads it back; schema serves where a partitioned table may hold no file.

        Shuffle files of the jobs before it can then go, which isn't awaited if small.
        """
        path = f"{self.root}/{name}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(path)
        if not small:
            free(self.spark)
        return (self.spark.read.schema(schema) if schema else self.spark.read).parquet(path)

    def save_by(self, df: DataFrame, key: str) -> DataFrame:
        """Writes df dealt and sorted by a key: joins on it read the table where it lies, and shuffle the other side only."""
        self.tables.append(f"scratch_{uuid.uuid4().hex}")
        df.write.option("path", f"{self.root}/{self.tables[-1]}").bucketBy(partitions(self.spark), key).sortBy(key).saveAsTable(self.tables[-1])
        free(self.spark)
        return self.spark.table(self.tables[-1])

    def drop_dealt(self) -> None:
        """Frees all tables that save_by() wrote."""
        for table in self.tables:
            self.spark.sql(f"drop table if exists {table}")
            self.drop(table)
        self.tables.clear()

    def drop(self, name: str = "") -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def clear(self) -> None:
        try:
            for table in self.tables:
                self.spark.sql(f"drop table if exists {table}")
            self.drop()
        except Exception:  # noqa: BLE001  the session may have ended before
            pass


_kept: dict[str, dict] = {}


def worker_cache(name: str) -> dict:
    """What a Python worker keeps between the tasks of one operator; what it kept for another one goes."""
    if others := [k for k in _kept if k != name]:
        for other in others:
            _kept.pop(other).clear()
        give_back()
    return _kept.setdefault(name, {})


def give_back() -> None:
    """Hands memory that Python, numpy and Arrow hold for later back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def trimmed(function: Callable) -> Callable:
    """A function for mapInArrow(); when a task ends, its worker, which waits for another one, gives free memory back."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return task


def free(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove shuffle files that nothing refers to any more."""
    for _ in range(2):  # what the first pass finds unused holds on to the rest until the second
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.4)  # the cleaner works beside


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that the strings of a column hold about most_bytes; one long text stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0))
        groups = (np.cumsum(sizes) - sizes) // most_bytes
        edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def text_of(column: str) -> Column:
    """A column's text as the operators take it: bytes that aren't UTF-8 become U+FFFD."""
    return F.make_valid_utf8(F.col(column).cast("string"))


def strings(column: pa.Array) -> list[str | None]:
    """The same for a column of a batch whose rows go on as they are."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if b is None else b.decode("utf-8", "replace") for b in column.cast(pa.binary()).to_pylist()]


def table_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def runs(columns: list[np.ndarray]) -> np.ndarray:
    """Starts of the runs of rows that are equal in all the columns."""
    n = len(columns[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str], most: int = 200_000) -> Iterator[pa.Table]:
    """From rows sorted by keys: tables of whole key groups, several small groups to a table.

    Only for groups whose size is bounded by what comes before; a group is held whole.
    """
    held: list[pa.RecordBatch] = []
    rows = 0

    def cut(final: bool):
        nonlocal held, rows
        table = pa.Table.from_batches(held).combine_chunks()
        if final:
            held, rows = [], 0
            return table
        starts = runs([table.column(k).to_numpy() for k in keys])
        last = int(starts[-1])
        if last == 0:
            return None
        held, rows = table.slice(last).combine_chunks().to_batches(), table.num_rows - last
        return table.slice(0, last)

    grown = most
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= grown:
            table = cut(False)
            grown = most if table is not None else 2 * rows
            if table is not None:
                yield table
    if rows:
        yield cut(True)


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components: (node, component), component being the smallest node reachable.

    Alternating large-star and small-star passes; each pass is a grouping and a join, written to the shared
    folder, until the edges no longer change. Stars shrink the longest path by half a pass, so the number of
    passes follows its logarithm. Nodes without edges are not returned.
    """
    i = 0
    now = scratch.save(_oriented(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))), "cc-0", small=True)
    before = None
    while True:
        # large star: every larger neighbour of a node is linked to the smallest neighbour
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = _oriented(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        # small star: a node and its smaller neighbours are linked to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = _oriented(small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))))
        i += 1
        now = scratch.save(small, f"cc-{i}", small=True)
        print_ = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if i > 1:
            scratch.drop(f"cc-{i - 1}")
        if tuple(print_) == before:
            break
        before = tuple(print_)
    scratch.drop("cc-0")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def fold(id_col: str, m: int):
    """crc32 of the id as text, modulo m."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % m
