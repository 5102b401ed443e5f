"""Cost-balanced packing of token ids into sequences."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import slices, table_of, text_of, trimmed
from parallax.llm.vocab import encoder

TEXT = 8 << 20  # bytes of text that a task encodes at once
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
ARROW = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])


def balance(rests: list[tuple[int, int, int]], capacity: int, linear: float, quadratic: float) -> list[list[tuple[int, int, int]]]:
    """Assigns pieces (document, start, length) to sequences; returns each sequence's pieces.

    A sequence's cost is the sum over its pieces of linear * length + quadratic * length^2. Pieces go in descending
    length, each to the sequence of lowest cost that has room; what exceeds the room is cut off and goes on as a piece
    of its own. The room of all sequences is exactly the number of tokens: full sequences, then for the tail
    sequences whose sizes are its powers of two. So nothing is padded.
    """
    total = sum(length for _, _, length in rests)
    room = [capacity] * (total // capacity)
    tail = total % capacity
    room += [1 << k for k in range(tail.bit_length() - 1, -1, -1) if tail >> k & 1]
    bins = [(0.0, i) for i in range(len(room))]
    waiting = [(-length, doc, start) for doc, start, length in rests]
    heapq.heapify(waiting)
    filled: list[list[tuple[int, int, int]]] = [[] for _ in room]
    while waiting:
        left, doc, start = heapq.heappop(waiting)
        cost, i = heapq.heappop(bins)
        take = min(-left, room[i])
        filled[i].append((doc, start, take))
        room[i] -= take
        if room[i]:
            heapq.heappush(bins, (cost + linear * take + quadratic * take * take, i))
        if take < -left:
            heapq.heappush(waiting, (left + take, doc, start + take))
    return filled


def withheld(rests: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int, int]]:
    """Takes from rests what exceeds whole sequences, shortest pieces first, one of them in part; returns that."""
    over = sum(length for _, _, length in rests) % capacity
    rests.sort(key=lambda r: (-r[2], r[0], r[1]))
    left = []
    while over:
        doc, start, length = rests.pop()
        take = min(over, length)
        left.append((doc, start + length - take, take))
        if take < length:
            rests.append((doc, start, length - take))
        over -= take
    return left


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1 / 2048,
    group_tokens: int = 1_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Packs every document's ids, with end_id appended, into sequences of at most capacity tokens.

    Each scan task packs its own documents, so there is no shuffle. Whole stretches of capacity tokens fill a sequence
    each; the rests are assigned by balance() in groups of about group_tokens. What doesn't fill a sequence goes on to
    the next group; only a task's last one ends in powers of two. Memory is bounded by one group, TEXT bytes and one
    document. Returns a row for each piece. A null or empty text is one piece that holds end_id alone; a very long one is
    cut into many sequences; a null id stays null; repeated ids are packed as separate documents; an empty table gives no rows; other columns
    are not read. A task that runs again deals the same rows in the same way.
    """
    @trimmed
    def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 40
        rests: list[tuple[int, int, int]] = []  # pieces that wait: place in held, start and length in the document
        held: list[tuple[int | None, int, int, np.ndarray]] = []  # document, its ids, start of what is held, that

        def flush(rows: list, final: bool) -> None:
            """Assigns the pieces that wait; those that don't fill a whole sequence wait on, unless no more come."""
            nonlocal sequence, rests, held
            left = [] if final else withheld(rests, capacity)
            for pieces in balance(rests, capacity, linear, quadratic):
                offset = 0
                for d, start, length in pieces:
                    doc, total, origin, ids = held[d]
                    rows.append((doc, start, length, zlib.crc32(ids[start - origin : start - origin + length]), total, sequence, offset))
                    offset += length
                sequence += 1
            rests = [(k, start, length) for k, (_, start, length) in enumerate(left)]
            held = [held[d] for d, _, _ in left]

        tokens = 0
        for batch in slices(batches, "text", TEXT):
            flat, edges = encoder(vocabulary, True).encode(batch.column("text"), end_id)
            flat, edges = flat.astype("<u4", copy=False), edges.tolist()
            rows: list[tuple] = []
            for doc, lo, hi in zip(batch.column("id").to_pylist(), edges, edges[1:]):
                n = hi - lo
                for start in range(0, n - capacity + 1, capacity):
                    rows.append((doc, start, capacity, zlib.crc32(flat[lo + start : lo + start + capacity]), n, sequence, 0))
                    sequence += 1
                rest = n % capacity
                if rest:
                    rests.append((len(held), n - rest, rest))
                    held.append((doc, n, n - rest, flat[hi - rest : hi].copy()))
                    tokens += rest
                    if tokens >= group_tokens:
                        flush(rows, False)
                        tokens = sum(length for _, _, length in rests)
            if rows:
                yield table_of(ARROW, **dict(zip(ARROW.names, zip(*rows))))
        rows = []
        flush(rows, True)
        if rows:
            yield table_of(ARROW, **dict(zip(ARROW.names, zip(*rows))))

    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).mapInArrow(tasks, SCHEMA)
