"""Folds over sorted rows with a state of constant size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ROWS = 20_000  # of a batch that goes out


def folded(rows: DataFrame, key: list[str], order: list, step: Callable, schema: StructType) -> DataFrame:
    """Rows of a key meet in one task, which goes through them in order and holds one at a time.

    step(rows) gets an iterator over a key's rows (tuples) and yields tuples of the schema; rows it leaves are skipped.
    """
    names, arrow = [*key, *(c for c in rows.columns if c not in key)], to_arrow_schema(schema)
    at = [names.index(c) for c in key]

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def groups(found: Iterator[tuple]) -> Iterator[Iterator[tuple]]:
        row = next(found, None)
        while row is not None:
            now = [row[i] for i in at]

            def own():
                nonlocal row
                while row is not None and [row[i] for i in at] == now:
                    this, row = row, next(found, None)
                    yield this

            mine = own()
            yield mine
            for _ in mine:
                pass

    def out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for group in groups(each(batches)):
            for made in step(group):
                held.append(made)
                if len(held) == ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    return rows.select(*names).repartition(*key).sortWithinPartitions(*key, *order).mapInArrow(out, schema)
