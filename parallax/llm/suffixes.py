"""Removal of repeated byte strings: depth-limited ordering of suffixes by most significant digits."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import Scratch, partitions, slices, table_of, trimmed

DIGIT = 32  # bytes of the first digit
UNIT = 4 << 20  # bytes of a long text that are treated at once; units overlap by a window
HELD = 1_200_000  # anchors that a task resolves among themselves before it sends them
_rng = np.random.default_rng(20260802)
_byte = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_weights = _rng.integers(1, 2**32, (4096, 4)).astype(np.float64)

ANCHORS = "kind int, digit long, context long, doc_id long, text_hi long, text_lo long, place long, bands long"
SPANS = "kind int, doc_id long, text_hi long, text_lo long, span long, band long"
_anchor_schema = pa.schema([("kind", pa.int32()), ("digit", pa.int64()), ("context", pa.int64()), ("doc_id", pa.int64()), ("text_hi", pa.int64()), ("text_lo", pa.int64()), ("place", pa.int64()), ("bands", pa.int64())])
_span_schema = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("text_hi", pa.int64()), ("text_lo", pa.int64()), ("span", pa.int64()), ("band", pa.int64())])
_window_schema = pa.schema([("kind", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64()), ("doc_id", pa.int64()), ("text_hi", pa.int64()), ("text_lo", pa.int64()), ("place", pa.int64())])
BANDS = 4  # parts of an anchor's windows, by how far they reach to its left
OUT, OPEN = 0, 1  # kinds: a span to remove; something that later passes decide
DOC = ("doc_id", "text_hi", "text_lo")  # what tells documents apart
NO_ID = -(2**63)  # a null id comes before all others


def mixed(v: np.ndarray) -> np.ndarray:
    """64-bit keys from two exact sums of products of bytes with 32-bit weights."""
    u = v[:, 0].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + v[:, 1].astype(np.uint64)
    u ^= u >> np.uint64(29)
    u *= np.uint64(0xBF58476D1CE4E5B9)
    return u ^ u >> np.uint64(32)


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """The windows of depth bytes that lie in the units, by their anchors: (digit, context, bands, place, first, last).

    A window's anchor is the suffix in it whose first digit (a hash of DIGIT bytes) is least, the leftmost of equals: a
    choice that depends on the window's bytes alone, so equal windows have anchors at the same place in them. first
    and last are the first and last of the consecutive windows of an anchor. context is a hash of all bytes that any
    window around the anchor can hold, cut off at the unit's ends. bands are four 16-bit hashes: of the bytes that all
    windows of a band hold.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < depth:
        return none, none, none, none, none, none
    h = _byte[data]
    m = 1
    while m < DIGIT:
        h = h[:-m] * np.uint64(pow(_BASE, m, 1 << 64)) + h[m:]
        m *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(30)
    least = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
    width, m = depth - DIGIT + 1, 1
    while 2 * m <= width:
        least = np.minimum(least[:-m], least[m:])
        m *= 2
    if width > m:
        least = np.minimum(least[: m - width], least[width - m :])
    edge = np.zeros(n + 1, np.int8)
    full = ends - starts >= depth
    edge[starts[full]] += 1
    edge[ends[full] - depth + 1] -= 1
    valid = np.cumsum(edge[: len(least)], dtype=np.int8) > 0
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    first = np.flatnonzero(new)
    stop = np.zeros(len(least), bool)
    stop[:-1] = new[1:] | ~valid[1:]
    stop[-1] = True
    last = np.flatnonzero(stop & valid)
    place = (least[first] & np.uint64(0xFFFFFF)).astype(np.int64)
    side = depth - DIGIT
    size = depth + side
    padded = np.zeros(n + 2 * depth, np.uint16)
    padded[side : side + n] = data
    padded[side : side + n] += 1
    views = np.lib.stride_tricks.sliding_window_view(padded, size)
    unit = np.searchsorted(starts, place, "right") - 1
    lead, room = place - starts[unit], ends[unit] - place
    context = np.empty(len(place), np.uint64)
    bands = np.zeros(len(place), np.uint64)
    step = -(-side // BANDS)
    columns = np.arange(size)
    for lo in range(0, len(place), 4096):
        at = slice(lo, lo + 4096)
        bytes_ = views[place[at]]
        cut = np.flatnonzero((lead[at] < side) | (room[at] < depth))
        bytes_[cut] *= (columns >= side - lead[at][cut, None]) & (columns < side + room[at][cut, None])
        exact = bytes_.astype(np.float64)
        context[at] = mixed(exact @ _weights[:size, :2])
        for k in range(BANDS):  # reaches k to k + 1 steps to the left
            part = exact[:, side - k * step : size - (k + 1) * step]
            bands[at] |= mixed(part @ _weights[: part.shape[1], :2]) >> np.uint64(48) << np.uint64(16 * k)
    return h[place].view(np.int64), context.view(np.int64), bands.view(np.int64), place, first, last


def units_of(texts: list[bytes], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of units: (bytes, starts, ends, text of each unit, its offset in that text)."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def batch():
        data = np.frombuffer(b"".join(u[2] for u in held), np.uint8)
        lengths = np.array([len(u[2]) for u in held])
        ends = np.cumsum(lengths)
        return data, ends - lengths, ends, np.array([u[0] for u in held]), np.array([u[1] for u in held])

    for k, text in enumerate(texts):
        for lo in range(0, max(1, len(text) - depth + 1), UNIT):
            unit = text[lo : lo + UNIT + depth - 1]
            if len(unit) < depth:
                continue
            if held and size + len(unit) > UNIT // 2:
                yield batch()
                held, size = [], 0
            held.append((k, lo, unit))
            size += len(unit)
    if held:
        yield batch()


def joined(doc: np.ndarray, hi: np.ndarray, lo: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of the same document that touch become one."""
    order = np.lexsort((start, lo, hi, doc))
    doc, hi, lo, start, end = doc[order], hi[order], lo[order], start[order], end[order]
    new = np.ones(len(doc), bool)
    # windows have one length, so ends rise with starts
    new[1:] = (doc[1:] != doc[:-1]) | (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    return doc[first], hi[first], lo[first], start[first], end[np.append(first[1:], len(doc))[: len(first)] - 1] if len(first) else end


def repeats(columns: list[np.ndarray], before: tuple | None) -> np.ndarray:
    """Rows that equal the row before them in all columns; before is what the row before the first one held."""
    same = np.ones(len(columns[0]), bool)
    for c in columns:
        same[1:] &= c[1:] == c[:-1]
    if len(same):
        same[0] = before is not None and all(c[0] == b for c, b in zip(columns, before))
    return same


def repeated_spans(docs: DataFrame, scratch: Scratch, depth: int = 100) -> DataFrame:
    """(doc_id, text_hi, text_lo, spans): what is to be removed of each document that has any, as packed start and end.

    docs: doc_id (null: NO_ID), text_hi and text_lo (a 128-bit hash of the text), data (the text's bytes); rows equal in
    these are one document, whose suffixes count once wherever they meet. Suffixes are ordered only as deep as the threshold,
    most significant digit first. Pass 1 deals the anchors by their first digit; a digit that occurs once is dropped.
    Pass 2 orders those of one digit by all bytes within reach; every one but the first of equals has all its windows
    repeated. What is left are anchors that share the digit and not the rest, as at the ends of repeated passages; of
    these, only bands of windows that share all their common bytes with another's go on, and pass 3 orders their windows
    one by one. Each pass first settles what meets in a task and sends one of equals, so a
    passage that a third of the documents hold arrives once from each task.
    """
    n = partitions(docs.sparkSession)

    @trimmed
    def first_pass(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def flush():
            digit, context, bands, doc, hi, lo, place, first, last = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((place, lo, hi, doc, context, digit))
            order = order[~repeats([c[order] for c in (digit, context, doc, hi, lo, place)], None)]
            same = repeats([digit[order], context[order]], None)
            out, keep = order[same], order[~same]
            o = joined(doc[out], hi[out], lo[out], first[out], last[out] + depth)
            zero = np.zeros(len(o[0]), np.int64)
            yield table_of(_anchor_schema, kind=np.full(len(zero), OUT, np.int32), digit=o[0] ^ o[3], context=zero, doc_id=o[0], text_hi=o[1], text_lo=o[2], place=o[3] << 32 | o[4], bands=zero)
            packed = place[keep] << 24 | (place[keep] - first[keep]) << 12 | (place[keep] - last[keep])
            yield table_of(_anchor_schema, kind=np.full(len(keep), OPEN, np.int32), digit=digit[keep], context=context[keep], doc_id=doc[keep], text_hi=hi[keep], text_lo=lo[keep], place=packed, bands=bands[keep])

        for batch in slices(batches, "data"):
            own = [batch.column(c).to_numpy() for c in DOC]
            for data, starts, ends, text, offset in units_of(batch.column("data").to_pylist(), depth):
                digit, context, bands, place, first, last = anchors(data, starts, ends, depth)
                unit = np.searchsorted(starts, place, "right") - 1
                shift = offset[unit] - starts[unit]
                held.append((digit, context, bands, *(c[text[unit]] for c in own), place + shift, first + shift, last + shift))
                rows += len(place)
                if rows >= HELD:
                    yield from flush()
                    held, rows = [], 0
        if held:
            yield from flush()

    step = -(-(depth - DIGIT) // BANDS)

    def open_rows(digit, packed, doc, hi, lo, bands):
        """A row for each band in which an anchor has windows; band: the digit with what the band's windows share."""
        place = packed >> 24
        first, last = place - (packed >> 12 & 0xFFF), place - (packed & 0xFFF)
        rows = []
        for k in range(BANDS):
            begin, end = np.maximum(first, place - (k + 1) * step), np.minimum(last, place - k * step - (k > 0))
            has = np.flatnonzero(begin <= end)
            key = digit[has] * np.int64(BANDS) + k ^ (bands[has] >> 16 * k & 0xFFFF) << 40
            rows.append((doc[has], hi[has], lo[has], begin[has] << 32 | end[has], key))
        doc, hi, lo, span, key = (np.concatenate(c) for c in zip(*rows))
        return table_of(_span_schema, kind=np.full(len(doc), OPEN, np.int32), doc_id=doc, text_hi=hi, text_lo=lo, span=span, band=key)

    def out_rows(spans):
        doc, hi, lo, start, end = spans
        return table_of(_span_schema, kind=np.full(len(doc), OUT, np.int32), doc_id=doc, text_hi=hi, text_lo=lo, span=start << 32 | end, band=np.zeros(len(doc), np.int64))

    @trimmed
    def second_pass(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None  # digit, context and place of the last row
        waiting: tuple | None = None  # the first of a digit, while no second context of it has come
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            plain = batch.filter(pa.array(kind == OUT))
            if plain.num_rows:
                yield table_of(_span_schema, kind=plain.column("kind"), **{c: plain.column(c) for c in DOC}, span=plain.column("place"), band=np.zeros(plain.num_rows, np.int64))
            batch = batch.filter(pa.array(kind == OPEN))
            if not batch.num_rows:
                continue
            digit, context, doc, hi, lo, packed, bands = (batch.column(c).to_numpy() for c in ("digit", "context", *DOC, "place", "bands"))
            new_digit, new_context = ~repeats([digit], before), ~repeats([digit, context], before)
            again_same = repeats([digit, context, doc, hi, lo, packed], before)  # from an equal row
            before = tuple(c[-1] for c in (digit, context, doc, hi, lo, packed))
            heads = np.flatnonzero(new_context)
            again = ~new_digit[heads]  # a further context of the digit
            is_open = again.copy()
            is_open[:-1] |= again[1:]
            if len(heads):
                columns = (digit, packed, doc, hi, lo, bands)
                if waiting is not None and again[0]:
                    yield open_rows(*waiting)
                waiting = None if again[-1] else tuple(c[heads[-1] :][:1].copy() for c in columns)
                yield open_rows(*(c[heads[is_open]] for c in columns))
            out = ~new_context & ~again_same
            place = packed[out] >> 24
            first, last = place - (packed[out] >> 12 & 0xFFF), place - (packed[out] & 0xFFF)
            yield out_rows(joined(doc[out], hi[out], lo[out], first, last + depth))

    dealt = docs.mapInArrow(first_pass, ANCHORS).repartition(n, "digit").sortWithinPartitions("kind", "digit", "context", *DOC, "place")
    spans = scratch.save(dealt.mapInArrow(second_pass, SPANS), "spans")

    @trimmed
    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data", 2 << 20):
            rows = []
            for *own, data, ranges in zip(*(batch.column(c).to_pylist() for c in (*DOC, "data", "ranges"))):
                views = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), depth)
                at = np.concatenate([np.arange(r >> 32, (r & 0xFFFFFFFF) + 1) for r in sorted(ranges)])
                for lo in range(0, len(at), 8192):
                    v = views[at[lo : lo + 8192]].astype(np.float64) @ _weights[:depth]
                    p = at[lo : lo + 8192]
                    rows.append((mixed(v[:, :2]).view(np.int64), mixed(v[:, 2:]).view(np.int64), *(np.full(len(p), x) for x in own), p))
            if not rows:
                continue
            w1, w2, doc, hi, lo, place = (np.concatenate(c) for c in zip(*rows))
            order = np.lexsort((place, lo, hi, doc, w2, w1))
            w1, w2, doc, hi, lo, place = (c[order] for c in (w1, w2, doc, hi, lo, place))
            once = ~repeats([w1, w2, doc, hi, lo, place], None)
            kind = np.where(repeats([w1[once], w2[once]], None), OUT, OPEN).astype(np.int32)
            yield table_of(_window_schema, kind=kind, w1=w1[once], w2=w2[once], doc_id=doc[once], text_hi=hi[once], text_lo=lo[once], place=place[once])

    @trimmed
    def third_pass(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            w1, w2, doc, hi, lo, place, kind = (batch.column(c).to_numpy() for c in ("w1", "w2", *DOC, "place", "kind"))
            out = repeats([w1, w2], before) & ~repeats([w1, w2, doc, hi, lo, place], before) | (kind == OUT)
            before = tuple(c[-1] for c in (w1, w2, doc, hi, lo, place))
            yield out_rows(joined(doc[out], hi[out], lo[out], place[out], place[out] + depth))

    left = spans.where(F.col("kind") == OPEN)
    left = left.join(left.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band"), "band", "left_semi")
    ranges = left.groupBy(*DOC).agg(F.collect_list("span").alias("ranges"))

    opened = docs.join(ranges, list(DOC)).select(*DOC, "data", "ranges").mapInArrow(windows, "kind int, w1 long, w2 long, doc_id long, text_hi long, text_lo long, place long")
    opened = opened.repartition(n, "w1").sortWithinPartitions("w1", "w2", *DOC, "place")
    late = scratch.save(opened.mapInArrow(third_pass, SPANS), "late")
    return spans.where(F.col("kind") == OUT).union(late).groupBy(*DOC).agg(F.collect_list("span").alias("spans"))


def remove_repeats(docs: DataFrame, scratch: Scratch, depth: int = 100, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """Every document with what is left of its bytes: doc_id, n_bytes, n_removed, n_spans, spans, kept.

    kept is binary; as_text makes it a string, without parts of characters that a cut has left.

    A byte goes if a string of depth bytes that covers it also starts earlier: in a document of smaller id, or
    earlier in the same one. Strings are judged on the input; they may overlap, and never cross documents. A null text
    is empty. A null id is smaller than any other; rows of one id are ordered by the MD5 of their texts, and rows
    equal in both are one document, whose result each of them gets. An empty table gives no rows. Columns other than
    the two named are not read, but for those to carry along. Strings are compared by 64 and 128-bit hashes of all their bytes.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    half = lambda at: F.conv(F.substring(F.md5(text), at, 16), 16, -10).cast("long")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), half(1).alias("text_hi"), half(17).alias("text_lo"), text.alias("data"), *carry)
    spans = repeated_spans(rows.drop(*carry), scratch, depth)

    @trimmed
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data"):
            out = []
            for doc, data, packed in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "data", "spans"))):
                runs: list[list[int]] = []
                for s in sorted(packed or ()):
                    start, end = s >> 32, s & 0xFFFFFFFF
                    if runs and start <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], end)
                    else:
                        runs.append([start, end])
                edges = [0, *(x for r in runs for x in r), len(data)]
                kept = b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                out.append((None if doc == NO_ID else doc, len(data), len(data) - len(kept), len(runs), [{"start": a, "end": b} for a, b in runs], kept.decode("utf-8", "ignore") if as_text else kept))
            own = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            yield pa.RecordBatch.from_arrays([*own, *(batch.column(c) for c in carry)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept", *carry])

    schema = ", ".join(["doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>", f"kept {'string' if as_text else 'binary'}", *(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)])
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string() if as_text else pa.binary()]
    return rows.join(spans, list(DOC), "left").select("doc_id", "data", "spans", *carry).mapInArrow(cut, schema)
