"""Repair of conversations' turn structure: a Viterbi search that runs in parallel over chunks of one conversation.

A conversation is sound if its role initials are nothing, or `ua` once or more after at most one `s`. The cheapest edits
that make it so are a shortest path over four states; going backward, a row maps a vector of costs (what is still to be
paid from each state) to another one. That map commutes with adding a constant, and vectors that differ only by a
constant stay so: they are one class here, and there are few classes. A chunk begins with a speculative vector; fix-up
passes run a chunk again from the vector that its neighbour has arrived at, until the two runs meet in a class, from
where on they differ by a constant only. The constants of all chunks, put together, give the cost; the classes drive
the tracing, from every state a chunk can be entered in, of which a scan over the chunks picks one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from parallax.llm.common import Scratch, partitions, text_of, trimmed

DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5  # costs
ROLES = "sua"  # initials that can be kept, each with its number; any other initial has number 3
SOUND, CUT, TWICE, BLANK = 0, 4, 8, 12  # a row's fault; a row's code is this plus the number of its initial
BEGIN, S, U, A = range(4)  # states: nothing yet, after a system turn, after a user's, after an assistant's
KEPT = {(BEGIN, 0): S, (BEGIN, 1): U, (S, 1): U, (U, 2): A, (A, 1): U}
MADE = (U, U, A, U)  # the state after a turn that is inserted or gets another role
NAMES = {U: "user", A: "assistant"}
LEGAL = {(0, 1), (1, 2), (2, 1)}
CHUNK = 1024  # rows


def _closed(v: list[int]) -> tuple[int, ...]:
    """Costs when turns may be inserted first."""
    u, a = min(v[U], INSERT + v[A]), min(v[A], INSERT + v[U])
    return min(v[BEGIN], INSERT + u), min(v[S], INSERT + u), u, a


def _before(code: int, v: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a row, from those behind it."""
    if code >= TWICE:
        return tuple(DELETE + x for x in v)
    extra = TRUNCATED * (code >= CUT)
    keep = [v[KEPT[s, code & 3]] + extra if (s, code & 3) in KEPT else DELETE + v[s] for s in range(4)]
    return _closed([min(DELETE + v[s], keep[s], REROLE + extra + v[MADE[s]]) for s in range(4)])


def _letters(code: int, v: tuple[int, ...], s: int) -> tuple[str, int]:
    """The ASCII-least cheapest edits at a row in state s, and the state behind it."""
    whole, done, extra = _before(code, v), "", TRUNCATED * (code >= CUT)
    while True:
        if DELETE + v[s] == whole[s]:
            return done + "D", s
        if INSERT + whole[MADE[s]] == whole[s]:
            done, s = done + "I", MADE[s]
        elif (s, code & 3) in KEPT and extra + v[KEPT[s, code & 3]] == whole[s]:
            return done + "K", KEPT[s, code & 3]
        else:
            return done + "R", MADE[s]


def _tables():
    """Classes of cost vectors that can come up: for each class and code the class before the row and what is added, and
    for each state the edits and the next state."""
    classes = [_closed([0, 10**6, 10**6, 0]), (0, 0, 0, 0)]  # behind the last row; the speculative one
    number = {c: k for k, c in enumerate(classes)}
    to, added, acts = [], [], []
    for c in classes:  # grows
        steps = [_before(code, c) for code in range(16)]
        for v in steps:
            if (x := tuple(y - min(v) for y in v)) not in number:
                number[x] = len(classes)
                classes.append(x)
        to.append([number[tuple(y - min(v) for y in v)] for v in steps])
        added.append([min(v) for v in steps])
        acts.append([[_letters(code, c, s) for s in range(4)] for code in range(16)])
    return classes, to, added, acts


CLASSES, TO, ADDED, ACTS = _tables()
LAST, SPECULATIVE = 0, 1
AT_END = ("", "II", "I", "")  # what is inserted behind the last row


def first_run(codes: bytes, right: int) -> tuple[int, int]:
    """The class before a chunk, and what its rows add."""
    total = 0
    for code in reversed(codes):
        total += ADDED[right][code]
        right = TO[right][code]
    return right, total


def run_again(codes: bytes, old: int, new: int) -> tuple[int | None, int]:
    """The class before a chunk when it is entered in a new class, and the change of what is added; None where the runs
    meet, and the class stays."""
    change = 0
    for code in reversed(codes):
        if old == new:
            return None, change
        change += ADDED[new][code] - ADDED[old][code]
        old, new = TO[old][code], TO[new][code]
    return (None if old == new else new), change


def _behind(codes: bytes, right: int) -> list[int]:
    """The class behind each row."""
    out = []
    for code in reversed(codes):
        out.append(right)
        right = TO[right][code]
    return out[::-1]


def exits(codes: bytes, right: int) -> list[int]:
    """The state behind a chunk for each state before it; paths that meet go on as one."""
    now = [0, 1, 2, 3]
    for code, c in zip(codes, _behind(codes, right)):
        act = ACTS[c][code]
        now = [act[s][1] for s in now]
    return now


def trace(codes: bytes, right: int, s: int) -> tuple[str, int]:
    out = []
    for code, c in zip(codes, _behind(codes, right)):
        letters, s = ACTS[c][code][s]
        out.append(letters)
    return "".join(out), s


def illegal(codes: bytes, before: int | None) -> int:
    """Adjacent initials that can't follow each other; before: the number of the initial in front."""
    pairs = zip(codes, codes[1:])
    return sum((a & 3, b & 3) not in LEGAL for a, b in pairs) + (before is not None and (before, codes[0] & 3) not in LEGAL)


def digest_of(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, code of each row: its initial, and if it is blank or cut short."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    ink = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    fault = F.when(ink == "", BLANK).when(~F.substring(ink, -1, 1).isin(".", "!", "?"), CUT).otherwise(SOUND)
    return rows.select("conv_id", "turn", "role", digest_of(F.col("text")).alias("digest"), (role + fault).alias("code"))


def _plain(rows: DataFrame) -> DataFrame:
    """The four columns; null roles and texts become one space."""
    one = lambda c: F.coalesce(text_of(c), F.lit(" ")).alias(c)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), one("role"), one("text"))


def _each(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _out(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size; the texts and binaries in them count."""
    held: list[tuple] = []
    heavy = 0
    for row in rows:
        held.append(row)
        heavy += sum(len(x) for x in row if isinstance(x, (str, bytes)))
        if len(held) >= size or heavy >= most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, heavy = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _schema(conv: pa.DataType, **columns: pa.DataType) -> pa.Schema:
    return pa.schema([("conv_id", conv), *columns.items()])


def _ddl(schema: pa.Schema, kind: str) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary", pa.list_(pa.int32()): "array<int>"}
    return ", ".join([f"conv_id {kind}", *(f"{f.name} {names[f.type]}" for f in schema if f.name != "conv_id")])


class Repaired:
    """The cheapest repair of every conversation.

    rows: conv_id, turn, role, text; other columns are not read. A conversation's rows stand by turn (nulls first), rows
    of one turn by role and the MD5 of the text; rows equal in all of these can change places without a difference. A
    null role or text is one space; null conv_ids are one conversation. Empty tables give empty results. Texts may have
    any length; they are not held together, but for one row's.

    summary: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, for conversations with rows.
    turns(): the repaired rows.
    """

    def __init__(self, rows: DataFrame, scratch: Scratch, chunk: int = CHUNK):
        self.rows, self.scratch, self.chunk = _plain(rows), scratch, chunk
        self.n = partitions(rows.sparkSession)
        self.kind = rows.schema["conv_id"].dataType.simpleString()
        self.conv = to_arrow_type(rows.schema["conv_id"].dataType)
        self.chunks = self._traced(self._settled(self._cut()))

    def _cut(self) -> DataFrame:
        """Chunks of rows in order, each with its rows' codes: conv_id, seq, k, whether another one follows."""
        size = self.chunk
        schema = _schema(self.conv, seq=pa.int64(), head=pa.int32(), turn=pa.int64(), role=pa.string(), digest=pa.string(), codes=pa.binary(), n_turns=pa.int64(), least=pa.int64(), most=pa.int64())

        @trimmed
        def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """head: null for a chunk, else the place of a row that is the first of its role and text in its chunk. Such
            rows are told of chunks that may not be a conversation's only one."""
            base = TaskContext.get().partitionId() << 32

            def chunk_rows(conv, k, rows, alone):
                codes, seen, turns = bytearray(), {}, [r[0] for r in rows if r[0] is not None]
                for place, (_, role, digest, code) in enumerate(rows):
                    if code < BLANK and seen.setdefault((role, digest), place) != place:
                        code = code & 3 | TWICE
                    codes.append(code)
                turn, role, digest, _ = rows[0]
                yield conv, base | k, None, turn, role, digest, bytes(codes), len(set(turns)), turns[0] if turns else None, turns[-1] if turns else None
                if not alone:
                    for (role, digest), place in seen.items():
                        yield conv, base | k, place, None, role, digest, None, None, None, None

            def all_rows():
                conv, rows, k, first, whole = None, [], 0, True, True
                for now, *row in _each(batches):
                    if rows and (now != conv or len(rows) == size):
                        yield from chunk_rows(conv, k, rows, now != conv and whole and not first)
                        first, whole, rows, k = first and now == conv, now != conv, [], k + 1
                    conv = now
                    rows.append(row)
                if rows:
                    yield from chunk_rows(conv, k, rows, False)

            yield from _out(all_rows(), schema)

        order = ["conv_id", "turn", "role", "digest"]
        dealt = faults(self.rows).repartitionByRange(self.n, *order).sortWithinPartitions(*order)
        cut_rows = self.scratch.save(dealt.mapInArrow(cut, _ddl(schema, self.kind)), "cut")
        heads = cut_rows.where("head is not null").select("conv_id", "seq", F.col("head"), "role", "digest")
        first = heads.groupBy("conv_id", "role", "digest").agg(F.min("seq").alias("first"))
        same = F.col("h.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("h.role") == F.col("f.role")) & (F.col("h.digest") == F.col("f.digest"))
        late = heads.alias("h").join(first.alias("f"), same & (F.col("h.seq") > F.col("f.first"))).groupBy("h.seq").agg(F.collect_list("h.head").alias("late"))
        line = W.partitionBy("conv_id").orderBy("seq")
        last_code = F.conv(F.hex(F.substring("codes", -1, 1)), 16, 10).cast("int")
        numbered = cut_rows.where("head is null").withColumns({"k": F.row_number().over(line), "more": F.lead("seq").over(line).isNotNull().cast("int"), "ahead": F.lag(last_code.bitwiseAND(3)).over(line), "n_turns": F.col("n_turns") - F.coalesce((F.lag("most").over(line) == F.col("least")).cast("long"), F.lit(0))})
        return numbered.drop("head").join(late, "seq", "left")

    def _settled(self, cut: DataFrame) -> DataFrame:
        """Chunks with the class behind each of them (right), the class before it (left) and what it adds."""
        columns = {c: pa.int64() for c in ("seq", "turn", "n_turns", "least", "most", "blank", "twice", "short", "illegal", "added")} | {"role": pa.string(), "digest": pa.string(), "codes": pa.binary(), "k": pa.int32(), "more": pa.int32(), "right": pa.int32(), "left": pa.int32()}
        schema = _schema(self.conv, **columns)
        given = ["conv_id", "seq", "turn", "n_turns", "least", "most", "role", "digest", "codes", "k", "more", "ahead", "late"]

        @trimmed
        def speculated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def chunk(conv, seq, turn, n_turns, least, most, role, digest, codes, k, more, ahead, late):
                codes = bytearray(codes)
                for place in late or ():
                    codes[place] = codes[place] & 3 | TWICE
                kinds = [c & 12 for c in codes]
                right = SPECULATIVE if more else LAST
                left, added = first_run(codes, right)
                return conv, seq, turn, n_turns, least, most, kinds.count(BLANK), kinds.count(TWICE), kinds.count(CUT), illegal(codes, ahead), added, role, digest, bytes(codes), k, more, right, left

            yield from _out((chunk(*row) for row in _each(batches)), schema)

        @trimmed
        def fixed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Chunks of a group from its end to its start; a chunk hands its class on to the next one."""
            names = [f.name for f in schema]

            def all_rows():
                group, carried = None, None
                for row in _each(batches):
                    r = dict(zip([*names, "actual", "part"], row))
                    right = carried if group == (r["conv_id"], r["part"]) else r["actual"]
                    if right != r["right"]:
                        left, change = run_again(r["codes"], r["right"], right)
                        r |= {"right": right, "left": r["left"] if left is None else left, "added": r["added"] + change}
                    group, carried = (r["conv_id"], r["part"]), r["left"]
                    yield tuple(r[c] for c in names)

            yield from _out(all_rows(), schema)

        ddl = _ddl(schema, self.kind)
        now = self.scratch.save(cut.select(*given).mapInArrow(speculated, ddl), "pass-0", small=True)
        reach, number = 1, 0
        while True:
            seen = now.withColumn("actual", F.coalesce(F.lead("left").over(W.partitionBy("conv_id").orderBy("k")), F.lit(LAST)))
            if seen.where("actual <> right").isEmpty():
                return now
            reach, number = 16 * reach, number + 1  # so that the number of passes follows the logarithm of the chunks'
            part = F.floor((F.col("k") - 1) / reach)
            dealt = seen.withColumn("part", part).repartition(self.n, "conv_id", "part").sortWithinPartitions("conv_id", "part", F.desc("k"))
            now = self.scratch.save(dealt.mapInArrow(fixed, ddl), f"pass-{number}", small=True)
            self.scratch.drop(f"pass-{number - 1}")

    def _traced(self, settled: DataFrame) -> DataFrame:
        """Chunks with their edits: each chunk's exits for all entries, a scan that picks the entries, the edits."""

        @trimmed
        def ways(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            way = _schema(self_conv, k=pa.int32(), seq=pa.int64(), ways=pa.list_(pa.int32()))
            yield from _out(((conv, k, seq, exits(codes, right)) for conv, k, seq, codes, right in _each(batches)), way)

        @trimmed
        def entered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def scan():
                state = BEGIN
                for _, k, seq, to in _each(batches):
                    state = BEGIN if k == 1 else state
                    yield seq, state
                    state = to[state]

            yield from _out(scan(), pa.schema([("seq", pa.int64()), ("entry", pa.int32())]))

        names = ["seq", "k", "turn", "role", "digest", "n_turns", "least", "most", "blank", "twice", "short", "illegal", "added"]
        kinds = {"k": pa.int32(), "role": pa.string(), "digest": pa.string()}
        self_conv = self.conv
        schema = _schema(self.conv, **{c: kinds.get(c, pa.int64()) for c in names}, base=pa.int64(), audit=pa.string())

        @trimmed
        def traced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def chunk(conv, *row):
                *own, codes, right, left, more, entry = row
                audit, state = trace(codes, right, entry)
                return conv, *own, CLASSES[left][BEGIN] if own[1] == 1 else 0, audit + ("" if more else AT_END[state])

            yield from _out((chunk(*row) for row in _each(batches)), schema)

        met = settled.where("more = 1 or k > 1").select("conv_id", "k", "seq", "codes", "right").mapInArrow(ways, f"conv_id {self.kind}, k int, seq long, ways array<int>")
        entries = met.repartition(self.n, "conv_id").sortWithinPartitions("conv_id", "k").mapInArrow(entered, "seq long, entry int")
        full = settled.join(entries, "seq", "left").select("conv_id", *names, "codes", "right", "left", "more", F.coalesce("entry", F.lit(BEGIN)).alias("entry"))
        return self.scratch.save(full.mapInArrow(traced, _ddl(schema, self.kind)), "traced", small=True)

    @property
    def summary(self) -> DataFrame:
        gaps = F.coalesce(F.max("most") - F.min("least") + 1 - F.sum("n_turns"), F.lit(0))
        parts = F.array_sort(F.collect_list(F.struct("k", "audit")))
        count = {"blank": "blank", "duplicate": "twice", "truncated": "short", "illegal": "illegal"}
        return self.chunks.groupBy("conv_id").agg(gaps.alias("gaps"), *(F.sum(c).alias(name) for name, c in count.items()), (F.sum("added") + F.sum("base")).alias("cost"), F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"))

    def _in_order(self) -> DataFrame:
        """Rows and, ahead of each chunk's first row, its edits; a conversation's in one task, in order."""
        rows = self.rows.select("conv_id", "turn", "role", digest_of(F.col("text")).alias("digest"), F.lit(1).alias("tag"), F.lit(0).alias("k"), "text")
        edits = self.chunks.select("conv_id", "turn", "role", "digest", F.lit(0).alias("tag"), "k", F.col("audit").alias("text"))
        both = edits.union(rows).repartition(self.n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest", "tag", "k")
        return both.select("conv_id", "tag", "role", "text")

    def turns(self) -> DataFrame:
        """conv_id, place (from 1), role, text, edit (K, R or I) of the repaired conversations' rows."""
        schema = _schema(self.conv, place=pa.int64(), role=pa.string(), text=pa.string(), edit=pa.string())

        @trimmed
        def mended(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def numbered():
                last, place = object(), 0
                for conv, role, text, edit in _mended(_each(batches)):
                    place = place + 1 if conv == last else 1
                    last = conv
                    yield conv, place, role, text, edit

            yield from _out(numbered(), schema)

        return self._in_order().mapInArrow(mended, _ddl(schema, self.kind))

    def digests(self) -> DataFrame:
        """conv_id, repaired_sha256 of the repaired rows as `role:text` lines; conversations without any are left out.

        A hash of this kind is a chain, so a conversation's rows pass through one task, one after another.
        """
        schema = _schema(self.conv, repaired_sha256=pa.string())

        @trimmed
        def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def each():
                last, state = None, None
                for conv, role, text, _ in _mended(_each(batches)):
                    if state is None or conv != last:
                        if state is not None:
                            yield last, state.hexdigest()
                        last, state = conv, hashlib.sha256()
                    else:
                        state.update(b"\n")
                    state.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
                if state is not None:
                    yield last, state.hexdigest()

            yield from _out(each(), schema)

        return self._in_order().mapInArrow(hashed, _ddl(schema, self.kind))


def _mended(rows: Iterable[tuple]) -> Iterator[tuple]:
    """(conv, role, text, edit) of the repaired rows, from rows (tag 1) and edits (tag 0) in order."""
    conv, state, edits, at = object(), BEGIN, "", 0

    def inserted(conv):
        nonlocal state, at
        while at < len(edits) and edits[at] == "I":
            state, at = MADE[state], at + 1
            yield conv, NAMES[state], "", "I"

    for now, tag, role, text in rows:
        if now != conv:
            yield from inserted(conv)
            conv, state, edits, at = now, BEGIN, "", 0
        if tag == 0:
            edits, at = edits[at:] + text, 0
            continue
        yield from inserted(conv)
        edit, at = edits[at], at + 1
        if edit == "K":
            state = KEPT[state, ROLES.index(role[0])]
            yield conv, role, text, "K"
        elif edit == "R":
            state = MADE[state]
            yield conv, NAMES[state], text, "R"
    yield from inserted(conv)


def damage(rows: DataFrame) -> DataFrame:
    """Rows damaged by crc32(`conv_id:turn`) % 20: 0 drops a row, 1 empties its text, 2 takes its `.!?` out, 3 repeats
    it, 4 makes its role user. Nulls are one space."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")) % 20
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(one("text"), "[.!?]", "")).otherwise(one("text"))
    left = rows.select("conv_id", "turn", F.when(draw == 4, "user").otherwise(one("role")).alias("role"), text.alias("text"), draw.alias("draw")).where("draw <> 0")
    times = F.explode(F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return left.select("conv_id", "turn", "role", "text", times.alias("time")).drop("time")


def repair_damaged(rows: DataFrame, scratch: Scratch, chunk: int = CHUNK) -> DataFrame:
    """Every conversation of rows, damaged and repaired: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256. One without rows after the damage, or after the repair, has zeros, an empty audit and the
    hash of nothing where that applies."""
    done = Repaired(damage(rows), scratch, chunk)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    parts = rows.select("conv_id").distinct().unionByName(done.summary, True).unionByName(done.digests(), True)
    found = parts.groupBy("conv_id").agg(*(F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts), F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
    return found
