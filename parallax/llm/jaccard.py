"""Similarity join of documents by the Jaccard index of their word shingles, by T-occurrence search."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import Scratch, components, partitions, runs, slices, sorted_groups, table_of, text_of, trimmed, worker_cache

WORDS = 5
LONG = 16  # documents from which a shingle's list counts as long
MOST_LONG = 1 << 20  # of the longest lists are told to the tasks; the order of shingles may be any, so this drops nothing
NAMED = 16  # low bits of a shingle's hash that are left off where the length of its list is told
REMEMBERED = 100_000  # classes or pairs that a task remembers, so as not to send them twice
BLOCK = 256  # partners of one query to an index
LIST = 8192  # sets of a list that one task holds; a longer list is dealt in blocks of about half of it and more
PIECE = 1 << 20  # pairs of sets that a task looks at before it folds what they give
INDEX = 1 << 20  # shingles of the sets that one task indexes
QUERIES = 4096  # searches in one index by one task
ORDERS = 3  # in which each list's sets are compared with the next one, before the search
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BASE = 0x9E3779B97F4A7C15


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_byte = np.random.default_rng(20260804).integers(1, 2**63, 256, dtype=np.uint64)


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base from 0 on, and of its inverse."""
    kept = worker_cache("jaccard")
    if not kept or len(kept["powers"][0]) < n:
        size = max(n, 1 << 21)
        kept["powers"] = [np.cumprod(np.append(np.uint64(1), np.full(size - 1, np.uint64(x)))) for x in (_BASE, pow(_BASE, -1, 1 << 64))]
    return kept["powers"]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(31)
    x = x * _MIX
    return x ^ x >> np.uint64(29)


def sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' shingle sets: (shingles of all, sorted in each text; sizes; a 64-bit key of each set).

    Only A-Z are lower-cased; words are runs without ASCII white space. A text of fewer than five words has its whole
    sequence as one shingle, one without words none. Shingles are 64-bit hashes of all their words' bytes.
    """
    data = [(t or "").encode("utf-8", "surrogatepass").lower() + b"\n" for t in texts]
    lengths = np.array([len(d) for d in data], np.int64)
    b = np.frombuffer(b"".join(data), np.uint8)
    inside = ~_SPACE[b]
    starts = np.flatnonzero(inside & np.append(True, ~inside[:-1]))
    stops = np.flatnonzero(~inside & np.append(False, inside[:-1]))
    # a word's hash: the sum of its bytes' numbers times powers that rise along the buffer, brought back to power 0
    powers, inverse = _powers(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_byte[b] * powers[: len(b)], out=sums[1:])
    h = mix((sums[stops] - sums[starts]) * inverse[starts])
    edges = np.searchsorted(starts, np.append(0, np.cumsum(lengths)))
    whole = np.full(max(0, len(h) - WORDS + 1), np.uint64(WORDS))
    for j in range(WORDS):
        whole = whole * np.uint64(_BASE) + h[j : len(h) - WORDS + 1 + j] if len(whole) else whole
    whole = mix(whole)
    out, counts = [np.zeros(0, np.uint64)], []
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        n = hi - lo
        if n >= WORDS:
            s = np.sort(whole[lo : hi - WORDS + 1])
            s = s[np.append(True, s[1:] != s[:-1])]
        elif n:
            s = np.full(1, np.uint64(n))
            for j in range(lo, hi):
                s = s * np.uint64(_BASE) + h[j]
            s = mix(s)
        else:
            counts.append(0)
            continue
        out.append(s)
        counts.append(len(s))
    flat = np.concatenate(out)
    counts = np.array(counts, np.int64)
    keys = np.zeros(len(texts), np.uint64)
    full = counts > 0
    starts = np.cumsum(counts)[full] - counts[full]
    keys[full] = mix(np.add.reduceat(mix(flat * np.uint64(0xC2B2AE3D27D4EB4F)), starts) + counts[full].astype(np.uint64))
    return flat, counts, keys.view(np.int64)


def needed(a, b):
    """The least intersection of sets of sizes a and b whose Jaccard index is 0.75: 3 (a + b) / 7, rounded up."""
    return -(-3 * (a + b) // 7)


class Inverted:
    """Inverted lists over given sets: the sets that hold each shingle, in ascending order."""

    def __init__(self, sets_: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets_], np.int64)
        flat = np.concatenate(sets_)
        owner = np.repeat(np.arange(len(sets_), dtype=np.int32), self.sizes)
        order = np.lexsort((owner, flat))
        self.owner = owner[order]
        self.names, self.starts = np.unique(flat[order], return_index=True)
        self.starts = np.append(self.starts, len(flat))

    def search(self, query: np.ndarray) -> np.ndarray:
        """The sets whose Jaccard index with the query is 0.75 or more, by T-occurrence.

        DivideSkip: the lists of the query's shingles are divided by length. The short ones are merged by a heap; a set
        met in too few of them to reach its number with all the long ones is out. For the rest, the long lists are
        probed by binary search.
        """
        m = len(query)
        least = needed(m, self.sizes)
        fits = (4 * self.sizes >= 3 * m) & (3 * self.sizes <= 4 * m)
        at = np.searchsorted(self.names, query)
        at = at[(at < len(self.names)) & (self.names[np.minimum(at, len(self.names) - 1)] == query)]
        lengths = self.starts[at + 1] - self.starts[at]
        if not fits.any() or len(at) < (t := max(1, int(least[fits].min()))):
            return np.zeros(0, np.int64)
        n_long = min(len(at), int(t / (0.0085 * math.log2(max(2, lengths.max())) + 1)), t - 1)
        by_length = at[np.argsort(lengths, kind="stable")]
        lists = [self.owner[self.starts[k] : self.starts[k + 1]] for k in by_length]
        short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
        met = np.zeros(len(self.sizes), np.int64)
        for i in heapq.merge(*(x.tolist() for x in short)):
            met[i] += 1
        candidates = np.flatnonzero(fits & (met > 0) & (met + n_long >= least))
        for one in long:
            if not len(candidates):
                break
            at = np.searchsorted(one, candidates)
            met[candidates] += one[np.minimum(at, len(one) - 1)] == candidates
        return candidates[met[candidates] >= least[candidates]]


def _first_of_task(keys: np.ndarray, counts: np.ndarray, seen: set) -> list[int]:
    """Places of the non-empty sets that the task hasn't met before."""
    if len(seen) > REMEMBERED:
        seen.clear()
    new = []
    for k, (key, n) in enumerate(zip(keys.tolist(), counts.tolist())):
        if n and key not in seen:
            seen.add(key)
            new.append(k)
    return new


def linked(rows: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the components of set keys that link by a Jaccard index of 0.75 or more.

    rows: doc_id, text. members: doc_id, key, n_shingles, text_hash. A pair that links shares a shingle among the first
    of each set in an order common to all, 1/4 of the larger and 1/7 of the smaller set. The order puts shingles with
    long lists last. Each set's first shingles are dealt by shingle, which gives the inverted lists; sets without a
    possible partner in any list are left out, and the others' whole sets are written once.

    First each list's sets are put in an order common to all lists and compared with the next one, so that most of a
    group of near copies meets in few pairs; what links becomes a component. The next order leaves out what is of one
    component already. At last _search() looks up what is left: sets of different components that can reach the needed
    number by their sizes and places in a list. Pairs aren't sent for that, but each set once to each index in which
    it has such a partner, so a large group is searched without listing its pairs, and no link is lost.
    """
    spark = rows.sparkSession
    n = partitions(spark)
    held = spark.sparkContext.broadcast(_long_lists(rows, n, scratch))

    @trimmed
    def prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in slices(batches, "text", 1 << 20):
            flat, counts, keys = sets(batch.column("text").to_pylist())
            ends = np.cumsum(counts)
            known, parts = held.value
            is_long = np.zeros(len(flat), bool)
            blocks = np.zeros(len(flat), np.int32)
            if len(known) and len(flat):
                at = np.minimum(np.searchsorted(known, flat >> np.uint64(NAMED)), len(known) - 1)
                is_long = known[at] == flat >> np.uint64(NAMED)
                blocks[is_long] = parts[at[is_long]]
            token, key, size, pos, block = [], [], [], [], []
            for k in _first_of_task(keys, counts, seen):
                m = int(counts[k])
                own, late = flat[ends[k] - m : ends[k]], is_long[ends[k] - m : ends[k]]
                p = m - -(-3 * m // 4) + 1
                order = np.argsort(late, kind="stable")[:p] if late.any() else np.arange(p)
                token.append(own[order])
                n_blocks = blocks[ends[k] - m : ends[k]][order]
                # the number of blocks, and which of them, in one number; 0 for a list in one piece
                block.append(np.where(n_blocks > 1, n_blocks << 16 | int(mix(keys[k : k + 1].view(np.uint64))[0] >> np.uint64(34)) % np.maximum(n_blocks, 1), 0).astype(np.int32))
                key.append(np.full(p, keys[k]))
                size.append(np.full(p, m, np.int32))
                pos.append(np.arange(p, dtype=np.int32))
            if token:
                yield table_of(_posting, token=np.concatenate(token).view(np.int64), key=np.concatenate(key), size=np.concatenate(size), pos=np.concatenate(pos), block=np.concatenate(block))

    @trimmed
    def shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The postings of sets that may link with another one of the list; all of those that are dealt in blocks."""
        for t in sorted_groups(batches, ["token", "block"]):
            at, keep = _may_link(*(t.column(c).to_numpy() for c in ("token", "block", "key", "size", "pos")))
            yield from t.take(pa.array(at[keep])).to_batches()

    dealt = rows.select("text").mapInArrow(prefixes, POSTING).repartition(n, "token", "block").sortWithinPartitions("token", "block", "size", "key")
    lists = scratch.save(dealt.mapInArrow(shared, POSTING), "lists")
    held_sets = scratch.save_by(_sets(rows, members, lists), "key")
    found = spark.createDataFrame([], "node long, component long")
    tested = spark.createDataFrame([], "a long, b long")
    for k in range(ORDERS):
        pairs = scratch.save(_next_ones(lists, found, k).join(tested, ["a", "b"], "left_anti"), f"pairs-{k}", small=True)
        links = scratch.save(_verified(held_sets, pairs), f"links-{k}", small=True)
        found = scratch.save(_composed(found, components(_between(links, found), scratch)), f"found-{k}")
        tested = tested.union(pairs)
    late = scratch.save(_search(lists, held_sets, found, scratch), "late")
    scratch.drop_dealt()
    return _composed(found, components(_between(late, found), scratch))


def _may_link(token: np.ndarray, block: np.ndarray, key: np.ndarray, size: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the distinct postings of whole lists, and which of them may link with another one of their list.

    The lists come one after another, by size in each. All small ones are looked at together, so that the calls follow
    the longest of these and not their number.
    """
    at = runs([token, block, key])
    token, block, size, pos = token[at], block[at], size[at], pos[at]
    starts = runs([token, block])
    length = np.diff(np.append(starts, len(at)))
    stops = np.repeat(starts + length, length)
    length = np.repeat(length, length)
    keep = block > 0
    # in a long list some set of a fitting size is near in the order of sizes
    i = np.flatnonzero((length > 64) & ~keep)
    i = i[i + 1 < stops[i]]
    i = i[4 * size[i] >= 3 * size[i + 1]]
    keep[i] = keep[i + 1] = True
    for i, j in _apart(np.flatnonzero((length > 1) & (length <= 64) & (block == 0)), stops, size):
        new = ~(keep[i] & keep[j])
        i, j = i[new], j[new]
        ok = _can(size[i], pos[i], size[j], pos[j])
        keep[i[ok]] = keep[j[ok]] = True
    return at, keep


def _apart(i: np.ndarray, stops: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of rows of one group that fit by their sizes, which ascend: all that lie one row apart, then two..."""
    step = 1
    while len(i := i[i + step < stops[i]]):
        i = i[4 * size[i] >= 3 * size[i + step]]
        yield i, i + step
        step += 1


def _placed(lists: DataFrame, found: DataFrame) -> DataFrame:
    """The postings with their sets' components; a set in none is its own."""
    return lists.join(found.select(F.col("node").alias("key"), "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))


def _next_ones(lists: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Distinct pairs (a, b) of sets that stand next to each other in a list, in the k-th of the common orders.

    The first is by size. A list in blocks is dealt anew each time into as many parts. Rows pass a task in order, and
    none is held but the last.
    """

    @trimmed
    def neighbours(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        seen: set = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if last is None else [last, batch])
            last = batch.slice(batch.num_rows - 1)
            token, part, key, size, pos, component = (table.column(c).to_numpy() for c in ("token", "part", "key", "size", "pos", "component"))
            ok = (token[1:] == token[:-1]) & (part[1:] == part[:-1]) & (component[1:] != component[:-1])
            i = np.flatnonzero(ok)
            i = i[_can(size[i], pos[i], size[i + 1], pos[i + 1])]
            pairs = set(zip(np.minimum(key[i], key[i + 1]).tolist(), np.maximum(key[i], key[i + 1]).tolist())) - seen
            if len(seen) > REMEMBERED:
                seen.clear()
            seen |= pairs
            if pairs:
                a, b = zip(*pairs)
                yield table_of(_pair, a=a, b=b)

    part = F.when(F.col("block") > 0, F.pmod(F.xxhash64("token", "key", F.lit(k)), F.shiftright("block", 16)).cast("int")).otherwise(0)
    place = F.col("size").cast("long") if k == 0 else F.xxhash64("key", F.lit(k))
    dealt = _placed(lists, found).select("token", part.alias("part"), place.alias("place"), "key", "size", "pos", "component")
    dealt = dealt.repartition(partitions(lists.sparkSession), "token", "part").sortWithinPartitions("token", "part", "place", "key")
    return dealt.mapInArrow(neighbours, "a long, b long").distinct()


def _search(lists: DataFrame, held_sets: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): the links between sets of different components that share a list.

    The sets are dealt into indexes of about INDEX shingles, a component to one as long as it fits; of two components
    the one with fewer sets asks. A list says which sets ask which indexes, and which sets these need to hold.
    """
    spark = lists.sparkSession
    n = partitions(spark)
    sets_ = held_sets.select("key", "size").join(found.select(F.col("node").alias("key"), "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    of = sets_.groupBy("component").agg(F.count("*").alias("members"), F.sum("size").alias("shingles"))
    few = 1 + int(of.where(f"shingles <= {INDEX}").agg(F.coalesce(F.sum("shingles"), F.lit(0))).first()[0]) // INDEX
    parts = F.ceil(F.col("shingles") / INDEX)
    index = F.when(F.col("shingles") <= INDEX, F.pmod(F.xxhash64("component"), F.lit(few))).otherwise(F.xxhash64("component", F.pmod(F.xxhash64("key"), parts)))
    placed = scratch.save(sets_.join(of, "component").select("key", "component", "members", index.alias("home")), "homes", small=True)

    @trimmed
    def asks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for t in sorted_groups(batches, ["token", "low", "high"]):
            token, low, high, block, key, size, pos, component, members, home = (t.column(c).to_numpy() for c in ("token", "low", "high", "block", "key", "size", "pos", "component", "members", "home"))
            starts = np.append(runs([token, low, high]), len(token))
            changed = np.append(0, np.cumsum(component[1:] != component[:-1]))
            rows: list[np.ndarray] = []

            def fold():
                both = _distinct(np.concatenate(rows, 1))
                rows.clear()
                fresh = [r for r in zip(*both.tolist()) if r not in seen]
                if len(seen) > REMEMBERED:
                    seen.clear()
                seen.update(fresh)
                if fresh:
                    index, asks_, name = zip(*fresh)
                    yield table_of(_asked, home=index, asks=asks_, key=name)

            waiting = 0
            apart = low != high  # then pairs within a block are another group's
            length = np.diff(starts)
            several = changed[starts[1:] - 1] != changed[starts[:-1]]
            small = np.flatnonzero(np.repeat(several & (length <= 256), length))
            large = (np.array(p) + lo for lo, hi in zip(starts[:-1][several & (length > 256)], starts[1:][several & (length > 256)]) for p in _pairs_of(size[lo:hi], pos[lo:hi]))
            for i, j in chain(_apart(small, np.repeat(starts[1:], length), size), large):
                other = (component[i] != component[j]) & (~apart[i] | (block[i] != block[j]))
                i, j = i[other], j[other]
                ok = _can(size[i], pos[i], size[j], pos[j])
                i, j = i[ok], j[ok]
                if len(i):
                    turn = (members[i] > members[j]) | ((members[i] == members[j]) & (component[i] > component[j]))
                    i, j = np.where(turn, j, i), np.where(turn, i, j)  # i asks where j is
                    ask = _distinct(np.stack([home[j], np.ones(len(i), np.int64), key[i]]))
                    told = _distinct(np.stack([home[j], np.zeros(len(i), np.int64), key[j]]))
                    rows += [ask, told]
                    waiting += ask.shape[1] + told.shape[1]
                    if waiting > PIECE:
                        yield from fold()
                        waiting = 0
            if rows:
                yield from fold()

    postings = lists.join(placed, "key").select("token", "key", "size", "pos", "block", "component", "members", "home")
    count, own = F.shiftright("block", 16), F.col("block").bitwiseAND(65535)
    # a list in blocks is of use only if it holds two components, and a set that may be a pair's smaller one
    of_use = postings.where("block > 0").groupBy("token").agg((F.min("component") < F.max("component")).alias("two"), F.min(F.expr("pos + int(ceil(6 * size / 7.0)) - size")).alias("first")).where("two and first < 1").select("token")
    split = postings.where("block > 0").join(of_use, "token", "left_semi").withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
    split = split.withColumns({"low": F.least(own, "other"), "high": F.greatest(own, "other")}).drop("other")
    dealt = postings.where("block = 0").withColumns({"low": F.lit(0), "high": F.lit(0)}).unionByName(split)
    dealt = dealt.repartition(n, "token", "low", "high").sortWithinPartitions("token", "low", "high", "size", "key")
    asked = scratch.save(dealt.mapInArrow(asks, "home long, asks long, key long").distinct(), "asked")
    scratch.drop("lists")

    # many searches in one index go to several tasks, each of which builds it
    busy = asked.where("asks = 1").groupBy("home").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("tasks"))
    told = asked.join(busy, "home").withColumn("task", F.when(F.col("asks") == 1, F.array(F.pmod(F.xxhash64("key"), F.col("tasks")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("tasks") - 1)))
    told = told.select("home", F.explode("task").alias("task"), "asks", "key").join(held_sets.select("key", "tokens"), "key")

    @trimmed
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, names, held, index = None, [], [], None
        for batch in slices(batches, "tokens", 4 << 20):
            a: list[int] = []
            b: list[int] = []
            for home, task, asks_, key, tokens in zip(*(batch.column(c).to_pylist() for c in ("home", "task", "asks", "key", "tokens"))):
                if at != (home, task):
                    at, names, held, index = (home, task), [], [], None
                if asks_ == 0:
                    names.append(key)
                    held.append(np.frombuffer(tokens, np.uint64))
                elif names:
                    index = index or Inverted(held)
                    hits = [names[k] for k in index.search(np.frombuffer(tokens, np.uint64)).tolist()]
                    a += [key] * len(hits)
                    b += hits
            if a:
                yield table_of(_pair, a=a, b=b)

    return told.repartition(n, "home", "task").sortWithinPartitions("home", "task", "asks").mapInArrow(find, "a long, b long").where("a <> b")


def _distinct(columns: np.ndarray) -> np.ndarray:
    """The distinct columns of a matrix, sorted."""
    columns = columns[:, np.lexsort(columns)]
    return columns[:, runs(list(columns))]


def _pairs_of(size: np.ndarray, pos: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all sets of a large group that may link by their sizes, which ascend, and by the smaller one's place."""
    leads = pos < size - -(-6 * size // 7) + 1
    for i in np.flatnonzero(leads).tolist():
        # of one size, a set that leads meets those before it that don't
        same = np.arange(np.searchsorted(size, size[i], "left"), i)
        j = np.append(same[~leads[same]], np.arange(i + 1, np.searchsorted(size, 4 * size[i] // 3, "right")))
        yield np.full(len(j), i), j


def _sets(rows: DataFrame, members: DataFrame, lists: DataFrame) -> DataFrame:
    """(key, size, tokens) of every set in a list, taken from one document that has it, whatever its id."""
    wanted = lists.select("key").distinct()
    one = members.where("n_shingles > 0").groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one"))
    holders = wanted.join(one, "key").select("key", F.coalesce("one.doc_id", F.lit(0)).alias("_id"), F.col("one.text_hash").alias("_hash"))

    @trimmed
    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            flat, counts, keys = sets(batch.column("text").to_pylist())
            ends = np.cumsum(counts)
            keep = np.flatnonzero(keys == batch.column("key").to_numpy())
            yield table_of(_set, key=keys[keep], size=counts[keep], tokens=[flat[ends[k] - counts[k] : ends[k]].tobytes() for k in keep])

    texts = rows.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    # by a shuffle at every size, so that what is read and written grows in proportion
    return texts.join(holders.hint("merge"), ["_id", "_hash"]).select("key", "text").mapInArrow(fetch, "key long, size long, tokens binary").dropDuplicates(["key"])


def _verified(held_sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that do link. A query's set comes before those of its partners, which are indexed by blocks.

    The sets lie dealt by key, so that only keys are shuffled to find them, and sets that have a partner to meet it.
    """
    sets_ = held_sets.select("key", "tokens")
    of_b = pairs.join(sets_, pairs["b"] == sets_["key"]).select("a", F.lit(1).alias("role"), "b", "tokens")
    queries = pairs.select("a").distinct()
    of_a = queries.join(sets_, queries["a"] == sets_["key"]).select("a", F.lit(0).alias("role"), F.col("a").alias("b"), "tokens")

    @trimmed
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, at = None, None
        names: list[int] = []
        partners: list[np.ndarray] = []

        def block():
            if names:
                hits = Inverted(partners).search(query)
                yield table_of(_pair, a=[at] * len(hits), b=[names[k] for k in hits])
                names.clear()
                partners.clear()

        for batch in slices(batches, "tokens", 4 << 20):
            for a, role, b, tokens in zip(*(batch.column(c).to_pylist() for c in ("a", "role", "b", "tokens"))):
                if role == 0:
                    yield from block()
                    query, at = np.frombuffer(tokens, np.uint64), a
                else:
                    names.append(b)
                    partners.append(np.frombuffer(tokens, np.uint64))
                    if len(names) >= BLOCK:
                        yield from block()
        yield from block()

    n = partitions(pairs.sparkSession)
    return of_a.union(of_b).repartition(n, "a").sortWithinPartitions("a", "role").mapInArrow(search, "a long, b long")


def _between(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The distinct pairs of components that links join; a key in no component is its own."""
    of = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    named = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    a, b = F.coalesce("ca", "a"), F.coalesce("cb", "b")
    return named.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()


def _composed(found: DataFrame, over: DataFrame) -> DataFrame:
    """(node, component), where the components of found are joined as over has it."""
    names = over.select(F.col("node").alias("component"), F.col("component").alias("final"))
    own = found.join(names, "component", "left").select("node", F.coalesce("final", "component").alias("component"))
    return own.union(over.join(found.select("node"), "node", "left_anti").select("node", "component"))


def _can(size_a, pos_a, size_b, pos_b):
    """Whether sets that share the shingles at these places may link: by size, by place, and by the smaller's prefix."""
    small, large = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    least = needed(small, large)
    room = 1 + np.minimum(size_a - pos_a, size_b - pos_b) - 1
    small_pos = np.where(size_a < size_b, pos_a, np.where(size_b < size_a, pos_b, np.minimum(pos_a, pos_b)))
    return (4 * small >= 3 * large) & (room >= least) & (small_pos < small - -(-6 * small // 7) + 1)


def _planes(numbers: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second ones, and so on: small numbers compress well so."""
    return numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T.tobytes()


def _numbers(planes: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, len(planes) // width).T).view(kind).ravel()


def _long_lists(rows: DataFrame, n: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """The shingles with the longest lists, sorted, and into how many blocks each list goes (a power of two).

    At most MOST_LONG, which bounds what is broadcast.

    Tasks send sorted runs of shingles with their counts, one for each range of hashes, so a shingle arrives at most
    once from each run however many documents hold it.
    """

    @trimmed
    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        held: list[np.ndarray] = []
        size = 0

        def flush():
            names, times = np.unique(np.concatenate(held) >> np.uint64(NAMED), return_counts=True)
            width = (1 << 64 - NAMED) // n + 1
            edges = np.searchsorted(names, np.array([k * width for k in range(1, n)], np.uint64))
            parts = list(zip(np.split(names, edges), np.split(times.astype("<u4"), edges)))
            return table_of(_run, part=range(n), names=[_planes(np.diff(a, prepend=np.uint64(0))) for a, _ in parts], times=[_planes(b) for _, b in parts])

        for batch in slices(batches, "text", 1 << 20):
            flat, counts, keys = sets(batch.column("text").to_pylist())
            ends = np.cumsum(counts)
            for k in _first_of_task(keys, counts, seen):
                held.append(flat[ends[k] - counts[k] : ends[k]])
                size += counts[k]
            if size > 1_000_000:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    @trimmed
    def long(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["part"], most=64):
            names = np.concatenate([np.cumsum(_numbers(b, np.uint64)) for b in t.column("names").to_pylist()])
            times = np.concatenate([_numbers(b, np.dtype("<u4")) for b in t.column("times").to_pylist()])
            order = np.argsort(names, kind="stable")
            names, times = names[order], times[order].astype(np.int64)
            if len(names):
                starts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
                total = np.add.reduceat(times, starts)
                keep = total >= LONG
                yield pa.RecordBatch.from_arrays([pa.array(names[starts][keep].view(np.int64)), pa.array(total[keep])], names=["token", "docs"])

    lists = rows.select("text").mapInArrow(counted, "part int, names binary, times binary").repartition(n, "part").sortWithinPartitions("part").mapInArrow(long, "token long, docs long")
    longest = lists.orderBy(F.desc("docs"), "token").limit(MOST_LONG).select("token", F.least("docs", F.lit((1 << 31) - 1)).cast("int").alias("docs"))
    found = np.array([tuple(r) for r in longest.toLocalIterator()], np.dtype([("token", np.int64), ("docs", np.int32)]))
    names, docs = found["token"].view(np.uint64), found["docs"].astype(np.int64)
    order = np.argsort(names)
    parts = 1 << np.ceil(np.log2(np.maximum(1, docs / LIST))).astype(np.int32)
    return names[order], np.minimum(parts, 1 << 14)[order].astype(np.int32)


POSTING = "token long, key long, size int, pos int, block int"
_posting = pa.schema([("token", pa.int64()), ("key", pa.int64()), ("size", pa.int32()), ("pos", pa.int32()), ("block", pa.int32())])
_pair = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_asked = pa.schema([("home", pa.int64()), ("asks", pa.int64()), ("key", pa.int64())])
_run = pa.schema([("part", pa.int32()), ("names", pa.binary()), ("times", pa.binary())])
_set = pa.schema([("key", pa.int64()), ("size", pa.int64()), ("tokens", pa.binary())])


def join(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every document.

    Documents link when their sets of distinct 5-word shingles have a Jaccard index of 0.75 or more. component_id is
    the smallest doc_id reachable by links, the own one included. Null and wordless texts have no shingles and link
    with nothing; their component is themselves. A document without id links as any other; a null id is never the
    smallest where another is there. Documents of equal sets are one class and link whatever their ids, so repeated
    rows share a component. A very long text is one set. An empty table gives no rows; other columns are not read. Sets
    are compared by 64-bit keys, shingles by 64-bit hashes.
    """
    members, named = _named(docs, scratch, id_col, text_col)
    return members.join(named, "key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of linked documents, with all its columns: the one of least id, then of least text hash.

    Rows without words are in no group and stay, all of them. Of rows equal in id and text one stays; a row without id
    stays only where its whole group has none.
    """
    members, named = _named(docs, scratch, id_col, text_col)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    classes = members.where("key is not null").groupBy("key").agg(F.min(place).alias("one"))
    kept = classes.join(named, "key").groupBy("component").agg(F.min("one").alias("one"))
    kept = kept.select(F.coalesce("one.doc_id", F.lit(0)).alias("_id"), F.col("one.none").alias("_none"), F.col("one.text_hash").alias("_hash"))
    text = text_of(text_col)
    # only three short columns are shuffled with each text, and what is equal in all of them is one row
    known = docs.withColumns({"_id": F.coalesce(F.col(id_col).cast("long"), F.lit(0)), "_none": F.col(id_col).isNull(), "_hash": F.xxhash64(text)})
    has_words = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    chosen = known.where(has_words).join(kept, ["_id", "_none", "_hash"], "left_semi").dropDuplicates(["_id", "_none", "_hash"])
    return chosen.unionByName(known.where(~has_words)).drop("_id", "_none", "_hash")


def _named(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, key, n_shingles of every row; component and component_id of every key)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))

    @trimmed
    def of_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            _, counts, keys = sets(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, mask=counts == 0), pa.array(counts)], names=["doc_id", "text_hash", "key", "n_shingles"])

    hashed = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    members = scratch.save(hashed.mapInArrow(of_sets, "doc_id long, text_hash long, key long, n_shingles long"), "members")
    found = linked(rows, members, scratch)
    classes = members.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    placed = classes.join(found.withColumnRenamed("node", "key"), "key", "left").select("key", "least", F.coalesce("component", "key").alias("component"))
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    return members, scratch.save(placed.join(names, "component").select("key", "component", "component_id"), "named")
