"""Fingerprints that follow the edit distance: Order Min Hash, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parallax.llm.common import partitions, text_of

GRAM = 8  # code points
BINS = 64  # tuples of a fingerprint: 6 bits
PICKED = 2  # k-mers of a tuple
CLASS = 3  # bits of a k-mer's class: ranks of a lower class come first
PLACE = 29  # bits of a place in a text: a string holds fewer than 2^29 code points of 4 bytes
RANK = 63 - 6 - CLASS - PLACE
ENOUGH = 1024  # k-mers among which all bins mostly find theirs
NONE = "........"  # a bin without k-mers
NO_ID = -(2**63)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


AT = (1 << PLACE) - 1  # masks: of the place
KIND = ((1 << CLASS) - 1) << PLACE + RANK  # of the class
REST = (1 << 63) - 1 ^ AT ^ KIND  # of bin and rank


def k_mers(text: Column) -> Column:
    """The runs of GRAM code points, by place: 34 bits of a hash (bin, class and rank), then the place. A text that is
    shorter is one run, an empty one has none."""

    def of(points: Column) -> Column:
        last = F.greatest(F.length(points) - 4 * GRAM + 1, F.lit(1))
        places = F.when(F.length(points) > 0, F.sequence(F.lit(1), last, F.lit(4))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda p, i: F.shiftrightunsigned(F.xxhash64(F.substring(points, p, F.lit(4 * GRAM))), 1).bitwiseAND(KIND | REST).bitwiseOR(i.cast("long")))

    return let(F.encode(text, "UTF-32"), of)


def numbered(k_mers: Column) -> Column:
    """k-mers with the numbers of their occurrences, as bin, rank and place: a first one has those of its hash, any
    other those of a hash of this and the number, in its k-mer's class.

    Sorted by hash and place, equal k-mers stand together in text order; the numbers come from their places there.
    """

    def of(line: Column) -> Column:
        same = lambda x, i: F.shiftright(x.bitwiseXOR(F.get(line, i - 1)), PLACE) == 0
        firsts = F.filter(line, lambda x, i: (i == 0) | ~same(x, i))
        again = F.filter(F.sequence(F.lit(1), F.size(line) - 1), lambda i: same(F.get(line, i), i))

        def packed(i: Column, number: Column) -> Column:
            x = F.get(line, i)
            return F.shiftrightunsigned(F.xxhash64(F.shiftright(x, PLACE), number), 1).bitwiseAND(REST).bitwiseOR(x.bitwiseAND(KIND | AT))

        def of_again(again: Column) -> Column:
            starts = F.filter(F.sequence(F.lit(0), F.size(again) - 1), lambda j: (j == 0) | (F.get(again, j - 1) != F.get(again, j) - 1))
            end = lambda starts, r: F.coalesce(F.get(starts, r + 1), F.size(again)) - 1
            runs = lambda starts: F.flatten(F.transform(starts, lambda s, r: F.transform(F.sequence(s, end(starts, r)), lambda j: packed(F.get(again, j), j - s + 1))))
            return F.when(F.size(again) > 0, let(starts, runs)).otherwise(F.array().cast("array<bigint>"))

        return F.when(F.size(line) > 1, F.concat(firsts, let(again, of_again))).otherwise(line)

    return let(F.sort_array(k_mers), of)


def _bin(packed: Column) -> Column:
    return F.shiftright(packed, PLACE + RANK + CLASS)


def least(k_mers: Column) -> Column:
    """The PICKED least of each bin, in order of bin and rank.

    As k-mers of a lower class come first, a long text's are looked at only as far as the classes in which it has about
    ENOUGH; if a bin is short of them there, all are.
    """

    def first(sorted_: Column) -> Column:
        return F.filter(sorted_, lambda x, i: (i < PICKED) | (_bin(F.get(sorted_, i - PICKED)) != _bin(x)))

    of = lambda some: let(F.sort_array(numbered(some)), first)
    classes = F.ceil(F.lit(float(ENOUGH << CLASS)) / F.greatest(F.size(k_mers), F.lit(1)))
    low = lambda c: F.filter(k_mers, lambda x: F.shiftright(x.bitwiseAND(KIND), PLACE + RANK) < c)
    some = let(classes, lambda c: let(low(c), of))
    return F.when(classes >= 1 << CLASS, of(k_mers)).otherwise(let(some, lambda s: F.when(F.size(s) == BINS * PICKED, s).otherwise(of(k_mers))))


def signature(k_mers: Column) -> Column:
    """A value for each bin: the hash of its least k-mers, taken in the order in which they stand in the text."""
    place = lambda x: x.bitwiseAND(AT).cast("int")
    written = lambda h: F.lpad(F.lower(F.hex(h.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")

    def of(picked: Column) -> Column:
        def value(own: Column) -> Column:
            in_order = F.array_sort(F.transform(own, place))
            return let(in_order, lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda a, i: F.xxhash64(a, F.shiftright(F.get(k_mers, i), PLACE))))

        full = F.size(picked) == BINS * PICKED
        own = lambda b: F.when(full, F.slice(picked, b * PICKED + 1, PICKED)).otherwise(F.filter(picked, lambda x: _bin(x) == b))
        return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: let(own(b), lambda o: F.when(F.size(o) > 0, written(value(o))).otherwise(F.lit(NONE))))

    return let(least(k_mers), of)


def fingerprint(text: Column) -> Column:
    """The signature of a text as a string of 8 characters for each bin; a null text is empty."""
    return let(k_mers(F.coalesce(text.cast("string"), F.lit(""))), lambda k: F.array_join(signature(k), ""))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal ones among the bins that have k-mers in either of two fingerprints; 1 of two empty texts."""
    cut = lambda f: F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.substring(f, i * 8 + 1, F.lit(8)))
    both = F.arrays_zip(cut(a).alias("a"), cut(b).alias("b"))
    used = F.filter(both, lambda x: (x["a"] != NONE) | (x["b"] != NONE))
    return F.when(a == b, F.lit(1.0)).otherwise(let(used, lambda u: F.size(F.filter(u, lambda x: x["a"] == x["b"])).cast("double") / F.size(u)))


def _below(bounds: list[int], x: Column, equal: bool) -> Column:
    """How many of the sorted bounds are less than x (or equal): first by every n-th of them, then between two."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    under = (lambda b: b <= x) if equal else (lambda b: b < x)
    array = F.array(*map(F.lit, bounds))
    whole = F.size(F.filter(F.array(*map(F.lit, bounds[step - 1 :: step])), under))
    return let(whole, lambda w: w * step + F.size(F.filter(F.slice(array, w * step + 1, step), under)))


def with_next(docs: DataFrame, columns: dict[str, Callable[[], Column]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, columns, and next_text and next_<column> of the document that comes next by falling id.

    After the last comes the first. Null ids come last; rows of one id come by a hash of the text, and equal rows in
    any order. Documents are dealt by id to buckets of about equal numbers of rows; an id that fills several buckets is dealt
    over these by the hash. Each bucket gets a copy of the next one's first row, so only a bucket is sorted at once.
    """
    text = F.coalesce(text_of(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    number = F.coalesce("doc_id", F.lit(NO_ID))
    n = 4 * partitions(docs.sparkSession)
    found = rows.agg(F.percentile_approx(number, [i / n for i in range(1, n)], max(10_000, 20 * n))).first()[0] or []
    draw = F.shiftrightunsigned(F.xxhash64("text"), 1)
    low = _below(found, number, False)
    bucket = let(low, lambda lo: lo + F.least(_below(found, number, True) - lo, F.floor(draw / float(1 << 63) * (_below(found, number, True) - lo + 1)).cast("int")))
    keyed = rows.withColumns({"number": number, "draw": draw}).withColumn("bucket", bucket)
    tops = sorted(keyed.groupBy("bucket").agg(F.max(F.struct("number", "draw")).alias("top")).collect())  # a row a bucket
    behind = [(tops[(i + 1) % len(tops)]["bucket"], t["top"]["number"], t["top"]["draw"]) for i, t in enumerate(tops)]
    first = docs.sparkSession.createDataFrame(behind, "goes int, number long, draw long")
    copies = keyed.join(F.broadcast(first), ["number", "draw"]).groupBy("goes").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("number").alias("number"), F.first("draw").alias("draw"))
    own = keyed.select("bucket", F.lit(0).alias("copy"), "doc_id", "text", "number", "draw")
    dealt = own.union(copies.select("goes", F.lit(1), "doc_id", "text", "number", "draw")).repartition(partitions(docs.sparkSession), "bucket")
    order = ["copy", F.desc("number"), F.desc("draw")]
    dealt = dealt.sortWithinPartitions("bucket", *order).withColumns({c: make() for c, make in columns.items()})
    line = W.partitionBy("bucket").orderBy(*order)
    led = dealt.withColumns({f"next_{c}": F.lead(c).over(line) for c in ["text", *columns]})
    return led.where("copy = 0").select("doc_id", "text", *columns, "next_text", *(f"next_{c}" for c in columns))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    A k-mer (GRAM code points; a shorter text is one) with the number of its occurrence goes by its hash to one of BINS
    bins; the PICKED of least rank in each, taken in text order, make a value of the fingerprint. So it
    depends on the order as well as on the set of k-mers, and a share of equal values falls with the edit distance.

    The edited text ends, in place of its last third, with as much of the start of the next document's (see
    with_next). A null text is empty, and so is its fingerprint, of empty bins only. An empty table gives no rows; a
    table's only document comes next to itself. Equal ranks are ordered by place. Other columns are not read.
    """
    led = with_next(docs, {"fingerprint": lambda: fingerprint(F.col("text"))}, id_col, text_col)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = led.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third)))
    out = edited.select("doc_id", n.cast("long").alias("n_chars"), F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "fingerprint", fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_fingerprint")
    near = lambda a, b: likeness(F.col(a), F.col(b))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near("fingerprint", "edited_fingerprint").alias("near_edited"), near("fingerprint", "next_fingerprint").alias("near_next"))
