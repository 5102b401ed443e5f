"""Byte-level BPE by longest matches and backtracking, and its decoding."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import slices, text_of, trimmed, worker_cache

IRREGULAR = re.compile(r"\s \S?| \s")  # white space beside a space: such a text isn't cut at spaces
MOST_CACHED_CHARS = 8_000_000


class BytePairs:
    """Encodes by an automaton over the whole vocabulary instead of by merging.

    Bytes become Latin-1 characters for the automaton, which gives the longest token at every place of a pre-token.
    From the left, the longest token that may follow the one before it is taken; if no token may, the one before is
    given up for a shorter one. Places known to lead nowhere are not entered twice, so the work is linear. A sequence
    in which every adjacent pair of tokens is its own encoding is what the merges give; whether a pair is, is
    computed once and remembered.
    """

    def __init__(self, path: str, pattern: str):
        import ahocorasick
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (i, len(token)))
        self.automaton.make_automaton()
        self.find = regex.compile(pattern).findall
        self._fits: dict[tuple[int, int], bool] = {}
        self._shorter: dict[int, int] = {}
        self._spines: dict[int, tuple[list, list]] = {}
        self.pieces: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}
        self.chars = 0

    def shorter(self, token: int) -> int:
        """The longest other token that token begins with, or -1."""
        if token not in self._shorter:
            text = self.tokens[token]
            self._shorter[token] = next((self.ranks[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.ranks), -1)
        return self._shorter[token]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte."""
        parts = [self.ranks[bytes([b])] for b in self.tokens[token]]
        while len(parts) > 2:
            rank, i = min((self.ranks.get(self.tokens[a] + self.tokens[b], 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            parts[i : i + 2] = [rank]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def spines(self, token: int) -> tuple[list[int], list[int]]:
        """The tokens at its left and at its right edge while its merges go on, bytes first, itself last."""
        if token not in self._spines:
            halves = self.halves(token)
            self._spines[token] = ([*self.spines(halves[0])[0], token], [*self.spines(halves[1])[1], token]) if halves else ([token], [token])
        return self._spines[token]

    def fits(self, a: int, b: int) -> bool:
        """Whether the text of a and b together is encoded as a, b: no merge across the seam comes before its time."""
        key = (a, b)
        known = self._fits.get(key)
        if known is None:
            left, right = self.spines(a)[1], self.spines(b)[0]
            i = j = 0
            known = True
            while known:
                across = self.ranks.get(self.tokens[left[i]] + self.tokens[right[j]], 1 << 60)
                next_left = left[i + 1] if i + 1 < len(left) else 1 << 59
                next_right = right[j + 1] if j + 1 < len(right) else 1 << 59
                if across < next_left and across <= next_right:  # of equal merges the leftmost goes first
                    known = False
                elif next_left == next_right == 1 << 59:
                    break
                elif next_left <= next_right:
                    i += 1
                else:
                    j += 1
            if len(self._fits) > 2_000_000:
                self._fits.clear()
            self._fits[key] = known
        return known

    def encode_bytes(self, text: bytes) -> list[int]:
        """The ids of one pre-token."""
        if (whole := self.ranks.get(text)) is not None:
            return [whole]
        n = len(text)
        longest = [0] * n
        for last, (token, size) in self.automaton.iter(text.decode("latin-1")):
            longest[last - size + 1] = token  # a later end is a longer match
        open_ends = bytearray(b"\1" * (n + 1))
        tokens, fits = self.tokens, self.fits
        ids: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            end = at + len(tokens[token])
            if open_ends[end] and (not ids or fits(ids[-1], token)):
                ids.append(token)
                at = end
                token = longest[at] if at < n else 0
            elif (less := self.shorter(token)) >= 0:
                token = less
            else:
                open_ends[at] = 0
                token = ids.pop()
                at -= len(tokens[token])
        return ids

    def _pieces(self, pieces: Iterable[str]) -> bytes:
        out = []
        for p in pieces:
            ids = self.pieces.get(p)
            if ids is None:
                ids = self.pieces[p] = np.array(self.encode_bytes(p.encode()), "<u4").tobytes()
                self.chars += len(p)
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit integers."""
        if self.chars > MOST_CACHED_CHARS:
            self.pieces.clear()
            self.first.clear()
            self.rest.clear()
            self.chars = 0
        if IRREGULAR.search(text):
            return self._pieces(self.find(text))
        head, *tail = text.split(" ")
        out = [self._known(self.first, head, head)]
        rest = self.rest
        for p in tail:
            ids = rest.get(p)
            out.append(self._known(rest, p, " " + p) if ids is None else ids)
        return b"".join(out)

    def _known(self, cache: dict, key: str, text: str) -> bytes:
        ids = cache.get(key)
        if ids is None:
            ids = cache[key] = self._pieces(self.find(text))
            self.chars += len(key)
        return ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def coder(path: str, pattern: str) -> BytePairs:
    kept = worker_cache("bytebpe")
    if path not in kept:
        kept[path] = BytePairs(path, pattern)
    return kept[path]


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit integers) and decoded (binary) of every whole text.

    No shuffle; a worker keeps a bounded memory of pieces seen. A null or empty text has no ids. Null and repeated ids
    pass through; an empty table gives no rows; other columns are not read.
    """

    @trimmed
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(ranks, pattern)
        for batch in slices(batches, "text"):
            ids = [own.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.binary()), pa.array([own.decode(i) for i in ids], pa.binary())], names=["doc_id", "ids", "decoded"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).mapInArrow(rows, "doc_id long, ids binary, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
