"""Piecewise encoding with a public vocabulary of the tokenizers library.

A text is cut at single spaces and line ends. In both vocabularies used here either one, if it stands between two
characters that are not white space, always ends one pre-token and starts the next, so pieces can be encoded one by
one. Arrow cuts a batch of texts and numbers its distinct pieces; each of these goes to the library once, and the texts'
ids are gathered from theirs. Where white space counts, texts with runs of it are left to the library whole.

A piece of Latin letters is one pre-token, and so is the punctuation after it. For these the library's model is called
without its pattern: the letters are handed over as the model's byte signs, which gives the same ids in less time.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from parallax.llm.common import worker_cache

RARE_SPACE = re.compile(r"[^\S \n]")
CHUNK = 5_000  # pieces to a call of the library
KNOWN = 1 << 19  # words of letters whose ids an encoder remembers for its next batches
AFTER_WORDS = ".,;:!?)\""
LATIN_WORD = "^[A-Za-zªµºÀ-ÖØ-öø-įı-ſ]+$"  # single code points whose lower case and normal form are as plain
START = "\r"  # stands before a text's first piece; a text that has one of its own goes to the library whole


def irregular(text: str) -> bool:
    """Whether white space stands at an end or beside other white space, or is neither a space nor a line end."""
    return "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[:1].isspace() or text[-1:].isspace() or RARE_SPACE.search(text) is not None


def byte_signs() -> dict[int, str]:
    """The characters that byte-level vocabularies write for bytes: printable Latin-1 ones as they are, others moved up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, entries: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries' values one after another, and where the runs of entries between edges begin and end there."""
    sizes = lengths[entries]
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    at = np.arange(total, dtype=kind)
    at += np.repeat((starts[entries] - (ends - sizes)).astype(kind), sizes)
    return flat[at], np.append(0, ends)[edges]


class Known:
    """The ids of words of letters met before. At KNOWN words it begins anew, so it only saves calls."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.flat, self.edges = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def places(self, words: pa.Array) -> np.ndarray:
        """Where distinct words stand; -1 for a new one."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def add(self, words: pa.Array, found: list[tuple[np.ndarray, np.ndarray]]) -> None:
        if len(self.words) + len(words) > KNOWN:
            self.clear()
        if len(words) <= KNOWN:
            sizes = np.concatenate([np.diff(self.edges), *(np.diff(e) for _, e in found)])
            self.words = pa.concat_arrays([self.words, words])
            self.flat = np.concatenate([self.flat, *(ids for ids, _ in found)])
            self.edges = np.append(0, np.cumsum(sizes))


class PieceEncoder:
    """encode() gives the ids of a batch of texts, as the library does by default."""

    def __init__(self, path: str, spaces_count: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        contents = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile("|".join(map(re.escape, contents)) or r"(?!)", re.I)
        self.added_first = {c[0] for c in contents}
        self.spaces_count = spaces_count
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = self.tokenizer.model.end_of_word_suffix or ""
        self.widths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.widths[i] = len(token) - len(suffix) * bool(suffix and token.endswith(suffix))
        self.signs = {b: c for b, c in byte_signs().items() if b != 10}  # line ends part words
        self.marks: dict[str, np.ndarray] = {"": np.zeros(0, np.uint32)}
        self.known = {lead: Known() for lead in (False, True)}

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, pieces: list[str], gap: str, lead: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces without white space at their ends, encoded as one text and told apart by place."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.cumsum(sizes + 1) - sizes - 1 + (1 if lead else 0)
        e = self.tokenizer.encode((gap if lead else "") + gap.join(pieces), add_special_tokens=False)
        at = np.fromiter((o[0] for o in e.offsets), np.int64, len(e.ids))
        owner = np.searchsorted(starts - lead, at, "right") - 1
        own = at < (starts + sizes)[owner]  # what is left is the gaps' own
        return np.array(e.ids, np.uint32)[own], np.searchsorted(owner[own], np.arange(len(pieces) + 1))

    def _letters(self, cores: pa.Array, lead: bool) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of words of Latin letters, told apart by the tokens' widths; None if the model lacks a sign."""
        gap = "\n " if lead else "\n"
        text = gap[1:] + gap.join(cores.to_pylist())
        text = text.replace(" ", self.signs[32]) if text.isascii() else text.encode().decode("latin-1").translate(self.signs)
        e = self.bare.encode_batch_fast([text], add_special_tokens=False)[0]
        ids = np.array(e.ids, np.uint32)
        ends = np.cumsum(pc.binary_length(cores).to_numpy(zero_copy_only=False).astype(np.int64) + lead)
        reach = np.cumsum(self.widths[ids])
        edges = np.append(0, np.searchsorted(reach, ends) + 1)
        if not len(reach) or edges[-1] != len(ids) or (reach[edges[1:] - 1] != ends).any():
            return None
        return ids, edges

    def _pieces(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all names, their edges). Names are distinct pieces with START or a line end before them, or nothing,
        where a space is. A name's ids are those of its line end, of its letters, and of the punctuation behind them."""
        n = len(names)
        line = np.zeros(n, bool)
        bare = np.full(n, not self.spaces_count)
        pieces = names
        if self.spaces_count:
            line = pc.starts_with(names, "\n").to_numpy(zero_copy_only=False)
            bare = line | pc.starts_with(names, START).to_numpy(zero_copy_only=False)
            pieces = pc.utf8_ltrim(names, START + "\n")
        cores = pc.utf8_rtrim(pieces, AFTER_WORDS)
        simple = pc.match_substring_regex(cores, LATIN_WORD).to_numpy(zero_copy_only=False)
        # parts: nothing, a line end, kinds of punctuation, then each name's own letters or whole piece
        parts = [np.zeros(0, np.uint32), self._mark("\n")]
        kinds: dict[str, int] = {"": 0}
        behind = np.zeros(n, np.int64)
        trimmed = simple & (pc.binary_length(cores).to_numpy(zero_copy_only=False) < pc.binary_length(pieces).to_numpy(zero_copy_only=False))
        for k, piece, core in zip(np.flatnonzero(trimmed).tolist(), pieces.filter(pa.array(trimmed)).to_pylist(), cores.filter(pa.array(trimmed)).to_pylist()):
            mark = piece[len(core) :]
            if mark not in kinds:
                kinds[mark] = len(parts)
                parts.append(self._mark(mark))
            behind[k] = kinds[mark]
        sizes = [len(p) for p in parts]
        flat, edges, own = parts, [np.array(sizes)], np.zeros(n, np.int64)
        at = len(parts)
        empty = pc.equal(pieces, "").to_numpy(zero_copy_only=False)
        for lead in (False, True):
            some = np.flatnonzero(simple & (bare != lead))
            rest = [np.flatnonzero(~simple & ~empty & (bare != lead))]
            words = cores.take(pa.array(some))
            words = (words if self.spaces_count else pc.utf8_lower(words)).dictionary_encode()
            names_ = words.dictionary.cast(pa.large_string())
            known = self.known[lead]
            met = known.places(names_)
            old, new = np.flatnonzero(met >= 0), np.flatnonzero(met < 0)
            place = np.full(len(names_), -1)  # of each word's ids among the parts; -1: left to the library
            if len(old):
                ids, cuts = gathered(known.flat, known.edges[:-1], np.diff(known.edges), met[old], np.arange(len(old) + 1))
                place[old] = np.arange(at, at + len(old))
                at += len(old)
                flat.append(ids)
                edges.append(np.diff(cuts))
            fresh, told = [], []
            for lo in range(0, len(new), CHUNK):
                some_new = new[lo : lo + CHUNK]
                found = self._letters(names_.take(pa.array(some_new)), lead)
                if found is None:
                    continue
                place[some_new] = np.arange(at, at + len(some_new))
                at += len(some_new)
                flat.append(found[0])
                edges.append(np.diff(found[1]))
                fresh.append(some_new)
                told.append(found)
            if fresh:
                known.add(names_.take(pa.array(np.concatenate(fresh))), told)
            own[some] = place[words.indices.to_numpy()]
            left = some[own[some] < 0]
            rest.append(left)
            behind[left] = 0
            others = np.concatenate(rest)
            for lo in range(0, len(others), CHUNK):
                some = others[lo : lo + CHUNK]
                ids, cuts = self._together(pieces.take(pa.array(some)).to_pylist(), " " if lead or not self.spaces_count else "\n", int(lead))
                own[some] = np.arange(at, at + len(some))
                at += len(some)
                flat.append(ids)
                edges.append(np.diff(cuts))
        lengths = np.concatenate(edges).astype(np.int64)
        entries = np.stack([line.astype(np.int64), own, behind], 1).ravel()
        return gathered(np.concatenate(flat), np.cumsum(lengths) - lengths, lengths, entries, np.arange(0, 3 * n + 1, 3))

    def _mark(self, text: str) -> np.ndarray:
        if text not in self.marks:
            self.marks[text] = self._library([text])[0]
        return self.marks[text]

    def _is_whole(self, text: str | None) -> bool:
        if not text:
            return False
        return (any(c in text for c in self.added_first) and self.added.search(text) is not None) or (self.spaces_count and irregular(text))

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, their edges there); a null text is empty, and end_id follows each text."""
        whole = [k for k, t in enumerate(texts.to_pylist()) if self._is_whole(t)]
        given = texts
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if whole:
            mask = np.zeros(len(texts), bool)
            mask[whole] = True
            texts = pc.if_else(pa.array(mask), pa.scalar("", pa.large_string()), texts)
        if self.spaces_count:
            texts = pc.binary_join_element_wise(pa.scalar(START, pa.large_string()), pc.replace_substring(texts, "\n", " \n"), pa.scalar("", pa.large_string()))
        else:
            texts = pc.replace_substring(texts, "\n", " ")
        lists = pc.split_pattern(texts, " ")
        pieces = lists.flatten().dictionary_encode()
        flat, starts = self._pieces(pieces.dictionary)
        starts, lengths = starts[:-1], np.diff(starts)
        entries = pieces.indices.to_numpy()
        edges = lists.offsets.to_numpy()
        edges = edges - edges[0]
        if end_id is not None:
            entries = np.insert(entries, edges[1:], len(starts))
            edges = edges + np.arange(len(edges))
            starts, lengths = np.append(starts, len(flat)), np.append(lengths, 1)
            flat = np.append(flat, np.uint32(end_id))
        ids, edges = gathered(flat, starts, lengths, entries, edges)
        if whole:
            last = [] if end_id is None else [end_id]
            parts = [ids[a:b] for a, b in zip(edges, edges[1:])]
            for k, own in zip(whole, self._library([given[k].as_py() for k in whole])):
                parts[k] = np.append(own, np.array(last, np.uint32))
            ids, edges = np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))
        return ids, edges


def encoder(path: str, spaces_count: bool) -> PieceEncoder:
    """One encoder for each vocabulary in a Python worker."""
    kept = worker_cache("vocab")
    if path not in kept:
        kept[path] = PieceEncoder(path, spaces_count)
    return kept[path]
