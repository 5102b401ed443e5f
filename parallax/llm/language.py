"""Language identification by unigram pieces, summed over all segmentations."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parallax.llm.common import slices, strings, text_of, trimmed, worker_cache

LETTERS = regex.compile(r"\p{L}+")
LEAD = "▁"  # the vocabulary's sign for the start of a word
LONG = 60  # letters from which a word is scored by itself, with rescaling
SCALE = 16.0  # times a character's share, so that the products of words stay in range
MOST_WORDS = 200_000  # that a worker remembers


def sample(docs: DataFrame, train, per_lang: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, text) of at most per_lang training documents of each language, those of least hash of the id.

    The limit acts on ids alone, first in shares of a language, so that no task ranks a whole one; the texts are fetched
    by the ids chosen, which are broadcast: per_lang for each language. Of repeated ids one text is taken.
    """
    rows = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    ids = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).distinct().withColumn("h", F.xxhash64("id"))
    for share in (F.pmod("h", F.lit(64)), F.lit(0)):
        rank = F.row_number().over(W.partitionBy("lang", share).orderBy("h", "id"))
        ids = ids.withColumn("rank", rank).where(F.col("rank") <= per_lang).select("id", "lang", "h")
    texts = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), text_of(text_col).alias("text"))
    return texts.join(F.broadcast(ids.select("id", "lang")), ["id", "lang"]).groupBy("id", "lang").agg(F.min("text").alias("text")).select("lang", "text")


class Model:
    """Piece probabilities of each language over the vocabulary's pieces.

    langs: names in order; table: piece to row; shares: rows by languages, share of the piece times SCALE to the
    number of its characters; the last row is that of a character in no piece.
    """

    def __init__(self, langs: list[str], table: dict[str, int], shares: np.ndarray):
        self.langs, self.table, self.shares = langs, table, shares
        self.longest = max(map(len, table), default=1)


def fit(rows: Iterable[tuple[str, str]], vocabulary: str, rounds: int = 2, smooth: float = 0.5) -> Model:
    """Learns from (lang, text) rows; all their words count.

    The first counts are those of the vocabulary's own segmentation of the words; each round replaces them by the counts
    expected over all segmentations (forward and backward sums).
    """
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
    names = [p for i, p in enumerate(names) if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i)) and not regex.search(r"[^\p{L}▁]", p)]
    table = {p: i for i, p in enumerate(dict.fromkeys(names))}
    words: dict[str, Counter] = {}
    for lang, text in rows:
        words.setdefault(lang, Counter()).update(LETTERS.findall(text.lower()))
    langs = sorted(words)
    shares = np.zeros((len(table) + 1, len(langs)))
    lengths = np.array([len(p) for p in table] + [1])
    for k, lang in enumerate(langs):
        own, times = list(words[lang]), np.array(list(words[lang].values()), float)
        counts = np.zeros(len(table) + 1)
        for n, cut in zip(times, pieces.encode(own, out_type=str, num_threads=1)):
            for p in cut:
                counts[table.get(p, len(table))] += n
        for _ in range(rounds):
            counts = expected(own, times, _smoothed(counts, smooth) * SCALE**lengths, table)
        shares[:, k] = _smoothed(counts, smooth) * SCALE**lengths
    return Model(langs, table, shares)


def _smoothed(counts: np.ndarray, smooth: float) -> np.ndarray:
    return (counts + smooth) / (counts.sum() + smooth * len(counts))


def expected(words: list[str], times: np.ndarray, scaled: np.ndarray, table: dict[str, int]) -> np.ndarray:
    """How often each piece is expected in the words (each so many times), over all their segmentations.

    scaled holds shares times SCALE to the piece's length. Words of one length go together; those longer than LONG one
    by one, with logarithms, so that their sums stay in range.
    """
    counts = np.zeros(len(table) + 1)
    longest = max(map(len, table), default=1)
    by_size: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_size.setdefault(len(w) + 1, []).append(k)
    for size, group in by_size.items():
        if size > LONG:
            for k in group:
                _expect_long(LEAD + words[k], times[k], np.log(scaled), table, counts, longest)
            continue
        for lo in range(0, len(group), 10_000):
            part = group[lo : lo + 10_000]
            marked = [LEAD + words[k] for k in part]
            spans = []
            for i in range(size):
                for j in range(i + 1, min(size, i + longest) + 1):
                    rows = np.array([table.get(w[i:j], -1) for w in marked])
                    if j == i + 1:
                        rows[rows < 0] = len(table)
                    if (has := np.flatnonzero(rows >= 0)).size:
                        spans.append((i, j, has, rows[has]))
            before, after = np.zeros((size + 1, len(part))), np.zeros((size + 1, len(part)))
            before[0] = after[size] = 1.0
            for i, j, has, rows in spans:
                before[j, has] += before[i, has] * scaled[rows]
            for i, j, has, rows in reversed(spans):
                after[i, has] += scaled[rows] * after[j, has]
            each = times[part] / before[size]
            for i, j, has, rows in spans:
                counts += np.bincount(rows, each[has] * before[i, has] * scaled[rows] * after[j, has], len(counts))
    return counts


def _expect_long(word: str, n: float, logs: np.ndarray, table: dict[str, int], counts: np.ndarray, longest: int) -> None:
    size = len(word)
    spans = [(i, j, table.get(word[i:j], len(table) if j == i + 1 else -1)) for i in range(size) for j in range(i + 1, min(size, i + longest) + 1)]
    spans = [s for s in spans if s[2] >= 0]
    before, after = [-math.inf] * (size + 1), [-math.inf] * (size + 1)
    before[0] = after[size] = 0.0
    both = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b))) if min(a, b) > -math.inf else max(a, b)
    for i, j, p in spans:
        before[j] = both(before[j], before[i] + logs[p])
    for i, j, p in reversed(spans):
        after[i] = both(after[i], after[j] + logs[p])
    for i, j, p in spans:
        counts[p] += n * math.exp(before[i] + logs[p] + after[j] - before[size])


class Scorer:
    """Log probabilities of texts in every language; words seen are remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.places: dict[str, int] = {}
        self.logs = np.zeros((0, len(model.langs)))

    def words(self, new: list[str]) -> np.ndarray:
        """Log probabilities of words: the forward sums of many words at once, by length."""
        m, unknown = self.model, len(self.model.table)
        out = np.zeros((len(new), len(m.langs)))
        by_size: dict[int, list[int]] = {}
        for k, w in enumerate(new):
            by_size.setdefault(len(w) + 1, []).append(k)
        get = m.table.get
        for size, group in by_size.items():
            if size > LONG:
                for k in group:
                    out[k] = self.long(LEAD + new[k])
                continue
            sums = np.zeros((len(group), size + 1, len(m.langs)))
            sums[:, 0] = 1.0
            marked = [LEAD + new[k] for k in group]
            for i in range(size):
                for j in range(i + 1, min(size, i + m.longest) + 1):
                    rows = np.array([get(w[i:j], -1) for w in marked])
                    if j == i + 1:
                        rows[rows < 0] = unknown
                        sums[:, j] += sums[:, i] * m.shares[rows]
                    elif (has := np.flatnonzero(rows >= 0)).size:
                        sums[has, j] += sums[has, i] * m.shares[rows[has]]
            out[group] = np.log(np.maximum(sums[:, size], 1e-300)) - size * math.log(SCALE)
        return out

    def long(self, word: str) -> np.ndarray:
        """As words(), for one word of any length; the sums in use are rescaled as they go."""
        m, unknown = self.model, len(self.model.table)
        sums = {0: np.ones(len(m.langs))}
        lost = np.zeros(len(m.langs))
        for j in range(1, len(word) + 1):
            total = np.zeros(len(m.langs))
            for i in range(max(0, j - m.longest), j):
                row = m.table.get(word[i:j], unknown if j == i + 1 else -1)
                if row >= 0:
                    total = total + sums[i] * m.shares[row]
            sums[j] = total
            sums.pop(j - m.longest - 1, None)
            if j % 32 == 0:
                top = np.maximum(total, 1e-300)
                lost += np.log(top)
                for i in sums:
                    sums[i] = sums[i] / top
        return np.log(np.maximum(sums[len(word)], 1e-300)) + lost - len(word) * math.log(SCALE)

    def texts(self, texts: list[str | None]) -> list[tuple[np.ndarray, int]]:
        """Each text's log probabilities and number of words."""
        out = []
        for lo in range(0, len(texts), 256):
            cut = [LETTERS.findall((t or "").lower()) for t in texts[lo : lo + 256]]
            need = list(set().union(*cut) - self.places.keys())
            if len(self.places) + len(need) > MOST_WORDS:
                self.places, self.logs = {}, self.logs[:0]
                need = list(set().union(*cut))
            if need:
                at = len(self.places)
                if at + len(need) > len(self.logs):
                    self.logs = np.concatenate([self.logs[:at], np.zeros((max(2 * at, len(need), 10_000), len(self.model.langs)))])
                self.logs[at : at + len(need)] = self.words(need)
                self.places.update(zip(need, range(at, at + len(need))))
            place = self.places.__getitem__
            for words in cut:
                out.append((self.logs[np.fromiter(map(place, words), np.int64, len(words))].sum(0), len(words)))
        return out


def predict(docs: DataFrame, model: Model, evidence: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every whole text.

    lang_pred: the language of highest probability; `und` (score 0) if the text is null or has no letter, or no
    language was learned. score: that language's share if the words' mean log probability held for at most `evidence`
    words, so that long texts don't all score 1. The first in name order wins a tie. Repeated and null ids pass
    through; an empty table gives no rows; other columns are not read. The model is bounded by the vocabulary.
    """
    decide = _decisions(docs, model, evidence)

    @trimmed
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            best, score = decide(strings(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(best, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).mapInArrow(rows, "doc_id long, lang_pred string, score double")


def _decisions(docs: DataFrame, model: Model, evidence: int):
    """A function for tasks: texts to their languages and scores."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def decide(texts: list[str | None]) -> tuple[list[str], list[float]]:
        m = held.value
        kept = worker_cache("language")
        if kept.get("model") is not m:
            kept.update(model=m, scorer=Scorer(m))
        best, score = [], []
        for logs, n in kept["scorer"].texts(texts):
            if not n or not m.langs:
                best.append("und")
                score.append(0.0)
                continue
            k = int(np.argmax(logs))
            shares = np.exp((logs - logs[k]) * min(n, evidence) / n)
            best.append(m.langs[k])
            score.append(float(1 / shares.sum()))
        return best, score

    return decide


def known(docs: DataFrame, model: Model, least: float = 0.5, evidence: int = 10, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of texts in a learned language: those with a letter and a score of least or more.

    Rows are decided on one by one where they lie, so nulls and repeats in other columns don't matter.
    """
    decide = _decisions(docs, model, evidence)

    @trimmed
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            best, score = decide(strings(batch.column(text_col)))
            yield batch.filter(pa.array([b != "und" and s >= least for b, s in zip(best, score)], pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)


def learn(docs: DataFrame, train, vocabulary: str, per_lang: int = 400, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from a bounded sample: at most per_lang documents of each language reach the driver.

    Null texts and languages are left out; with no row left, the model knows no language.
    """
    return fit([(r["lang"], r["text"]) for r in sample(docs, train, per_lang, id_col, text_col, lang_col).toLocalIterator()], vocabulary)
