"""Language identification by unigram pieces, summed over all segmentations."""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macroloom.llm.common import portions, stored

#: Documents per language that training reads at most (in expectation), chosen by a hash of the id.
SAMPLE_DOCS = 3000
#: Rounds of expectation maximisation.
ROUNDS = 2
#: Pieces of more bytes are not used, words of more bytes are cut into runs of at most so many.
PIECE_BYTES, WORD_BYTES = 16, 48
#: Weight of the uniform distribution over the vocabulary, in pieces.
PRIOR = 200.0
#: Words whose scores a task keeps; the store is emptied beyond.
STORE_WORDS = 400_000
#: Factor e**TILT per byte on the piece probabilities keeps sums over long words in range.
TILT = 2.0
#: Expected counts are summed as whole multiples of 2**-20, so that no order of summing matters.
STEP = float(1 << 20)

words_of = re.compile(r"[^\W\d_]+").findall


class Pieces:
    """The pieces of a public vocabulary file (base64 text and rank per line), looked up in bulk."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            found = sorted(base64.b64decode(line.split()[0]) for line in lines if line.strip())
        self.pieces = [p for p in found if len(p) <= PIECE_BYTES]
        hashes = np.array([self.hash_of(p) for p in self.pieces], np.uint64)
        self.bits = 20
        self.keys, self.ids = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, len(self.pieces), np.int32)
        self.probes = 1
        for i, (key, slot) in enumerate(zip(hashes.tolist(), self._slots(hashes).tolist())):
            n = 1
            while self.keys[slot]:
                slot, n = (slot + 1) & ((1 << self.bits) - 1), n + 1
            self.keys[slot], self.ids[slot] = key, i
            self.probes = max(self.probes, n)

    @staticmethod
    def hash_of(piece: bytes) -> int:
        h = len(piece)
        for b in piece:
            h = (h * 0x9E3779B97F4A7C15 + b + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _slots(self, h: np.ndarray) -> np.ndarray:
        return (((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        slot = self._slots(h)
        out = np.full(h.shape, len(self.pieces), np.int32)
        for _ in range(self.probes):
            out = np.where(self.keys[slot] == h, self.ids[slot], out)
            slot = (slot + 1) & ((1 << self.bits) - 1)
        return out

    def edges(self, data: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """Piece ids of all substrings of words of one length, rows of ``data``: by (start, end); absent is len(pieces)."""
        out = {}
        for n in range(1, min(PIECE_BYTES, data.shape[1]) + 1):
            h = np.full((len(data), data.shape[1] - n + 1), n, np.uint64)
            for k in range(n):
                h = h * np.uint64(0x9E3779B97F4A7C15) + data[:, k : data.shape[1] - n + 1 + k] + np.uint64(1)
            ids = self.find(h)
            for start in range(ids.shape[1]):
                if (ids[:, start] < len(self.pieces)).any():
                    out[start, start + n] = ids[:, start]
        return out


def runs_of(word: str) -> list[bytes]:
    """The word after a space, in runs of at most WORD_BYTES bytes that end between characters."""
    data = (" " + word).encode()
    runs = []
    while len(data) > WORD_BYTES:
        cut = WORD_BYTES
        while data[cut] & 0xC0 == 0x80:
            cut -= 1
        runs.append(data[:cut])
        data = data[cut:]
    return [*runs, data]


def by_length(runs: Sequence[bytes], block: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers, bytes as rows) of runs of equal length."""
    lengths = np.array([len(r) for r in runs])
    for n in np.unique(lengths).tolist():
        same = np.flatnonzero(lengths == n)
        for a in range(0, len(same), block):
            some = same[a : a + block]
            yield some, np.frombuffer(b"".join(runs[i] for i in some), np.uint8).reshape(-1, n).astype(np.uint64)


def tilted(weights: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Probabilities by piece and language with the factor per byte; a last row of zeros stands for no piece."""
    lengths = np.array([len(p) for p in pieces.pieces])
    return np.vstack([weights * np.exp(TILT * lengths)[:, None], np.zeros((1, weights.shape[1]))])


def forward(edges: dict, n: int, rows: int, table: np.ndarray) -> list[np.ndarray]:
    """Sums over all segmentations of each prefix, by language."""
    alpha = [np.ones((rows, table.shape[1]))] + [np.zeros((rows, table.shape[1])) for _ in range(n)]
    for (start, end), ids in sorted(edges.items(), key=lambda e: e[0][1]):
        alpha[end] += alpha[start] * table[ids]
    return alpha


def word_scores(words: Sequence[str], pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """Logarithm of each word's probability by language."""
    runs, owner = [], []
    for i, w in enumerate(words):
        for r in runs_of(w):
            runs.append(r)
            owner.append(i)
    out, owner = np.zeros((len(words), table.shape[1])), np.array(owner)
    for some, data in by_length(runs):
        n = data.shape[1]
        last = forward(pieces.edges(data), n, len(data), table)[n]
        np.add.at(out, owner[some], np.log(np.maximum(last, 1e-300)) - TILT * n)
    return out


def expected_counts(words: Sequence[str], times: np.ndarray, langs: np.ndarray, pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece by language, over all segmentations of the words."""
    runs, owner = [], []
    for i, w in enumerate(words):
        for r in runs_of(w):
            runs.append(r)
            owner.append(i)
    owner = np.array(owner)
    counts = np.zeros((len(pieces.pieces) + 1) * table.shape[1])
    for some, data in by_length(runs):
        n, lang, weight = data.shape[1], langs[owner[some]], times[owner[some]]
        edges = pieces.edges(data)
        own = {k: table[ids, lang] for k, ids in edges.items()}
        alpha = np.zeros((n + 1, len(data)))
        beta = np.zeros((n + 1, len(data)))
        alpha[0] = beta[n] = 1.0
        for (start, end), p in sorted(own.items(), key=lambda e: e[0][1]):
            alpha[end] += alpha[start] * p
        for (start, end), p in sorted(own.items(), key=lambda e: -e[0][0]):
            beta[start] += beta[end] * p
        share = weight / np.maximum(alpha[n], 1e-300)
        for (start, end), p in own.items():
            counts += np.bincount(edges[start, end] * table.shape[1] + lang, alpha[start] * p * beta[end] * share, counts.size)
    return counts.reshape(-1, table.shape[1])[:-1]


@dataclass
class LanguageModel:
    """Piece probabilities by language; its size is that of the vocabulary times the languages."""

    path: str
    langs: list[str]
    weights: np.ndarray


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, 1):
        by_lang: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_lang.setdefault(lang, Counter()).update(words_of(text.lower()))
        rows = [(lang, w, n) for lang, found in by_lang.items() for w, n in found.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"])


def train(docs: DataFrame, path: str, lang_column: str = "lang", text_column: str = "text", id_column: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> LanguageModel:
    """Piece probabilities from texts whose language is known.

    Reads about ``sample_docs`` documents of each language. Words are counted by language, and the
    pieces' expected counts come from these by expectation maximisation from equal probabilities.
    Null texts and languages teach nothing; without any, the model has no language.
    """
    known = docs.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text"), F.col(id_column).alias("id")
    )
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}  # one row a language
    langs = sorted(sizes)
    pieces = Pieces(path)
    v = len(pieces.pieces)
    weights = np.full((v, len(langs)), 1.0 / v)
    if not langs:
        return LanguageModel(path, [], weights)
    chance = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1_000_000)) / 1_000_000
    share = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(sample_docs / n)) for lang, n in sizes.items()])
    counted = stored(known.where(chance < share).select("lang", "text").mapInArrow(count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    number = {lang: i for i, lang in enumerate(langs)}
    for _ in range(ROUNDS):
        sent = counted.sparkSession.sparkContext.broadcast(weights)

        def expect(batches, sent=sent):
            table, own = None, Pieces(path)
            total = np.zeros((v, len(langs)))
            for batch in batches:
                table = tilted(sent.value, own) if table is None else table
                lang = np.array([number[x] for x in batch.column(0).to_pylist()])
                found = expected_counts(batch.column(1).to_pylist(), batch.column(2).to_numpy().astype(float), lang, own, table)
                total += np.rint(found * STEP)
            where = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(where[0], pa.int32()), pa.array(where[1], pa.int32()), pa.array(total[where].astype(np.int64))], names=["piece", "lang", "n"])

        sums = counted.mapInArrow(expect, "piece int, lang int, n long").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()  # vocabulary x languages
        counts = np.zeros_like(weights)
        counts[sums.piece.to_numpy(), sums.lang.to_numpy()] = sums.n.to_numpy() / STEP
        weights = (counts + PRIOR / v) / (counts.sum(0) + PRIOR)
        sent.unpersist()
    return LanguageModel(path, langs, weights)


def score_batches(batches: Iterator[pa.RecordBatch], path: str, langs: list[str], weights: np.ndarray, with_text: bool = False) -> Iterator[pa.RecordBatch]:
    """Appends language and score to batches whose last column is the text, which stays if asked for."""
    pieces = Pieces(path)
    table = tilted(weights, pieces) if langs else None
    index: dict[str, int] = {}
    scores = np.zeros((1024, len(langs)))
    for batch in portions(batches, -1):
        preds, posts = [], []
        found = [words_of(t.lower()) if t else [] for t in batch.column(batch.num_columns - 1).to_pylist()]
        if len(index) > STORE_WORDS:
            index.clear()
        if langs:
            fresh = sorted({w for ws in found for w in ws if w not in index})
            if fresh:
                a, b = len(index), len(index) + len(fresh)
                if b > len(scores):
                    scores = np.vstack([scores[:a], np.zeros((2 * b - a, len(langs)))])
                scores[a:b] = word_scores(fresh, pieces, table)
                index.update(zip(fresh, range(a, b)))
        for ws in found:
            if not langs or not any(c.isalpha() for w in ws for c in w):
                preds.append("und")
                posts.append(0.0)
                continue
            total = scores[np.fromiter(map(index.__getitem__, ws), np.int64, len(ws))].sum(0)
            best = int(total.argmax())
            preds.append(langs[best])
            posts.append(min(1.0, 1.0 / float(np.exp(np.maximum(total - total[best], -700)).sum())))
        kept = batch.num_columns - (not with_text)
        yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(preds, pa.string()), pa.array(posts, pa.float64())], names=[*batch.schema.names[:kept], "__lang", "__score"])


def identify(docs: DataFrame, model: LanguageModel, keep: Sequence[str] = ("doc_id",), text_column: str = "text") -> DataFrame:
    """Columns ``keep`` of every row, then ``lang_pred`` and ``score``.

    A word's probability in a language is the sum over all ways to cut it into pieces of the product
    of the pieces' probabilities; a text's is the product over its words, read whole. ``score`` is the
    probability of the language, all languages being equally likely beforehand; of equal ones the
    first by name is taken. Null, empty and letterless texts are ``und`` with score 0, as are all
    texts under a model without languages. Words are lower-cased runs of letters.

    Runs where the rows are, without a shuffle. Repeated rows are scored row by row. Columns of
    ``docs`` outside ``keep`` are ignored; a kept one of the name of a result is an error of Spark's
    when it is used, as it is for any repeated name.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model.weights)
    path, langs = model.path, model.langs
    names = ["__text" if c == text_column else f"__{i}" for i, c in enumerate(keep)]  # a text that is kept goes to the tasks once
    beside, kinds = [(c, n) for c, n in zip(keep, names) if n != "__text"], dict(docs.dtypes)
    rows = docs.select(*[F.col(c).alias(n) for c, n in beside], F.col(text_column).alias("__text"))
    with_text = "__text" in names
    schema = ", ".join([*[f"{n} {kinds[c]}" for c, n in beside], *[f"__text {kinds[text_column]}"] * with_text, "__lang string, __score double"])
    out = rows.mapInArrow(lambda batches: score_batches(batches, path, langs, sent.value, with_text), schema).select(*names, "__lang", "__score")
    return out.toDF(*keep, "lang_pred", "score")


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))
