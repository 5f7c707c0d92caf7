"""Benchmark passages in documents, found with an FM-index per shard of documents."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.llm.common import portions
from macroloom.llm.fmindex import FMIndex

#: Words of a window.
WINDOW = 10
#: Benchmark text that is sent to the tasks at once; a larger benchmark is searched in blocks.
BLOCK_BYTES = 8 << 20
#: Document text that one index covers; a longer document has one of its own.
SHARD_BYTES = 32 << 20

_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, letters a-z and all characters beyond ASCII."""
    return text.translate(_WORD_BYTES).split()


class Phrases:
    """The distinct windows of a block of benchmark items as symbol rows, and the items of each."""

    def __init__(self, items: Sequence[tuple[str, bytes]]):
        self.symbol: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            codes = [self.symbol.setdefault(w, len(self.symbol) + 1) for w in words_of(text)]
            width = min(WINDOW, len(codes))
            for i in range(len(codes) - width + 1 if width else 0):
                windows.setdefault(tuple(codes[i : i + width]), set()).add(name)
        self.rows: dict[int, np.ndarray] = {}
        self.items: dict[int, list[list[str]]] = {}
        for width in sorted({len(w) for w in windows}):
            same = sorted(w for w in windows if len(w) == width)
            self.rows[width] = np.array(same, np.int64)
            self.items[width] = [sorted(windows[w]) for w in same]
        self.shortest = min(self.rows, default=0)


class Shard:
    """Documents, reduced to the runs of benchmark words that are long enough to hold a window.

    A window holds benchmark words only. Runs of fewer such words than the shortest window cannot
    hold one, so leaving them out of the index loses no occurrence.
    """

    def __init__(self, phrases: Phrases):
        self.phrases, self.documents, self.bytes = phrases, 0, 0
        self.text, self.owner, self.word = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]

    def add(self, text: bytes) -> int:
        """Takes in one document; its number of words."""
        words = words_of(text)
        self.bytes += len(text)
        number, self.documents = self.documents, self.documents + 1
        if self.phrases.rows and words:
            codes = np.zeros(len(words) + 2, np.int64)
            codes[1:-1] = np.fromiter(map(self.phrases.symbol.get, words, repeat(0)), np.int64, len(words))
            edges = np.diff((codes > 0).astype(np.int8))
            starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            for a, b in zip(*(x[ends - starts >= self.phrases.shortest].tolist() for x in (starts, ends))):
                self.text.append(codes[a + 1 : b + 2])  # with the zero behind it
                self.owner.append(np.full(b - a + 1, number))
                self.word.append(np.arange(a, b + 1))
        return len(words)

    def hits(self) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
        """Merged spans of words (first, after) and the items found, by document."""
        spans: list[list[tuple[int, int]]] = [[] for _ in range(self.documents)]
        items: list[set[str]] = [set() for _ in range(self.documents)]
        text = np.concatenate(self.text)
        if len(text) == 1:
            return spans, items
        owner, word = np.concatenate(self.owner), np.concatenate(self.word)
        text, owner, word = text[1:], owner[1:], word[1:]
        index = FMIndex(text, len(self.phrases.symbol))
        depth = np.zeros(len(text) + 1, np.int64)
        for width, rows in self.phrases.rows.items():
            low, high = index.ranges(rows)
            counts = np.maximum(high - low, 0)
            found = np.repeat(np.arange(len(rows)), counts)
            at = index.locate(np.arange(len(found)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts))
            np.add.at(depth, at, 1)
            np.add.at(depth, at + width, -1)
            for document, window in set(zip(owner[at].tolist(), found.tolist())):
                items[document].update(self.phrases.items[width][window])
        inside = np.concatenate(([0], np.cumsum(depth[:-1]) > 0, [0])).astype(np.int8)
        edges = np.diff(inside)
        for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
            spans[owner[a]].append((int(word[a]), int(word[a]) + b - a))
        return spans, items


def merged(one: Sequence[tuple[int, int]], other: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of two lists of spans; spans that touch become one."""
    out: list[tuple[int, int]] = []
    for first, after in sorted([*one, *other]):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], after))
        else:
            out.append((first, after))
    return out


SPANS = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))


def search_batches(batches: Iterator[pa.RecordBatch], items: Sequence[tuple[str | None, bytes]], kept: int) -> Iterator[pa.RecordBatch]:
    """(kept columns, text, n_words, spans, items) with what these items add to spans and items."""
    phrases = Phrases(items)
    shard, held, sizes = Shard(phrases), [], []

    def close():
        spans, found = shard.hits()
        start = 0
        for batch in held:
            rows = range(start, start + batch.num_rows)
            start += batch.num_rows
            old_spans = [[(s["first"], s["after"]) for s in x] for x in batch.column(kept + 2).to_pylist()]
            both = [merged(old, spans[i]) for old, i in zip(old_spans, rows)]
            names = [sorted(found[i].union(old), key=lambda x: (x is None, x)) for old, i in zip(batch.column(kept + 3).to_pylist(), rows)]
            columns = [pa.array([sizes[i] for i in rows], pa.int64()), pa.array([[{"first": a, "after": b} for a, b in x] for x in both], SPANS), pa.array(names, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: kept + 1], *columns], names=batch.schema.names)

    for batch in portions(batches, kept):
        for text in batch.column(kept).cast(pa.binary()).to_pylist():
            sizes.append(shard.add(text or b""))
        held.append(batch)
        if shard.bytes >= SHARD_BYTES:
            yield from close()
            shard, held, sizes = Shard(phrases), [], []
    yield from close()


def find_passages(
    docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] = ("doc_id",), text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Columns ``keep`` of every document, then ``n_words``, ``spans`` (merged runs of hit words, as
    word numbers ``first`` to before ``after``), ``items`` (ids found, as sorted text) and ``n_hit``.

    Words are lower-cased (A-Z) runs of letters, digits and characters beyond ASCII. A window is 10
    consecutive words of an item, or all words of a shorter one. Each shard of documents inside a
    task gets an FM-index over its words; windows are searched backwards through wavelet ranks, and
    their occurrences located by sampled positions. Documents are not shuffled and not cut.

    The benchmark is sent to the tasks in blocks of about ``block_bytes``; documents pass all blocks
    one after another, and spans and items are united. Null texts have no words; null, empty and
    wordless items have no windows. Items that repeat an id count as one, and so do all items with a
    null id, which stand last among ``items``. Repeated documents are reported row by row. Other
    columns are ignored.
    """
    asked = benchmark.where(F.col(item_text_column).isNotNull()).select(
        F.col(item_column).cast("string").alias("item"), F.col(item_text_column).alias("text")
    )
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    kinds = dict(docs.dtypes)
    once = kinds[text_column] == "string"  # a text that is kept goes to the tasks once
    names = ["__text" if once and c == text_column else f"__{i}" for i, c in enumerate(keep)]
    beside = [(c, n) for c, n in zip(keep, names) if n != "__text"]
    rows = docs.select(
        *[F.col(c).alias(n) for c, n in beside],
        F.col(text_column).cast("string").alias("__text"),
        F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<struct<first:int,after:int>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    schema = ", ".join([*[f"{n} {kinds[c]}" for c, n in beside], "__text string, n_words long, spans array<struct<first:int,after:int>>, items array<string>"])
    for block in range(blocks):
        found = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).select("item", F.col("text").cast("binary")).collect()  # about block_bytes
        sent = docs.sparkSession.sparkContext.broadcast([(r.item, bytes(r.text)) for r in found])
        rows = rows.mapInArrow(lambda batches, sent=sent: search_batches(batches, sent.value, len(beside)), schema)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["after"] - s["first"])
    return rows.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "n_words", "spans", "items", n_hit.alias("n_hit"))
