"""Byte-pair encoding of documents by content-defined chunks, and decoding."""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.llm.common import portions, runs

#: A chunk ends where the rolling hash of the last 16 bytes has so many zero bits: about 512 bytes.
CHUNK_BITS = 9
#: A worker's stores of encoded chunks and of pieces are each emptied when they take about so many bytes.
STORE_BYTES = 80 << 20
#: Pieces of at most so many bytes are looked up in bulk, by all their bytes as three numbers.
SHORT = 23
#: The table of short pieces has 2**TABLE_BITS places, of which six tenths are used at most.
TABLE_BITS = 21

# Characters that either the tokenizers' patterns or Python take for white space.
_BLANK = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_ASCII_BLANK = np.array([chr(i) in _BLANK and i < 128 for i in range(256)])
_WIDE_BLANK = [np.array([int.from_bytes(c.encode()) for c in _BLANK if len(c.encode()) == n]) for n in (2, 3)]
_LETTER = np.array([chr(i).isalpha() and i < 128 for i in range(256)])
_MARK = np.array([i in b",.;:!?" for i in range(256)])
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def byte_texts(tokenizer) -> dict[int, bytes]:
    """The bytes that each id of a byte-level vocabulary stands for."""
    # Printable stand-ins of bytes in byte-level vocabularies: the fixed values of the format.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(shown))}
    added = {k: v.content for k, v in tokenizer.get_added_tokens_decoder().items()}
    return {i: (added[i].encode() if i in added else bytes(byte_of[c] for c in t)) for t, i in tokenizer.get_vocab(with_added_tokens=True).items()}


class PieceTable:
    """Ids of short pieces, found by all bytes of a piece; an open-addressing table over numpy arrays."""

    def __init__(self):
        places = 1 << TABLE_BITS
        self.rows = np.zeros((places, 3), np.uint64)  # bytes as three numbers, length in the last byte; all zero: free
        self.first, self.count = np.zeros(places, np.int32), np.full(places, -1, np.int32)
        self.ids, self.used, self.pieces = np.zeros(1 << 16, np.uint32), 0, 0

    def places(self, words: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Place of each piece, new ones included; ``words`` are the eight bytes from each byte on."""
        keys = np.empty((len(start), 3), np.uint64)
        for k in range(3):
            keys[:, k] = words[start + 8 * k] & _MASK[np.clip(length - 8 * k, 0, 8)]
        keys[:, 2] |= length.astype(np.uint64) << np.uint64(56)
        h = keys[:, 0] * _MIX[0] + keys[:, 1] * _MIX[1] + keys[:, 2] * _MIX[2]
        place = (((h ^ (h >> np.uint64(32))) * _MIX[3]) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        left, asked, at = np.arange(len(start)), keys, place
        while len(left):
            found = self.rows.take(at, 0)
            free = np.flatnonzero(found[:, 2] == 0)
            if len(free):
                self.rows[at[free]] = asked[free]  # of different pieces at one place the last stays
                found[free] = self.rows[at[free]]
            other = np.flatnonzero((found[:, 0] != asked[:, 0]) | (found[:, 1] != asked[:, 1]) | (found[:, 2] != asked[:, 2]))
            left, asked, at = left[other], asked[other], at[other] + 1 & (1 << TABLE_BITS) - 1
            place[left] = at
        return place

    def learn(self, place: np.ndarray, count: np.ndarray, ids: np.ndarray) -> None:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + 2 * len(ids), np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.first[place], self.count[place] = self.used + np.cumsum(count) - count, count
        self.used += len(ids)
        self.pieces += len(place)


class ChunkEncoder:
    """Encodes texts as ``Tokenizer.encode(text, add_special_tokens=False)`` does, reusing chunks.

    A text is cut where a rolling hash of its bytes says so, hence texts that share a passage share
    the chunks inside it. Such a cut may fall inside a token. Of a chunk therefore the core is kept,
    which lies between two *seams*, and each join, from the last seam of one chunk to the first of
    the next, is encoded anew. A seam is a place after a character that is not white space and
    before a space or line end, or after one of A-Z, a-z and before one of ``,.;:!?`` that has a seam after it.
    No token of this kind of vocabulary crosses a seam, whatever stands around it, so pieces between seams are encoded alone and agree exactly with the encoding of the
    whole text. A chunk without a seam is part of a join as a whole. Pieces are looked up for many
    texts at once, and those not known yet are encoded one after the other as one text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        texts = byte_texts(self.tokenizer)
        self.bytes_of_id = np.zeros(max(texts) + 1, np.int64)
        self.bytes_of_id[list(texts)] = [len(t) for t in texts.values()]
        self.short = PieceTable()
        self.long: dict[bytes, np.ndarray] = {}
        self.long_held = 0
        self.chunks: dict[bytes, np.ndarray] = {}
        self.held = 0
        self.gear = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)

    @classmethod
    def of_worker(cls, path: str) -> ChunkEncoder:
        """The encoder of this Python worker, which keeps its stores from one task to the next."""
        home = sys.modules.setdefault("_macroloom_worker", types.ModuleType("_macroloom_worker")).__dict__
        if ("encoder", path) not in home:
            home["encoder", path] = cls(path)
        return home["encoder", path]

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Places where a chunk ends, never inside a character."""
        if data.size < 2:
            return np.empty(0, np.int64)
        h = self.gear[data]
        for width in (1, 2, 4, 8):
            longer = h.copy()
            longer[width:] += h[:-width] << np.uint32(width)
            h = longer
        ends = np.flatnonzero((h[:-1] >> np.uint32(32 - CHUNK_BITS)) == 0) + 1
        return ends[(data[ends] & 0xC0) != 0x80]

    def _seams(self, data: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Places after a character that is not white space and before a space or line end, or around a mark as above."""
        at = np.flatnonzero((data[1:] == 32) | (data[1:] == 10)) + 1
        at = at[~_ASCII_BLANK[data[at - 1]]]
        wide = np.flatnonzero(data[at - 1] >= 128)
        two = data[at[wide] - 2].astype(np.int64) << 8 | data[at[wide] - 1]
        three = data[at[wide] - 3].astype(np.int64) << 16 | two
        at = np.delete(at, wide[np.isin(two, _WIDE_BLANK[0]) | np.isin(three, _WIDE_BLANK[1])])
        marks = at[at > 1] - 1
        # Whether a mark is a seam must not depend on what follows its chunk.
        return np.append(at, marks[_MARK[data[marks]] & _LETTER[data[marks - 1]] & ~edge[marks] & ~edge[marks + 1]])

    def _encode_pieces(self, texts: list[bytes], joinable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, all ids). Joinable ones start with a seam, and end before one if a seam follows."""
        codes: list = [None] * len(texts)
        some = np.flatnonzero(joinable)
        blocks = [some[a : a + 1024].tolist() for a in range(0, len(some), 1024)]
        joined = [b"".join(texts[i] for i in block).decode() for block in blocks]
        for block, code in zip(blocks, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False) if joined else []):
            ids = np.array(code.ids, np.uint32)
            reached = np.cumsum(self.bytes_of_id[ids])
            wanted = np.cumsum([len(texts[i]) for i in block])
            ends = np.searchsorted(reached, wanted)
            if len(ids) == 0 or ends[-1] >= len(ids) or (reached[ends] != wanted).any():
                joinable[block] = False  # a vocabulary without some bytes: these are encoded one by one
                continue
            a = 0
            for i, b in zip(block, (ends + 1).tolist()):
                codes[i] = ids[a:b]
                a = b
        alone = np.flatnonzero(~joinable).tolist()
        for i, code in zip(alone, self.tokenizer.encode_batch_fast([texts[i].decode() for i in alone], add_special_tokens=False) if alone else []):
            codes[i] = np.array(code.ids, np.uint32)
        return np.array([len(c) for c in codes], np.int64), np.concatenate(codes)

    def _bound(self) -> None:
        if self.held > STORE_BYTES:
            self.chunks.clear()
            self.held = 0
        if self.long_held > STORE_BYTES // 4:
            self.long.clear()
            self.long_held = 0
        if self.short.pieces > 0.5 * (1 << TABLE_BITS) or 64 * self.short.pieces > STORE_BYTES:
            self.short = PieceTable()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        self._bound()
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        size = int(bounds[-1])
        if not size:
            return [b""] * len(texts)
        whole = b"".join(texts)
        buffer = whole + bytes(SHORT + 8)
        data = np.frombuffer(whole, np.uint8)
        edge = np.zeros(size + 1, bool)
        edge[self.cuts(data)] = True
        edge[bounds] = True
        edges = np.flatnonzero(edge)
        mark = np.zeros(size + 1, bool)
        mark[self._seams(data, edge)] = True
        mark[bounds] = True
        start = np.flatnonzero(mark[:-1])
        end = np.append(start[1:], size)
        # The core of a chunk: the pieces from the first seam inside it up to the last one.
        low = np.searchsorted(start, edges[:-1], "right")
        high = np.searchsorted(start, edges[1:], "left") - 1
        asked = np.ones(len(start), bool)
        count = np.zeros(len(start), np.int64)
        known, fresh = [], {}
        held = np.flatnonzero(high > low)
        for a, b, x, y in zip(edges[held].tolist(), edges[held + 1].tolist(), low[held].tolist(), high[held].tolist()):
            chunk = whole[a:b]
            ids = self.chunks.get(chunk)
            if ids is not None:
                asked[x:y] = False
                count[x] = len(ids)
                known.append((x, ids))
            elif chunk not in fresh:
                fresh[chunk] = (x, y)
        is_end = np.zeros(size + 1, bool)
        is_end[bounds] = True
        joinable = ((data[start] == 32) | (data[start] == 10)) & ~is_end[end]
        first, length = np.zeros(len(start), np.int64), end - start

        some = np.flatnonzero(asked & (length <= SHORT))
        words = np.ndarray((size + SHORT,), "<u8", buffer, strides=(1,))
        for a in range(0, len(some), 1 << 19):  # the table has room for so many more
            part = some[a : a + (1 << 19)]
            if self.short.pieces > 0.5 * (1 << TABLE_BITS):
                break
            place = self.short.places(words, start[part], length[part])
            new, at = np.unique(np.where(self.short.count[place] < 0, place, -1), return_index=True)
            new, at = (new[1:], at[1:]) if len(new) and new[0] < 0 else (new, at)
            if len(new):
                which = part[at]
                self.short.learn(new, *self._encode_pieces([whole[x:y] for x, y in zip(start[which].tolist(), end[which].tolist())], joinable[which]))
            first[part], count[part] = self.short.first[place], self.short.count[place]
            asked[part] = False
        some = some[~asked[some]]

        rest = np.flatnonzero(asked).tolist()
        names = [whole[x:y] for x, y in zip(start[rest].tolist(), end[rest].tolist())]
        missing = {t: i for t, i in zip(names, rest) if t not in self.long}
        if missing:
            counts, ids = self._encode_pieces(list(missing), joinable[list(missing.values())])
            for t, code in zip(missing, np.split(ids, np.cumsum(counts)[:-1])):
                self.long[t] = code.copy()
                self.long_held += 300 + 3 * len(t)
        own = [self.long[t] for t in names]
        count[rest] = [len(x) for x in own]

        offsets = np.concatenate(([0], np.cumsum(count)))
        out = np.empty(int(offsets[-1]), "<u4")
        out[runs(offsets[some], count[some])] = self.short.ids[runs(first[some], count[some])]
        for i, ids in [*known, *zip(rest, own)]:
            out[offsets[i] : offsets[i] + len(ids)] = ids
        for chunk, (x, y) in fresh.items():
            self.chunks[chunk] = out[offsets[x] : offsets[y]].copy()
            self.held += 350 + len(chunk) + 4 * int(offsets[y] - offsets[x])
        reached = offsets[np.searchsorted(start, bounds)]
        coded = out.tobytes()
        return [coded[4 * a : 4 * b] for a, b in zip(reached[:-1].tolist(), reached[1:].tolist())]


class IdDecoder:
    """Decodes ids as ``Tokenizer.decode(ids, skip_special_tokens=False)`` of a byte-level vocabulary does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        texts = byte_texts(Tokenizer.from_file(path))
        ordered = [texts.get(i, b"") for i in range(max(texts) + 1)]
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)
        self.count = np.array([len(t) for t in ordered], np.int64)
        self.first = np.cumsum(self.count) - self.count

    def decode(self, ids: bytes) -> str:
        return self.decode_all([ids])[0]

    def decode_all(self, codes: list[bytes]) -> list[str]:
        """Texts of many documents' ids at once."""
        ids = np.frombuffer(b"".join(codes), "<u4")
        count = self.count[ids]
        data = self.bytes[runs(self.first[ids], count)].tobytes()
        reached = np.concatenate(([0], np.cumsum(count)))[np.concatenate(([0], np.cumsum([len(c) // 4 for c in codes], dtype=np.int64)))].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(reached, reached[1:])]


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, decoded: bool) -> Iterator[pa.RecordBatch]:
    """(id, text) batches to (id, ids[, decoded])."""
    encoder, decoder = ChunkEncoder.of_worker(path), IdDecoder(path) if decoded else None
    for batch in portions(batches, 1):
        texts = [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]
        codes = encoder.encode(texts)
        out = [batch.column(0), pa.array(codes, pa.binary())]
        names = ["id", "ids"]
        if decoded:
            out.append(pa.array(decoder.decode_all(codes), pa.string()))
            names.append("decoded")
        yield pa.RecordBatch.from_arrays(out, names=names)


def encode_documents(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", decoded: bool = True) -> DataFrame:
    """(id, ids, decoded) of every row: token ids as little-endian unsigned 32-bit integers, and their text.

    Runs where the rows are, without a shuffle; a worker keeps the chunks and pieces it has encoded up to
    ``STORE_BYTES`` each, from one task to the next, and works on a few MB of text at a time,
    so its memory does not grow with the input. Null and empty texts have no
    ids and decode to the empty text. Repeated rows and ids are encoded row by row; very long texts
    are encoded whole. Other columns are ignored, whatever their names.
    """
    kind = dict(docs.dtypes)[id_column]
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = f"id {kind}, ids binary" + ", decoded string" * decoded
    return rows.mapInArrow(lambda batches: encode_batches(batches, path, decoded), schema).withColumnRenamed("id", id_column)
