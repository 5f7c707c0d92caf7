"""Token ids of documents as files of range-coded, checksummed blocks."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from macroloom.llm import rangecoder
from macroloom.llm.bpe import ChunkEncoder
from macroloom.llm.common import portions

#: Tokens after which a segment is closed; it always holds whole documents.
SEGMENT = 1 << 22
#: Tokens of a block: the shorter, the more blocks are coded in step, and the more heads are stored.
BLOCK = 2048

_MAGIC = b"MLT1"
_HEAD = "<4sIQIII"


def pack(names: np.ndarray, absent: np.ndarray, lengths: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A segment: head, ids and lengths of its documents, sizes and checksums of its blocks, checksum of all this, blocks."""
    blocks = rangecoder.encode(ids, block)
    highest = int(ids.max()) + 1 if len(ids) else 0
    front = struct.pack(_HEAD, _MAGIC, len(names), len(ids), block, len(blocks), highest)
    front += names.astype("<i8").tobytes() + absent.astype(np.uint8).tobytes() + lengths.astype("<u4").tobytes()
    front += np.array([[len(b), zlib.crc32(b)] for b in blocks], "<u4").tobytes()
    return front + struct.pack("<I", zlib.crc32(front)) + b"".join(blocks)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, which are absent, lengths, token ids) of a segment; damage is an error."""
    if len(data) < struct.calcsize(_HEAD) + 4 or data[:4] != _MAGIC:
        raise ValueError("not a token segment")
    _, documents, tokens, block, blocks, highest = struct.unpack_from(_HEAD, data)
    at = struct.calcsize(_HEAD)
    places = np.cumsum([at, 8 * documents, documents, 4 * documents, 8 * blocks]).tolist()
    if len(data) < places[-1] + 4 or struct.unpack_from("<I", data, places[-1])[0] != zlib.crc32(data[: places[-1]]):
        raise ValueError("the directory of a token segment is damaged")
    names = np.frombuffer(data[places[0] : places[1]], "<i8")
    absent = np.frombuffer(data[places[1] : places[2]], np.uint8).astype(bool)
    lengths = np.frombuffer(data[places[2] : places[3]], "<u4").astype(np.int64)
    table = np.frombuffer(data[places[3] : places[4]], "<u4").reshape(-1, 2).tolist()
    coded, at = [], places[-1] + 4
    for i, (size, check) in enumerate(table):
        coded.append(data[at : at + size])
        at += size
        if zlib.crc32(coded[-1]) != check:
            raise ValueError(f"block {i} of a token segment is damaged")
    return names, absent, lengths, rangecoder.decode(coded, tokens, highest, block)


def segment_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """(id, text) in order to (part, number, start in part, tokens, segment)."""
    encoder, part = ChunkEncoder.of_worker(path), TaskContext.get().partitionId()
    names, codes, tokens, number, start = [], [], 0, 0, 0
    end = np.array([end_id], "<u4").tobytes()

    def close() -> pa.RecordBatch:
        lengths = np.array([len(c) // 4 for c in codes], np.int64)
        known = np.array([n if n is not None else 0 for n in names], np.int64)
        data = pack(known, np.array([n is None for n in names]), lengths, np.frombuffer(b"".join(codes), "<u4"))
        values = ([part], [number], [start], [tokens], [data])
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], names=["part", "number", "start", "tokens", "segment"])

    for batch in portions(batches, 1):
        names += batch.column(0).to_pylist()
        fresh = [c + end for c in encoder.encode([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()])]
        codes += fresh
        tokens += sum(len(c) // 4 for c in fresh)
        if tokens >= SEGMENT:
            yield close()
            names, codes, number, start, tokens = [], [], number + 1, start + tokens, 0
    if names:
        yield close()


def document_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(start, segment) to (id, start, ids)."""
    for batch in batches:
        for start, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            names, absent, lengths, ids = unpack(data.as_py())
            offsets = np.concatenate(([0], np.cumsum(lengths)))
            coded = pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer((4 * offsets).astype(np.int32).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(names, mask=absent), pa.array(start + offsets[:-1]), coded], names=["id", "start", "ids"])


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int = 2, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encodes every text, adds ``end_id``, and writes the ids below ``folder`` in ascending order of document ids.

    Documents are dealt to tasks by ranges of their ids and sorted there; a task codes one segment
    after another, and Spark's writer stores them, so any file system and lost executors are its
    matter. Null texts have the end id alone; a null id comes first; repeated ids stay neighbours.
    Ids of documents are whole numbers. Other columns are ignored.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id")
    ordered.mapInArrow(lambda b: segment_batches(b, path, end_id), "part int, number int, start long, tokens long, segment binary").write.parquet(folder)


def read_tokens(spark, folder: str, id_column: str = "doc_id") -> DataFrame:
    """(id, start, ids) of the documents below ``folder``: ``start`` counts the ids of all documents before, the
    ids are little-endian unsigned 32-bit integers. A block whose checksum is wrong is an error.
    """
    segments = spark.read.parquet(folder)
    parts = segments.groupBy("part").agg(F.sum("tokens").alias("tokens"))  # a row for each task that wrote
    before = parts.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("before"))
    placed = segments.join(before, "part").select((F.col("start") + F.col("before")).alias("start"), "segment")
    return placed.mapInArrow(document_batches, "id long, start long, ids binary").withColumnRenamed("id", id_column)
