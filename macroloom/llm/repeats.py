"""Passages that an earlier document has already, byte by byte, by refining buckets of suffixes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from macroloom.llm.common import portions, stored

#: Bytes of a repeated string.
LENGTH = 50
#: Bytes of the strings that name the initial buckets. A string of LENGTH bytes holds REACH of them.
FIRST = 24
REACH = LENGTH - FIRST + 1

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
_BYTE_NAMES = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64)


def refine(names: np.ndarray, offset: int) -> np.ndarray:
    """Bucket names of longer prefixes: the name at each place with the name of the bucket ``offset`` later."""
    n = len(names) - offset
    out = names[:n] * _ODD[0]
    out ^= names[offset:] * _ODD[1] >> np.uint64(7)
    out ^= out >> np.uint64(31)
    out *= _ODD[2]
    out ^= out >> np.uint64(29)
    return out


def bucket_names(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the buckets of the first FIRST and of the first LENGTH bytes of each suffix.

    Every refinement reuses the names that the one before it has just given to later offsets, so
    50 bytes take six steps: 2, 4, 8, 16, 32, and 50 from two of 32 that overlap.
    """
    one = _BYTE_NAMES[data]
    sixteen = refine(refine(refine(refine(one, 1), 2), 4), 8)
    return refine(sixteen, FIRST - 16), refine(refine(sixteen, 16), LENGTH - 32)


def least(names: np.ndarray) -> np.ndarray:
    """Least of each REACH consecutive names."""
    width, out = 1, names
    while 2 * width <= REACH:
        out, width = np.minimum(out[:-width], out[width:]), 2 * width
    return np.minimum(out[: len(out) - (REACH - width)], out[REACH - width :]) if width < REACH else out


def runs(texts: Sequence[bytes]) -> tuple[np.ndarray, ...]:
    """(text, first place, places, bucket, content) of runs of places whose LENGTH-byte strings share their least bucket.

    ``content`` names all the bytes that the strings of a run cover, so runs of equal bucket and
    content are equal strings at equal places. A run has at most REACH places.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int32, np.int32, np.uint64, np.uint64))
    first, whole = bucket_names(data)
    bucket = least(first)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    counts = np.maximum(sizes - LENGTH + 1, 0)
    have = np.flatnonzero(counts)
    at = np.concatenate([np.arange(starts[i], starts[i] + counts[i]) for i in have]) if len(have) else np.zeros(0, np.int64)
    if not len(at):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int32, np.int32, np.uint64, np.uint64))
    owner = np.repeat(have, counts[have])
    own = bucket[at]
    new = np.concatenate(([True], (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])))
    begin = np.flatnonzero(new)
    since = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    begin = np.flatnonzero(since % REACH == 0)
    places = np.diff(np.append(begin, len(at)))
    a, b = whole[at[begin]], whole[at[begin] + places - 1]
    content = (a * _ODD[1] ^ (b + places.astype(np.uint64)) * _ODD[0]) * _ODD[2]
    content ^= content >> np.uint64(32)
    return owner[begin], (at[begin] - starts[owner[begin]]).astype(np.int32), places.astype(np.int32), own[begin], content


def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, first, places, bucket, content)."""
    for batch in portions(batches, 1):
        owner, first, places, bucket, content = runs([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()])
        columns = [batch.column(0).take(pa.array(owner)), pa.array(first), pa.array(places), pa.array(bucket.view(np.int64)), pa.array(content.view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "first", "places", "bucket", "content"])


def string_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, runs) to (id, first, bucket, name) of every single string in the runs."""
    for batch in portions(batches, 1, 256 << 10):
        texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
        offsets = np.cumsum([0] + [len(t) for t in texts])
        data = np.frombuffer(b"".join(texts), np.uint8)
        if len(data) < LENGTH:
            continue
        _, whole = bucket_names(data)
        wanted = batch.column(2)
        many = np.diff(wanted.offsets.to_numpy())
        flat = wanted.flatten()
        first, places, bucket = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("first", "places", "bucket"))
        row = np.repeat(np.repeat(np.arange(len(texts)), many), places)
        start = np.repeat(first, places) + (np.arange(len(row)) - np.repeat(np.cumsum(places) - places, places))
        names = whole[offsets[row] + start].view(np.int64)
        for i in range(0, len(row), 1 << 16):
            part = slice(i, i + (1 << 16))
            columns = [batch.column(0).take(pa.array(row[part])), pa.array(start[part].astype(np.int32)), pa.array(np.repeat(bucket, places)[part]), pa.array(names[part])]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "first", "bucket", "name"])


def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, spans) to (id, n_bytes, spans merged, kept)."""
    for batch in portions(batches, 1):
        out = []
        for text, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
            text, whole = text or b"", []
            for first, after in sorted((s["first"], s["after"]) for s in spans or ()):
                if whole and first <= whole[-1]["after"]:
                    whole[-1]["after"] = max(whole[-1]["after"], after)
                else:
                    whole.append({"first": first, "after": after})
            edges = [0, *(x for s in whole for x in (s["first"], s["after"])), len(text)]
            out.append((len(text), whole, b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))))
        spans = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))
        columns = [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], spans), pa.array([x[2] for x in out], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, spans, kept) of every document: ``spans`` of bytes covered by a 50-byte string that
    also starts in a document of a smaller id, merged where they touch, and the bytes kept.

    Suffixes are put into buckets by their first 24 bytes. Of the 27 such buckets within a 50-byte
    string the one of least name stands for the string, so that neighbouring strings mostly share
    one and travel as one run, with a name of all the bytes it covers. Buckets are names instead of
    ranks: a name of twice the length is made of the names at two offsets, as refinement by the
    buckets of later offsets does, and equal strings have equal names in all tasks. One shuffle
    brings the runs of a bucket together. A run whose bytes an earlier document has at the same
    place is settled as a whole. The bucket is refined to the single strings only where it holds
    different contents from several documents, which is at the edges of passages.

    A string is told by two names of 64 bits. Null texts are empty; texts under 50 bytes have no
    strings. Ids have to be distinct and not null: rows of equal id are one document's parts to
    this operator, and a null id is earlier than none and later than none, so such a row is kept
    whole. Other columns are ignored.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = dict(docs.dtypes)[id_column]
    found = rows.where(F.octet_length("text") >= LENGTH).mapInArrow(run_batches, f"id {kind}, first int, places int, bucket long, content long")
    same, bucket = Window.partitionBy("bucket", "content"), Window.partitionBy("bucket")
    judged = (
        found.where(F.col("id").isNotNull())
        .withColumn("earliest", F.min("id").over(same))
        .withColumn("low", F.min("content").over(bucket))
        .withColumn("high", F.max("content").over(bucket))
        .withColumn("from_id", F.min("id").over(bucket))
        .withColumn("to_id", F.max("id").over(bucket))
        .where((F.col("earliest") < F.col("id")) | ((F.col("low") != F.col("high")) & (F.col("from_id") < F.col("to_id"))))
        .select("id", "first", "places", "bucket", (F.col("earliest") < F.col("id")).alias("settled"))
    )
    judged = stored(judged, "repeats-runs")
    settled = judged.where("settled").select("id", "first", (F.col("first") + F.col("places") + (LENGTH - 1)).alias("after"))
    open_runs = judged.where("not settled").groupBy("id").agg(F.collect_list(F.struct("first", "places", "bucket")).alias("runs"))
    strings = rows.join(open_runs, "id").select("id", "text", "runs").mapInArrow(string_batches, f"id {kind}, first int, bucket long, name long")
    again = (
        strings.withColumn("earliest", F.min("id").over(Window.partitionBy("bucket", "name")))
        .where(F.col("earliest") < F.col("id"))
        .select("id", "first", (F.col("first") + LENGTH).alias("after"))
    )
    again = stored(again, "repeats-strings")  # frees the shuffled texts and strings before spans are gathered
    spans = stored(settled.union(again).groupBy("id").agg(F.collect_list(F.struct("first", "after")).alias("spans")), "repeats-spans")
    schema = f"id {kind}, n_bytes long, spans array<struct<first:int,after:int>>, kept binary"
    return rows.join(spans, "id", "left").select("id", "text", "spans").mapInArrow(cut_batches, schema).withColumnRenamed("id", id_column)
