"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macroloom import work


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table in the shared work folder.

    Cuts the lineage: an executor lost later costs no earlier step. The shuffle files of the
    finished step are freed as soon as the driver collects its garbage, which is asked for here
    because a small driver heap may otherwise keep them for the rest of the job.
    """
    out = work.stored(df, purpose)
    out.sparkSession.sparkContext._jvm.System.gc()
    return out


#: 64-bit words of a filter; those that mark nothing are left out (a full one is some 30 MB where it is broadcast).
FILTER_WORDS = 1 << 20


def _marked(df: DataFrame, column: str, wanted: DataFrame, how: str) -> tuple[DataFrame, Column]:
    """``df`` joined with the marks of ``wanted``, and whether a row's value is marked."""

    def word_and_bit(value):
        place = F.pmod(F.xxhash64(value), F.lit(64 * FILTER_WORDS))
        return F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))

    word, bit = word_and_bit(wanted[wanted.columns[0]])
    marks = wanted.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("marks"))
    word, bit = word_and_bit(df[column])
    return df.join(F.broadcast(marks), word == marks["word"], how), bit.bitwiseAND(marks["marks"]) != 0


def may_be_in(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows whose value in ``column`` is in the one column of ``wanted``, and a few others.

    For use before an exact join: the rows that it would drop are not shuffled. The values are marked
    by hash in a table of bits whose size has a bound, which is why it may be broadcast. Beyond that
    bound more rows pass than need to; none that is wanted is ever dropped. Null is a value like others.
    """
    joined, marked = _marked(df, column, wanted, "inner")
    return joined.where(marked).select(*[df[c] for c in df.columns])


def cannot_be_in(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows that ``may_be_in`` leaves out: for these an exact join has no partner."""
    joined, marked = _marked(df, column, wanted, "left")
    return joined.where(~F.coalesce(marked, F.lit(False))).select(*[df[c] for c in df.columns])


def portions(batches: Iterator[pa.RecordBatch], column: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into runs of rows whose texts together have at most ``most`` bytes, or single rows.

    Workers outlive their tasks, so what Arrow holds of batches that are done with is given back with each one.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.columns[column]), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if i > start and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)
        del batch
        pa.default_memory_pool().release_unused()


def runs(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each run, ``count`` of them, one run after the other."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)
