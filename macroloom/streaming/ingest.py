"""Incremental ingest: files that land are aligned once and become snapshot partitions."""

import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macroloom.operators.observations import named
from macroloom.sources.snapshots import PARTITION_TYPES, read_partitioned, write_snapshot
from macroloom.work import stored

#: Folder of a store, hidden from readers of the batches: its log and the compacted partitions.
STATE = "_state"
LOG_SCHEMA = "kind string, batch bigint, at timestamp, generation string, types string, parts array<struct<part:string,generation:string>>"


def landed_stream(spark: SparkSession, path: str, schema, fmt="csv", files_per_trigger: int | None = None, **options):
    """Stream of landed files of one format."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def _optional(read):
    try:
        return read()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return None


def _log(spark: SparkSession, store: str) -> Row | None:
    """Newest finished batch, types of the partition columns, and the newest compaction, from the store's log."""
    log = _optional(lambda: spark.read.schema(LOG_SCHEMA).parquet(f"{store}/{STATE}/log"))
    if log is None:
        return None
    is_batch = F.col("kind") == "batch"
    return log.agg(
        F.max("batch").alias("newest"),
        F.max_by(F.when(is_batch, F.col("types")), F.when(is_batch, F.struct("batch", "at"))).alias("types"),
        F.max_by(F.when(~is_batch, F.struct("batch", "parts")), F.when(~is_batch, F.struct("batch", "at"))).alias("compaction"),
    ).first()


def _append_log(spark: SparkSession, store: str, entry: DataFrame) -> None:
    """One row in one file: it becomes visible by a single rename, so readers see all of it or nothing."""
    entry = entry.withColumn("at", F.current_timestamp())
    fields = T.StructType.fromDDL(LOG_SCHEMA)
    columns = [F.col(f.name).cast(f.dataType) if f.name in entry.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    entry.select(*columns).coalesce(1).write.mode("append").parquet(f"{store}/{STATE}/log")


def _part(partitions):
    return F.to_json(F.struct(*[named(p).cast("string").alias(p) for p in partitions]))


def _same(left, right, observation):
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"__{c}"]) for c in observation])


def _newest(rows: DataFrame, observation) -> DataFrame:
    """Each observation as the newest batch that holds it has it; one shuffle, or none where all rows are of one batch."""
    if len(rows.select("batch").distinct().limit(2).collect()) < 2:
        return rows
    newest = F.max("batch").over(Window.partitionBy(*[named(c) for c in observation]))
    return rows.withColumn("__newest", newest).filter(F.col("batch") == F.col("__newest")).drop("__newest")


class _Store(NamedTuple):
    """Rows of finished batches since the last compaction, and the compacted rows (None where there are none)."""

    deltas: DataFrame | None
    base: DataFrame | None
    parts: DataFrame | None
    newest: int | None
    types: dict


def _open(spark: SparkSession, store: str) -> _Store:
    log = _log(spark, store)
    types = {f.name: f.dataType for f in T.StructType.fromDDL(log["types"])} if log and log["types"] else PARTITION_TYPES
    landed = _optional(lambda: read_partitioned(spark, store, types))
    if log is None:
        return _Store(landed, None, None, None, types)
    deltas = landed.filter(F.col("batch") <= log["newest"])
    if log["compaction"] is None:
        return _Store(deltas, None, None, log["newest"], types)
    upto, listed = log["compaction"]
    deltas = deltas.filter(F.col("batch") > upto) if log["newest"] > upto else None
    parts = spark.createDataFrame([tuple(p) for p in listed], "part string, generation string")
    # Filters on partition columns alone, so that files of other generations are not opened; the log has the list anyway.
    compacted = read_partitioned(spark, f"{store}/{STATE}/compacted", {**types, "generation": T.StringType()})
    live = compacted.filter(F.col("generation").isin(sorted({p["generation"] for p in listed})))
    name = F.concat("generation", _part([p for p in types if p != "batch"]))
    base = live.filter(name.isin([p["generation"] + p["part"] for p in listed]))
    return _Store(deltas, base.drop("generation"), parts, log["newest"], types)


def read_ingested(spark: SparkSession, store: str, observation: Sequence[str]) -> DataFrame:
    """What the stream has stored, each observation as the newest batch that holds it has it.

    ``observation`` names the columns that tell observations apart. A restated file replaces the
    observations it repeats; a late file only adds its own. Batches that have not finished are not
    read. What ``compact_ingested`` has merged is read as it is; only batches since then are reduced.
    """
    opened = _open(spark, store)
    if opened.base is None:
        return _newest(opened.deltas, observation)
    if opened.deltas is None:
        return opened.base
    fresh = _newest(opened.deltas, observation)
    keys = _keys(fresh, observation)
    return opened.base.join(keys, _same(opened.base, keys, observation), "left_anti").unionByName(fresh)


def _keys(rows, observation):
    return rows.select(*[named(c).alias(f"__{c}") for c in observation]).distinct()


def compact_ingested(spark: SparkSession, store: str, observation: Sequence[str], sort_by: Sequence[str] = ()) -> bool:
    """Merge finished batches into compacted partitions; False if there was nothing to merge.

    Only partitions that new batches have rows for, or hold observations that they restate (by a hash
    of what tells observations apart), are written again, as a new generation beside the old one. One
    batch that nothing has been compacted before is copied as its files are, without a shuffle. One log row then names the generation of
    every partition. Until it is there readers follow the old row, so a crash in between leaves
    files that nobody reads and the next run merges anew. Files of old generations may be removed
    when no reader uses them any more.
    """
    opened = _open(spark, store)
    if opened.deltas is None:
        return False
    partitions = [p for p in opened.types if p != "batch"]
    generation = uuid.uuid4().hex
    newest = _newest(opened.deltas, observation)
    fresh = newest if newest is opened.deltas else stored(newest, "ingest-deltas")
    touched = fresh.select(_part(partitions).alias("part"))
    rows = fresh
    if opened.base is not None:
        told = [named(c) for c in observation]
        common = opened.base.select(*told).unionByName(fresh.select(*told)).schema  # equal values have to hash alike
        mark = F.xxhash64(*[named(c).cast(common[c].dataType) for c in observation]).alias("__mark")
        restated = opened.base.select(_part(partitions).alias("part"), mark).join(fresh.select(mark).distinct(), "__mark", "left_semi")
        touched = stored(touched.union(restated.select("part")).distinct(), "ingest-parts")
        # As many names as partitions, which the log lists too; with them the other partitions are not read.
        keys, names = _keys(fresh, observation), [r["part"] for r in touched.collect()]
        kept = opened.base.filter(_part(partitions).isin(names))
        rows = kept.join(keys, _same(kept, keys, observation), "left_anti").unionByName(fresh)
    target = f"{store}/{STATE}/compacted"
    as_read = rows is opened.deltas
    write_snapshot(rows.withColumn("generation", F.lit(generation)), target, ["generation", *partitions], sort_by, rebalance=not as_read)
    written = read_partitioned(spark, target, {**opened.types, "generation": T.StringType()}).filter(F.col("generation") == generation)
    parts = written.select(_part(partitions).alias("part"), "generation").distinct()
    if opened.parts is not None:
        parts = parts.union(opened.parts.join(touched, "part", "left_anti"))
    listed = parts.agg(F.collect_list(F.struct("part", "generation")).alias("parts"))
    entry = listed.select(F.lit("compaction").alias("kind"), F.lit(opened.newest).alias("batch"), F.lit(generation).alias("generation"), "parts")
    _append_log(spark, store, entry)
    return True


def ingest_stream(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    store: str,
    checkpoint: str,
    partitions: Sequence[str],
    sort_by: Sequence[str] = (),
):
    """Start a query that writes whatever has landed and then stops.

    Each batch goes through ``transform`` and replaces only partitions of its own: ``batch`` is a
    partition column, so a batch that is run again after a failure overwrites what its first run
    left, and rows of one release that land in different batches do not replace each other. A row
    of the store's log says that a batch has finished.
    """
    keys = [*partitions, "batch"]  # ``read_ingested`` tells restated rows from rows that came late

    def write(batch: DataFrame, batch_id: int):
        frame = transform(batch).withColumn("batch", F.lit(batch_id).cast("bigint"))
        write_snapshot(frame, store, partitions=keys, sort_by=sort_by)
        types = ", ".join(f"`{k}` {frame.schema[k].dataType.simpleString()}" for k in keys)
        entry = batch.sparkSession.range(1).select(F.lit("batch").alias("kind"), F.lit(batch_id).alias("batch"), F.lit(types).alias("types"))
        _append_log(batch.sparkSession, store, entry)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
