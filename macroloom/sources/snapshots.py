"""Partitioned snapshot tables: the lasting form of an aligned release.

A snapshot is a partition keyed by what it was made from (scope, release, flow, flow version and
schema version), so a release that is served by another flow is another partition and never a
stale hit. Writing replaces the partitions it has rows for and leaves the others.
"""

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macroloom.operators.observations import named

log = logging.getLogger(__name__)
PARTITIONS = ["sublayer", "release_year", "release_month", "flow_id", "flow_version", "schema_version"]
PARTITION_TYPES = {p: T.IntegerType() if p == "release_year" else T.StringType() for p in PARTITIONS}
SCHEMA_VERSION = "1"
# Snapshot lifetimes in seconds: mapping, announcement date, data.
HOUR, DAY, WEEK = 3_600, 86_400, 604_800


def keyed(df, *, sublayer, release, flow_id="", flow_version="", schema_version=SCHEMA_VERSION) -> DataFrame:
    """Add the partition columns of one release as constants."""
    month, year = release
    parts = {
        "sublayer": sublayer, "release_year": int(year), "release_month": month,
        "flow_id": flow_id or "none", "flow_version": flow_version or "none", "schema_version": schema_version,
    }
    return df.withColumns({k: F.lit(v) for k, v in parts.items()})


def write_snapshot(df: DataFrame, root: str, partitions=tuple(PARTITIONS), sort_by=(), now=None, rebalance=True) -> None:
    """Replace the partitions ``df`` has rows for.

    Rows are rebalanced, so small partitions end up in one file and AQE splits a large one over
    several tasks; inside files they are sorted so that row groups can be skipped. Without ``rebalance``
    rows stay where they are: for those read from one snapshot, whose files are so already.
    """
    stamp = F.current_timestamp() if now is None else F.lit(now)
    rows = df if "ingested_at" in df.columns else df.withColumn("ingested_at", stamp)
    if rebalance:
        rows = rows.hint("rebalance", *[named(p) for p in partitions])
    if sort_by:
        rows = rows.sortWithinPartitions(*partitions, *sort_by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(root)


def read_snapshot(spark: SparkSession, root: str, **keys) -> DataFrame:
    """Snapshots with the given partition values; other partitions are pruned.

    The partition columns have set types. Inferred ones would take the flow versions 9.1 and 9.10
    for the same number.
    """
    df = read_partitioned(spark, root, sublayer=keys.get("sublayer"))
    for column, wanted in keys.items():
        df = df.filter(named(column) == F.lit(wanted))
    return df


def read_partitioned(spark: SparkSession, root: str, types=None, sublayer: str | None = None) -> DataFrame:
    """A partitioned table whose partition columns have the set types, or those of ``types``.

    Sublayers hold different datasets, so the columns are those of the one that is asked for.
    """
    types = PARTITION_TYPES if types is None else types
    path = root if sublayer is None else f"{root}/sublayer={sublayer}"
    try:
        found = spark.read.option("basePath", root).parquet(path).schema
    except AnalysisException as exc:
        if path == root or not any(reason in str(exc) for reason in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            raise
        return read_partitioned(spark, root, types)  # the store has no rows of this sublayer
    fields = [T.StructField(f.name, types.get(f.name, f.dataType)) for f in found]
    return spark.read.option("basePath", root).schema(T.StructType(fields)).parquet(path)


def fresh(df: DataFrame, ttl_seconds: int, now=None, stamp="ingested_at") -> DataFrame:
    """Rows younger than the lifetime; a stamp in the future counts as age zero."""
    present = F.current_timestamp() if now is None else now
    age = F.unix_micros(present.cast("timestamp")) - F.unix_micros(named(stamp).cast("timestamp"))
    return df.filter(F.greatest(age, F.lit(0)) < ttl_seconds * 1_000_000)


def clear_snapshots(spark: SparkSession, root: str, scope: str = "all") -> None:
    """Empty the partitions of one scope (``weo``, ``sdr``) or of all; others stay as they are.

    Writing no rows over a scope's folder removes what it held.
    """
    prefixes = {"all": "", "weo": "weo", "sdr": "sdr"}
    if scope not in prefixes:
        raise ValueError(f"scope must be one of {sorted(prefixes)}")
    try:
        stored = spark.read.option("basePath", root).parquet(root)
        sublayers = [r[0] for r in stored.select("sublayer").distinct().collect()]
    except AnalysisException as exc:
        log.info("nothing to clear under %s: %s", root, exc)
        return
    rest = [p for p in PARTITIONS if p != "sublayer"]
    no_rows = spark.createDataFrame([], stored.drop("sublayer").schema)
    for sublayer in sublayers:
        if sublayer.startswith(prefixes[scope]):
            no_rows.write.mode("overwrite").partitionBy(*rest).parquet(f"{root}/sublayer={sublayer}")
    spark.catalog.refreshByPath(root)
