"""Pinned results: a table of versions, of which readers take the newest one that is young enough.

A version is one row in one file, so it becomes visible by a single rename and is never seen in
parts. Rows are partitioned by the day they were made on, so a reader lists the days of a
lifetime and nothing older. Versions are never changed; two writers leave two versions, and all readers
choose the same one.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = "made_on date, made_at timestamp, version_id string"


def publish(entries: DataFrame, root: str, now=None) -> None:
    """Append a version that holds the rows of ``entries``, in order. For tables of few rows."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    held = F.collect_list(F.struct(*entries.columns)).alias("entries")
    row = entries.coalesce(1).agg(held).select(F.to_date(stamp).alias("made_on"), stamp.alias("made_at"), F.lit(uuid.uuid4().hex).alias("version_id"), "entries")
    row.coalesce(1).write.mode("append").partitionBy("made_on").parquet(root)


def newest(spark: SparkSession, root: str, entries: T.StructType, ttl_seconds: int, now=None) -> list[Row] | None:
    """Entries of the newest version younger than the lifetime, by one job; None where there is none.

    A stamp in the future counts as age zero.
    """
    present = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    oldest = F.timestamp_seconds(F.unix_micros(present) / 1_000_000 - ttl_seconds)
    schema = T.StructType([*T.StructType.fromDDL(KEYS).fields, T.StructField("entries", T.ArrayType(entries))])
    try:
        versions = spark.read.schema(schema).parquet(root)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return None
    # A version may have been made just before midnight, hence the comparison of days with >=.
    young = versions.filter((F.col("made_on") >= F.to_date(oldest)) & (F.col("made_at") > oldest))
    found = young.collect()
    if not found:
        return None
    return max(found, key=lambda r: (r["made_at"], r["version_id"]))["entries"]
