"""Tables bucketed by a key: joins on it exchange neither side, however large both are.

Observations and series metadata of stored releases are joined again and again on the series key.
Written into the same number of buckets by it, they meet bucket by bucket.
"""

from pyspark.sql import DataFrame, SparkSession

from macroloom.operators.observations import named


def write_bucketed(df: DataFrame, path: str, table: str, keys, buckets: int = 64) -> DataFrame:
    """Write ``df`` as the external table ``table`` at ``path``: one sorted file a bucket."""
    rows = df.repartition(buckets, *[named(k) for k in keys])
    rows.write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, path: str, table: str, keys, buckets: int = 64) -> DataFrame:
    """A table that ``write_bucketed`` left at ``path``, made known to a session that has not written it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
