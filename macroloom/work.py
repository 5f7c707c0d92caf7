"""Where jobs keep tables of their own, and what has been landed."""

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_local_root = None


def work_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only in a local session, where driver and executors are one machine, a temporary folder takes
    the place of an absent setting. On a cluster its absence is an error.
    """
    global _local_root
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="macroloom-")
    return _local_root


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A folder name of its own under the work root (nothing is created yet)."""
    return f"{work_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table of its own under the work root.

    For a frame that several later steps read: it is computed once, its lineage ends, a lost
    executor costs nothing that was written, and its true size is known to the planner.
    """
    folder = new_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over as many partitions as this session's shuffles have.

    For parsing that costs far more than a shuffle of its input.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def inline(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A handful of rows as an inline relation.

    Unlike a frame made of a Python list its size is known to the planner, so that joining it does
    not shuffle the other side.
    """
    columns = T.StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], columns)

    def literal(value):
        if value is None:
            return "NULL"
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else repr(value)

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f"`{c.name}`" for c in columns)
    found = spark.sql(f"SELECT * FROM VALUES {values} AS rows({names})")
    return found.select(*[F.col(f"`{c.name}`").cast(c.dataType).alias(c.name) for c in columns])


def refuse_rows(df: DataFrame, message: str, error: type[Exception] = ValueError) -> None:
    """Raises ``error`` if the frame has rows, with their exact number and where all of them are written.

    The message lists the first rows in order too, as many as fit on a screen; the table has the rest.
    """
    if df.isEmpty():
        return
    table = stored(df, "refused")
    number = table.count()
    listed = [tuple(r) if len(df.columns) > 1 else r[0] for r in table.orderBy(*table.columns).limit(100).collect()]
    raise error(f"{message}: {listed} ({number} in all, in {table.inputFiles()[0].rsplit('/', 1)[0]})")


def landed(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, length, modified) of landed files. File contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    try:
        found = reader.load(folder)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")
    return found.select("path", "length", F.col("modificationTime").alias("modified"))
