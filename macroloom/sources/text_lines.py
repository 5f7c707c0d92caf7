"""Line-oriented feeds, read without losing the order of lines and without reading files whole."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macroloom.operators.positional import ordinal


def scan_lines(spark: SparkSession, path, pattern: str = "*") -> DataFrame:
    """(file, line_no, value) of every non-blank line, numbered from zero per file.

    A file may be split into blocks that different tasks read. Within a block the row id grows
    in file order, and blocks are ordered by their start, so lines are numbered per block and
    shifted by the lines of earlier blocks.
    """
    raw = spark.read.text(path, recursiveFileLookup=True, pathGlobFilter=pattern).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )
    lines = raw.filter(F.col("value").rlike(r"\S"))
    return ordinal(lines, ["file"], ["seq"], "line_no", chunk=F.col("block")).select("file", "line_no", "value")
