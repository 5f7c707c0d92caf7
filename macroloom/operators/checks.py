"""Contract checks that cost no pass of their own: counted by the job that writes the rows."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from macroloom.operators.observations import named
from macroloom.work import refuse_rows, stored


def staged(df: DataFrame, purpose: str, message: str) -> tuple[DataFrame, dict]:
    """The frame, written, and what the write saw: ``rows``, ``faults`` and ``null <column>`` for every column.

    Rows with a text in ``__faults`` (``strict_lookup(check="flag")``) are an error. Its report comes from the
    written table, so the frame is computed once whether it is sound or not.
    """
    if "__faults" not in df.columns:
        df = df.withColumn("__faults", F.lit(None).cast("string"))
    columns = [c for c in df.columns if c != "__faults"]
    seen = Observation(purpose)
    nulls = [F.count(F.when(named(c).isNull(), 1)).alias(f"null {c}") for c in columns]
    out = stored(df.observe(seen, F.count("*").alias("rows"), F.count("__faults").alias("faults"), *nulls), purpose)
    counts = seen.get
    if counts["faults"]:
        refuse_rows(out.filter(F.col("__faults").isNotNull()).select("__faults").distinct(), message)
    return out.select(*[named(c) for c in columns]), counts
