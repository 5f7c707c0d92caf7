"""Key-by-key comparison of two releases."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.operators.observations import named


def side_by_side(left, right, keys, columns) -> DataFrame:
    """Full outer join on unique keys, with presence flags and both copies of each column."""
    a = left.select(*[named(k).alias(f"__a{i}") for i, k in enumerate(keys)],
                    *[named(c).alias(f"{c}_left") for c in columns], F.lit(True).alias("__in_left"))
    b = right.select(*[named(k).alias(f"__b{i}") for i, k in enumerate(keys)],
                     *[named(c).alias(f"{c}_right") for c in columns], F.lit(True).alias("__in_right"))
    same = reduce(lambda x, y: x & y, [F.col(f"__a{i}").eqNullSafe(F.col(f"__b{i}")) for i in range(len(keys))])
    joined = a.join(b, same, "full")
    return joined.select(
        *[F.coalesce(F.col(f"__a{i}"), F.col(f"__b{i}")).alias(k) for i, k in enumerate(keys)],
        F.coalesce(F.col("__in_left"), F.lit(False)).alias("in_left"),
        F.coalesce(F.col("__in_right"), F.lit(False)).alias("in_right"),
        *[F.col(f"{c}_{side}") for c in columns for side in ("left", "right")],
    )


def parity(left, right, keys, columns, only_where_left=()) -> DataFrame:
    """Rows on which two releases disagree.

    ``differs`` lists the columns whose values differ (null equals null). A column in
    ``only_where_left`` is compared only where the left release has a value.
    """
    both = side_by_side(left, right, keys, columns)

    def unequal(c):
        a, b = F.col(f"{c}_left"), F.col(f"{c}_right")
        different = ~a.eqNullSafe(b)
        return (different & a.isNotNull()) if c in only_where_left else different

    in_both = F.col("in_left") & F.col("in_right")
    marks = F.array(*[F.when(in_both & unequal(c), F.lit(c)) for c in columns])
    flagged = both.withColumn("differs", F.array_compact(marks))
    return flagged.filter(~in_both | (F.size("differs") > 0))


def revision_share(left, right, keys, value, tolerance, by=()) -> DataFrame:
    """Overlapping observations, those revised beyond the tolerance, and their share."""
    a = left.select(*[named(k) for k in keys], named(value).alias("__left"))
    b = right.select(*[named(k) for k in keys], named(value).alias("__right"))
    revised = F.abs(F.col("__left") - F.col("__right")) > tolerance
    return (
        a.join(b, list(keys))
        .groupBy(*[named(c) for c in by])
        .agg(F.count("*").alias("n_overlap"), F.count_if(revised).alias("n_revised"))
        .withColumn("share", F.col("n_revised") / F.col("n_overlap"))
    )
