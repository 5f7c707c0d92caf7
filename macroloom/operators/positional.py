"""Row numbers and ordinal pairing that do not put a whole group into one task.

A plain ``row_number`` over a group sorts the group in one task, and one file or user may hold
a third of all rows. ``ordinal`` cuts a group into consecutive chunks, numbers the rows of each
chunk on its own, and shifts them by the number of rows in the chunks before, which is a window
over one count per chunk.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macroloom.operators.observations import named

CHUNK_WIDTH = 65_536


def ordinal(df: DataFrame, group, order, out: str, chunk: Column | None = None) -> DataFrame:
    """Add ``out``: the 0-based position of each row of its group in ``order``.

    ``order`` is a list of column names that identify a row within its group. ``chunk`` has to
    grow with the first of them (rows of a smaller chunk come first); it defaults to
    ``order[0] div 65536`` for an integer position.
    """
    if chunk is None:
        chunk = F.floor(named(order[0]) / CHUNK_WIDTH)
    group_key = F.struct(*[named(g) for g in group]) if group else F.struct(F.lit(0).alias("all"))
    # One struct of group and chunk: a struct equals itself even where a part of it is null.
    tagged = df.withColumn("__at", F.struct(group_key.alias("group"), chunk.alias("chunk")))
    before = Window.partitionBy("__at.group").orderBy("__at.chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        tagged.groupBy("__at")
        .agg(F.count("*").alias("__n"))
        .select("__at", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    inside = Window.partitionBy("__at").orderBy(*[named(o) for o in order])
    return (
        tagged.withColumn("__inside", F.row_number().over(inside) - 1)
        .join(starts, "__at")
        .withColumn(out, (F.col("__start") + F.col("__inside")).cast("bigint"))
        .drop("__at", "__start", "__inside")
    )


def first_occurrences(df: DataFrame, group, columns, position: str) -> DataFrame:
    """Distinct ``columns`` per group, each with the position it is first seen at."""
    return df.groupBy(*[named(c) for c in [*group, *columns]]).agg(F.min(named(position)).alias(position))


def pair_by_ordinal(left, right, group, left_order, right_order, how, out="ordinal", chunks=(None, None)):
    """Pair the k-th left row with the k-th right row of the same group.

    ``how='full'`` pads the shorter side with nulls; ``how='left'`` drops surplus right rows.
    The order columns themselves are dropped, the ordinal is kept as ``out``.
    """
    a = _numbered(left, group, left_order, out, chunks[0])
    b = _numbered(right, group, right_order, out, chunks[1])
    a_values = [c for c in left.columns if c not in [*group, *left_order]]
    b_values = [c for c in right.columns if c not in [*group, *right_order]]
    joined = a.alias("a").join(b.alias("b"), "__pair", how)
    return joined.select("__pair.*", *[F.col(f"a.`{c}`") for c in a_values], *[F.col(f"b.`{c}`") for c in b_values])


def pair_classes(entries: DataFrame, group, position: str, left_columns, right_columns, how, out="ordinal") -> DataFrame:
    """As ``pair_by_ordinal`` for two classes of rows of one frame: ``is_left`` tells them apart.

    Both classes are numbered in one pass, with one table of the rows before each chunk, and an
    aggregate puts the k-th rows of both beside each other: the frame is not joined with itself.
    ``position`` is a whole number that no two rows of a class and group share.
    """
    numbered = ordinal(entries, [*group, "is_left"], [position], out)
    is_left = F.col("is_left")
    values = [F.max(F.when(is_left, named(c))).alias(c) for c in left_columns]
    values += [F.max(F.when(~is_left, named(c))).alias(c) for c in right_columns]
    paired = numbered.groupBy(*[named(g) for g in group], named(out)).agg(F.max("is_left").alias("is_left"), *values)
    return (paired if how == "full" else paired.filter("is_left")).drop("is_left")


def _numbered(df, group, order, out, chunk):
    numbered = ordinal(df, group, order, out, chunk)
    # A struct key equals itself even where a group column is null.
    return numbered.withColumn("__pair", F.struct(*[named(g) for g in group], named(out)))


def rows_labelled(df: DataFrame, parts: Column, label: str, label_at=0, value_at=1, out="value") -> DataFrame:
    """Rows whose label field equals ``label``, with their value field as ``out``."""
    at = label_at if isinstance(label_at, Column) else F.lit(label_at)
    return df.filter(F.get(parts, at) == label).withColumn(out, F.get(parts, F.lit(value_at)))


def without_labels(df: DataFrame, label: Column, excluded) -> DataFrame:
    """Drop rows labelled with one of ``excluded``; a row without a label stays."""
    return df.filter(F.coalesce(~label.isin(list(excluded)), F.lit(True)))


def header_positions(headers: DataFrame, header: str, wanted: dict) -> DataFrame:
    """Per header row, the 0-based index of each wanted column (-1 where it is missing)."""
    index = {out: (F.array_position(named(header), name) - 1).cast("int") for name, out in wanted.items()}
    return headers.withColumns(index).drop(header)


def require_columns(positions: DataFrame, wanted: dict) -> dict | None:
    """KeyError for the first wanted column that some header row lacks.

    Returns the index of each wanted column if it is the same in all header rows, else None.
    """
    ends = [f(named(out)).alias(f"{name}_{out}") for out in wanted.values() for name, f in (("min", F.min), ("max", F.max))]
    found = positions.agg(*ends).first()
    for name, out in wanted.items():
        if found[f"min_{out}"] is not None and found[f"min_{out}"] < 0:
            raise KeyError(f"Missing required column: {name}")
    same = all(found[f"min_{out}"] == found[f"max_{out}"] for out in wanted.values())
    return {out: found[f"min_{out}"] for out in wanted.values()} if same else None
