"""Code lookups against dimension frames.

No join here carries a broadcast hint. A dimension is broadcast only when its size, estimated
by Catalyst or measured by AQE, is below ``spark.sql.autoBroadcastJoinThreshold``; a larger one
is shuffled, where AQE splits partitions that a frequent code makes too large.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.operators.observations import named
from macroloom.work import refuse_rows


def lookup(df: DataFrame, dim: DataFrame, on: dict, take: dict, null_safe=False) -> DataFrame:
    """Left join that adds ``take`` (dimension column -> output column); unmatched is null.

    ``on`` maps fact columns to dimension columns. The dimension holds each key once. An output
    column that the fact already has is replaced.
    """
    keys = {fact: f"__key{i}" for i, fact in enumerate(on)}
    side = dim.select(
        *[named(dim_col).alias(keys[fact]) for fact, dim_col in on.items()],
        *[named(src).alias(f"__out_{out}") for src, out in take.items()],
    )
    match = [
        named(fact).eqNullSafe(F.col(key)) if null_safe else named(fact) == F.col(key)
        for fact, key in keys.items()
    ]
    joined = df.join(side, reduce(lambda a, b: a & b, match), "left").drop(*keys.values())
    kept = [named(c) for c in df.columns if c not in take.values()]
    return joined.select(*kept, *[F.col(f"__out_{out}").alias(out) for out in take.values()])


def unmapped(df: DataFrame, dim: DataFrame, on: dict) -> DataFrame:
    """Distinct fact keys the dimension lacks. A key with a null part counts as lacking."""
    keys = dim.select(*[named(d).alias(f"__key{i}") for i, d in enumerate(on.values())]).distinct()
    wanted = df.select(*[named(f) for f in on]).distinct()
    match = [named(f) == F.col(f"__key{i}") for i, f in enumerate(on)]
    return wanted.join(keys, reduce(lambda a, b: a & b, match), "left_anti")


def mapped(df: DataFrame, dim: DataFrame, on: dict) -> DataFrame:
    """Rows whose key the dimension holds."""
    keys = dim.select(*[named(d).alias(f"__key{i}") for i, d in enumerate(on.values())])
    match = [named(f) == F.col(f"__key{i}") for i, f in enumerate(on)]
    return df.join(keys, reduce(lambda a, b: a & b, match), "left_semi")


def require_mapped(df: DataFrame, dim: DataFrame, on: dict, what: str) -> None:
    """ValueError with the keys the dimension lacks: how many, and the table that holds all of them."""
    refuse_rows(unmapped(df, dim, on), f"No mapping for {what}")


def repeated_keys(dim: DataFrame, keys) -> DataFrame:
    """Keys that several rows of a dimension share."""
    return dim.groupBy(*[named(k) for k in keys]).agg(F.count("*").alias("__n")).filter("__n > 1").drop("__n")


def strict_lookup(df, dim, on, take, what, check=True) -> DataFrame:
    """Lookup in which every fact key, nulls included, has to be in the dimension, and there only once.

    ``check=True`` runs one job over the distinct keys and raises before anything is built.
    ``check=False`` builds the same test into the plan, so that the job that uses the result
    fails on the first unmapped key, with no pass of its own; a stream needs this form.
    ``check="flag"`` fails nothing: rows that break the rule say why in ``__faults``, which
    ``operators.checks.staged`` counts in the job that writes them.
    """
    if check is True:
        refuse_rows(repeated_keys(dim, dict.fromkeys(on.values())), f"Repeated keys in the mapping for {what}")
        require_mapped(df, dim, on, what)
        return lookup(df, dim, on, take)
    keys = list(dict.fromkeys(on.values()))
    firsts = [F.first(named(c)).alias(c) for c in dict.fromkeys(take) if c not in keys]
    flagged = dim.groupBy(*[named(k) for k in keys]).agg(F.count("*").alias("__times"), *firsts).withColumn("__known", F.col("__times") == 1)
    key_text = F.concat_ws(", ", *[F.coalesce(named(f).cast("string"), F.lit("null")) for f in on])
    # The offending key is written down before the lookup replaces any of its parts.
    joined = lookup(df.withColumn("__key_text", key_text), flagged, on, {**take, "__known": "__known"})
    if check == "flag":
        fault = F.when(~F.coalesce("__known", F.lit(False)), F.concat(_fault(what), F.col("__key_text")))
        earlier = F.col("__faults") if "__faults" in df.columns else F.lit(None).cast("string")
        return joined.withColumn("__faults", F.coalesce(earlier, fault)).drop("__known", "__key_text")
    return _fail_unknown(joined, take, what).drop("__known", "__key_text")


def _fault(what):
    return F.when(F.col("__known").isNull(), f"No mapping for {what}: ").otherwise(f"Repeated keys in the mapping for {what}: ")


def _fail_unknown(joined, take, what):
    def guard(out):
        return F.when(F.col("__known"), named(out)).otherwise(
            F.raise_error(F.concat(_fault(what), F.col("__key_text"))).cast(
                joined.schema[out].dataType
            )
        )

    return joined.withColumns({out: guard(out) for out in take.values()})


def label_with_fallback(df, labels, fallback, code, out) -> DataFrame:
    """Label from the code list, else from the fallback table; a label the input has is ignored."""
    df = lookup(df, labels, {code: "code"}, {"label": out})
    df = lookup(df, fallback, {code: "code"}, {"label": "__fallback"})
    return df.withColumn(out, F.coalesce(named(out), F.col("__fallback"))).drop("__fallback")


def labels_of(codelists: DataFrame, agency: str, codelist_id: str) -> DataFrame:
    """(code, label) of one code list."""
    wanted = (F.col("agency") == agency) & (F.col("codelist_id") == codelist_id)
    return codelists.filter(wanted).select("code", "label")


def coded_column_label(df, codelists, column, out=None, agency="IMF.RES") -> DataFrame:
    """Label of a coded metadata column ``X`` from the code list that is named ``CL_X``."""
    return lookup(df, labels_of(codelists, agency, f"CL_{column}"), {column: "code"}, {"label": out or f"{column}_LABEL"})


def strict_inverse(mapping: DataFrame, source: str, target: str) -> DataFrame:
    """Mapping with its columns swapped; ValueError when two sources share a target."""
    require_one_to_one(mapping, target)
    return mapping.select(named(target), named(source))


def shared_targets(mapping: DataFrame, target: str) -> DataFrame:
    """Targets more than one row maps to."""
    return mapping.groupBy(named(target)).agg(F.count("*").alias("n")).filter("n > 1")


def require_one_to_one(mapping: DataFrame, target: str) -> None:
    """ValueError with the targets that several rows share: how many, and the table that holds all of them."""
    refuse_rows(shared_targets(mapping, target).select(named(target)), "The map is not one-to-one, shared targets")
