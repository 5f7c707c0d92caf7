"""Series metadata: narrow, guard, join, repair.

Metadata may never add or remove an observation, so every join here is a left join onto a side
that was checked to hold each key once.
"""

import logging
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.functions.dates import actual_year, us_date
from macroloom.functions.text import null_if_not_applicable
from macroloom.operators.lookup import lookup
from macroloom.operators.observations import keys_first_text, named, with_null_metadata
from macroloom.schema import (
    FEED_RENAMES,
    METADATA_FIELDS,
    PRIVATE_METADATA_COLUMNS,
    SERIES_METADATA_JOIN_KEYS,
    SIDECAR_KEYS,
    SIDECAR_VALUES,
)

log = logging.getLogger(__name__)
KEYS = list(SERIES_METADATA_JOIN_KEYS)
RENAMED_KEYS = {k: FEED_RENAMES[k] for k in SIDECAR_KEYS}


def repeated_keys(df: DataFrame, keys) -> DataFrame:
    """Keys held by more than one row, with their row count. Null counts as equal to null."""
    return df.groupBy(*[named(k) for k in keys]).agg(F.count("*").alias("n")).filter("n > 1")


def has_repeated_keys(df: DataFrame, keys) -> bool:
    return not repeated_keys(df, keys).isEmpty()


def surplus_rows(df: DataFrame, keys) -> int:
    """Number of rows that repeat the key of another row."""
    return repeated_keys(df, keys).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()[0]


def derive_metadata_fields(df: DataFrame) -> DataFrame:
    """Raw metadata texts to the three typed contract columns."""
    return df.withColumns(
        {
            "LASTACTUALDATE": actual_year(F.col("LATEST_ACTUAL_ANNUAL_DATA")),
            "NOTES": null_if_not_applicable(F.col("METHODOLOGY_NOTES")),
            "COUNTRY_UPDATE_DATE": us_date(F.col("COUNTRY_UPDATE_DATE")),
        }
    ).drop("LATEST_ACTUAL_ANNUAL_DATA", "METHODOLOGY_NOTES")


def left_join_once(facts, dim, keys, values, scope=()) -> DataFrame:
    """Null-safe left join of ``values`` for one or, with ``scope`` columns, many releases at once.

    With a scope, the key carries the release columns, so no release sees the metadata of
    another, and a release whose metadata repeats a key gets nulls without affecting the others.
    The number of rows of such a release is decided inside the plan, not by a job of its own.
    """
    if scope:
        dim = without_repeating_scopes(dim, keys, scope)
    on = {c: c for c in [*scope, *keys]}
    return lookup(facts, dim, on, {v: v for v in values}, null_safe=True)


def without_repeating_scopes(dim: DataFrame, keys, scope) -> DataFrame:
    """Drop every scope (release) in which some key occurs twice."""
    spoiled = repeated_keys(dim, [*scope, *keys]).select(*[named(c).alias(f"__s_{c}") for c in scope]).distinct()
    same = reduce(lambda a, b: a & b, [named(c).eqNullSafe(F.col(f"__s_{c}")) for c in scope])
    return dim.join(spoiled, same, "left_anti")


def attach_series_metadata(facts, sidecar, scope=()) -> DataFrame:
    """Facts with LASTACTUALDATE, NOTES and COUNTRY_UPDATE_DATE from the series metadata.

    Degrades to typed nulls, with a warning, when the sidecar is absent (None), lacks a needed
    column or repeats a key: an annotation never costs the caller their observations.
    """
    needed = [*scope, *SIDECAR_KEYS, *SIDECAR_VALUES]
    absent = None if sidecar is None else [c for c in needed if c not in sidecar.columns]
    if sidecar is None or absent:
        log.warning("No usable series metadata (%s); its columns are null", absent or "not landed")
        return with_null_metadata(facts)
    narrow = sidecar.select(*[named(c) for c in needed]).withColumnsRenamed(RENAMED_KEYS)
    if not scope and has_repeated_keys(narrow, KEYS):
        log.warning("Series metadata repeats %s keys; it is left out", KEYS)
        return with_null_metadata(facts)
    derived = derive_metadata_fields(narrow)
    facts = facts.drop(*SIDECAR_VALUES, *METADATA_FIELDS)
    return left_join_once(facts, derived, KEYS, list(METADATA_FIELDS), scope)


def is_degraded(facts: DataFrame) -> bool:
    """True when all three metadata columns are null on every row."""
    populated = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in METADATA_FIELDS])
    return facts.filter(populated).isEmpty()


def repair_if_degraded(facts: DataFrame, sidecar: DataFrame) -> DataFrame:
    """Join the metadata again if the facts carry none at all; column order is kept."""
    if not is_degraded(facts):
        return facts
    return attach_series_metadata(facts.drop(*METADATA_FIELDS), sidecar).select(*[named(c) for c in facts.columns])


def repair_degraded_releases(facts, sidecar, scope) -> DataFrame:
    """Backfill over many releases: a release with no metadata on any row is joined again.

    Which releases are degraded is one partially aggregated flag per release. It narrows the
    sidecar, not the facts, to those releases, so healthy releases meet no metadata row and keep
    what they have, and the facts are joined once, on the full series key.
    """
    any_value = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in METADATA_FIELDS])
    degraded = (
        facts.groupBy(*[named(c).alias(f"__d_{c}") for c in scope])
        .agg(F.max(any_value).alias("__healthy"))
        .filter(~F.col("__healthy"))
    )
    same = reduce(lambda a, b: a & b, [named(c).eqNullSafe(F.col(f"__d_{c}")) for c in scope])
    fresh = derive_metadata_fields(
        sidecar.select(*[named(c) for c in [*scope, *SIDECAR_KEYS, *SIDECAR_VALUES]])
        .withColumnsRenamed(RENAMED_KEYS)
        .join(degraded, same, "left_semi")
    ).withColumnsRenamed({c: f"__new_{c}" for c in METADATA_FIELDS})
    joined = left_join_once(facts, fresh, KEYS, [f"__new_{c}" for c in METADATA_FIELDS], scope)
    # A degraded release is null throughout, so whatever it meets is what it gets.
    filled = {c: F.coalesce(F.col(c), F.col(f"__new_{c}")) for c in METADATA_FIELDS}
    return joined.withColumns(filled).select(*[named(c) for c in facts.columns])


def public_metadata(sidecar: DataFrame) -> DataFrame:
    """The metadata frame as served: private columns dropped, keys first, all text.

    ValueError when a key repeats, because a join on it would then fabricate observations.
    """
    frame = sidecar.drop(*PRIVATE_METADATA_COLUMNS).withColumnsRenamed(RENAMED_KEYS)
    frame = keys_first_text(frame, KEYS)
    surplus = surplus_rows(frame, KEYS)
    if surplus:
        raise ValueError(f"Series metadata has {surplus} row(s) with a duplicated {KEYS} key")
    return frame


def merge_public_metadata(facts, metadata, keys=tuple(KEYS)) -> DataFrame:
    """Facts with every metadata column; where both have a column, the fact's copy stays."""
    values = [c for c in metadata.columns if c not in keys]
    clash = [c for c in values if c in facts.columns]
    if clash:
        log.warning("Metadata columns %s are already in the facts, whose copies are kept", sorted(clash))
    values = [c for c in values if c not in clash]
    return lookup(facts, metadata, {k: k for k in keys}, {v: v for v in values}, null_safe=True)


def newest_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the one greatest in ``order``, by aggregation rather than a window."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[named(c) for c in rest]), F.struct(*[named(o) for o in order])).alias("__best")
    return df.groupBy(*[named(k) for k in keys]).agg(best).select(*[named(k) for k in keys], "__best.*")
