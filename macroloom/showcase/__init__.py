"""Every operator bound to the driver's tables, each with the SQL that has to give the same rows.

The driver's tables hold no macro data, so each query renames their columns to what an operator
expects. All of them run over whole tables.
"""

from macroloom.showcase import (
    alignment,
    comparison,
    documents,
    feeds,
    joins,
    releases_served,
    serving,
    storage,
    values,
    vocabularies,
)
from macroloom.showcase.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "alignment",
    "comparison",
    "documents",
    "feeds",
    "joins",
    "releases_served",
    "serving",
    "storage",
    "values",
    "vocabularies",
]
