from macroloom.operators import (
    codemap,
    lookup,
    metadata,
    observations,
    positional,
    profile,
    reconcile,
    releases,
)

__all__ = [
    "codemap",
    "lookup",
    "metadata",
    "observations",
    "positional",
    "profile",
    "reconcile",
    "releases",
]
