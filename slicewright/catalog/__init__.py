"""Queries over the test tables that exercise every operator, with their oracles."""

from slicewright.catalog import (  # noqa: F401  (each module registers its queries)
    checks,
    control,
    joins,
    loads,
    scalars,
    sinks,
    sources,
    versioned,
)
from slicewright.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
