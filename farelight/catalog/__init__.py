"""Registered queries: every operator over the test tables, with equivalent SQL."""

from farelight.catalog import (  # noqa: F401
    features,
    geometry,
    joins,
    learning,
    quality,
    sequences,
    storage,
    summaries,
    texts,
)
from farelight.catalog.registry import FITTED, ORACLES, QUERIES

__all__ = ["FITTED", "ORACLES", "QUERIES"]
