"""Operators bound to the given tables, each with a SQL text that must give the same rows."""

from skyweave.queries import (  # noqa: F401
    change_data,
    evaluation,
    feature_tables,
    learning,
    profiling,
    quality,
    regional,
    sequences,
    sources,
    streams,
)
from skyweave.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
