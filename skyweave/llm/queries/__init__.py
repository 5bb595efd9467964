"""The operators bound to the given tables, with SQL texts where SQL can express them."""

from skyweave.llm.queries.registry import ORACLES, QUERIES, load

load()

__all__ = ["ORACLES", "QUERIES"]
