"""The library's operators applied to the given tables."""

from registry import basics, docs, retrieval, scalars, starbook, streams  # noqa: F401
from registry.book import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
