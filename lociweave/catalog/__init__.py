"""Every operator as a query over the base tables."""

from lociweave.catalog import files, overlaps, predict, results, signals  # noqa: F401
from lociweave.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
