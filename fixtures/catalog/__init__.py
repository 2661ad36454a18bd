"""Every operator as a query over the driver's tables, with its SQL twin for DuckDB."""

from fixtures.catalog import functions, keys, scores, tables  # noqa: F401  (they register on import)
from fixtures.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
