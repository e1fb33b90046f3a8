"""All registered queries."""

from tidewick.plans import (  # noqa: F401
    catalog_io, catalog_memory, catalog_rules, catalog_series, catalog_texts,
    catalog_trades)
from tidewick.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
