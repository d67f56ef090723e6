"""Registered queries over the test tables, each with its DuckDB twin where SQL can say it."""

from shelfsight.plans import (  # noqa: F401  (importing registers the queries)
    forecast_queries,
    inventory_queries,
    io_queries,
    model_queries,
    reorder_queries,
    sales_queries,
    series_queries,
)
from shelfsight.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
