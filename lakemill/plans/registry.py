"""Registered queries of the library and their DuckDB oracles."""

from __future__ import annotations

import lakemill.plans.table_queries  # noqa: F401  (registers its queries beside the others)
from lakemill.plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
