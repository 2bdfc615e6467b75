"""Registered query plans and their DuckDB oracles."""

from streamkit.plans.queries import QUERIES
from streamkit.plans.oracle import ORACLE

__all__ = ["QUERIES", "ORACLE"]
