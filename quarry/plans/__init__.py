"""Fixtures over the driver tables, the query catalog and its SQL oracles."""

from quarry.plans.catalog import QUERIES
from quarry.plans.oracle import oracle_sql

__all__ = ["QUERIES", "oracle_sql"]
