"""Registered queries over the given tables, with the SQL that checks them."""

from . import analysis, checks, cleaning, joining, reporting, tracing  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
