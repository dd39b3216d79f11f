"""Registered queries over the given tables, each with the SQL that checks it."""

from ledger_queries import checks, exchange, parsing, published, reshaping, tables  # noqa: F401  (they register)
from ledger_queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
