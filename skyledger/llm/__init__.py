"""Operators for training-data pipelines, their queries and checking SQL."""

from skyledger.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
