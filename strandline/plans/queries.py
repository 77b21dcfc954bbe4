"""Registered queries of the interval and embedding operators."""

from . import gate_queries, interval_queries, log_queries, pairing_queries, rule_queries, session_queries, sink_queries, vector_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
