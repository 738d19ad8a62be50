"""Registered queries, fixtures and the daily plan."""

from seriesforge.plans import audit_queries, ingest_queries, model_queries, risk_queries, series_queries
from seriesforge.plans.registry import ORACLES, QUERIES

flagship = QUERIES["c14_scoring_frame"]

__all__ = ["ORACLES", "QUERIES", "audit_queries", "flagship", "ingest_queries", "model_queries", "risk_queries", "series_queries"]
