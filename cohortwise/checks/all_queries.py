"""Imports every query module so that all queries are registered."""

from cohortwise.checks import q_aggregates, q_joins, q_metrics, q_models, q_pathway, q_reports, q_select, q_sources  # noqa: F401
from cohortwise.checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
