"""All registered queries: importing this module registers them."""

from tidemark.plans import q_books, q_core, q_data, q_metrics, q_risk  # noqa: F401
from tidemark.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
