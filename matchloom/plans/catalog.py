"""All registered queries."""

from matchloom.plans import queries_analytics, queries_features, queries_models, queries_tables  # noqa: F401
from matchloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
