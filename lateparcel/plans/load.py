"""Importing this module fills the registry."""

from lateparcel.plans import (  # noqa: F401
    queries_metrics,
    queries_models,
    queries_profile,
    queries_sample,
    queries_tables,
)
from lateparcel.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
