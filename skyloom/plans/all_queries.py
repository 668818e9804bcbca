"""Imports every query module so that the registry is complete."""

from skyloom.plans import daily_queries, encode_queries, metric_queries, model_queries  # noqa: F401
from skyloom.plans.registry import ORACLES, QUERIES  # noqa: F401
