"""Queries over the given tables, one per operator, each with its SQL twin."""

from . import catalog_q, chart_q, clean_q, cluster_q, model_q, profile_q, stats_q  # noqa: F401
from .core import FIX, REGISTRY, TABLES, Tables, query  # noqa: F401
