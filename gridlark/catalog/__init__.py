"""Registered queries and their SQL counterparts."""

from gridlark.catalog import cleaning, ensembles, features, fitting, models, profiling, runs  # noqa: F401
from gridlark.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
