"""Registered queries over the driver tables, each beside its reference SQL."""

from homeload.queries import audit, documents, files, loads, rare_rules, streams, tasks, usage, weather  # noqa: F401
from homeload.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
