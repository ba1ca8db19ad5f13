"""Registered queries."""

from . import ingest_queries, series_queries, table_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
