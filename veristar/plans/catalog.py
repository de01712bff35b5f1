"""All registered queries."""

from __future__ import annotations

from . import cleaning_queries, model_queries, profile_queries, text_queries  # noqa: F401  (registration)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
