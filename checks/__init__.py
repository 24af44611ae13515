"""Registered queries with their SQL counterparts, and the inputs they share."""

from checks import cleaning, consolidation, extraction, loading, quality, whole_run  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
