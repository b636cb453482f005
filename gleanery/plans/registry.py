"""Queries by name and their SQL."""

from __future__ import annotations

from . import extraction, guides, relations, rules, scalars, schedules  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
