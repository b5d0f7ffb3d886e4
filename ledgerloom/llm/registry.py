"""All queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
