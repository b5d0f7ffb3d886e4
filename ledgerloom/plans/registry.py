"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from . import almanac, captures, finder, learning, panel, profiling, retail, vectors

AREAS = (retail, panel, captures, almanac, vectors, profiling, learning, finder)

QUERIES = {name: query for area in AREAS for name, query in area.QUERIES.items()}
ORACLES = {name: sql for area in AREAS for name, sql in area.ORACLES.items()}
