"""Joins on keys of which one may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key with more than one in so many rows is heavy, so there are fewer heavy keys than this, whatever the table.
HEAVY = 1000


def join_counted(rows: DataFrame, groups: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Inner join of rows with groups, which has one row per key with its number of rows in ``count``.

    Heavy keys are joined by broadcast, so their rows stay where they are; no key of the others fills a task.
    """
    total = groups.agg(F.sum(count)).first()[0] or 0
    heavy = F.col(count) * HEAVY > total
    few = F.broadcast(groups.filter(heavy).drop(count))
    many = groups.filter(~heavy).drop(count)
    return rows.join(few, keys).unionByName(rows.join(few.select(*keys), keys, "left_anti").join(many, keys))
