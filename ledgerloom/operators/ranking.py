"""Top-k reports, first row per key, shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(df: DataFrame, k: int, by: Column | str, ties: Sequence[str], ascending: bool = False) -> DataFrame:
    """The first ``k`` rows by a measure; ``ties`` must make the order unique.

    Runs as one top-k pass per partition and a merge, never as a full sort.
    """
    by = F.col(by) if isinstance(by, str) else by
    return df.orderBy(by.asc() if ascending else by.desc(), *ties).limit(k)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of each key by ``order``, then by all other columns.

    Spark keeps one row of each key per task before the shuffle, so a key with very many rows does no harm.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def share_of_total(df: DataFrame, value: str, out: str, decimals: int = 2) -> DataFrame:
    """Per cent of the column's sum.  For the few rows of a finished report."""
    everything = F.sum(value).over(Window.partitionBy())
    return df.withColumn(out, F.round(F.try_divide(F.col(value) * 100, everything), decimals))
