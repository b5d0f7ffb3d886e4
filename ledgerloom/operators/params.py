"""Small tables handed over by the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def parameter_table(spark: SparkSession, rows: Sequence[tuple], columns: dict[str, str]) -> DataFrame:
    """A list from the caller as a table with the given columns and types; it becomes part of the plan."""
    fields = list(columns.items())
    structs = [F.struct(*[F.lit(v).cast(t).alias(c) for v, (c, t) in zip(row, fields)]) for row in rows]
    empty = F.lit(None).cast("array<struct<" + ", ".join(f"`{c}`: {t}" for c, t in fields) + ">>")
    return spark.range(1).select(F.inline(F.array(*structs) if structs else empty))
