"""Wide and long tables, stacked years, key sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .params import parameter_table


def wide_to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def long_to_wide(
    df: DataFrame, ids: Sequence[str], name: str, value: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One column per member of ``name``.  Give ``columns`` to spare the pass that looks them up."""
    grouped = df.groupBy(*ids)
    pivoted = grouped.pivot(name, list(columns)) if columns else grouped.pivot(name)
    return pivoted.agg(F.first(value, ignorenulls=True))


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables under each other, columns matched by name, null where absent."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


Mapping = Sequence[tuple[int, int, str, str]]


def _mapping_table(long: DataFrame, mapping: Mapping) -> DataFrame:
    columns = {"year_from": "int", "year_to": "int", "_label": "string", "metric": "string"}
    return parameter_table(long.sparkSession, mapping, columns)


def map_headings(long: DataFrame, mapping: Mapping) -> DataFrame:
    """Give drifting headings their common metric name.

    ``long`` has ``year`` and ``label``; ``mapping`` lists (first year, last year, label,
    metric), one entry per spelling.  Headings not listed are left out, as a column
    selection would.
    """
    valid = (F.col("label") == F.col("_label")) & F.col("year").between(F.col("year_from"), F.col("year_to"))
    return long.join(_mapping_table(long, mapping), valid).drop("_label", "year_from", "year_to")


def heading_faults(long: DataFrame, mapping: Mapping) -> DataFrame:
    """(year, metric) pairs not found under exactly one heading; should come out empty."""
    headings = long.select("year", "label").distinct()
    found = map_headings(headings, mapping).groupBy("year", "metric").agg(F.count("*").alias("n_headings"))
    spans = _mapping_table(long, mapping).select("year_from", "year_to", "metric").distinct()
    # A handful of years against a handful of spans.
    wanted = headings.select("year").distinct().join(
        F.broadcast(spans), F.col("year").between(F.col("year_from"), F.col("year_to"))
    )
    return (
        wanted.select("year", "metric")
        .join(found, ["year", "metric"], "left")
        .select("year", "metric", F.coalesce("n_headings", F.lit(0)).alias("n_headings"))
        .filter("n_headings <> 1")
    )


def balanced_panel(df: DataFrame, key: str, period: str, one_row_each: bool = False) -> DataFrame:
    """Rows of the keys that occur in every period.

    With ``one_row_each`` (key, period) is known to be unique; a key then has no more rows
    than there are periods and is counted in place, without a second pass and a join.
    """
    n_periods = df.select(F.count_distinct(period)).scalar()
    if one_row_each:
        counted = df.withColumn("_n", F.count(period).over(Window.partitionBy(key)))
        return counted.filter((F.col("_n") == n_periods) & F.col(key).isNotNull()).drop("_n")
    pairs = df.select(key, period).dropna().distinct()
    complete = pairs.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") == n_periods)
    return df.join(complete.select(key), key, "left_semi")


def key_set_difference(df: DataFrame, key: str, in_first: Column, in_second: Column) -> DataFrame:
    """Keys found on one side only, with the side; the symmetric difference of two key sets.

    One aggregate over the rows of both sides; copies of a key shrink before the shuffle.
    """
    sides = df.filter(in_first | in_second).groupBy(key).agg(
        F.bool_or(in_first).alias("_first"), F.bool_or(in_second).alias("_second")
    )
    return sides.filter(F.col("_first") != F.col("_second")).select(
        key, F.when(F.col("_first"), "first").otherwise("second").alias("side")
    )


def columns_numbered(df: DataFrame) -> DataFrame:
    """Each column with its number, its ``number_name`` label and its count of filled cells."""
    names = df.columns
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(names)])
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"_{i}").alias("n")) for i, c in enumerate(names)])
    return counts.select(F.posexplode(cells).alias("position", "cell")).select(
        "position",
        F.col("cell.name").alias("column_name"),
        F.concat_ws("_", F.col("position").cast("string"), F.col("cell.name")).alias("numbered_name"),
        F.col("cell.n").alias("n_filled"),
    )
