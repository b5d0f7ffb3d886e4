"""Filters driven by parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from .params import parameter_table


def is_cancelled(invoice_no: Column) -> Column:
    """Cancelled invoices carry the prefix C."""
    return invoice_no.startswith("C")


def suffix_or_equal(col: Column, suffix: str, name: str) -> Column:
    return col.endswith(suffix) | (col == name)


def filter_if_any(df: DataFrame, column: str, selected: Sequence) -> DataFrame:
    """Keep the selected members; an empty selection keeps everything."""
    return df.filter(F.col(column).isin(list(selected))) if selected else df


def in_date_range(day: Column, first, last) -> Column:
    return day.between(F.lit(first), F.lit(last))


def with_threshold(df: DataFrame, column: str, thresholds: Mapping[str, object], out: str) -> DataFrame:
    """Keep rows whose ``column`` is listed and add the threshold that goes with it."""
    rows = [(name, Decimal(str(value))) for name, value in thresholds.items()]
    table = parameter_table(df.sparkSession, rows, {column: "string", out: "decimal(18,2)"})
    # The filter lets the scan skip what the join would drop anyway.
    return df.filter(F.col(column).isin(list(thresholds))).join(table, column)


def trailing_window(df: DataFrame, column: str, units: int) -> DataFrame:
    """The last ``units`` values of an integer column, counted back from its maximum."""
    latest = df.agg(F.max(column)).scalar()
    return df.filter(F.col(column) > latest - units)
