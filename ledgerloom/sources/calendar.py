"""Calendar of month-day names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import month_day_name

# Fixed value: names are checked against a common year, so 29 February is no valid day.
CALENDAR_YEAR = 1900


def month_days(spark: SparkSession) -> DataFrame:
    """The 365 names from ``January 1`` to ``December 31`` with their position in the year."""
    first = F.make_date(F.lit(CALENDAR_YEAR), F.lit(1), F.lit(1))
    days = spark.range(365).select(F.date_add(first, F.col("id").cast("int")).alias("d"))
    return days.select(F.dayofyear("d").alias("day_of_year"), month_day_name(F.col("d")).alias("month_day"))
