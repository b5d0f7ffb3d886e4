"""Column profiles: summary statistics, value counts, histogram, label rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, Window, functions as F

from .running import ROWS_SO_FAR, value_step

QUARTILES = (0.25, 0.5, 0.75)
#: The sketch's accuracy, and how many times its error a bracket reaches to either side.
ACCURACY, MARGIN = 10_000, 20


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), column)
    )


def label_rate(df: DataFrame, group: str, label: str) -> DataFrame:
    """Mean of a 0/1 label per group."""
    return df.groupBy(group).agg(F.avg(label).alias("rate"))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last bin closed, empty bins shown."""
    spark = df.sparkSession
    values = df.select(F.col(column).cast("double").alias("x")).filter("x is not null")
    edges = values.agg(F.min("x").alias("low"), F.max("x").alias("high"))
    low, high = edges.select("low").scalar(), edges.select("high").scalar()
    place = F.floor((F.col("x") - low) / F.nullif(high - low, F.lit(0.0)) * bins)
    counted = (
        values.select(F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    frame = spark.range(bins).select(F.col("id").alias("bin"))
    width = (high - low) / bins
    return frame.join(counted, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_from"),
        (low + (F.col("bin") + 1) * width).alias("bin_to"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, x) for the filled cells of some numeric columns."""
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot([], list(columns), "column_name", "x").filter("x is not null")


def _measured(df: DataFrame, columns: Sequence[str], points: Sequence[float]) -> DataFrame:
    """A row per column: count, mean, standard deviation, minimum, maximum, and a bracket (point, low, high) per point.

    One scan, of which each task sends a sketch.  A bracket reaches MARGIN / ACCURACY of the ranks to either side of its point;
    few values are all in the bracket.
    """
    apart = MARGIN / ACCURACY
    measures = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    places = [float(min(1, max(0, p + side))) for p in points for side in (-apart, apart)]
    sketch = lambda x: F.percentile_approx(x, places, ACCURACY)
    wide = df.agg(*[f(F.col(c).cast("double")).alias(f"{i}_{m}") for i, c in enumerate(columns) for m, f in (measures | {"at": sketch}).items()])

    def brackets(i: int):
        few = F.col(f"{i}_n") * apart < 4
        low, high = (lambda k: F.when(~few & F.lit(places[k] > 0), F.col(f"{i}_at")[k])), (lambda k: F.when(~few & F.lit(places[k] < 1), F.col(f"{i}_at")[k]))
        rows = [
            F.struct(F.lit(float(p)).alias("point"), F.coalesce(low(2 * k), F.lit(float("-inf"))).alias("low"), F.coalesce(high(2 * k + 1), F.lit(float("nan"))).alias("high"))
            for k, p in enumerate(points)
        ]
        return F.array(*rows).alias("brackets")

    rows = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{i}_{m}").alias(m) for m in measures], brackets(i)) for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*rows)))


def _in_brackets(df: DataFrame, columns: Sequence[str], asked: DataFrame) -> DataFrame:
    """(column_name, point, value, complete) for asked (column_name, point, n_values, low, high), by one scan.

    All values below a bracket are one count, those above are left out, and only the inside is counted by value (a map-side
    combine).  Counts per step of the value range tell in which step of the bracket a rank lies; that step is sorted.
    A point is complete if its ranks lie inside its bracket.
    """
    asked = F.broadcast(asked)  # a row per column and point
    # NaN is above all numbers, so an open end is NaN and holds it.
    high = F.when(F.col("high") == float("inf"), F.lit(float("nan"))).otherwise(F.col("high"))
    inside = _long(df, columns).join(asked, "column_name").filter(F.col("x") <= high)
    counts = (
        inside.withColumn("x", F.when(F.col("x") >= F.col("low"), F.col("x")))
        .groupBy("column_name", "point", "n_values", "x").agg(F.count("*").alias("n"))
        # what lies below has a step of its own, under all others; a null would be filtered from one of the two uses and cost a scan
        .withColumn("step", F.coalesce(F.when(F.col("x").isNotNull(), value_step(F.col("x"))), F.lit(-(1 << 62))))
    )
    by_step = Window.partitionBy("column_name", "point").orderBy("step")
    both_ends = F.explode(F.array(F.floor("rank"), F.ceil("rank")))
    wanted = (
        counts.groupBy("column_name", "point", "n_values", "step")
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(by_step.rowsBetween(*ROWS_SO_FAR)))
        .withColumn("rank", F.col("point") * (F.col("n_values") - 1))
        .withColumn("place", both_ends)
        .withColumn("before", F.col("upto") - F.col("n"))
        .filter((F.col("place") >= F.col("before")) & (F.col("place") < F.col("upto")))
        .select("column_name", "step", "point", "rank", "place", "before")
        .distinct()
    )
    # At most two steps per column and point.
    near = counts.join(F.broadcast(wanted), ["column_name", "point", "step"])
    by_value = Window.partitionBy("column_name", "point", "rank", "place").orderBy("x").rowsBetween(*ROWS_SO_FAR)
    # The value at a place (from 0) is the smallest whose count so far exceeds it.
    found = (
        near.withColumn("upto", F.col("before") + F.sum("n").over(by_value))
        .filter(F.col("upto") > F.col("place"))
        .groupBy("column_name", "point", "rank", "place")
        .agg(F.min("x").alias("x"))
        .filter("x IS NOT NULL")  # a place below the bracket has no value
    )
    part = F.col("rank") - F.floor("rank")
    ends = found.groupBy("column_name", "point", "rank").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("places"))
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") + (F.col("high") - F.col("low")) * part)
    return ends.select("column_name", "point", value.alias("value"), (F.col("places") == F.ceil("rank") - F.floor("rank") + 1).alias("complete"))


def _placed(df: DataFrame, measured: Sequence[Row]) -> DataFrame:
    """(column_name, point, value) of all points.  The driver holds a few numbers per column and point.

    A point that its bracket misses is looked for again with an open one, so the result is exact whatever the sketch.
    """
    asked = {(r.column_name, b.point): (r.n, b.low, b.high) for r in measured if r.n for b in r.brackets}
    found = {}
    for _ in range(2):
        if asked:
            columns = sorted({c for c, _ in asked})
            table = df.sparkSession.createDataFrame([(*k, *v) for k, v in asked.items()], "column_name string, point double, n_values long, low double, high double")
            found |= {(r.column_name, r.point): r.value for r in _in_brackets(df, columns, table).collect() if r.complete}
        asked = {k: (v[0], float("-inf"), float("nan")) for k, v in asked.items() if k not in found}
    return df.sparkSession.createDataFrame([(*k, v) for k, v in found.items()], "column_name string, point double, value double")


def quantiles(df: DataFrame, columns: Sequence[str], points: Sequence[float] = QUARTILES) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per column and point; columns without values have none.

    A mergeable sketch brackets each rank; a second scan counts what lies below and orders the bracket only.  Both run here.
    """
    return _placed(df, _measured(df, columns, points).collect())


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles, maximum; one row per column.  Two scans, which run here."""
    measured = _measured(df, columns, QUARTILES)
    rows = measured.collect()  # a row per column
    basic = df.sparkSession.createDataFrame(rows, measured.schema).drop("brackets")
    names = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    wide = _placed(df, rows).groupBy("column_name").agg(*[F.max(F.when(F.col("point") == p, F.col("value"))).alias(n) for p, n in names.items()])
    return basic.join(wide, "column_name", "left").select("column_name", "n", "mean", "std", "min", "q25", "q50", "q75", "max")
