"""Running totals that stay spread out when one key holds most of the rows.

A plain window puts all rows of a key into one task.  Here the order is cut into chunks:
``levels`` names columns that are coarse versions of the order (say day, then a block of
order numbers), coarsest first, so that sorting by the levels never contradicts the order.
Rows are sorted only inside a chunk; what came before a chunk is found from chunk totals.
These are few where many rows share a key and chunk, and almost as many as rows where they do not.  Chunk totals are added up level by level in
the same way, so no task ever sees all rows, or all chunks, of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

ROWS_SO_FAR = (Window.unboundedPreceding, Window.currentRow)
ROWS_BEFORE = (Window.unboundedPreceding, -1)


def _sums(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, levels: list[str], rows) -> DataFrame:
    """Sum of ``value`` over the frame ``rows`` of the key's order, chunk by chunk."""
    if not levels:
        return df.withColumn(out, F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(*rows)))
    chunk = F.struct(*keys, *levels)
    earlier = f"_before_{len(levels)}"
    totals = df.groupBy(*keys, *levels).agg(F.sum(value).alias("_total"))
    totals = _sums(totals, keys, levels, "_total", earlier, levels[:-1], ROWS_BEFORE)
    # rows move with their keys and levels in the chunk only, which is one value in all rows that are ordered together
    own = {*keys, *levels}
    inside = Window.partitionBy("_chunk").orderBy(*[c for c in order if c not in own])
    within = F.sum(value).over(inside.rowsBetween(*rows))
    # Null fields of equal structs compare as equal, which keeps null keys in the join.
    return (
        df.select(chunk.alias("_chunk"), *[c for c in df.columns if c not in own])
        .withColumn("_within", within)
        .join(totals.select(chunk.alias("_chunk"), earlier), "_chunk")
        .withColumn(out, F.coalesce(F.col("_within") + F.col(earlier), "_within", earlier))
        .select(*[F.col("_chunk").getField(c).alias(c) if c in own else c for c in df.columns], out)
    )


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    levels: Sequence[str] = (),
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the key's rows up to the current one.

    ``order`` must be unique within a key, otherwise the result depends on chance.  As in SQL,
    null values are passed over, the total is null until the first value, and null keys form
    a group of their own.

    The rows are read twice, for the chunk totals and for the result.  If they are costly to work
    out, give a stored table: ``df.write`` to a folder of your own, or ``df.checkpoint()``.
    Building the plan writes nothing.
    """
    return _sums(df, list(keys), list(order), value, out, list(levels), ROWS_SO_FAR)


def running_summary(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, levels: Sequence[str]
) -> DataFrame:
    """Summarise the running total per key and first level without keeping its rows.

    Returns ``keys + levels[:1]`` with the number of rows and of rows that have a running total
    (``n_rows``, ``n_valued``), the plain ``total``, and the sum and the maximum of the running
    total over those rows (``running_sum``, ``running_max``).  Rows are shuffled once;
    everything after that works on chunk summaries.
    """
    keys, order, levels = list(keys), list(order), list(levels)
    if not levels:
        raise ValueError("running_summary needs at least one level")
    chunk = keys + levels
    so_far = Window.partitionBy(*chunk).orderBy(*order).rowsBetween(*ROWS_SO_FAR)
    chunks = (
        df.select(*dict.fromkeys([*chunk, *order]), F.col(value).alias("_value"))
        .withColumn("_running", F.sum("_value").over(so_far))
        .groupBy(*chunk)
        .agg(
            F.count("*").alias("n_rows"),
            F.count("_running").alias("n_valued"),
            F.sum("_value").alias("total"),
            F.sum("_running").alias("running_sum"),
            F.max("_running").alias("running_max"),
        )
    )
    before = F.col("_before")
    for depth in reversed(range(len(levels))):
        parent = keys + levels[:depth]
        earlier = Window.partitionBy(*parent).orderBy(levels[depth]).rowsBetween(*ROWS_BEFORE)
        # Rows ahead of the chunk's first value stand at what came before, if there was any.
        waiting = F.when(F.col("n_valued") < F.col("n_rows"), before)
        raised_sum = F.coalesce("running_sum", F.lit(0)) + F.col("n_rows") * before
        chunks = (
            chunks.withColumn("_before", F.sum("total").over(earlier))
            .withColumn("running_sum", F.when(before.isNull(), F.col("running_sum")).otherwise(raised_sum))
            .withColumn(
                "running_max",
                F.when(before.isNull(), F.col("running_max")).otherwise(F.greatest(F.col("running_max") + before, waiting)),
            )
            .withColumn("n_valued", F.when(before.isNull(), F.col("n_valued")).otherwise(F.col("n_rows")))
            .drop("_before")
        )
        if depth:
            chunks = chunks.groupBy(*parent).agg(
                F.sum("n_rows").alias("n_rows"),
                F.sum("n_valued").alias("n_valued"),
                F.sum("total").alias("total"),
                F.sum("running_sum").alias("running_sum"),
                F.max("running_max").alias("running_max"),
            )
    return chunks


def numbered(df: DataFrame, order: Sequence[str], out: str, levels: Sequence[str]) -> DataFrame:
    """Number all rows from 1 in a given unique order, without one task seeing them all."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running_total(ones, [], order, "_one", out, levels).drop("_one")


# Steps per doubling of a number; all doubles together fall into fewer than 18 million steps.
STEPS_PER_DOUBLING = 4096


# Not a number sorts after all numbers; infinity is taken as 2150 doublings up.
NAN_STEP = 2200 * STEPS_PER_DOUBLING


def value_step(value: Column) -> Column:
    """A whole number that grows with ``value``, in relative steps of about 0.02 per cent.

    Cuts an order by a number into chunks that stay small even when a few values are very
    large or very small.
    """
    x = value.cast("double")
    # log2 of the smallest positive double is -1074.
    size = F.least(F.log2(F.nullif(F.abs(x), F.lit(0.0))) + 1075, F.lit(2150.0))
    step = F.floor(F.coalesce(F.signum(x) * size, F.lit(0.0)) * STEPS_PER_DOUBLING)
    return F.when(F.isnan(x), F.lit(NAN_STEP)).otherwise(step)
