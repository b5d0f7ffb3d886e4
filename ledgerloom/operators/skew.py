"""Joins whose keys may be heavy: one key may hold a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Keys that the sketch reports and tracks at most; it bounds what is broadcast, whatever the tables.
FREQUENT, TRACKED = 512, 10_000
#: A key with more than one in so many rows is dealt out, in pieces of about that size.
PIECES = 256


def heavy_keys(rows: DataFrame, key: str, pieces: int = PIECES) -> DataFrame:
    """(key, salts) of keys with more than a piece of all rows, by a mergeable sketch of frequent items: fewer rows than ``pieces``, about."""
    sketch = rows.agg(F.expr(f"approx_top_k(`{key}`, {FREQUENT}, {TRACKED})").alias("top"), F.count("*").alias("n"))
    items = sketch.select(F.explode("top").alias("t"), "n").select(F.col("t.item").alias(key), F.ceil(F.col("t.count") * pieces / F.col("n")).cast("int").alias("_salts"))
    return items.filter((F.col("_salts") > 1) & F.col(key).isNotNull())


def join_skewed(rows: DataFrame, other: DataFrame, key: str, spread: Sequence[str], how: str = "inner", pieces: int = PIECES) -> DataFrame:
    """rows joined with other on ``key``, inner or left; the rows of heavy keys are dealt out by a hash of ``spread``.

    The heavy keys come from a sketch, which reads the key column once more.
    ``other`` is copied once per piece of a heavy key, so give the side with few rows per key.  Rows without
    a key meet nothing; in a left join they are dealt out as well.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"an inner or a left join, not {how}")
    heavy = F.broadcast(heavy_keys(rows, key, pieces))  # bounded by the number of pieces
    salts = F.when(F.col(key).isNull(), F.lit(pieces)).otherwise(F.coalesce("_salts", F.lit(1)))
    dealt = rows.join(heavy, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int")).drop("_salts")
    copied = other.join(heavy, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")
