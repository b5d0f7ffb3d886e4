"""Shards of near equal bytes by sampled splitters.

A size-weighted sample of keys gives quantile boundaries, records are put into the ranges between
them, and a key that alone would fill a range is subdivided by a second key.  Ranges, not shards, are what a
task orders; their exact bytes and rows then place every record.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import keep

RANGES = 512
#: Expected number of sampled keys, whatever the size of the table; this bounds what the driver gets.
SAMPLE = 16384
_UNIT = 2.0**-53


def _unit(*columns: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") * _UNIT


def splitters(sample: pd.DataFrame, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted boundaries (k1, k2).  A range starts at a whole key k1 unless that key holds several quantiles."""
    if sample.empty:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ordered = sample.sort_values(["k1", "k2"])
    places = (np.arange(1, ranges) * len(ordered)) // ranges
    picked = ordered.iloc[places].drop_duplicates().reset_index(drop=True)
    lowest = np.iinfo(np.int64).min
    picked["_nth"] = picked.groupby("k1").cumcount()
    picked.loc[picked._nth == 0, "k2"] = lowest
    heavy = picked.k1[picked._nth > 0].unique()
    # the range after a heavy key starts with the next key, so the key's last range holds nothing else
    after = pd.DataFrame({"k1": heavy[heavy < np.iinfo(np.int64).max] + 1, "k2": lowest})
    picked = pd.concat([picked[["k1", "k2"]], after]).drop_duplicates().sort_values(["k1", "k2"])
    return picked.k1.to_numpy(np.int64), picked.k2.to_numpy(np.int64)


def range_number(k1: np.ndarray, k2: np.ndarray, b1: np.ndarray, b2: np.ndarray) -> np.ndarray:
    """Number of boundaries at or below each (k1, k2)."""
    low = np.searchsorted(b1, k1, "left")
    high = np.searchsorted(b1, k1, "right")
    for i in np.flatnonzero(high > low):
        low[i] += np.searchsorted(b2[low[i] : high[i]], k2[i], "right")
    return low.astype(np.int32)


def sharded(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", ranges: int = RANGES, sample: int = SAMPLE, seed: int = 7) -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the text's UTF-8 bytes plus 1; null text has no bytes and the crc of nothing.  Shards
    are near equal in bytes (law ``bytes``) and follow the order of the text's hash; equal texts share a
    shard unless they would fill a whole range (1 / ``ranges`` of all bytes) and are subdivided by id.  Rows
    that repeat id and text, and null ids, get a slot each.  Other columns are not read.  An
    empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = keep(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("k1"),
            F.xxhash64(F.lit(seed), F.col(id_col)).alias("k2"),
        ),
        "shard-keys",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        total = 1
    chance = F.col("size") * (sample / total)
    # a record as large as several sample steps is drawn as many times
    draws = F.floor(chance + _unit(F.lit(seed), F.col("id"), F.col("k1")))
    drawn = rows.select("k1", "k2", draws.alias("n")).filter("n > 0").toPandas()
    b1, b2 = splitters(drawn.loc[drawn.index.repeat(drawn.n), ["k1", "k2"]], ranges)

    @F.pandas_udf("int")
    def numbered(k1: pd.Series, k2: pd.Series) -> pd.Series:
        return pd.Series(range_number(k1.to_numpy(), k2.to_numpy(), b1, b2))

    ranged = keep(rows.withColumn("range", numbered("k1", "k2")), "shard-ranges")
    sums = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range, at most 2 * ranges + 1
    firsts = sums.select("range", F.coalesce(F.sum("bytes").over(upto), F.lit(0)).alias("_bytes0"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("_row0"))
    inside = Window.partitionBy("range").orderBy("k1", "k2", "id", "size")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    heavy = np.unique(b1[:-1][b1[1:] == b1[:-1]]).tolist()
    placed = (
        ranged.join(F.broadcast(firsts), "range")
        .withColumn("_row", F.col("_row0") + F.row_number().over(inside) - 1)
        .withColumn("_start", F.col("_bytes0") + F.coalesce(F.sum("size").over(before), F.lit(0)))
        .withColumn("_whole", F.min("_start").over(Window.partitionBy("range", "k1")))
    )
    start = F.when(F.col("k1").isin(heavy), F.col("_start")).otherwise(F.col("_whole")) if heavy else F.col("_whole")
    put = keep(
        placed.withColumn("shard", F.least(F.lit(shards - 1), F.floor(start * shards / F.lit(total))).cast("int")).select(
            "id", "size", "text_crc32", "shard", "_row"
        ),
        "shard-places",
    )
    first_row = F.broadcast(put.groupBy("shard").agg(F.min("_row").alias("_first")))
    return put.join(first_row, "shard").select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_row") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
