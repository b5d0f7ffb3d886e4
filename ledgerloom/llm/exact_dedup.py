"""Exact copies, combined in three steps so that no group of copies meets in one task.

Rows with equal digest *and* equal text are combined inside each task, then per salt, then across
salts.  The text is part of the key in every step, so two texts with one digest never merge.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import keep

SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def content_groups(rows: DataFrame, salts: int) -> DataFrame:
    """One row per different (_digest, _text): its largest id and its number of rows.

    Both aggregates combine before their shuffle, so a task sends one row per text and salt however
    many copies it holds, and the second shuffle gets at most ``salts`` rows per text.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)))
    by_salt = salted.groupBy("_digest", "_salt", "_text").agg(F.max("_id").alias("_top"), F.count("*").alias("_n"))
    return by_salt.groupBy("_digest", "_text").agg(F.max("_top").alias("keep_id"), F.sum("_n").alias("group_size"))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty text.  The row with the largest id of equal texts stays; of rows that
    repeat both id and text one stays.  Null ids lose against any id; a group without ids has a null
    keep_id and keeps one row.  Other columns are not read.  An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).withColumn("_digest", digest(F.col("_text")))
    winners = content_groups(rows, salts)
    groups = keep(
        winners.groupBy("_digest").agg(
            F.count("*").alias("_texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
        ),
        "exact-groups",
    )
    ids = rows.select("_id", "_digest", F.sha2(F.col("_text").cast("binary"), 256).alias("text_sha256"))
    answer = ids.join(groups.filter("_texts = 1").drop("_texts"), "_digest")
    shared = groups.filter("_texts > 1").select("_digest")
    if not shared.isEmpty():  # digests that stand for several texts: their rows are told apart by the text
        apart = rows.join(shared, "_digest", "left_semi").join(winners, ["_digest", "_text"])
        answer = answer.unionByName(
            apart.select(
                "_id", "_digest", F.sha2(F.col("_text").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size"
            )
        )
    repeat = F.row_number().over(Window.partitionBy("_id", "text_sha256").orderBy("group_size"))
    return answer.select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("_id").eqNullSafe(F.col("keep_id")) & (repeat == 1)).alias("kept"),
        "text_sha256",
    )
