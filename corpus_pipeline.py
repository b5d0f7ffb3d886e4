"""From raw documents to shards: toxic documents go, near copies go, benchmark passages go, sources are mixed, the rest is sharded.

Ids may be null or repeat, with equal or with different texts: each stage decides about rows, not about ids.  Texts stay where
they are as far as that goes: no stage copies or shuffles them to drop rows, unless ids repeat or very many rows go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType

from ledgerloom.llm.decontaminate import contaminated
from ledgerloom.llm.mixing import mixed
from ledgerloom.llm.ngram_jaccard import jaccard_components
from ledgerloom.llm.queries import MIX, SHARDS
from ledgerloom.llm.sharding import sharded
from ledgerloom.llm.storage import all_of, free_name, keep, table
from ledgerloom.llm.toxicity import THRESHOLD, toxicity_model, toxicity_score

#: The last stage does not return the columns of documents but the places of documents in shards.
ORACLE_SQL = None


#: Up to so many numbers of rows to drop are sent to every executor.
SENT_ROWS = 1 << 21


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number each, and the name of that column.

    Where ids tell the rows apart they are the numbers; else the rows are stored with numbers, so that these stay.
    """
    row = free_name(docs, "row")
    if isinstance(docs.schema["doc_id"].dataType, LongType):
        n = docs.agg(F.count("*").alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
        if n.rows == n.ids:
            return docs.withColumn(row, F.col("doc_id")), row
    return keep(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def without(rows: DataFrame, found: DataFrame, row: str) -> DataFrame:
    """The rows whose number was not found; only more than SENT_ROWS numbers meet the rows in a shuffle."""
    gone = keep(found.select(row).distinct(), "gone")
    if gone.count() <= SENT_ROWS:
        gone = F.broadcast(gone)
    return rows.join(gone, row, "left_anti").drop(row)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier does not reject; null and empty texts stay, an empty table stays empty.

    Long texts are scored whole; rows of equal text go or stay together, whatever their ids.
    """
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity_score(spark, F.col("text"), model) < THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five words, 0.8): that of the smallest id, null ids last, then the first of the table.

    Rows that repeat id and text are copies too.  Null, empty and blank texts have no words, link with nothing and stay.
    """
    rows, row = numbered(docs)
    groups = keep(jaccard_components(rows, row, words=5, percent=80).select(row, "component_id"), "near-copies")
    # the row that names a group and those linked to it; single rows are not looked at again
    linked = groups.filter(F.col("component_id") != F.col(row))
    heads = linked.select(F.col("component_id").alias(row), "component_id").distinct()
    members = linked.unionByName(heads).join(rows.select(row, F.col("doc_id").alias("id")), row)
    best = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", F.col(row).alias("stays")))
    stay = members.groupBy("component_id").agg(best.alias("best")).select(F.col("best.stays").alias(row))
    gone = linked.select(row).unionByName(heads.select(row)).join(stay, row, "left_anti")
    return without(rows, gone, row).select(*all_of(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark passage; null and empty texts have none, an empty table stays empty.

    Long texts are searched whole; rows of equal text go or stay together, whatever their ids.
    """
    rows, row = numbered(docs)
    return without(rows, contaminated(rows, table(spark, sf_dir, "benchmark"), row), row).select(*all_of(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the mix takes at all, whole; one that it takes in several epochs is there several times.

    Texts without words (null, empty, blank) are never taken.  Rows that repeat an id are taken each for itself.
    """
    rows, row = numbered(docs)
    times, nth = free_name(docs, "times"), free_name(docs, "nth")
    taken = mixed(rows, MIX, row_col=row).groupBy(F.col("row").alias(row)).agg(F.count_distinct("epoch").cast("int").alias(times))
    again = rows.join(taken, row).withColumn(nth, F.explode(F.sequence(F.lit(1), times)))
    return again.select(*all_of(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its place in it; null texts count as empty, rows that repeat have a place each."""
    return sharded(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's input; an empty table gives no rows."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = keep(stage(spark, docs, sf_dir), f"stage{n}")
    return docs
