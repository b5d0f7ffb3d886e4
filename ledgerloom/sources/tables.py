"""Saved tables: read, create, append, insert if absent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.ranking import first_per_key


def table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """One parquet table of a folder."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_jdbc(spark: SparkSession, options: Mapping[str, str], query: str) -> DataFrame:
    """Rows of a database query; filters and columns are pushed to the database.

    URL, user and password come from the caller's options.  Give ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` (with ``dbtable``) to read in parallel.
    """
    reader = spark.read.format("jdbc").options(**options)
    return (reader if "dbtable" in options else reader.option("query", query)).load()


def register(df: DataFrame, name: str) -> DataFrame:
    """Make a table available to SQL text."""
    df.createOrReplaceTempView(name)
    return df


def create_if_missing(spark: SparkSession, name: str, schema: str, partition_by: Sequence[str] = ()) -> None:
    """``schema`` as in ``id bigint, sol int``; an existing table is left alone."""
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet{layout}")


def append(df: DataFrame, name: str) -> None:
    """Add rows to a saved table in one write, columns matched by name."""
    target = df.sparkSession.table(name)
    df.select(*target.columns).write.mode("append").insertInto(name)


def absent_rows(batch: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key of ``batch`` whose key ``target`` does not hold yet."""
    return first_per_key(batch, keys, order).join(target.select(*keys), list(keys), "left_anti")


def insert_if_absent(batch: DataFrame, name: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Append the absent rows to a saved table; running it twice adds nothing more.

    Meant for one writer at a time, like any append to plain parquet.
    """
    append(absent_rows(batch, batch.sparkSession.table(name), keys, order), name)
