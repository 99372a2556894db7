"""Registry of queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dayfolio.session import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``fn(spark, folder)`` under a name, with its SQL if it has one."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


# Tables with long texts, and the key they are spread by when they lie in few files.
LONG_TEXTS = {"documents": "doc_id", "pages": "page_id"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A supplied table. Long texts in a single file are spread over the cores;
    a table of many files already is. They reach Python in small batches."""
    if name in (*LONG_TEXTS, "conversations"):
        small_batches(spark)
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in LONG_TEXTS and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, LONG_TEXTS[name])
    return df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows of a narrow table dealt over the cores, for work that takes long per row.

    A file of a few megabytes is read by one task, however many rows it has.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
