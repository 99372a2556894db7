"""Small helpers that several operators share."""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayfolio.session import cut_lineage, shared_folder

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-cases A to Z alone."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def with_rank(df: DataFrame, *order: Column, name: str) -> DataFrame:
    """Adds the row's place from 0 in the order, without one task that sorts all rows.

    Rows are dealt by ranges and written once, so that a rerun of a task can't
    deal them anew; then each range counts its rows and adds those before it.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_lineage(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))  # one row per range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        dealt.withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(starts), "_range")  # as many rows as there are ranges
        .withColumn(name, F.col("_start") + F.col("_row") - 1)
        .drop("_range", "_row", "_start")
    )


def small_enough(df: DataFrame, size: Column, most: int = 16 << 20) -> DataFrame:
    """Marked for broadcast if its bytes, which are summed first, are few; else joined as any table."""
    total = df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= most else df


def staged(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows written as Parquet to the shared folder, and where.

    Smaller than a checkpoint for millions of narrow rows, and as safe when
    executors are lost. The folder goes when the driver ends, or earlier by
    ``unstage`` when nothing will read it any more.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.parquet(folder), folder


def unstage(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
