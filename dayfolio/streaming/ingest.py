"""Micro-batch jobs: ordered events, new dates, idempotent imports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from dayfolio.plans.jobs import reduced_arrivals
from dayfolio.sources.writers import is_folder, path_exists
from dayfolio.streaming.state import ImportProcessor, use_typed_state


def table_stream(spark: SparkSession, folder: str, name: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """One table of a folder as a stream: a file, files of that pattern, or a folder of part files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if is_folder(spark, f"{folder}/{name}"):
        return reader.parquet(f"{folder}/{name}")
    return reader.option("pathGlobFilter", name).parquet(folder)


def unique_events(events: DataFrame, keys: Sequence[str], time: str = "event_time", late: str | None = None) -> DataFrame:
    """Each event once, however late it arrives; the state keeps every key.

    With ``late`` the state is bounded instead: keys are forgotten, and events
    dropped, that are further behind the newest event than that.
    """
    if late is None:
        return events.dropDuplicates(list(keys))
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what has landed and stops; rows go to Parquet files."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    query.awaitTermination()


def run_changes(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str]) -> None:
    """Like ``run_to_table`` for update streams: every change is kept with its batch number."""
    def keep(batch: DataFrame, number: int) -> None:
        # The folder name makes a repeated batch overwrite itself.
        batch.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(f"{path}/part={number}")

    stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start().awaitTermination()


def all_changes(spark: SparkSession, path: str) -> DataFrame:
    """Every row that ``run_changes`` has kept, with its batch number."""
    return spark.read.option("basePath", path).parquet(path).drop("part")


def latest_changes(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest change of every key from ``run_changes``."""
    changes = all_changes(spark, path)
    if "late_event_id" in changes.columns:
        changes = changes.where("late_event_id is null").drop("late_event_id", "late_event_at")
    columns = [c for c in changes.columns if c not in keys]
    order = F.struct("batch", *[c for c in ("as_of",) if c in columns])
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("_r")).select(*keys, "_r.*").drop("batch")


def new_dates_stream(listings: DataFrame, published_path: str, queue_path: str, checkpoint: str, date: str = "date",
                     keys: Sequence[str] = (), salts: int = 16) -> StreamingQuery:
    """Queues newly announced dates, each once.

    The dates that came before are the stream's state, looked up by key, so a
    batch takes as long as its own rows whatever the queue holds. A date is
    first met by ``salts`` tasks and then by one, so listings of one date do not
    all go to one task. Dates that were published when the stream (re)started
    are not queued; those published later were queued by it.
    """
    spark = listings.sparkSession
    salt = F.pmod(F.xxhash64(*listings.columns), F.lit(salts))
    dates = listings.select(*keys, date, salt.alias("_salt")).dropDuplicates([*keys, date, "_salt"]).drop("_salt").dropDuplicates([*keys, date])
    if path_exists(spark, published_path):
        dates = dates.join(spark.read.parquet(published_path).select(*keys, date).distinct(), [*keys, date], "left_anti")
    return dates.writeStream.outputMode("append").format("parquet").option("path", queue_path).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()


def next_queued(spark: SparkSession, queue_path: str, published_path: str | None, date: str = "date", keys: Sequence[str] = ()) -> DataFrame:
    """The oldest queued date that is not published: one date per run."""
    queued = spark.read.parquet(queue_path).select(*keys, date).distinct()
    if published_path and path_exists(spark, published_path):
        queued = queued.join(spark.read.parquet(published_path).select(*keys, date).distinct(), [*keys, date], "left_anti")
    return queued.groupBy(*keys).agg(F.min(date).alias(date))


def import_stream(records: DataFrame, store: str, refused: str, checkpoint: str, keys: Sequence[str],
                  checks: Sequence[Callable[[DataFrame], Column]] = (), payload: str = "payload") -> StreamingQuery:
    """Adds records whose key is new; the same bytes again change nothing.

    Each batch is first reduced to a row per key (its digests, and whether all
    arrivals are valid), where tasks combine what they hold of a key before it
    moves. A second stream over the reduced rows has the digest of each key as
    its state, so a batch looks up its own keys alone, whatever the store
    holds. Both write a batch to a folder of its own, which a repeated batch
    overwrites, so a restart cannot add twice.
    """
    spark = records.sparkSession
    use_typed_state(spark)
    landed = f"{checkpoint}/reduced"

    def reduce(batch: DataFrame, number: int) -> None:
        reduced_arrivals(batch, keys, checks, payload).write.mode("overwrite").parquet(f"{landed}/batch={number}")

    records.writeStream.foreachBatch(reduce).option("checkpointLocation", f"{checkpoint}/first").trigger(availableNow=True).start().awaitTermination()
    fields = records.select("*", F.lit("").alias("sha256"), F.lit("").alias("high"), F.lit(True).alias("valid"), F.lit(0).cast("bigint").alias("batch")).schema
    arrivals = spark.readStream.schema(fields).parquet(landed)
    out = T.StructType([f for f in fields if f.name not in ("high", "valid")]).add("reason", "string")
    judged = arrivals.groupBy(*keys).transformWithStateInPandas(ImportProcessor(), out, "Append", "None")

    def add(batch: DataFrame, number: int) -> None:
        batch = batch.drop("batch").persist()
        batch.where("reason is null").drop("reason").write.mode("overwrite").parquet(f"{store}/batch={number}")
        batch.where("reason is not null").select(*keys, "reason").write.mode("overwrite").parquet(f"{refused}/batch={number}")
        batch.unpersist()

    return judged.writeStream.outputMode("append").foreachBatch(add).option("checkpointLocation", f"{checkpoint}/second").trigger(availableNow=True).start()
