"""Sinks: dated outputs that never change, and publications seen whole or not at all."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dayfolio import config
from dayfolio.functions import records as R
from dayfolio.operators.aggregates import complete_jobs
from dayfolio.operators.reconcile import pair_up, verify_receipts
from dayfolio.operators.sets import set_diff
from dayfolio.operators.skew import small_or_plain


class RefusedWrite(ValueError):
    """The target already holds something else, or the content may not be written."""


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return not any(sign in path for sign in "*?[{") and files.exists(hadoop) and files.getFileStatus(hadoop).isDirectory()


def write_edition(editions: DataFrame, path: str) -> None:
    """One folder per date; other dates stay as they are."""
    (editions.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").json(path))


def read_edition_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def current_edition(editions: DataFrame) -> DataFrame:
    """The edition of the newest date; a view, not a copy."""
    newest = editions.agg(F.max("date").alias("date"))
    return editions.join(F.broadcast(newest), "date")


def index_row(editions: DataFrame, schema_version: str = config.CURRENT_SCHEMA) -> DataFrame:
    """Latest date, dates newest first and the newest edition's times."""
    return editions.agg(
        F.lit(schema_version).alias("schemaVersion"), F.max("date").alias("latestDate"),
        F.sort_array(F.collect_set("date"), asc=False).alias("availableDates"),
        F.max_by("generatedAtJst", "date").alias("generatedAtJst"), F.max_by("lastSuccessfulAtJst", "date").alias("lastSuccessfulAtJst"))


def partition_states(new: DataFrame, stored: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Per partition: absent, same or different, by order-free content digest."""
    columns = [c for c in new.columns if c not in keys]
    digest = lambda df: df.groupBy(*keys).agg(R.set_digest(R.canonical_json(df, columns)).alias("digest"))
    ours = digest(new)
    if stored is None:
        return ours.select(*keys, F.lit("absent").alias("state"))
    pairs = pair_up(ours, digest(stored.select(*new.columns)), keys, ["digest"], ["digest"]).where("left_rows > 0")
    state = F.when(F.col("right_rows") == 0, "absent").when(F.col("l.digest") == F.col("r.digest"), "same").otherwise("different")
    return pairs.select(*keys, state.alias("state"))


def write_immutable(df: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Writes the partitions that are absent; the number of them is returned.

    A partition with the same content is left alone. When any partition exists
    with other content nothing is written.
    """
    spark = df.sparkSession
    stored = spark.read.schema(df.schema).parquet(path) if path_exists(spark, path) else None
    states = partition_states(df, stored, keys)
    changed = states.where("state = 'different'").limit(5).collect()
    if changed:
        raise RefusedWrite(f"existing content differs: {[tuple(row)[:-1] for row in changed]}")
    fresh = states.where("state = 'absent'").select(*keys)
    count = fresh.count()
    if count:
        df.join(fresh, list(keys), "left_semi").write.mode("append").partitionBy(*keys).parquet(path)
    return count


def publish(staged: Mapping[str, DataFrame], root: str, run_id: str, validate: Callable[[dict[str, DataFrame]], DataFrame] | None = None) -> None:
    """Makes all targets of a run visible together.

    Each target has a folder per run, written and audited there. One appended
    manifest row is the commit; readers see only runs the manifest names.
    """
    spark = next(iter(staged.values())).sparkSession
    if path_exists(spark, f"{root}/manifest") and not spark.read.json(f"{root}/manifest").where(F.col("run_id") == run_id).isEmpty():
        raise RefusedWrite(f"run {run_id} is already published")
    written = {}
    for name, df in staged.items():
        target = f"{root}/data/{name}/run_id={run_id}"
        df.write.mode("overwrite").parquet(target)
        written[name] = spark.read.schema(df.schema).parquet(target)
    if validate is not None and not validate(written).isEmpty():
        raise RefusedWrite(f"run {run_id} failed validation and stays unpublished")
    row = spark.createDataFrame([(run_id, list(staged))], "run_id STRING, targets ARRAY<STRING>")
    row.coalesce(1).write.mode("append").json(f"{root}/manifest")


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All rows of one target from published runs, with their ``run_id``.

    The manifest is joined on ``run_id``, which is the target's partition
    column, so that runs it does not name are pruned before they are read; the
    driver holds no list of runs.
    """
    runs = (spark.read.schema("run_id STRING, targets ARRAY<STRING>").json(f"{root}/manifest")
            .select("run_id", F.explode("targets").alias("target")).where(F.col("target") == name).select("run_id").distinct())
    path = f"{root}/data/{name}"
    fields = [f for f in spark.read.parquet(path).schema if f.name != "run_id"]
    stored = spark.read.schema(T.StructType(fields).add("run_id", "string")).parquet(path)  # a run named 007 is no number
    return stored.join(small_or_plain(runs), "run_id")


def append_event(events: DataFrame, path: str, job: Sequence[str], published: DataFrame | None = None) -> None:
    """Appends events; a job that is published accepts no more."""
    if published is not None:
        refused = events.join(published.select(*job).distinct(), list(job), "left_semi")
        if not refused.isEmpty():
            raise RefusedWrite("the job was already published")
    events.write.mode("append").json(path)


def complete_set(records: DataFrame, receipts: DataFrame, job: Sequence[str], slug: str = "slug", payload: str = "payload") -> DataFrame:
    """Records of jobs whose every category is present and verified."""
    judged = verify_receipts(records, receipts, [*job, slug], payload)
    verified = judged.withColumn("_ok", F.col("receipt_state") == "verified")
    whole = complete_jobs(verified, job, slug, "_ok").where("is_complete").select(*job)
    return verified.where("_ok").drop("_ok", "receipt_state").join(whole, list(job), "left_semi")


def export_complete_set(records: DataFrame, receipts: DataFrame, path: str, job: Sequence[str], **options) -> None:
    """Writes ``complete_set`` into a target that must not exist yet."""
    if path_exists(records.sparkSession, path):
        raise RefusedWrite(f"{path} already exists")
    complete_set(records, receipts, job, **options).write.mode("errorifexists").partitionBy(*job).parquet(path)


def write_issues(issues: DataFrame, path: str) -> None:
    """One folder per date and category; an existing result is never replaced."""
    issues.write.mode("errorifexists").partitionBy("date", "slug").json(path)


def publication_allowlist(dates: DataFrame, categories: Sequence[str] = config.CATEGORIES, date: str = "date") -> DataFrame:
    """Every path one publication of each date may touch."""
    day = F.col(date).cast("string")
    reports = [F.concat(F.lit("data/reports/"), day, F.lit(f"-{c}.json")) for c in categories]
    public = [F.concat(F.lit("public/data/"), day, F.lit(".json")), F.lit("public/data/current.json"), F.lit("public/data/index.json")]
    return dates.select(date, F.explode(F.array(*reports, *public)).alias("path"))


def check_bundle(actual: DataFrame, allowed: DataFrame, columns: Sequence[str] = ("path",)) -> DataFrame:
    """Paths that are missing or not allowed."""
    return set_diff(actual, allowed, columns).withColumn("side", F.when(F.col("side") == "left_only", "not allowed").otherwise("missing"))


def path_conflicts(files: DataFrame, key: str = "id", path: str = "path") -> DataFrame:
    """Files whose path is also a folder of another file of the same id, and repeats."""
    parts = F.split(F.col(path), "/")
    folders = files.select(key, F.explode(F.when(F.size(parts) > 1, F.transform(
        F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")))).alias(path)).distinct()
    nested = files.select(key, path).distinct().join(folders, [key, path]).withColumn("problem", F.lit("is also a folder"))
    repeated = files.groupBy(key, path).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n").withColumn("problem", F.lit("is repeated"))
    return nested.unionByName(repeated)


def write_source_text(files: DataFrame, root: str, run_id: str, buckets: int = 64) -> None:
    """Source text of new ids, whole or not at all.

    Refused when an id is already published or its paths conflict.
    """
    spark = files.sparkSession
    if path_exists(spark, f"{root}/manifest"):
        old = read_published(spark, root, "source_text").select("id").distinct()
        if not files.join(old, "id", "left_semi").isEmpty():
            raise RefusedWrite("source text already exists for an id")
    if not path_conflicts(files).isEmpty():
        raise RefusedWrite("source paths conflict")
    publish({"source_text": files.withColumn("id_bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))}, root, run_id)
