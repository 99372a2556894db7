"""Scans of landed files and tables, with the rejects kept as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dayfolio import config, schemas
from dayfolio.functions import records as R, text as X, times
from dayfolio.operators.issues import Rule, as_issue, find_issues, union_all

REPORT_NAME = r"^(\d{4}-\d{2}-\d{2})-(hep-th|gr-qc|quant-ph)\.json$"
EVENT_NAME = r"^(\d{8}T\d{6}\.\d{3}Z)-([a-f0-9]{32})\.json$"


def read_reports(spark: SparkSession, path: str, pattern: str = REPORT_NAME) -> DataFrame:
    """Category reports with ``file_name``, ``report_date`` and ``file_slug``.

    The date and category come from the file name; both are null for a file
    with an unknown name, which ``report_file_issues`` reports.
    """
    reports = spark.read.schema(schemas.REPORT).option("multiLine", True).json(path)
    name = F.col("_metadata.file_name")
    part = lambda i: F.nullif(F.regexp_extract(name, pattern, i), F.lit(""))
    return reports.select("*", name.alias("file_name"), part(1).alias("report_date"), part(2).alias("file_slug"))


def report_file_issues(reports: DataFrame, categories=config.CATEGORIES) -> DataFrame:
    """Unknown names, records that disagree with their name, incomplete dates."""
    rows = find_issues(reports, [
        Rule("file", "name", "unexpected report file name", times.parse_date("report_date").isNotNull()),
        Rule("reportDate", "value", "must equal the date in the file name", F.col("reportDate") == F.col("report_date"),
             applies=F.col("report_date").isNotNull()),
        Rule("slug", "value", "must equal the category in the file name", F.col("slug") == F.col("file_slug"),
             applies=F.col("file_slug").isNotNull()),
    ], {"date": "report_date", "slug": "file_slug", "id": "file_name"}, "report")
    held = reports.where("report_date is not null").groupBy("report_date").agg(F.count_distinct("file_slug").alias("n"))
    return union_all([rows, as_issue(held.where(F.col("n") < len(categories)), "incomplete", "needs a report of every category",
                                     "reports", {"date": "report_date"}, "date")])


def read_editions(spark: SparkSession, path: str) -> DataFrame:
    """Dated editions; ``file_date`` is the date in the file name."""
    editions = spark.read.schema(schemas.EDITION).option("multiLine", True).option("pathGlobFilter", "????-??-??.json").json(path)
    return editions.select("*", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1).alias("file_date"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.INDEX).option("multiLine", True).json(path)


def available_dates(editions: DataFrame, date: str = "date") -> DataFrame:
    """Dates newest first."""
    return editions.select(date).distinct().orderBy(F.desc(date))


def stray_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of the public folder that are neither dated, current nor index."""
    names = (spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "([^/]*)$", 1).alias("name")))
    return names.where(~F.col("name").rlike(r"^(?:current|index|\d{4}-\d{2}-\d{2})\.json$"))


def read_json_bounded(spark: SparkSession, path: str, schema: str, maximum_bytes: int = config.MAX_JSON_BYTES) -> tuple[DataFrame, DataFrame]:
    """Parsed rows and a quarantine of (path, length, reason).

    Only the length of an oversized file is read, never its content.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    large = files.select("path", "length").where(F.col("length") > maximum_bytes).select(
        "path", "length", F.lit(f"exceeds {maximum_bytes} bytes").alias("reason"))
    small = files.where(F.col("length") <= maximum_bytes).select("path", "length", F.col("content").cast("string").alias("text"))
    return parse_json(small, "text", schema, large)


def is_whole_json(text: Column) -> Column:
    """The text is one JSON value and nothing after it.

    Spark's readers stop at the end of the first value. Put in an array before
    an end mark, a value with anything behind it no longer gives two elements.
    """
    wrapped = F.from_json(F.concat(F.lit("["), text, F.lit(',"--end--"]')), "array<string>")
    return F.coalesce((F.size(wrapped) == 2) & (F.get(wrapped, F.lit(1)) == "--end--"), F.lit(False))


def parse_json(df: DataFrame, text: str, schema: str, rejects: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Splits rows by whether their JSON text parses with the schema."""
    keep = [c for c in df.columns if c != text]
    parsed = df.withColumn("_valid", F.coalesce(F.is_valid_utf8(F.col(text)), F.lit(False))).withColumn("_r", F.from_json(
        F.when(F.col("_valid"), F.col(text)), f"{schema}, _corrupt STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    broken = F.col("_r").isNull() | F.col("_r._corrupt").isNotNull() | ~is_whole_json(F.col(text))
    good = parsed.where(~broken).select(*keep, "_r.*").drop("_corrupt")
    bad = parsed.where(broken).select(*keep, F.when(F.col("_valid"), "invalid JSON").otherwise("invalid UTF-8").alias("reason"))
    return good, bad if rejects is None else bad.unionByName(rejects)


def load_author_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry entries with their place in ``entry``."""
    return registry_rows(spark.read.schema(schemas.REGISTRY).option("multiLine", True).json(path))


def registry_rows(registry: DataFrame) -> DataFrame:
    return registry.select(F.posexplode("authors").alias("entry", "a")).select("entry", "a.*")


def load_run_policy(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.POLICY).option("multiLine", True).json(path)


def policy_issues(policy: DataFrame, expected: dict[str, object], effort: str = "ultra", categories=config.CATEGORIES) -> DataFrame:
    """Fixed values, dated exceptions and unique exception runs."""
    fixed = [Rule(k, "value", f"must be {v}", F.col(k).eqNullSafe(F.lit(v))) for k, v in expected.items()]
    rows = find_issues(policy, fixed + [
        Rule("verificationScope", "value", "must be a non-empty string", ~X.is_blank("verificationScope")),
        Rule("publicationRule", "value", "must be a non-empty string", ~X.is_blank("publicationRule")),
        Rule("lastReviewed", "value", "must be a real date", times.parse_date("lastReviewed").isNotNull()),
        Rule("qualificationStatus", "value", "must not claim qualification", ~F.col("qualificationStatus").rlike(r"(?i)\bqualified\b")),
    ], {}, "policy")
    each = policy.select(F.posexplode("historicalRunExceptions").alias("position", "e")).select("position", "e.*")
    limits = F.col("maximumFullTextEvaluated")
    wanted = F.array(*[F.lit(c) for c in categories])
    exceptions = find_issues(each, [
        Rule("runId", "value", "must be a stable run identifier", F.col("runId").rlike(config.RUN_ID_PATTERN)),
        Rule("reportDate", "value", "must be a real date", times.parse_date("reportDate").isNotNull()),
        Rule("reasoningEffort", "value", f"must be {effort}", F.col("reasoningEffort") == effort),
        Rule("maximumFullTextEvaluated", "value", "must limit every category to at least 10",
             (F.size(F.array_except(F.map_keys(limits), wanted)) == 0) & (F.size(limits) == len(categories))
             & F.forall(F.map_values(limits), lambda v: v >= 10)),
        Rule("reason", "value", "must be a non-empty string", ~X.is_blank("reason")),
    ], {"id": "runId", "position": "position", "date": "reportDate"}, "exception")
    repeated = each.groupBy("runId").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return union_all([rows, exceptions, as_issue(repeated, "duplicate", "runId must be unique", "runId", {"id": "runId"}, "exception")])


def page_reason(html: Column | str, maximum_bytes: int = config.MAX_LISTING_BYTES) -> Column:
    """Why a landed page cannot be read; null for a usable one."""
    text = F.col(html) if isinstance(html, str) else html
    return (F.when(F.coalesce(F.octet_length(text), F.lit(0)) == 0, "empty")
            .when(F.octet_length(text) > maximum_bytes, "too large")
            .when(F.locate("\x00", text) > 0, "NUL byte")
            .when(~F.is_valid_utf8(text), "invalid UTF-8"))


def empty_files(files: DataFrame) -> DataFrame:
    """(path) of the files without a byte, which Spark's readers pass over.

    The names are those of the reader's own file index on the driver.
    """
    bare = lambda c: F.regexp_replace(F.coalesce(F.try_url_decode(c), c), "^([a-z0-9]+):/+", "$1:/")
    named = files.sparkSession.createDataFrame([(name,) for name in files.inputFiles()], "path string").select(bare(F.col("path")).alias("path"))
    return named.join(files.select(bare(F.col("path")).alias("path")), "path", "left_anti")


def read_pages(source: SparkSession | DataFrame, path: str | None = None, html: str = "html",
               maximum_bytes: int = config.MAX_LISTING_BYTES) -> tuple[DataFrame, DataFrame]:
    """Usable pages and rejected ones with a reason.

    Takes a table with an HTML column, or a folder of files.
    """
    if isinstance(source, DataFrame):
        pages = source
    else:
        files = source.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        # The bytes of a file above the limit are not read; it is still rejected by name.
        pages = files.where(F.col("length") <= maximum_bytes).select("path", F.col("content").cast("string").alias(html), F.lit(None).cast("string").alias("_large"))
        pages = pages.unionByName(files.where(F.col("length") > maximum_bytes).select("path", F.lit(None).cast("string").alias(html), F.lit("too large").alias("_large")))
        pages = pages.unionByName(empty_files(files).select("path", F.lit("").alias(html), F.lit(None).cast("string").alias("_large")))
    judged = pages.withColumn("reason", page_reason(html, maximum_bytes))
    if "_large" in pages.columns:
        judged = judged.withColumn("reason", F.coalesce("_large", "reason")).drop("_large")
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null").drop(html)


def read_archives(spark: SparkSession, path: str, maximum_bytes: int = config.ARCHIVE["download"]) -> tuple[DataFrame, DataFrame]:
    """Usable archives, and rejected ones with a reason; the id is the file name up to its suffix."""
    name = F.regexp_extract("path", r"(\d{4}\.\d{4,5})[^/]*$", 1).alias("id")
    files = spark.read.format("binaryFile").load(path)
    usable = files.where(F.col("length") <= maximum_bytes).select(name, "content", "length")
    large = files.where(F.col("length") > maximum_bytes).select(name, "path", "length", F.lit("too large").alias("reason"))
    empty = empty_files(files).select(name, "path", F.lit(0).cast("bigint").alias("length"), F.lit("empty").alias("reason"))
    return usable, large.unionByName(empty)


def read_events(spark: SparkSession, path: str, kind: str = "attempt", streaming: bool = False) -> DataFrame:
    """Event records, with a reason when a file does not fit its record.

    The name must hold the event's time and id; a record may not exceed 64 KiB.
    """
    schema = schemas.ATTEMPT if kind == "attempt" else schemas.PUBLICATION
    reader = spark.readStream if streaming else spark.read
    events = reader.schema(schema).option("multiLine", True).json(path)
    name = F.col("_metadata.file_name")
    stamp = F.regexp_replace(F.col("at"), "[-:]", "")
    reason = (F.when(F.col("_metadata.file_size") > config.MAX_EVENT_BYTES, "too large")
              .when(~name.rlike(EVENT_NAME), "unexpected file name")
              .when(F.regexp_extract(name, EVENT_NAME, 2) != F.col("eventId"), "eventId does not match the file name")
              .when(F.regexp_extract(name, EVENT_NAME, 1) != stamp, "time does not match the file name"))
    return events.withColumn("reason", reason)


def ordered_events(events: DataFrame) -> DataFrame:
    return events.orderBy("at", "eventId")


def scan_files(spark: SparkSession, path: str, maximum_bytes: int = config.MAX_SCANNED_BYTES) -> DataFrame:
    """path, length, first bytes and, for small files without NUL, the text."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    small = files.where(F.col("length") <= maximum_bytes).select(
        "path", "length", F.substring("content", 1, 5).alias("head"),
        F.when(F.locate("\x00", F.col("content").cast("string")) == 0, F.col("content").cast("string")).alias("text"))
    large = files.where(F.col("length") > maximum_bytes).select(
        "path", "length", F.lit(None).cast("binary").alias("head"), F.lit(None).cast("string").alias("text"))
    return small.unionByName(large)
