"""Reference-shaped tables derived from the supplied ones, in Spark and in SQL.

Every row of the source table takes part. Faults (wrong totals, missing URLs,
repeated names) follow from key arithmetic, so both sides plant the same ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dayfolio.functions import records as R
from dayfolio.operators.issues import ISSUE_COLUMNS
from dayfolio.session import shared_folder
from dayfolio.workload.registry import table

def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of this run in the shared folder, removed when the driver ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def key() -> Column:
    return F.col("o_orderkey")


def when_key(divisor: int) -> Column:
    return key() % divisor == 0


def slug_of_priority() -> Column:
    first = F.substring("o_orderpriority", 1, 1)
    return F.when(first.isin("1", "2"), "quant-ph").when(first.isin("3", "4"), "gr-qc").otherwise("hep-th")


def padded(number: Column) -> Column:
    text = number.cast("string")
    return F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)


def papers(spark: SparkSession, folder: str) -> DataFrame:
    """One scored paper per order, dated by month, three categories."""
    return papers_of(table(spark, folder, "orders"))


def papers_of(o: DataFrame, *kept: str) -> DataFrame:
    """``papers`` of any rows of the table; columns named in ``kept`` stay."""
    paper_id = F.concat(F.date_format("o_orderdate", "yyMM"), F.lit("."), padded(key()))
    axes = {"broadImpact": (F.col("o_custkey") * 7 + key()) % 26, "categoryImpact": (key() * 11) % 26,
            "originality": (F.col("o_custkey") + key() * 3) % 26, "technicalStrength": (F.col("o_custkey") * 5 + key()) % 26}
    base = o.select(
        *kept, F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd").alias("report_date"), slug_of_priority().alias("slug"),
        key().alias("index"), "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", paper_id.alias("arxivId"),
        F.struct(*[v.cast("int").alias(k) for k, v in axes.items()]).alias("scores"),
        (F.col("o_orderstatus") == "F").alias("fullTextEvaluated"))
    total = sum((F.col(f"scores.{k}") for k in axes), F.lit(0)) + F.when(when_key(53), 1).otherwise(0)
    full = F.col("fullTextEvaluated")
    return base.select(
        "*", total.cast("int").alias("totalScore"),
        F.when(when_key(41), R.abs_url_v1("arxivId")).otherwise(R.abs_url("arxivId")).alias("url"),
        F.when(full == when_key(37), "title_authors_abstract").otherwise("full_text_major_sections").alias("evaluationBasis"),
        F.when(full & ~when_key(43), "read in full").alias("fullTextReviewStatus"),
        F.when(full & ~when_key(47), F.array(R.abs_url_v1("arxivId"), R.pdf_url_v1("arxivId"))).otherwise(
            F.array(R.abs_url_v1("arxivId"))).alias("sourceUrls"))


PAPERS = """papers AS (
  SELECT *, broad + cat + orig + tech + CASE WHEN idx % 53 = 0 THEN 1 ELSE 0 END AS total,
    'https://arxiv.org/abs/' || arxiv_id || CASE WHEN idx % 41 = 0 THEN 'v1' ELSE '' END AS url,
    CASE WHEN full_text = (idx % 37 = 0) THEN 'title_authors_abstract' ELSE 'full_text_major_sections' END AS basis,
    CASE WHEN full_text AND idx % 43 <> 0 THEN 'read in full' END AS status_text,
    full_text AND idx % 47 <> 0 AS has_pdf
  FROM (SELECT o_orderkey AS idx, o_custkey, o_orderstatus, o_orderdate,
      strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS report_date,
      CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'quant-ph'
           WHEN substr(o_orderpriority, 1, 1) IN ('3', '4') THEN 'gr-qc' ELSE 'hep-th' END AS slug,
      strftime(o_orderdate, '%y%m') || '.' || CASE WHEN length(o_orderkey::VARCHAR) < 5
           THEN lpad(o_orderkey::VARCHAR, 5, '0') ELSE o_orderkey::VARCHAR END AS arxiv_id,
      (o_custkey * 7 + o_orderkey) % 26 AS broad, (o_orderkey * 11) % 26 AS cat,
      (o_custkey + o_orderkey * 3) % 26 AS orig, (o_custkey * 5 + o_orderkey) % 26 AS tech,
      o_orderstatus = 'F' AS full_text
    FROM orders))"""
PAPER_ORDER_SQL = "total DESC, broad DESC, orig DESC, tech DESC, cat DESC, arxiv_id"


def stored_rank(df: DataFrame) -> DataFrame:
    """A competition rank by total alone: tied papers share it.

    Counted per total first, so at most 102 rows per group are accumulated.
    """
    from pyspark.sql import Window
    counts = df.groupBy("report_date", "slug", "totalScore").agg(F.count(F.lit(1)).alias("_n"))
    above = Window.partitionBy("report_date", "slug").orderBy(F.desc("totalScore")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("report_date", "slug", "totalScore", (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).alias("rank"))
    return df.join(ranks, ["report_date", "slug", "totalScore"])


def authored(df: DataFrame) -> DataFrame:
    """Adds authors: the customer, a colleague, sometimes a repeat in other spelling."""
    name = F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"))
    colleague = F.concat(F.lit("Zoë Ångström-"), (F.col("o_custkey") % 10).cast("string"))
    authors = F.when(when_key(29), F.array(name, colleague, F.concat(F.lit("CUSTOMER  "), F.col("o_custkey").cast("string")))) \
        .when(when_key(31), F.array(name, F.lit(" "))).when(when_key(59), F.array().cast("array<string>")).otherwise(F.array(name, colleague))
    return df.withColumn("authors", authors)


def announcements(spark: SparkSession, folder: str) -> DataFrame:
    """Announced ids from events: key (user), date, slug, id, crosslist."""
    e = table(spark, folder, "events")
    slug = F.when(F.col("event_type").isin("view", "error"), "quant-ph").when(F.col("event_type").isin("click", "purchase"), "gr-qc").otherwise("hep-th")
    return e.select(F.col("user_id").alias("key"), F.col("ts").cast("date").alias("date"), slug.alias("slug"),
                    F.concat(F.date_format("ts", "yyMM"), F.lit("."), padded(F.col("event_id"))).alias("id"),
                    F.col("event_type").isin("error").alias("crosslist"), "event_id", "event_type", "ts", "value")


ANNOUNCED = """announced AS (
  SELECT user_id AS key, ts::DATE AS date,
    CASE WHEN event_type IN ('view', 'error') THEN 'quant-ph' WHEN event_type IN ('click', 'purchase') THEN 'gr-qc' ELSE 'hep-th' END AS slug,
    strftime(ts, '%y%m') || '.' || CASE WHEN length(event_id::VARCHAR) < 5 THEN lpad(event_id::VARCHAR, 5, '0') ELSE event_id::VARCHAR END AS id,
    event_type = 'error' AS crosslist, event_id, event_type, ts, value FROM events)"""


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Attempt events: job (user), attempt, stage, status, time, receipt flag."""
    return attempts_of(table(spark, folder, "events"))


def attempts_of(events: DataFrame) -> DataFrame:
    e = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    stage = F.when(F.col("k") % 4 == 0, "category_source_resume").when(F.col("k") % 4 == 1, "category_repair") \
        .when(F.col("k") % 4 == 2, "category_generation").otherwise("publication")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "completed") \
        .when(F.col("event_type") == "view", "started").when(F.col("event_type") == "click", "deferred").otherwise("resumed")
    structured = (F.col("event_type") == "error") & (F.col("k") >= 60)
    return e.select(
        F.col("user_id").alias("job"), F.concat(F.lit("a"), F.floor(F.col("k") / 5).cast("string")).alias("attempt_id"),
        "event_id", stage.alias("stage"), status.alias("status"), F.col("ts").alias("at"), structured.alias("structured"),
        F.when(structured, F.col("ts") - F.expr("interval 30 minutes")).otherwise(F.col("ts")).alias("observed_at"))


ATTEMPTS = """attempts AS (
  SELECT user_id AS job, 'a' || (k // 5)::VARCHAR AS attempt_id, event_id,
    CASE k % 4 WHEN 0 THEN 'category_source_resume' WHEN 1 THEN 'category_repair' WHEN 2 THEN 'category_generation' ELSE 'publication' END AS stage,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' WHEN 'view' THEN 'started' WHEN 'click' THEN 'deferred' ELSE 'resumed' END AS status,
    ts AS at, event_type = 'error' AND k >= 60 AS structured,
    CASE WHEN event_type = 'error' AND k >= 60 THEN ts - INTERVAL 30 MINUTE ELSE ts END AS observed_at
  FROM (SELECT *, json_extract_string(props, '$.k')::INT AS k FROM events))"""


def plain(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Selects result columns, with dates as text and counts as BIGINT."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def issue_rows(issues: DataFrame, *columns: str) -> DataFrame:
    """The named issue columns as text; position as BIGINT."""
    return issues.select(*[F.col(c) for c in (columns or ISSUE_COLUMNS)])
