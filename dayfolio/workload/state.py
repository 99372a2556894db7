"""Retry, publication and job state from the event table, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfolio.operators import aggregates as A
from dayfolio.operators.skew import attach_row
from dayfolio.plans import jobs as J
from dayfolio.streaming import ingest, state as ST
from dayfolio.workload.counts import PUBLICATION_SQL, publications, publications_of
from dayfolio.workload.derive import ATTEMPTS, attempts, attempts_of, issue_rows, scratch
from dayfolio.workload.registry import query, table

NOW = "2024-01-31 00:00:00"
now = lambda: F.lit(NOW).cast("timestamp_ntz")

OUTCOMES = f"""{ATTEMPTS}, done AS (SELECT job, max(event_id) AS last FROM attempts WHERE status = 'completed' GROUP BY 1),
  recent AS (SELECT a.* FROM attempts a LEFT JOIN done d USING (job) WHERE d.last IS NULL OR a.event_id > d.last),
  f AS (SELECT *, row_number() OVER (PARTITION BY job, attempt_id ORDER BY structured DESC, observed_at DESC, event_id DESC) AS n FROM recent
    WHERE status = 'failed' AND (structured OR stage IN ('category_generation', 'category_source_resume', 'category_repair'))),
  best AS (SELECT job, attempt_id, structured, observed_at, event_id, CASE WHEN structured THEN 'source_incomplete' WHEN stage = 'category_repair' THEN 'repair_failure' ELSE 'generation_failure' END AS kind, false AS orphan FROM f WHERE n = 1),
  st AS (SELECT job, attempt_id, max(event_id) FILTER (status = 'started' AND stage IN ('category_generation', 'category_source_resume')) AS s, max(event_id) FILTER (status = 'failed') AS t FROM recent GROUP BY 1, 2),
  orphans AS (SELECT st.job, st.attempt_id, false AS structured, r.at AS observed_at, st.s AS event_id, 'generation_failure' AS kind, true AS orphan FROM st JOIN recent r ON r.event_id = st.s
    WHERE (t IS NULL OR s > t) AND (st.job, st.attempt_id) NOT IN (SELECT (job, attempt_id) FROM best) AND r.at + INTERVAL 5 HOUR <= TIMESTAMP '{NOW}'),
  o AS (SELECT * FROM best UNION ALL SELECT * FROM orphans)"""


@query("w6_dedupe_attempts", f"""WITH {ATTEMPTS}, f AS (SELECT *, row_number() OVER (PARTITION BY job, attempt_id ORDER BY structured DESC, observed_at DESC, event_id DESC) AS n FROM attempts
  WHERE status = 'failed' AND (structured OR stage IN ('category_generation', 'category_source_resume', 'category_repair'))) SELECT job, attempt_id, event_id, structured FROM f WHERE n = 1""")
def dedupe_attempts(spark, folder):
    return J.dedupe_attempts(attempts(spark, folder), ["job"]).select("job", "attempt_id", "event_id", "structured")


@query("w7_since_last_success", f"WITH {OUTCOMES} SELECT job, event_id, status FROM recent")
def since_last_success(spark, folder):
    return J.since_last_success(attempts(spark, folder), ["job"]).select("job", "event_id", "status")


@query("w8_orphan_starts", f"WITH {OUTCOMES} SELECT job, attempt_id, strftime(observed_at, '%Y-%m-%d %H:%M:%S') AS started FROM orphans")
def orphan_starts(spark, folder):
    found = J.orphan_starts(attempts(spark, folder), ["job"], now())
    return found.select("job", "attempt_id", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started"))


LATEST_SQL = f"""WITH {OUTCOMES}, c AS (SELECT job, count(*) AS failure_count, count(*) FILTER (structured) AS source_failure_count FROM o GROUP BY 1),
  l AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY observed_at DESC, event_id DESC) AS n FROM o), z AS (SELECT * FROM l JOIN c USING (job) WHERE n = 1),
  d AS (SELECT *, (CASE WHEN structured THEN [0.25, 4, 18, 36, 72][least(source_failure_count, 5)] ELSE [1, 4, 12, 24][least(failure_count - source_failure_count, 4)] END)::DOUBLE AS delay_hours FROM z)"""


@query("w9_latest_failure", f"{LATEST_SQL} SELECT job, failure_count, source_failure_count, kind, attempt_id AS latest_attempt_id FROM d")
def latest_failure(spark, folder):
    outcomes = J.attempt_outcomes(attempts(spark, folder), ["job"], now())
    return J.latest_failure(outcomes, ["job"]).select("job", "failure_count", "source_failure_count", "kind", "latest_attempt_id")


@query("r1_retry_state", f"""{LATEST_SQL} SELECT job, kind, failure_count, source_failure_count, delay_hours, strftime(observed_at + to_microseconds((delay_hours * 3600000000)::BIGINT), '%Y-%m-%d %H:%M:%S') AS retry_at,
  observed_at + to_microseconds((delay_hours * 3600000000)::BIGINT) > TIMESTAMP '{NOW}' AS should_defer FROM d""")
def retry_state(spark, folder):
    found = J.retry_state(attempts(spark, folder), ["job"], now())
    return found.select("job", "kind", "failure_count", "source_failure_count", "delay_hours", F.date_format("retry_at", "yyyy-MM-dd HH:mm:ss").alias("retry_at"), "should_defer")


@query("r2_deferral", f"""{LATEST_SQL}, m AS (SELECT *, CASE job % 3 WHEN 0 THEN 'repair' WHEN 1 THEN 'source_resume' ELSE 'generation' END AS mode, observed_at + to_microseconds((delay_hours * 3600000000)::BIGINT) > TIMESTAMP '{NOW}' AS wait FROM d)
  SELECT job, mode, wait AND mode <> 'repair' AND NOT (mode = 'source_resume' AND structured) AS "defer", wait AND mode = 'source_resume' AND structured AS bypassed FROM m""")
def deferral(spark, folder):
    r = J.retry_state(attempts(spark, folder), ["job"], now())
    mode = F.when(F.col("job") % 3 == 0, "repair").when(F.col("job") % 3 == 1, "source_resume").otherwise("generation")
    d = r.withColumn("mode", mode).withColumn("d", J.deferral(F.col("mode"), F.col("should_defer"), F.col("structured")))
    return d.select("job", "mode", F.col("d.defer").alias("defer"), F.col("d.cooldown_bypassed").alias("bypassed"))


@query("w5_latest_draft", f"WITH {ATTEMPTS} SELECT job, stage, max(event_id) AS event_id, arg_max(status, event_id) AS status FROM attempts GROUP BY 1, 2")
def latest_draft(spark, folder):
    return J.latest_draft(attempts(spark, folder), ["job", "stage"]).select("job", "stage", "event_id", "status")


@query("r3_next_action", f"""WITH {ATTEMPTS}, k AS (SELECT DISTINCT job FROM attempts), c AS (SELECT DISTINCT job FROM attempts WHERE status = 'completed' AND stage = 'publication'),
  d AS (SELECT job, arg_max(structured, event_id) AS has_receipt FROM attempts WHERE status = 'failed' AND stage = 'category_generation' GROUP BY 1),
  r AS (SELECT job, count(DISTINCT attempt_id) AS n FROM attempts WHERE stage = 'category_repair' AND status = 'failed' GROUP BY 1)
  SELECT k.job, CASE WHEN c.job IS NOT NULL THEN 'reuse' WHEN has_receipt IS NULL THEN 'generate' WHEN has_receipt THEN 'resume' WHEN coalesce(n, 0) >= 4 THEN 'regenerate' ELSE 'repair' END AS action, coalesce(n, 0) AS repair_failures
  FROM k LEFT JOIN c USING (job) LEFT JOIN d USING (job) LEFT JOIN r USING (job)""")
def next_action(spark, folder):
    a = attempts(spark, folder)
    drafts = a.where("status = 'failed' and stage = 'category_generation'").withColumn("has_receipt", F.col("structured"))
    return J.next_action(a.select("job").distinct(), a.where("status = 'completed' and stage = 'publication'"), drafts, a, ["job"])


@query("r6_publication_state", f"WITH {PUBLICATION_SQL} SELECT job, arg_max(status, event_id) AS last_status, count(*) FILTER (commit IS NOT NULL) > 0 AS terminal FROM p GROUP BY 1")
def publication(spark, folder):
    found = A.publication_state(publications(spark, folder), ["job"])
    return found.select("job", "last_status", F.col("published_commit").isNotNull().alias("terminal"))


@query("r10_open_jobs", """WITH e AS (SELECT user_id AS job, min(event_id) FILTER (event_type = 'signup') AS old, min(event_id) FILTER (event_type = 'view') AS new FROM events GROUP BY 1)
  SELECT job, 'run-' || coalesce(old, new) AS run, old IS NULL AS opened FROM e WHERE old IS NOT NULL OR new IS NOT NULL""")
def open_jobs(spark, folder):
    e = table(spark, folder, "events").select(F.col("user_id").alias("job"), F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("evaluationRunId"), F.col("event_id").alias("createdAt"), F.lit("s").alias("snapshotSha256"), "event_type")
    jobs, _ = J.open_jobs(e.where("event_type = 'signup'").drop("event_type"), e.where("event_type = 'view'").drop("event_type"), ["job"])
    return jobs.select("job", F.col("evaluationRunId").alias("run"), "opened")


@query("p27_check_job", """SELECT user_id::VARCHAR AS date, 'digest' AS kind, 1 AS rows FROM events WHERE user_id % 5 = 0 GROUP BY 1 UNION ALL SELECT user_id::VARCHAR, 'missing', 1 FROM events WHERE user_id % 7 = 0 GROUP BY 1
  UNION ALL SELECT user_id::VARCHAR, 'run', 1 FROM events WHERE event_type = 'error' GROUP BY 1""".replace("user_id % 5 = 0 GROUP", "user_id % 5 = 0 AND user_id % 7 <> 0 GROUP"))
def check_job(spark, folder):
    e = table(spark, folder, "events").select(F.col("user_id").alias("reportDate"), F.lit("f").alias("snapshotFingerprint"), F.lit("r").alias("runtimeFingerprint"), F.when(F.col("event_type") == "error", "other").otherwise("run").alias("evaluationRunId"))
    jobs = e.select("reportDate", "snapshotFingerprint", "runtimeFingerprint").distinct().withColumn("evaluationRunId", F.lit("run")).withColumn("snapshotSha256", F.lit("s"))
    snapshots = jobs.where("reportDate % 7 <> 0").select("reportDate", "snapshotFingerprint", F.when(F.col("reportDate") % 5 == 0, "t").otherwise("s").alias("sha256"))
    return issue_rows(J.check_job(jobs, snapshots, e), "date", "kind").groupBy("date", "kind").agg(F.count(F.lit(1)).cast("int").alias("rows"))


@query("r9_import_records", """WITH s AS (SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) SELECT doc_id, 'added' AS outcome FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND length(text) > 50
  UNION ALL SELECT doc_id, 'failed validation' FROM documents WHERE length(text) <= 50 UNION ALL SELECT doc_id, 'differs from the stored record' FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) AND doc_id % 10 = 3 AND length(text) > 50""")
def import_records(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", F.col("text").alias("payload"))
    held = d.join(table(spark, folder, "labels").select("doc_id").distinct(), "doc_id").select("doc_id", F.sha2(F.when(F.col("doc_id") % 10 == 3, F.concat("payload", F.lit("!"))).otherwise(F.col("payload")), 256).alias("sha256"))
    fresh, refused = J.import_records(d, held, ["doc_id"], [lambda df: F.char_length("payload") > 50], transform=lambda df: df.select("doc_id", "payload"))
    return fresh.select("doc_id", F.lit("added").alias("outcome")).unionByName(refused.select("doc_id", F.col("reason").alias("outcome")))


# Streams -------------------------------------------------------------------------------------------------------

def event_stream(spark, folder):
    schema = table(spark, folder, "events").schema
    return ingest.table_stream(spark, folder, "events.parquet", schema)


@query("r5_unique_events_stream", "SELECT event_id, user_id, event_type FROM events")
def unique_events_stream(spark, folder):
    path = scratch(spark, "unique")
    stream = event_stream(spark, folder).withColumn("event_time", F.col("ts").cast("timestamp"))
    doubled = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    unique = ingest.unique_events(doubled, ["event_id"]).select("event_id", "user_id", "event_type")
    ingest.run_to_table(unique, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out")


# A stream judges orphans at the newest event of their key.
STREAM_SQL = LATEST_SQL.replace(f"<= TIMESTAMP '{NOW}'", "<= mx.newest").replace(
    "ON r.event_id = st.s\n", "ON r.event_id = st.s JOIN (SELECT job, max(\"at\") AS newest FROM attempts GROUP BY 1) mx ON mx.job = st.job\n")


@query("r1_retry_state_stream", f"{STREAM_SQL} SELECT job, kind, failure_count, source_failure_count, delay_hours, attempt_id AS latest_attempt_id FROM d")
def retry_state_stream(spark, folder):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    path = scratch(spark, "retry")
    stream = attempts_of(event_stream(spark, folder)).withColumn("event_time", F.col("at").cast("timestamp"))
    ingest.run_changes(ST.retry_stream(stream, ["job"], "60 days"), f"{path}/out", f"{path}/checkpoint", ["job"])
    found = ingest.latest_changes(spark, f"{path}/out", ["job"]).where("active")
    return found.select("job", "kind", "failure_count", "source_failure_count", "delay_hours", "latest_attempt_id")


@query("r6_publication_stream", f"WITH {PUBLICATION_SQL} SELECT job, arg_max(status, event_id) AS last_status, count(DISTINCT commit) > 1 AS conflicting FROM p GROUP BY 1")
def publication_stream(spark, folder):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    path = scratch(spark, "publication")
    stream = ST.publication_stream(publications_of(event_stream(spark, folder)), ["job"])
    ingest.run_changes(stream, f"{path}/out", f"{path}/checkpoint", ["job"])
    return ingest.latest_changes(spark, f"{path}/out", ["job"]).select("job", "last_status", "conflicting")


@query("r8_new_dates_stream", "SELECT DISTINCT ts::DATE::VARCHAR AS date FROM events WHERE ts::DATE > (SELECT min(ts)::DATE + 4 FROM events)")
def new_dates_stream(spark, folder):
    path = scratch(spark, "dates")
    e = table(spark, folder, "events")
    first = e.agg(F.date_add(F.min("ts"), 4).alias("limit"))
    attach_row(e.select(F.col("ts").cast("date").alias("day")).distinct(), first).where("day <= limit").select(F.col("day").cast("string").alias("date")).write.parquet(f"{path}/published")
    stream = event_stream(spark, folder).select(F.col("ts").cast("date").cast("string").alias("date"))
    ingest.new_dates_stream(stream, f"{path}/published", f"{path}/queue", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/queue").select("date")


@query("r9_import_stream", "SELECT doc_id, sha256(text) AS sha256 FROM documents WHERE length(text) > 50")
def import_stream(spark, folder):
    path = scratch(spark, "import")
    schema = table(spark, folder, "documents").schema
    stream = ingest.table_stream(spark, folder, "documents.parquet", schema).select("doc_id", F.col("text").alias("payload"))
    ingest.import_stream(stream, f"{path}/store", f"{path}/refused", f"{path}/checkpoint", ["doc_id"], [lambda df: F.char_length("payload") > 50]).awaitTermination()
    return spark.read.parquet(f"{path}/store").select("doc_id", "sha256")
