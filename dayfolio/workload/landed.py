"""Files landed from the supplied tables under the names their readers demand, read back with the rejects."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from dayfolio import config
from dayfolio.operators.issues import union_all
from dayfolio.operators.ranking import split_top
from dayfolio.plans.audits import audit_safety
from dayfolio.sources import readers, writers as S
from dayfolio.workload.derive import PAPERS, PAPER_ORDER_SQL, issue_rows, papers, scratch
from dayfolio.workload.registry import query, table


def land(df: DataFrame, label: str, name: Column, text: Column) -> str:
    """Writes each row's text, and a line feed, to a file of the given name; returns the folder.

    Tasks write the files under their names, so the driver does nothing per
    file. Rows of one name are lines of one file. A file is written beside the
    folder and moved there when it is whole, so a repeated task does no harm.
    """
    spark = df.sparkSession
    folder = scratch(spark, label)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{folder}/files"))
    files.mkdirs(path(f"{folder}/written"))
    target = re.sub("^file:/+", "file:///", path(folder).makeQualified(files.getUri(), files.getWorkingDirectory()).toString())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pa.fs.FileSystem.from_uri(target)
        lines = ((n, t) for batch in batches for n, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for file, held in groupby(lines, key=itemgetter(0)):
            made = f"{root}/written/{uuid.uuid4().hex}"
            with store.open_output_stream(made) as out:
                for _, line in held:
                    out.write(((line or "") + "\n").encode())
            store.move(made, f"{root}/files/{file}")
        yield pa.RecordBatch.from_pydict({"file": pa.array([], pa.string())})

    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    df.select(name.alias("file"), text.alias("text")).repartition(tasks, "file").sortWithinPartitions("file").mapInArrow(write, "file string").count()
    return f"{folder}/files"


def month(date: str = "report_date") -> Column:
    return F.year(date) * 12 + F.month(date)


MONTH = "(year(report_date::DATE) * 12 + month(report_date::DATE))"
LANDED = f"""{PAPERS}, r AS (SELECT report_date, slug, count(*) AS n, {MONTH} AS m FROM papers GROUP BY ALL),
  f AS (SELECT *, NOT (m % 11 = 0 AND slug = 'hep-th') AS named, CASE WHEN m % 5 = 0 AND slug = 'gr-qc' THEN 'quant-ph' ELSE slug END AS held,
    CASE WHEN m % 9 = 4 AND slug = 'hep-th' THEN '2001-01-01' ELSE report_date END AS dated FROM r WHERE NOT (m % 7 = 0 AND slug = 'quant-ph')),
  k AS (SELECT *, CASE WHEN named THEN report_date || '-' || slug || '.json' ELSE 'report-' || report_date || '.json' END AS file FROM f)"""


def landed_reports(spark, folder) -> DataFrame:
    """A report a date and category: some missing, some under another name, some that disagree with their name."""
    r = papers(spark, folder).groupBy("report_date", "slug").agg(F.count(F.lit(1)).cast("int").alias("totalNew")).withColumn("m", month())
    r = r.where(~((F.col("m") % 7 == 0) & (F.col("slug") == "quant-ph")))
    named = ~((F.col("m") % 11 == 0) & (F.col("slug") == "hep-th"))
    name = F.when(named, F.concat("report_date", F.lit("-"), "slug", F.lit(".json"))).otherwise(F.concat(F.lit("report-"), "report_date", F.lit(".json")))
    record = F.struct(
        F.lit("1.4").alias("schemaVersion"), F.when((F.col("m") % 9 == 4) & (F.col("slug") == "hep-th"), "2001-01-01").otherwise(F.col("report_date")).alias("reportDate"),
        F.when((F.col("m") % 5 == 0) & (F.col("slug") == "gr-qc"), "quant-ph").otherwise(F.col("slug")).alias("slug"), "totalNew")
    return readers.read_reports(spark, land(r, "reports", name, F.to_json(record)))


@query("s1_read_reports", f"WITH {LANDED} SELECT file, CASE WHEN named THEN report_date END AS report_date, CASE WHEN named THEN slug END AS file_slug, held AS slug, n::INT AS total FROM k")
def read_reports(spark, folder):
    return landed_reports(spark, folder).select(F.col("file_name").alias("file"), "report_date", "file_slug", "slug", F.col("totalNew").alias("total"))


@query("s1_report_file_issues", f"""WITH {LANDED} SELECT NULL::VARCHAR AS date, file AS id, 'file' AS path FROM k WHERE NOT named
  UNION ALL SELECT report_date, file, 'slug' FROM k WHERE named AND held <> slug UNION ALL SELECT report_date, file, 'reportDate' FROM k WHERE named AND dated <> report_date
  UNION ALL SELECT report_date, NULL, 'reports' FROM k WHERE named GROUP BY 1 HAVING count(DISTINCT slug) < 3""")
def report_file_issues(spark, folder):
    return issue_rows(readers.report_file_issues(landed_reports(spark, folder)), "date", "id", "path")


@query("s2_read_editions", f"""WITH {PAPERS}, e AS (SELECT report_date, count(*) AS n, {MONTH} AS m, row_number() OVER (ORDER BY report_date DESC) AS place FROM papers GROUP BY 1)
  SELECT 'edition' AS kind, report_date AS name, CASE WHEN m % 4 = 1 THEN 'failed' ELSE 'ok' END AS status, place FROM e
  UNION ALL SELECT 'stray', 'notes-' || report_date || '.json', NULL, NULL FROM e WHERE m % 6 = 0
  UNION ALL SELECT 'index', report_date, NULL, 1 FROM e WHERE place = 1""")
def read_editions(spark, folder):
    """Dated editions newest first, the index beside them, and the files that are neither."""
    from dayfolio.operators.ordering import with_position

    dates = papers(spark, folder).select("report_date").distinct().withColumn("m", month())
    edition = F.to_json(F.struct(F.lit("1.4").alias("schemaVersion"), F.col("report_date").alias("date"), F.when(F.col("m") % 4 == 1, "failed").otherwise("ok").alias("status")))
    newest = dates.agg(F.max("report_date").alias("latestDate"))
    files = dates.select(F.concat("report_date", F.lit(".json")).alias("n"), edition.alias("t")).unionByName(
        dates.where("m % 6 = 0").select(F.concat(F.lit("notes-"), "report_date", F.lit(".json")).alias("n"), F.lit("{}").alias("t"))).unionByName(
        newest.select(F.lit("index.json").alias("n"), F.to_json(F.struct("latestDate")).alias("t")))
    path = land(files, "editions", F.col("n"), F.col("t"))
    editions = readers.read_editions(spark, path)
    placed = with_position(readers.available_dates(editions, "file_date"), [], [-F.unix_date(F.col("file_date").cast("date"))], "place")
    return union_all([
        editions.select(F.lit("edition").alias("kind"), F.col("file_date").alias("name"), "status").join(placed.withColumnRenamed("file_date", "name"), "name"),
        readers.stray_files(spark, path).select(F.lit("stray").alias("kind"), "name"),
        readers.read_index(spark, f"{path}/index.json").select(F.lit("index").alias("kind"), F.col("latestDate").alias("name"), F.lit(1).cast("int").alias("place")),
    ]).select("kind", "name", "status", F.col("place").cast("bigint").alias("place"))


POLICY_FAULTS = [("runId", "k % 7 = 0"), ("reportDate", "k % 6 = 0"), ("reasoningEffort", "k % 5 = 0"), ("maximumFullTextEvaluated", "k % 11 = 0 OR k % 17 = 3"), ("reason", "k % 13 = 0")]


@query("s5_run_policy", "WITH e AS (SELECT s_suppkey AS k, s_nationkey AS nation, CASE WHEN s_suppkey % 7 = 0 THEN 'r' || s_suppkey ELSE 'run-' || lpad((s_suppkey - CASE WHEN s_suppkey % 19 = 0 THEN 1 ELSE 0 END)::VARCHAR, 9, '0') END AS run FROM supplier) "
       + " UNION ALL ".join(f"SELECT 'exception' AS scope, run AS id, '{path}' AS path FROM e WHERE {condition}" for path, condition in POLICY_FAULTS)
       + """ UNION ALL SELECT 'exception', run, 'runId' FROM e GROUP BY run HAVING count(*) > 1
  UNION ALL SELECT 'policy', NULL, p FROM (SELECT DISTINCT nation FROM e), (VALUES ('schemaVersion', 4), ('lastReviewed', 5), ('qualificationStatus', 3)) AS v(p, d) WHERE nation % d = 1""")
def run_policy(spark, folder):
    """A policy a nation, whose dated exceptions are its suppliers' runs."""
    k, nation = F.col("s_suppkey"), F.col("s_nationkey")
    run = F.when(k % 7 == 0, F.concat(F.lit("r"), k.cast("string"))).otherwise(F.concat(F.lit("run-"), F.lpad((k - F.when(k % 19 == 0, 1).otherwise(0)).cast("string"), 9, "0")))
    each = F.struct(k.alias("k"), run.alias("run"))
    limit = lambda n: F.when(n % 17 == 3, 9).otherwise(12)

    def exception(x: Column) -> Column:
        n = x["k"]
        limits = F.when(n % 11 == 0, F.create_map(F.lit("gr-qc"), limit(n))).otherwise(F.create_map(*[v for c in config.CATEGORIES for v in (F.lit(c), limit(n))]))
        return F.struct(x["run"].alias("runId"), F.when(n % 6 == 0, "2024-02-30").otherwise("2024-02-28").alias("reportDate"), F.when(n % 5 == 0, "high").otherwise("ultra").alias("reasoningEffort"),
                        limits.alias("maximumFullTextEvaluated"), F.when(n % 13 == 0, " ").otherwise("moved").alias("reason"))

    # A nation's suppliers are one policy file, read as one record.
    policies = table(spark, folder, "supplier").groupBy("s_nationkey").agg(F.transform(F.sort_array(F.collect_list(each)), exception).alias("historicalRunExceptions"))
    record = F.struct(
        F.when(nation % 4 == 1, "0.9").otherwise("1.0").alias("schemaVersion"), F.when(nation % 5 == 1, "2024-13-01").otherwise("2024-01-31").alias("lastReviewed"),
        F.when(nation % 3 == 1, "Qualified by us").otherwise("not assessed").alias("qualificationStatus"), F.lit("all runs").alias("verificationScope"),
        F.lit("as scheduled").alias("publicationRule"), "historicalRunExceptions")
    path = land(policies, "policies", F.concat(F.lit("policy-"), nation.cast("string"), F.lit(".json")), F.to_json(record))
    return issue_rows(readers.policy_issues(readers.load_run_policy(spark, path), {"schemaVersion": "1.0"}), "scope", "id", "path")


SUPPLIED = "SELECT s_suppkey AS k, repeat(s_name || ' ', (s_suppkey % 9 + 1)::INT) || CASE WHEN s_suppkey % 8 = 3 THEN 'password = ' || repeat('q', 20) ELSE '' END AS body FROM supplier"


def supplied(spark, folder) -> DataFrame:
    k = F.col("s_suppkey")
    body = F.concat(F.expr("repeat(concat(s_name, ' '), cast(s_suppkey % 9 + 1 as int))"), F.when(k % 8 == 3, F.concat(F.lit("password = "), F.lit("q" * 20))).otherwise(""))
    return table(spark, folder, "supplier").select(k.alias("k"), body.alias("body"))


@query("s7_read_archives", f"""WITH b AS ({SUPPLIED}), a AS (SELECT lpad((k // 10000)::VARCHAR, 4, '0') || '.' || lpad((k % 10000)::VARCHAR, 5, '0') AS id, strlen(body) + 1 AS length, body FROM b)
  SELECT id, length, CASE WHEN length > 120 THEN 'too large' END AS reason, CASE WHEN length <= 120 THEN sha256(body || chr(10)) END AS digest FROM a""")
def read_archives(spark, folder):
    """Archives by the id in their name; those above the limit are rejected without a look inside."""
    k = F.col("k")
    name = F.concat(F.lpad(F.floor(k / 10000).cast("string"), 4, "0"), F.lit("."), F.lpad((k % 10000).cast("string"), 5, "0"), F.lit(".gz"))
    usable, refused = readers.read_archives(spark, land(supplied(spark, folder), "archives", name, F.col("body")), maximum_bytes=120)
    return usable.select("id", "length", F.lit(None).cast("string").alias("reason"), F.sha2("content", 256).alias("digest")).unionByName(
        refused.select("id", "length", "reason", F.lit(None).cast("string").alias("digest")))


FILES_SQL = f"""b AS ({SUPPLIED}), f AS (SELECT CASE k % 6 WHEN 1 THEN k || '.pem' WHEN 2 THEN k || '.pdf' ELSE k || '.txt' END AS file, k,
    CASE WHEN k % 6 = 4 THEN '%PDF-' || body ELSE body END || chr(10) AS content FROM b)"""


def landed_files(spark, folder) -> DataFrame:
    kind = F.col("k") % 6
    files = supplied(spark, folder).withColumn("body", F.when(kind == 4, F.concat(F.lit("%PDF-"), "body")).otherwise(F.col("body")))
    name = F.concat(F.col("k").cast("string"), F.when(kind == 1, ".pem").when(kind == 2, ".pdf").otherwise(".txt"))
    found = readers.scan_files(spark, land(files, "tree", name, F.col("body")), maximum_bytes=150)
    return found.withColumn("file", F.regexp_extract("path", "([^/]*)$", 1))


@query("s9_scan_files", f"""WITH {FILES_SQL} SELECT file, strlen(content) AS length, CASE WHEN strlen(content) <= 150 THEN substr(content, 1, 5) END AS head,
  CASE WHEN strlen(content) <= 150 THEN sha256(content) END AS digest FROM f""")
def scan_files(spark, folder):
    return landed_files(spark, folder).select("file", "length", F.col("head").cast("string").alias("head"), F.sha2("text", 256).alias("digest"))


@query("s9_audit_files", f"""WITH {FILES_SQL} SELECT file, 'file name' AS rule FROM f WHERE k % 6 = 1 UNION ALL SELECT file, 'pdf name' FROM f WHERE k % 6 = 2
  UNION ALL SELECT file, 'pdf content' FROM f WHERE k % 6 = 4 AND strlen(content) <= 150 UNION ALL SELECT file, 'too large' FROM f WHERE strlen(content) > 150
  UNION ALL SELECT file, 'assignment' FROM f WHERE k % 8 = 3 AND strlen(content) <= 150""")
def audit_files(spark, folder):
    found = audit_safety(landed_files(spark, folder).withColumn("path", F.col("file")), maximum_bytes=150)
    return found.select(F.col("path").alias("file"), "rule")


@query("s8_read_events", """WITH e AS (SELECT user_id AS u, min(event_id) AS id FROM events GROUP BY 1), t AS (SELECT e.u, e.id, lpad(lower(to_hex(e.id)), 32, '0') AS event, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(((epoch_us(ts) // 1000) % 1000)::VARCHAR, 3, '0') || 'Z' AS at FROM e JOIN events ON events.event_id = e.id)
  SELECT event, "at", CASE WHEN u % 13 = 0 THEN 'too large' WHEN u % 17 = 0 THEN 'unexpected file name' WHEN u % 7 = 0 THEN 'eventId does not match the file name' WHEN u % 11 = 0 THEN 'time does not match the file name' END AS reason FROM t""")
def read_events(spark, folder):
    """The first event of each user as a record of its own, some under a name that does not fit."""
    e = table(spark, folder, "events").groupBy(F.col("user_id").alias("u")).agg(F.min_by(F.struct("event_id", "ts"), "event_id").alias("e")).select("u", "e.*")
    u, event, at = F.col("u"), F.lpad(F.lower(F.hex("event_id")), 32, "0"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    stamp = F.regexp_replace(F.when(u % 11 == 0, F.date_format(F.col("ts") + F.expr("interval 1 second"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).otherwise(at), "[-:]", "")
    name = F.when(u % 17 == 0, F.concat(F.lit("event-"), event, F.lit(".json"))).otherwise(
        F.concat(stamp, F.lit("-"), F.when(u % 7 == 0, F.lpad(F.lower(F.hex(F.col("event_id") + 1)), 32, "f")).otherwise(event), F.lit(".json")))
    record = F.struct(F.lit("1.0").alias("schemaVersion"), F.lit("attempt").alias("kind"), event.alias("eventId"), at.alias("at"), F.lit("failed").alias("status"),
                      F.when(u % 13 == 0, F.expr("repeat('m', 70000)")).otherwise("short").alias("message"))
    found = readers.read_events(spark, land(e, "events", name, F.to_json(record)))
    return readers.ordered_events(found).select(F.col("eventId").alias("event"), "at", "reason")


@query("u1_union_records", f"WITH {PAPERS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY report_date, slug ORDER BY {PAPER_ORDER_SQL}) AS rank FROM papers) "
       "SELECT report_date, slug, arxiv_id, CASE WHEN rank <= 10 THEN rank END AS place, CASE WHEN rank > 10 THEN total END AS total FROM ranked")
def union_records(spark, folder):
    """Top and remaining records in one table, each with the columns it has."""
    top, rest = split_top(papers(spark, folder))
    both = union_all([top.select("report_date", "slug", "arxivId", F.col("rank").cast("bigint").alias("place")),
                      rest.select("report_date", "slug", "arxivId", F.col("totalScore").cast("bigint").alias("total"))])
    return both.withColumnRenamed("arxivId", "arxiv_id")


@query("s14_export_refused", f"""WITH {PAPERS}, r AS (SELECT report_date AS job, slug, string_agg(arxiv_id, ',' ORDER BY arxiv_id) AS payload, {MONTH} AS m FROM papers GROUP BY ALL),
  v AS (SELECT * FROM r WHERE NOT (m % 5 = 0 AND slug = 'gr-qc')) SELECT job, slug, sha256(payload) AS digest, true AS refused FROM v WHERE job IN (SELECT job FROM v GROUP BY 1 HAVING count(*) = 3)""")
def export_refused(spark, folder):
    """Whole sets are exported once; a second export to the same target is turned away and changes nothing."""
    from dayfolio.workload.sinks import refused

    records = papers(spark, folder).groupBy(F.col("report_date").alias("job"), "slug").agg(F.array_join(F.sort_array(F.collect_list("arxivId")), ",").alias("payload"))
    stale = (month("job") % 5 == 0) & (F.col("slug") == "gr-qc")
    receipts = records.select("job", "slug", F.sha2(F.when(stale, F.concat("payload", F.lit("!"))).otherwise(F.col("payload")), 256).alias("sha256"), F.octet_length("payload").cast("bigint").alias("bytes"))
    path = scratch(spark, "exported")
    S.export_complete_set(records, receipts, path, ["job"])
    turned_away = refused(lambda: S.export_complete_set(records.withColumn("payload", F.lit("other")), receipts, path, ["job"]))
    return spark.read.schema("slug string, payload string, job string").parquet(path).select("job", "slug", F.sha2("payload", 256).alias("digest"), F.lit(turned_away).alias("refused"))
