"""Row predicates over derived papers, reports, listings and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfolio import config
from dayfolio.functions import records as R
from dayfolio.operators import checks as C, reconcile as RC
from dayfolio.operators.issues import Rule, collect_issues, find_issues, order_issues, summarize_issues
from dayfolio.workload.counts import PUBLICATION_SQL, publications
from dayfolio.workload.derive import ANNOUNCED, PAPERS, announcements, authored, issue_rows, papers, when_key
from dayfolio.workload.registry import query, table

KEYS = {"date": "report_date", "slug": "slug", "id": "arxivId", "position": "index"}


def raw_records(spark, folder):
    """JSON text per order, some with a missing or an unknown key, some broken."""
    o = table(spark, folder, "orders")
    text = F.concat(F.lit('{"id": '), F.col("o_orderkey").cast("string"), F.when(when_key(7), '').otherwise(', "status": "x"'),
                    F.when(when_key(11), ', "note": null').otherwise(''), F.when(when_key(97), '').otherwise('}'))
    return o.select("o_orderkey", text.alias("raw"))


@query("p1_check_keys", """SELECT o_orderkey AS position, 'record.status' AS path, 'missing_key' AS kind FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 97 <> 0
  UNION ALL SELECT o_orderkey, 'record.note', 'extra_key' FROM orders WHERE o_orderkey % 11 = 0 AND o_orderkey % 97 <> 0
  UNION ALL SELECT o_orderkey, 'record', 'type' FROM orders WHERE o_orderkey % 97 = 0""")
def check_keys(spark, folder):
    found = C.check_keys(raw_records(spark, folder), "raw", ["id", "status"], keys={"position": "o_orderkey"}, path="record")
    return issue_rows(found, "position", "path", "kind")


@query("p2_check_scalar", """SELECT c_custkey AS position, 'c_acctbal' AS path, 'must be a non-negative integer' AS message FROM customer WHERE NOT c_acctbal >= 0
  UNION ALL SELECT c_custkey, 'c_mktsegment', 'must be one of BUILDING, MACHINERY' FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
  UNION ALL SELECT c_custkey, 'c_nationkey', 'must equal 7' FROM customer WHERE c_nationkey <> 7""")
def check_scalar(spark, folder):
    rules = [C.scalar_rule(F.col("c_acctbal"), "c_acctbal", "non_negative"), C.scalar_rule(F.col("c_name"), "c_name", "non_empty"),
             C.scalar_rule(F.col("c_mktsegment"), "c_mktsegment", "one_of", ("BUILDING", "MACHINERY")), C.scalar_rule(F.col("c_nationkey"), "c_nationkey", "equal", 7)]
    return issue_rows(find_issues(table(spark, folder, "customer"), rules, {"position": "c_custkey"}), "position", "path", "message")


IDENTITY_SQL = """SELECT report_date AS date, slug, arxiv_id AS id, idx AS position, 'arxivId' AS path FROM papers WHERE NOT regexp_full_match(arxiv_id, '\\d{4}\\.\\d{4,5}')
  UNION ALL SELECT report_date, slug, arxiv_id, idx, 'url' FROM papers WHERE regexp_full_match(arxiv_id, '\\d{4}\\.\\d{4,5}') AND idx % 41 = 0"""
SCORE_SQL = "SELECT report_date AS date, slug, arxiv_id AS id, idx AS position, 'totalScore' AS path FROM papers WHERE total <> broad + cat + orig + tech UNION ALL SELECT report_date, slug, arxiv_id, idx, 'totalScore' FROM papers WHERE NOT total BETWEEN 0 AND 100"
EVIDENCE_SQL = """SELECT report_date AS date, slug, arxiv_id AS id, idx AS position, 'evaluationBasis' AS path FROM papers WHERE idx % 37 = 0
  UNION ALL SELECT report_date, slug, arxiv_id, idx, 'fullTextReviewStatus' FROM papers WHERE full_text AND status_text IS NULL
  UNION ALL SELECT report_date, slug, arxiv_id, idx, 'sourceUrls' FROM papers WHERE full_text <> has_pdf AND regexp_full_match(arxiv_id, '\\d{4}\\.\\d{4,5}')"""


@query("p3_check_identity", f"WITH {PAPERS} {IDENTITY_SQL}")
def check_identity(spark, folder):
    return issue_rows(C.check_identity(papers(spark, folder)), "date", "slug", "id", "position", "path")


@query("p4_check_scores", f"WITH {PAPERS} {SCORE_SQL}")
def check_scores(spark, folder):
    return issue_rows(C.check_scores(papers(spark, folder)), "date", "slug", "id", "position", "path")


@query("p5_check_evidence", f"WITH {PAPERS} {EVIDENCE_SQL}")
def check_evidence(spark, folder):
    return issue_rows(C.check_evidence(papers(spark, folder)), "date", "slug", "id", "position", "path")


@query("p6_check_score_caps", f"""WITH {PAPERS}, u AS (SELECT * FROM papers WHERE NOT full_text)
  SELECT arxiv_id AS id, 'scores.broadImpact' AS path FROM u WHERE broad >= 24 UNION ALL SELECT arxiv_id, 'scores.categoryImpact' FROM u WHERE cat >= 24
  UNION ALL SELECT arxiv_id, 'scores.originality' FROM u WHERE orig >= 24 UNION ALL SELECT arxiv_id, 'scores.technicalStrength' FROM u WHERE tech >= 24
  UNION ALL SELECT arxiv_id, 'scores.technicalStrength' FROM u WHERE tech > 17""")
def check_score_caps(spark, folder):
    return issue_rows(C.check_score_caps(papers(spark, folder)), "id", "path")


@query("p7_check_authors", f"""WITH {PAPERS} SELECT arxiv_id AS id, 'contains a duplicate author' AS message FROM papers WHERE idx % 29 = 0
  UNION ALL SELECT arxiv_id, 'must contain only non-empty strings' FROM papers WHERE idx % 31 = 0 AND idx % 29 <> 0
  UNION ALL SELECT arxiv_id, 'must be a non-empty array' FROM papers WHERE idx % 59 = 0 AND idx % 29 <> 0 AND idx % 31 <> 0""")
def check_authors(spark, folder):
    return issue_rows(C.check_authors(authored(papers(spark, folder))), "id", "message")


@query("p10_check_max_chars", """SELECT doc_id AS position, 'text' AS path, 'must be at most 2000 characters (got ' || length(text) || ')' AS message FROM documents WHERE length(text) > 2000""")
def check_max_chars(spark, folder):
    found = C.check_max_chars(table(spark, folder, "documents"), {"text": 2000}, {"position": "doc_id"})
    return issue_rows(found, "position", "path", "message")


MARKED_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag = 'R' AS one, l_quantity = 7 AS two, l_quantity = 9 AS odd FROM lineitem"""


def marked(spark, folder):
    li = table(spark, folder, "lineitem")
    marker = F.lit(" (cross-list from math-ph)")
    text = F.concat(F.lit("arXiv:"), F.col("l_partkey").cast("string"), F.when(F.col("l_returnflag") == "R", marker).otherwise(""),
                    F.when(F.col("l_quantity") == 7, F.lit(" (cross-list from cond-mat.stat-mech)")).otherwise(""),
                    F.when(F.col("l_quantity") == 9, F.lit(" (Cross-List)")).otherwise(""))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", text.alias("text"))


@query("p11_primary_only", f"SELECT l_orderkey, l_linenumber, l_partkey FROM ({MARKED_SQL}) WHERE NOT one AND NOT two AND NOT odd")
def primary_only(spark, folder):
    return C.primary_only(marked(spark, folder), "text").drop("text")


@query("p11_marker_errors", f"SELECT l_orderkey, l_linenumber, one::INT + two::INT = 1 AS crosslist, (one AND two) OR odd AS marker_error FROM ({MARKED_SQL})")
def marker_errors(spark, folder):
    return C.mark_crosslists(marked(spark, folder), "text").select("l_orderkey", "l_linenumber", "crosslist", "marker_error")


@query("p13_rules_in_force", f"""WITH {PAPERS}, r(rule, valid_from) AS (VALUES ('base', '1900-01-01'), ('quality', '1997-01-16'), ('prose', '1999-08-03'))
  SELECT report_date, slug, arxiv_id, rule FROM papers, r WHERE valid_from <= report_date AND NOT (report_date = '1999-09-01' AND slug = 'gr-qc' AND rule = 'prose')""")
def rules_in_force(spark, folder):
    rules = spark.createDataFrame([("base", "1900-01-01"), ("quality", "1997-01-16"), ("prose", "1999-08-03")], "rule string, valid_from string")
    exempt = spark.createDataFrame([("1999-09-01", "gr-qc", "prose")], "report_date string, slug string, rule string")
    found = C.rules_in_force(papers(spark, folder), rules, F.broadcast(exempt))
    return found.select("report_date", "slug", F.col("arxivId").alias("arxiv_id"), "rule")


def full_papers(df):
    """Adds the remaining record columns, filled from the keys."""
    text = lambda label: F.concat(F.lit(label + " "), F.col("index").cast("string"))
    return df.select(
        "*", F.lit("v1").alias("arxivVersion"), F.lit("new").alias("submissionType"), F.when(when_key(61), "math-ph").otherwise(F.col("slug")).alias("primaryCategory"),
        *[F.when(F.lit(f == "concept") & when_key(67), " ").otherwise(text(f)).alias(f) for f in ("title", "titleJa", "paperType", "curiosity", "concept", "conclusion", "assessment")],
        F.when(when_key(71), F.array(text("a"), text("b"))).otherwise(F.array(text("a"), text("b"), text("c"))).alias("abstractLines"),
        F.struct(*[text(k).alias(k) for k in config.SCORE_KEYS]).alias("scoreReasons"))


VERSION_SQL = "CASE idx % 5 WHEN 0 THEN '1.2' WHEN 1 THEN '1.3' WHEN 2 THEN '9.9' ELSE '1.4' END"


@query("p14_validate_by_version", f"""WITH {PAPERS}, v AS (SELECT *, {VERSION_SQL} AS version FROM papers), ok AS (SELECT * FROM v WHERE version <> '9.9')
  SELECT idx AS position, 'schemaVersion' AS path FROM v WHERE version = '9.9'
  UNION ALL SELECT idx, 'url' FROM ok WHERE idx % 41 = 0 AND regexp_full_match(arxiv_id, '\\d{{4}}\\.\\d{{4,5}}')
  UNION ALL SELECT idx, 'arxivId' FROM ok WHERE NOT regexp_full_match(arxiv_id, '\\d{{4}}\\.\\d{{4,5}}')
  UNION ALL SELECT idx, 'totalScore' FROM ok WHERE total <> broad + cat + orig + tech UNION ALL SELECT idx, 'totalScore' FROM ok WHERE total > 100
  UNION ALL SELECT idx, 'evaluationBasis' FROM ok WHERE idx % 37 = 0
  UNION ALL SELECT idx, 'fullTextReviewStatus' FROM ok WHERE full_text AND status_text IS NULL
  UNION ALL SELECT idx, 'sourceUrls' FROM ok WHERE version <> '1.2' AND full_text <> has_pdf AND regexp_full_match(arxiv_id, '\\d{{4}}\\.\\d{{4,5}}')
  UNION ALL SELECT idx, 'concept' FROM ok WHERE version = '1.2' AND idx % 67 = 0 UNION ALL SELECT idx, 'primaryCategory' FROM ok WHERE version = '1.2' AND idx % 61 = 0
  UNION ALL SELECT idx, 'abstractLines' FROM ok WHERE version = '1.2' AND idx % 71 = 0
  UNION ALL SELECT idx, 'scores.broadImpact' FROM ok WHERE version = '1.4' AND NOT full_text AND broad >= 24
  UNION ALL SELECT idx, 'scores.categoryImpact' FROM ok WHERE version = '1.4' AND NOT full_text AND cat >= 24
  UNION ALL SELECT idx, 'scores.originality' FROM ok WHERE version = '1.4' AND NOT full_text AND orig >= 24
  UNION ALL SELECT idx, 'scores.technicalStrength' FROM ok WHERE version = '1.4' AND NOT full_text AND tech >= 24
  UNION ALL SELECT idx, 'scores.technicalStrength' FROM ok WHERE version = '1.4' AND NOT full_text AND tech > 17""")
def validate_by_version(spark, folder):
    i = F.col("index") % 5
    version = F.when(i == 0, "1.2").when(i == 1, "1.3").when(i == 2, "9.9").otherwise("1.4")
    found = C.validate_by_version(full_papers(papers(spark, folder)).withColumn("schema_version", version))
    return issue_rows(found, "position", "path")


@query("a15_collect_issues", f"""WITH {PAPERS}, i AS ({IDENTITY_SQL} UNION ALL {SCORE_SQL.replace('SELECT report_date AS date, slug, arxiv_id AS id, idx AS position,', 'SELECT report_date, slug, arxiv_id, idx,')} UNION ALL {EVIDENCE_SQL.replace('SELECT report_date AS date, slug, arxiv_id AS id, idx AS position,', 'SELECT report_date, slug, arxiv_id, idx,')}),
  k AS (SELECT DISTINCT * FROM i) SELECT date, slug, path, count(*) AS affected, min(position) AS first_position FROM k GROUP BY ALL""")
def collected(spark, folder):
    p = papers(spark, folder)
    strip = lambda df: df.withColumn("message", F.lit("")).withColumn("kind", F.lit(""))
    found = collect_issues(*[strip(f(p)) for f in (C.check_identity, C.check_scores, C.check_evidence, C.check_identity)])
    return summarize_issues(found).select("date", "slug", "path", "affected", "first_position")


@query("k6_order_issues", f"WITH {PAPERS} SELECT path, id FROM ({EVIDENCE_SQL})")
def ordered(spark, folder):
    return order_issues(C.check_evidence(papers(spark, folder))).select("path", "id")


# Reports ------------------------------------------------------------------------------------------------

REPORTS = f"""reports AS (SELECT report_date, slug, count(*) AS n, count(*) FILTER (full_text) AS ft, min(idx) AS first, min(idx) % 3 AS third, min(idx) % 7 AS seventh FROM papers GROUP BY 1, 2)"""


def reports(spark, folder, p=None):
    """Report rows per date and category, with planted faults."""
    p = papers(spark, folder) if p is None else p
    r = p.groupBy("report_date", "slug").agg(F.count(F.lit(1)).cast("int").alias("n"), F.count_if("fullTextEvaluated").cast("int").alias("ft"), F.min("index").alias("first"))
    third, seventh = F.col("first") % 3, F.col("first") % 7
    run = F.struct(F.lit("m1").alias("modelId"), F.lit("M 1").alias("modelDisplayName"), F.when(seventh == 5, "ultra").otherwise("high").alias("reasoningEffort"),
                   (seventh != 6).alias("modelSelectionVerified"), F.concat(F.lit("run-"), F.when(seventh == 4, "?").otherwise(F.lpad((F.col("first") % 1000).cast("string"), 8, "0"))).alias("runId"))
    counts = F.struct((F.col("n") + F.when(third == 1, 1).otherwise(0)).alias("newPrimary"), F.lit(2).alias("crosslistsExcluded"), F.col("n").alias("titleAuthorAbstractEvaluated"))
    audit = F.struct(
        F.when(seventh == 1, F.lit("https://example.org/list")).otherwise(R.listing_url("slug", "new")).alias("listingUrl"), F.col("report_date").alias("announcementDate"),
        F.lit("primary only").alias("selectionRule"), counts.alias("sourceCounts"), F.lit("policy").alias("evaluationPolicy"),
        F.when(seventh == 2, "old").otherwise("Rubric 3.0: four axes").alias("scoreRubric"), F.lit("top").alias("fullTextPolicy"), F.col("ft").alias("fullTextEvaluatedCount"),
        F.when(seventh == 3, " ").otherwise("none").alias("authorPolicy"), F.lit("total").alias("rankingTieBreak"),
        F.concat("report_date", F.when(third == 2, "T25:00:00+09:00").otherwise("T12:00:00+09:00")).alias("generatedAtJst"))
    return r.select(
        "report_date", "slug", F.lit("1.4").alias("schemaVersion"), F.col("report_date").alias("reportDate"), F.col("slug").alias("label"), F.col("n").alias("totalNew"),
        F.lit(2).alias("crosslistsExcluded"), F.col("n").alias("evaluatedCount"), F.col("ft").alias("fullTextEvaluatedCount"), run.alias("evaluationRun"), audit.alias("audit"),
        F.col("n").alias("paper_count"), "first")


@query("p8_check_audit", f"""WITH {PAPERS}, {REPORTS} SELECT report_date AS date, slug, 'audit.listingUrl' AS path FROM reports WHERE seventh = 1
  UNION ALL SELECT report_date, slug, 'audit.scoreRubric' FROM reports WHERE seventh = 2 UNION ALL SELECT report_date, slug, 'audit.authorPolicy' FROM reports WHERE seventh = 3
  UNION ALL SELECT report_date, slug, 'audit.sourceCounts.newPrimary' FROM reports WHERE third = 1 UNION ALL SELECT report_date, slug, 'audit.generatedAtJst' FROM reports WHERE third = 2""")
def check_audit(spark, folder):
    return issue_rows(C.check_audit(reports(spark, folder), "Rubric 3.0"), "date", "slug", "path")


def exceptions(spark, folder):
    """Dated exceptions for the runs of reports whose effort differs."""
    r = reports(spark, folder).where("first % 7 = 5 and first % 2 = 0")
    return r.select("report_date", F.col("evaluationRun.runId").alias("run_id"), F.lit("ultra").alias("effort"), "slug", F.lit(35).alias("full_text_limit"))


@query("p9_check_run", f"""WITH {PAPERS}, {REPORTS} SELECT report_date AS date, slug, 'evaluationRun.reasoningEffort' AS path FROM reports WHERE seventh = 5 AND first % 2 = 1
  UNION ALL SELECT report_date, slug, 'evaluationRun.modelSelectionVerified' FROM reports WHERE seventh = 6 UNION ALL SELECT report_date, slug, 'evaluationRun.runId' FROM reports WHERE seventh = 4""")
def check_run(spark, folder):
    return issue_rows(C.check_run(reports(spark, folder), exceptions(spark, folder), "m1", "M 1"), "date", "slug", "path")


@query("j6_effective_limit", f"""WITH {PAPERS}, {REPORTS} SELECT report_date, slug, least(CASE WHEN seventh = 5 AND first % 2 = 0 THEN 35 ELSE 12 END, n)::BIGINT AS full_text_limit,
  CASE WHEN seventh = 5 AND first % 2 = 0 THEN 'ultra' ELSE 'high' END AS expected_effort FROM reports""")
def effective_limit(spark, folder):
    found = C.effective_limit(reports(spark, folder), exceptions(spark, folder))
    return found.select("report_date", "slug", F.col("full_text_limit").cast("bigint").alias("full_text_limit"), "expected_effort")


# Repairs, patches, badges, metadata -------------------------------------------------------------------------

def repaired(df):
    """A copy in which some papers changed, some are gone and one set is new."""
    changed = df.withColumn("totalScore", F.when(when_key(83), F.col("totalScore") + 1).otherwise(F.col("totalScore")))
    kept = changed.where(F.col("o_orderkey") % 89 != 0)
    return kept.withColumn("arxivId", F.when(when_key(101), F.concat("arxivId", F.lit("x"))).otherwise(F.col("arxivId")))


REPAIR_SQL = """SELECT arxiv_id AS id, 'protected' AS kind FROM papers WHERE idx % 83 = 0 AND idx % 89 <> 0 AND idx % 101 <> 0
  UNION ALL SELECT arxiv_id, 'missing' FROM papers WHERE idx % 89 = 0 OR idx % 101 = 0
  UNION ALL SELECT arxiv_id || 'x', 'unknown' FROM papers WHERE idx % 101 = 0 AND idx % 89 <> 0"""
PROTECTED = ("arxivId", "scores", "totalScore", "evaluationBasis", "fullTextEvaluated", "sourceUrls")


@query("j15_verify_repair", f"WITH {PAPERS} {REPAIR_SQL}")
def verify_repair(spark, folder):
    p = papers(spark, folder)
    return issue_rows(RC.verify_repair(p, repaired(p), columns=PROTECTED), "id", "kind")


@query("p16_protected_projection", f"""WITH {PAPERS} SELECT arxiv_id, sha256('{{"arxivId":"' || arxiv_id || '","fullTextEvaluated":' || full_text || ',"totalScore":' || total || '}}') AS digest FROM papers""")
def protected_projection(spark, folder):
    p = papers(spark, folder)
    return p.select(F.col("arxivId").alias("arxiv_id"), F.sha2(RC.protected_projection(p, ["totalScore", "arxivId", "fullTextEvaluated"]), 256).alias("digest"))


@query("p17_apply_prose_patch", f"""WITH {PAPERS} SELECT arxiv_id, CASE WHEN idx % 5 = 0 THEN 'corrected ' || idx ELSE 'curiosity ' || idx END AS curiosity FROM papers""")
def apply_prose_patch(spark, folder):
    base = full_papers(papers(spark, folder)).select("report_date", "slug", "arxivId", "index", "totalScore", "curiosity", "fullTextReviewStatus")
    patch = base.withColumn("curiosity", F.when(F.col("index") % 5 == 0, F.concat(F.lit("corrected "), F.col("index").cast("string"))).otherwise(F.col("curiosity")))
    fixed, _ = RC.apply_prose_patch(base, patch, ["curiosity", "fullTextReviewStatus"])
    return fixed.select(F.col("arxivId").alias("arxiv_id"), "curiosity")


@query("p17_patch_issues", f"WITH {PAPERS} SELECT arxiv_id AS id, 'paper.scores.broadImpact' AS path FROM papers WHERE idx % 13 = 0 UNION ALL SELECT arxiv_id, 'paper.totalScore' FROM papers WHERE idx % 17 = 0 AND idx % 13 <> 0")
def patch_issues(spark, folder):
    base = papers(spark, folder).select("report_date", "slug", "arxivId", "o_orderkey", "scores", "totalScore", "fullTextReviewStatus")
    patch = base.withColumn("scores", F.col("scores").withField("broadImpact", F.col("scores.broadImpact") + F.when(when_key(13), 1).otherwise(0))) \
        .withColumn("totalScore", F.col("totalScore") + F.when(when_key(17), 1).otherwise(0)).withColumn("fullTextReviewStatus", F.lit("changed"))
    _, issues = RC.apply_prose_patch(base, patch, ["fullTextReviewStatus"])
    return issue_rows(issues, "id", "path")


@query("p18_check_badges", f"""WITH {PAPERS} SELECT arxiv_id AS id, 'must identify one listed author once' AS message FROM papers WHERE idx % 3 = 1
  UNION ALL SELECT arxiv_id, 'must contain official HTTPS evidence' FROM papers WHERE idx % 10 = 4""")
def check_badges(spark, folder):
    name = F.when(F.col("index") % 3 == 1, "Nobody").otherwise(F.concat(F.lit("customer "), F.col("o_custkey").cast("string")))
    badge = F.struct(name.alias("authorName"), F.lit("著名著者").alias("label"), F.lit("prize").alias("reason"), F.lit("biography").alias("identityEvidence"),
                     F.when(F.col("index") % 10 == 4, F.array(F.lit("http://a.example"))).otherwise(F.array(F.lit("https://a.example"))).alias("evidenceUrls"))
    p = papers(spark, folder).withColumn("authors", F.array(F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")), F.lit("Other")))
    return issue_rows(C.check_badges(p.withColumn("eminentAuthors", F.array(badge))), "id", "message")


def metadata(spark, folder):
    p = papers(spark, folder)
    title = F.concat(F.lit("Résult "), F.col("index").cast("string"))
    return p.select(
        "report_date", "slug", F.col("index").alias("position"), "arxivId", F.lit("v1").alias("arxivVersion"), F.lit("new").alias("submissionType"), "url",
        R.abs_url_v1("arxivId").alias("sourceUrl"), F.when(when_key(13), F.concat(F.lit(" "), title)).when(when_key(17), F.concat(title, F.lit(" é"))).otherwise(title).alias("title"),
        F.array(F.lit("Ann Author"), F.when(when_key(19), "Bo  Author").otherwise("Bo Author")).alias("authors"), F.lit("Abstract text.").alias("abstract"),
        F.when(when_key(23), F.lit("")).alias("comments"), F.when(when_key(61), "math-ph").otherwise(F.col("slug")).alias("primaryCategory"))


@query("p19_check_metadata", f"""WITH {PAPERS} SELECT idx AS position, 'url' AS path FROM papers WHERE idx % 41 = 0 AND regexp_full_match(arxiv_id, '\\d{{4}}\\.\\d{{4,5}}')
  UNION ALL SELECT idx, 'arxivId' FROM papers WHERE NOT regexp_full_match(arxiv_id, '\\d{{4}}\\.\\d{{4,5}}')
  UNION ALL SELECT idx, 'title' FROM papers WHERE idx % 13 = 0 OR idx % 17 = 0 UNION ALL SELECT idx, 'authors' FROM papers WHERE idx % 19 = 0
  UNION ALL SELECT idx, 'comments' FROM papers WHERE idx % 23 = 0 UNION ALL SELECT idx, 'primaryCategory' FROM papers WHERE idx % 61 = 0
  UNION ALL SELECT idx, 'papers' FROM (SELECT idx, arxiv_id, lag(arxiv_id) OVER (PARTITION BY report_date, slug ORDER BY idx) AS before FROM papers) WHERE NOT before < arxiv_id""")
def check_metadata(spark, folder):
    return issue_rows(C.check_metadata(metadata(spark, folder)), "position", "path")


# Listings, receipts, events ------------------------------------------------------------------------------------

def listings(spark, folder):
    """Declared counts per (day, category), some wrong, and the announced ids."""
    a = announcements(spark, folder).withColumn("date", F.col("date").cast("string"))
    ids = a.where("not crosslist").select("date", "slug", "id")
    rows = a.groupBy("date", "slug").agg(F.count_if(~F.col("crosslist")).alias("real"), F.count_if("crosslist").alias("crosslistCount"))
    day = F.dayofmonth(F.col("date").cast("date"))
    rows = rows.select("date", "slug", F.when(day % 5 == 0, F.lit("https://example.org")).otherwise(R.listing_url("slug", "new")).alias("sourceUrl"),
                       (F.col("real") + F.when(day % 7 == 0, 1).otherwise(0)).alias("newCount"), "crosslistCount")
    return rows, ids


@query("p20_check_snapshot", f"""WITH {ANNOUNCED}, l AS (SELECT date::VARCHAR AS date, slug, day(date) AS d, count(*) FILTER (NOT crosslist AND NOT regexp_full_match(id, '\\d{{4}}\\.\\d{{4,5}}')) AS bad FROM announced GROUP BY ALL)
  SELECT date, slug, 'sourceUrl' AS path FROM l WHERE d % 5 = 0 UNION ALL SELECT date, slug, 'newIds' FROM l WHERE d % 7 = 0 UNION ALL SELECT date, slug, 'newIds' FROM l WHERE bad > 0""")
def check_snapshot(spark, folder):
    return issue_rows(C.check_snapshot(*listings(spark, folder)), "date", "slug", "path")


@query("p23_check_events", f"""WITH {PUBLICATION_SQL}, e AS (SELECT *, 'x' AS y FROM p)
  SELECT event_id AS position, 'attemptId' AS path FROM e WHERE event_id % 11 = 0 UNION ALL SELECT event_id, 'message' FROM e WHERE event_id % 13 = 0
  UNION ALL SELECT event_id, 'commit' FROM e WHERE status = 'published' AND event_id % 17 = 0 UNION ALL SELECT event_id, 'commit' FROM e WHERE status <> 'published' AND event_id % 19 = 0""")
def check_events(spark, folder):
    e = publications(spark, folder)
    n = F.col("event_id")
    published = F.col("status") == "published"
    events = e.select(
        F.lit("publication").alias("kind"), F.lpad(F.lower(F.hex(n)), 32, "0").alias("eventId"), F.when(n % 11 == 0, "not safe!").otherwise(F.concat(F.lit("a"), n.cast("string"))).alias("attemptId"),
        R.iso_time(F.col("at")).alias("at"), F.when(n % 13 == 0, F.lit("bad\u0007")).otherwise("fine").alias("message"), "status",
        F.when(published & (n % 17 != 0), F.col("commit")).when(~published & (n % 19 == 0), F.lit("a" * 40)).alias("commit"), n.alias("reportDate"))
    found = find_issues(events, C.event_rules("publication"), {"position": "reportDate"}, "event")
    return issue_rows(found, "position", "path")


def receipts(spark, folder):
    """A candidate receipt per (month, category): the first 12 ids, some damaged."""
    from dayfolio.operators.ordering import top_rows
    p = papers(spark, folder)
    top = top_rows(p, ["report_date", "slug"], ["arxivId"], 12, "_n")
    r = top.groupBy("report_date", "slug").agg(F.transform(F.sort_array(F.collect_list(F.struct("_n", "arxivId"))), lambda s: s["arxivId"]).alias("ids"), F.min("index").alias("first"))
    third = F.col("first") % 3
    held = F.when(third == 1, F.slice("ids", 1, 3)).when(third == 2, F.concat(F.slice("ids", F.lit(1), F.size("ids") - 1), F.array(F.lit("0000.00000")))).otherwise(F.col("ids"))
    made = r.select("report_date", "slug", F.get("ids", F.lit(0)).alias("arxivId"), F.when(F.col("first") % 5 == 0, "other").otherwise(config.MODEL_FAILURE).alias("failureClass"), held.alias("provisionalCandidateIds"), "first")
    return p, made


RECEIPT_SQL = f"""WITH {PAPERS}, top AS (SELECT *, row_number() OVER (PARTITION BY report_date, slug ORDER BY arxiv_id) AS n FROM papers),
  t AS (SELECT report_date, slug, min(idx) AS first, count(*) AS k FROM top WHERE n <= 12 GROUP BY 1, 2),
  c AS (SELECT report_date, slug, count(*) AS total FROM papers GROUP BY 1, 2), r AS (SELECT * FROM t JOIN c USING (report_date, slug))"""


@query("p21_check_receipt", f"""{RECEIPT_SQL} SELECT report_date AS date, slug, 'failureClass' AS path FROM r WHERE first % 5 = 0
  UNION ALL SELECT report_date, slug, 'provisionalCandidateIds' FROM r WHERE first % 3 = 1 AND k > 3
  UNION ALL SELECT report_date, slug, 'provisionalCandidateIds' FROM r WHERE first % 3 = 2 UNION ALL SELECT report_date, slug, 'arxivId' FROM r WHERE first % 3 = 2 AND k = 1""")
def check_receipt(spark, folder):
    from dayfolio.plans.jobs import check_receipt as check
    p, made = receipts(spark, folder)
    return issue_rows(check(made, p.select("report_date", "slug", F.col("arxivId").alias("id"))), "date", "slug", "path")


@query("r11_probe_failure", f"""{RECEIPT_SQL} SELECT t2.report_date, t2.slug, t2.arxiv_id FROM top t2 JOIN r USING (report_date, slug)
  WHERE t2.n <= 12 AND CASE r.first % 3 WHEN 1 THEN t2.n <= 3 WHEN 2 THEN t2.n < r.k ELSE TRUE END""")
def probe_failure(spark, folder):
    from dayfolio.plans.jobs import probe_failure as derive
    p, made = receipts(spark, folder)
    found, _ = derive(made, p.select("report_date", "slug", "arxivId"))
    return found.select("report_date", "slug", F.col("arxivId").alias("arxiv_id"))


@query("p26_check_resume_draft", f"""{RECEIPT_SQL}, m AS (SELECT top.*, r.first, r.k, CASE r.first % 3 WHEN 1 THEN top.n <= 3 WHEN 2 THEN top.n <= 12 AND top.n < r.k ELSE top.n <= 12 END AS candidate FROM top JOIN r USING (report_date, slug))
  SELECT arxiv_id AS id, 'candidate' AS kind FROM m WHERE full_text AND NOT candidate
  UNION ALL SELECT arxiv_id, 'receipt' FROM m WHERE n = 1 AND (full_text OR basis <> 'title_authors_abstract' OR has_pdf)""")
def check_resume_draft(spark, folder):
    from dayfolio.plans.jobs import check_resume_draft as check
    p, made = receipts(spark, folder)
    return issue_rows(check(p, made), "id", "kind")
