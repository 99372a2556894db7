"""Counts, consistency and distribution checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfolio.functions import records as R
from dayfolio.operators import aggregates as A, sets as S
from dayfolio.workload.derive import ANNOUNCED, ATTEMPTS, PAPERS, announcements, attempts, papers
from dayfolio.workload.registry import query, table


@query("a1_total_score", f"WITH {PAPERS} SELECT arxiv_id, (broad + cat + orig + tech)::BIGINT AS total FROM papers")
def total_score(spark, folder):
    from dayfolio.operators.checks import total_score as total
    return papers(spark, folder).select(F.col("arxivId").alias("arxiv_id"), total().cast("bigint").alias("total"))


@query("a2_category_counts", f"""WITH {PAPERS} SELECT report_date, slug, count(*) FILTER (o_orderstatus <> 'P') AS total_new,
  count(*) FILTER (o_orderstatus <> 'P') AS evaluated, count(*) FILTER (full_text) AS full_text, count(*) FILTER (o_orderstatus = 'P') AS crosslists FROM papers GROUP BY ALL""")
def category_counts(spark, folder):
    return A.category_counts(papers(spark, folder).withColumn("cross", F.col("o_orderstatus") == "P"), crosslist="cross")


@query("a3_edition_totals", f"""WITH {PAPERS} SELECT report_date, slug, count(*) AS total_new, count(*) AS evaluated, count(*) FILTER (full_text) AS full_text
  FROM papers GROUP BY ROLLUP (report_date, slug) HAVING report_date IS NOT NULL""")
def edition_totals(spark, folder):
    return A.edition_totals(A.category_counts(papers(spark, folder)))


@query("a4_edition_time", f"WITH {PAPERS} SELECT report_date, strftime(max(o_orderdate), '%Y-%m-%d') AS generated_at FROM papers GROUP BY 1")
def edition_time(spark, folder):
    p = papers(spark, folder).withColumn("generated_at", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return A.edition_time(p)


@query("a5_duplicate_ids", """SELECT l_orderkey AS date, l_linenumber AS id, count(*) AS rows, count(DISTINCT l_returnflag) AS categories,
  string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS category_list FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_ids(spark, folder):
    li = table(spark, folder, "lineitem")
    found = A.duplicate_ids(li, "l_orderkey", "l_returnflag", "l_linenumber")
    return found.select(F.col("l_orderkey").alias("date"), F.col("l_linenumber").alias("id"), "rows", "categories", "category_list")


@query("a22_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicates(spark, folder):
    return A.duplicates(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("a6_run_consistency", f"""WITH {PAPERS}, rows AS (SELECT report_date, 'run-' || (idx % 500) AS run, CASE WHEN o_orderstatus = 'P' AND slug = 'hep-th' THEN 'pastweek' ELSE 'new' END AS kind FROM papers)
 SELECT 'date' AS scope, report_date AS value, count(DISTINCT run) AS runs, count(DISTINCT kind) AS kinds, NULL::BIGINT AS dates FROM rows GROUP BY report_date HAVING count(DISTINCT run) > 1 OR count(DISTINCT kind) > 1
 UNION ALL SELECT 'run', run, NULL, NULL, count(DISTINCT report_date) FROM rows GROUP BY run HAVING count(DISTINCT report_date) > 1""")
def run_consistency(spark, folder):
    p = papers(spark, folder)
    kind = F.when((F.col("o_orderstatus") == "P") & (F.col("slug") == "hep-th"), "pastweek").otherwise("new")
    return A.run_consistency(p.withColumn("run_id", F.concat(F.lit("run-"), (F.col("index") % 500).cast("string"))).withColumn("listing_kind", kind))


@query("a7_repeated_groups", """SELECT p_brand AS value, count(*) AS size, min(p_partkey) AS first_position,
  row_number() OVER (ORDER BY count(*) DESC, min(p_partkey)) AS place FROM part GROUP BY 1""")
def repeated_groups(spark, folder):
    found = A.repeated_groups(table(spark, folder, "part"), "p_brand", "p_partkey")
    return found.select("value", "size", "first_position", F.col("place").cast("bigint").alias("place"))


PLATEAU = """SELECT report_date, slug, value, size, first_position, papers FROM (
  SELECT *, sum(size) OVER (PARTITION BY report_date, slug)::BIGINT AS papers FROM (
    SELECT report_date, slug, {value} AS value, count(*) AS size, min({position}) AS first_position FROM {source} GROUP BY 1, 2, 3))
  WHERE papers >= 16 AND size >= 8 AND size / papers::DOUBLE > {ratio}"""


@query("a8_score_plateau", f"WITH {PAPERS} " + PLATEAU.format(value="CASE WHEN o_orderstatus = 'F' THEN 50 ELSE 1000 + idx END", position="idx", source="papers", ratio=0.35))
def score_plateau(spark, folder):
    scored = papers(spark, folder).withColumn("totalScore", F.when(F.col("o_orderstatus") == "F", F.lit(50).cast("bigint")).otherwise(1000 + F.col("index")))
    return A.score_plateau(scored)


@query("a9_vector_plateau", f"WITH {PAPERS} " + PLATEAU.format(value="CASE WHEN o_orderstatus = 'O' THEN '9/8/7/6' ELSE broad || '/' || cat || '/' || orig || '/' || tech END", position="idx", source="papers", ratio=0.20))
def vector_plateau(spark, folder):
    same = F.struct(*[F.lit(n).alias(k) for n, k in zip((9, 8, 7, 6), ("broadImpact", "categoryImpact", "originality", "technicalStrength"))])
    return A.vector_plateau(papers(spark, folder).withColumn("scores", F.when(F.col("o_orderstatus") == "O", same).otherwise(F.col("scores"))))


@query("a13_latest_id", f"""WITH {PAPERS} SELECT slug, max_by(arxiv_id, split_part(arxiv_id, '.', 1)::BIGINT * 1000000000000 + split_part(arxiv_id, '.', 2)::BIGINT) AS latest_id FROM papers GROUP BY 1""")
def latest_id(spark, folder):
    return A.latest_id(papers(spark, folder), group=["slug"])


@query("a14_failure_counts", f"""WITH {ATTEMPTS}, a AS (SELECT job, attempt_id, bool_or(structured) AS s FROM attempts WHERE status = 'failed' GROUP BY 1, 2)
 SELECT job, count(*) AS failures, count(*) FILTER (s) AS structured_failures, count(*) FILTER (NOT s) AS ordinary_failures FROM a GROUP BY 1""")
def failure_counts(spark, folder):
    return A.failure_counts(attempts(spark, folder).withColumn("failed", F.col("status") == "failed"), ["job"])


def lanes_sql(text: str) -> str:
    """The order-free digest of ``text`` values, in SQL."""
    sums = " || '/' || ".join(
        f"coalesce(sum(('0x' || substr(sha256({text}), {1 + 15 * i}, 15))::HUGEINT), 0)::HUGEINT::VARCHAR" for i in range(4))
    return f"sha256(count(*)::VARCHAR || '/' || {sums})"


def part_sql(*values: str) -> str:
    return " || '|' || ".join(f"coalesce(length({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR, 'null')" for v in values)


@query("a16_set_digest", f"SELECT ts::DATE::VARCHAR AS date, {lanes_sql(part_sql('event_id', 'event_type'))} AS digest FROM events GROUP BY 1")
def set_digest(spark, folder):
    e = table(spark, folder, "events")
    return e.groupBy(F.col("ts").cast("date").cast("string").alias("date")).agg(R.set_digest(F.col("event_id"), F.col("event_type")).alias("digest"))


@query("a17_complete_jobs", f"""WITH {PAPERS}, s AS (SELECT report_date, slug, bool_or(full_text) AS ok FROM papers GROUP BY 1, 2),
  j AS (SELECT report_date, count(*) FILTER (ok)::INT AS n FROM s GROUP BY 1) SELECT report_date, n::BIGINT AS complete_categories, n = 3 AS is_complete FROM j""")
def complete_jobs(spark, folder):
    found = A.complete_jobs(papers(spark, folder), ["report_date"], receipted="fullTextEvaluated")
    return found.withColumn("complete_categories", F.col("complete_categories").cast("bigint"))


@query("a18_badge_counts", f"""WITH {PAPERS} SELECT report_date, slug, count(*) FILTER (has_pdf) AS badge_papers FROM papers GROUP BY ROLLUP (report_date, slug) HAVING report_date IS NOT NULL""")
def badge_counts(spark, folder):
    p = papers(spark, folder).withColumn("badges", F.when(F.size("sourceUrls") == 2, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
    return A.badge_counts(p, badges="badges")


@query("a19_pending_summary", f"""WITH {ANNOUNCED}, d AS (SELECT DISTINCT key, date FROM announced), l AS (SELECT key, min(date) AS latest FROM d GROUP BY 1)
 SELECT key, count(*) AS pending, min(date)::VARCHAR AS oldest, max(date)::VARCHAR AS newest FROM d JOIN l USING (key) WHERE date > latest GROUP BY 1""")
def pending_summary(spark, folder):
    from dayfolio.plans.backfill import pending_dates
    dates = announcements(spark, folder).select("key", "date").distinct()
    latest = dates.groupBy("key").agg(F.min("date").alias("latest_date"))
    found = A.pending_summary(pending_dates(dates, latest, ["key"]), ["key"])
    return found.select("key", "pending", F.col("oldest").cast("string").alias("oldest"), F.col("newest").cast("string").alias("newest"))


PUBLICATION_SQL = """p AS (SELECT user_id AS job, event_id, ts AS at,
  CASE event_type WHEN 'purchase' THEN 'published' WHEN 'view' THEN 'pending' WHEN 'click' THEN 'publishing' WHEN 'error' THEN 'failed' ELSE 'deferred' END AS status,
  CASE WHEN event_type = 'purchase' THEN sha256((event_id % 2)::VARCHAR) END AS commit FROM events)"""


def publications(spark, folder):
    return publications_of(table(spark, folder, "events"))


def publications_of(e):
    status = F.when(F.col("event_type") == "purchase", "published").when(F.col("event_type") == "view", "pending") \
        .when(F.col("event_type") == "click", "publishing").when(F.col("event_type") == "error", "failed").otherwise("deferred")
    return e.select(F.col("user_id").alias("job"), "event_id", F.col("ts").alias("at"), status.alias("status"),
                    F.when(F.col("event_type") == "purchase", F.sha2((F.col("event_id") % 2).cast("string"), 256)).alias("commit"))


@query("a21_publication_state", f"""WITH {PUBLICATION_SQL} SELECT job, arg_max(status, event_id) AS last_status,
  arg_max(commit, event_id) FILTER (commit IS NOT NULL) AS published_commit, coalesce(min(commit) <> max(commit), false) AS conflicting FROM p GROUP BY 1""")
def publication_state(spark, folder):
    return A.publication_state(publications(spark, folder), ["job"])


@query("p12_eligible_dates", f"WITH {ANNOUNCED} SELECT date::VARCHAR AS date, count(*) FILTER (NOT crosslist) AS new_count FROM announced GROUP BY 1 HAVING count(*) FILTER (NOT crosslist) > 0")
def eligible_dates(spark, folder):
    per = announcements(spark, folder).groupBy(F.col("date").cast("string").alias("date"), "slug").agg(F.count_if(~F.col("crosslist")).alias("new_count"))
    return A.eligible_dates(per)


@query("k4_sorted_ids", f"WITH {PAPERS} SELECT report_date, slug, arxiv_id, row_number() OVER (PARTITION BY report_date, slug ORDER BY arxiv_id) AS position FROM (SELECT DISTINCT report_date, slug, arxiv_id FROM papers)")
def sorted_ids(spark, folder):
    return A.sorted_ids(papers(spark, folder)).select("report_date", "slug", F.col("arxivId").alias("arxiv_id"), F.col("position").cast("bigint").alias("position"))


@query("k5_latest_date", "SELECT max(o_orderdate)::DATE::VARCHAR AS latest_date FROM orders")
def latest_date(spark, folder):
    return A.latest_date(table(spark, folder, "orders"), "o_orderdate").select(F.col("latest_date").cast("date").cast("string").alias("latest_date"))


@query("u2_union_dates", "SELECT o_orderdate::DATE::VARCHAR AS date FROM orders UNION SELECT l_shipdate::DATE::VARCHAR FROM lineitem")
def union_dates(spark, folder):
    left = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").cast("string").alias("date"))
    right = table(spark, folder, "lineitem").select(F.col("l_shipdate").cast("date").cast("string").alias("date"))
    return S.union_dates(left, right)


@query("u3_set_diff", """SELECT coalesce(o, l) AS o_orderkey, CASE WHEN l IS NULL THEN 'left_only' ELSE 'right_only' END AS side FROM
  (SELECT DISTINCT o_orderkey AS o FROM orders) FULL JOIN (SELECT DISTINCT l_orderkey AS l FROM lineitem) ON o = l WHERE o IS NULL OR l IS NULL""")
def set_diff(spark, folder):
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return S.set_diff(table(spark, folder, "orders"), lines, ["o_orderkey"])


@query("u4_overlap", "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def overlap(spark, folder):
    return S.overlap(table(spark, folder, "documents"), table(spark, folder, "labels"), ["doc_id"])


@query("u5_not_in", "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def not_in(spark, folder):
    return S.not_in(table(spark, folder, "documents"), table(spark, folder, "labels"), ["doc_id"])
