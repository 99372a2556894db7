"""Two-sided queries: metadata, announcements, registry, receipts, chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfolio import config
from dayfolio.functions import records as R
from dayfolio.operators import reconcile as RC
from dayfolio.plans import audits, backfill as B, jobs as J
from dayfolio.workload.checks import PROTECTED, metadata, receipts, reports, RECEIPT_SQL, REPORTS
from dayfolio.workload.derive import PAPERS, authored, issue_rows, papers, when_key
from dayfolio.operators.skew import attach_row
from dayfolio.workload.registry import query, table

FIELDS = ["url", "totalScore", "evaluationBasis"]


def canonical(df):
    """The other side: some values differ, some papers are absent, some are new or repeated."""
    c = df.select("report_date", "slug", "arxivId", "o_orderkey", R.abs_url("arxivId").alias("url"),
                  F.when(when_key(23), F.col("totalScore") + 1).otherwise(F.col("totalScore")).alias("totalScore"), "evaluationBasis")
    kept = c.where(F.col("o_orderkey") % 79 != 0)
    extra = c.where(when_key(73)).withColumn("arxivId", F.concat("arxivId", F.lit("n")))
    return kept.unionByName(extra).unionByName(c.where(when_key(109) & (F.col("o_orderkey") % 79 != 0)))


@query("j1_bind_metadata", f"""WITH {PAPERS} SELECT arxiv_id, CASE WHEN idx % 79 = 0 THEN url ELSE 'https://arxiv.org/abs/' || arxiv_id END AS url,
  CASE WHEN idx % 79 = 0 THEN 0 ELSE (idx % 41 = 0)::INT + (idx % 23 = 0)::INT END::BIGINT AS corrected_fields FROM papers""")
def bind_metadata(spark, folder):
    p = papers(spark, folder)
    bound, _ = RC.bind_metadata(p, canonical(p), FIELDS)
    return bound.select(F.col("arxivId").alias("arxiv_id"), "url", F.col("corrected_fields").cast("bigint").alias("corrected_fields"))


@query("j1_binding_summary", f"""WITH {PAPERS}, b AS (SELECT *, idx % 79 <> 0 AS known FROM papers)
  SELECT report_date, slug, sum(CASE WHEN known THEN (idx % 41 = 0)::INT + (idx % 23 = 0)::INT ELSE 0 END)::BIGINT AS corrected_fields,
  bool_or(known AND (idx % 41 = 0 OR idx % 23 = 0)) AS changed FROM b GROUP BY 1, 2""")
def binding_summary(spark, folder):
    p = papers(spark, folder)
    bound, _ = RC.bind_metadata(p, canonical(p), FIELDS)
    found = RC.binding_summary(bound, p, fields=FIELDS)
    return found.select("report_date", "slug", F.col("corrected_fields").cast("bigint").alias("corrected_fields"), (F.col("digest_before") != F.col("digest_after")).alias("changed"))


PRESENCE_SQL = """SELECT arxiv_id AS id, 'unknown' AS kind, 'arxivId' AS path FROM papers WHERE idx % 79 = 0
  UNION ALL SELECT arxiv_id || 'n', 'missing', 'arxivId' FROM papers WHERE idx % 73 = 0
  UNION ALL SELECT arxiv_id, 'duplicate', 'arxivId' FROM papers WHERE idx % 109 = 0 AND idx % 79 <> 0"""


@query("j1_binding_issues", f"WITH {PAPERS} {PRESENCE_SQL}")
def binding_issues(spark, folder):
    p = papers(spark, folder)
    return issue_rows(RC.bind_metadata(p, canonical(p), FIELDS)[1], "id", "kind", "path")


@query("j2_verify_metadata", f"""WITH {PAPERS} {PRESENCE_SQL} UNION ALL SELECT arxiv_id, 'mismatch', 'url' FROM papers WHERE idx % 41 = 0 AND idx % 79 <> 0
  UNION ALL SELECT arxiv_id, 'mismatch', 'totalScore' FROM papers WHERE idx % 23 = 0 AND idx % 79 <> 0""")
def verify_metadata(spark, folder):
    p = papers(spark, folder)
    return issue_rows(RC.verify_metadata(p, canonical(p), FIELDS), "id", "kind", "path")


@query("j3_reconcile_ids", f"WITH {PAPERS} {PRESENCE_SQL}")
def reconcile_ids(spark, folder):
    p = papers(spark, folder)
    return issue_rows(RC.reconcile_ids(p, canonical(p)), "id", "kind", "path")


@query("j3_reconcile_orders_lines", """SELECT coalesce(o, l)::VARCHAR AS id, CASE WHEN o IS NULL THEN 'missing' ELSE 'unknown' END AS kind FROM
  (SELECT DISTINCT o_orderkey AS o FROM orders) FULL JOIN (SELECT DISTINCT l_orderkey AS l FROM lineitem) ON o = l WHERE o IS NULL OR l IS NULL
  UNION ALL SELECT l_orderkey::VARCHAR, 'duplicate' FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""")
def reconcile_orders_lines(spark, folder):
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return issue_rows(RC.reconcile_ids(table(spark, folder, "orders").select("o_orderkey"), lines, ["o_orderkey"]), "id", "kind")


@query("j3_reconcile_reports", f"""WITH {PAPERS}, {REPORTS}, l AS (SELECT *, n + CASE WHEN first % 4 = 0 THEN 1 ELSE 0 END AS new_count FROM reports WHERE first % 10 <> 0)
  SELECT report_date AS date, slug, 'report' AS path FROM reports WHERE first % 10 = 0 UNION ALL SELECT report_date, slug, 'totalNew' FROM l WHERE first % 4 = 0
  UNION ALL SELECT report_date, slug, 'evaluatedCount' FROM l WHERE first % 4 = 0 UNION ALL SELECT report_date, slug, 'audit.sourceCounts.titleAuthorAbstractEvaluated' FROM l WHERE first % 4 = 0
  UNION ALL SELECT report_date, slug, 'audit.sourceCounts.newPrimary' FROM l WHERE (third = 1) <> (first % 4 = 0)
  UNION ALL SELECT report_date, slug, 'audit.listingUrl' FROM l WHERE seventh = 1""")
def reconcile_reports(spark, folder):
    r = reports(spark, folder)
    l = r.where("first % 10 <> 0").select("report_date", "slug", (F.col("totalNew") + F.when(F.col("first") % 4 == 0, 1).otherwise(0)).alias("newCount"),
                                          F.lit(2).alias("crosslistCount"), R.listing_url("slug", "new").alias("sourceUrl"))
    return issue_rows(RC.reconcile_reports(r, l), "date", "slug", "path")


def registry(spark, folder):
    """Known people from customers: every third, under an accented alias, for one or two fields."""
    c = table(spark, folder, "customer")
    key = F.col("c_custkey")
    name = F.concat(F.lit("Customer "), key.cast("string"))
    tags = F.when(key % 2 == 0, F.array(F.lit("quant-ph"), F.lit("gr-qc"))).otherwise(F.array(F.lit("hep-th")))
    known = c.where(key % 3 == 0).select((key * 2).alias("entry"), name.alias("canonicalName"), F.array(F.concat(F.lit("Çustomér-"), key.cast("string"))).alias("aliases"), tags.alias("fieldTags"),
                                         F.concat(F.lit("prize "), key.cast("string")).alias("distinction"), F.lit("biography").alias("identityEvidence"),
                                         F.array(F.lit("https://a.example")).alias("officialUrls"), F.lit("2026-07-10").alias("lastVerified"))
    return known


@query("j4_match_authors", f"""WITH {PAPERS} SELECT arxiv_id, CASE WHEN idx % 59 = 0 AND idx % 29 <> 0 AND idx % 31 <> 0 THEN 0 WHEN o_custkey % 3 <> 0 THEN 0
    WHEN o_custkey % 2 = 0 AND slug = 'hep-th' THEN 0 WHEN o_custkey % 2 = 1 AND slug <> 'hep-th' THEN 0 WHEN idx % 29 = 0 THEN 2 ELSE 1 END::BIGINT AS badges FROM papers""")
def match_authors(spark, folder):
    found = RC.match_authors(authored(papers(spark, folder)), registry(spark, folder))
    return found.select(F.col("arxivId").alias("arxiv_id"), F.size("eminentAuthors").cast("bigint").alias("badges"))


@query("s4_author_registry", """SELECT 'duplicate registry identity customer ' || c_custkey AS message FROM customer WHERE c_custkey % 3 = 0""")
def author_registry(spark, folder):
    return issue_rows(RC.registry_issues(registry(spark, folder)), "message")


@query("j7_candidate_semi_join", f"""{RECEIPT_SQL}, listed AS (SELECT r.report_date, r.slug FROM r WHERE r.first % 3 = 2)
  SELECT report_date AS date, slug, 'candidate 0000.00000 is not announced' AS message FROM listed""")
def candidate_semi_join(spark, folder):
    p, made = receipts(spark, folder)
    found = J.check_receipt(made, p.select("report_date", "slug", F.col("arxivId").alias("id")))
    return issue_rows(found.where("kind = 'unknown'"), "date", "slug", "message")


@query("j8_orphan_dates", f"""WITH {PAPERS}, d AS (SELECT report_date, count(DISTINCT slug) AS n, min(idx) AS first FROM papers GROUP BY 1)
  SELECT report_date, 'reports have no edition' AS problem FROM d WHERE first % 6 = 0
  UNION ALL SELECT report_date, 'edition lacks its reports' FROM d WHERE first % 6 <> 0 AND n < 3
  UNION ALL SELECT report_date || 'x', 'edition lacks its reports' FROM d WHERE first % 9 = 0 AND first % 6 <> 0""")
def orphan_dates(spark, folder):
    r = reports(spark, folder)
    d = r.groupBy("report_date").agg(F.min("first").alias("first")).where("first % 6 <> 0")
    editions = d.select("report_date").union(d.where("first % 9 = 0").select(F.concat("report_date", F.lit("x"))))
    return RC.orphan_dates(r, editions)


@query("j11_reconcile_authors", """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Ann Nr' || c_custkey || 'Bee Gee' WHEN 1 THEN 'AnnaĆustomer' WHEN 2 THEN 'Nr, AnnGee, Bee' ELSE 'Nr, Ann' END AS authors FROM customer""")
def reconcile_authors(spark, folder):
    c = table(spark, folder, "customer")
    k = F.col("c_custkey")
    n = F.concat(F.lit("Nr"), k.cast("string"))
    cited = (F.when(k % 4 == 0, F.array(F.concat(n, F.lit(", Ann")), F.lit("Gee, Bee"))).when(k % 4 == 1, F.array(F.lit("ustomer, AnnaĆ")))
             .when(k % 4 == 2, F.array(F.lit("Nr, Ann"), F.lit("Gee, Bee"))).otherwise(F.array(F.lit("Nr, Ann"))))
    visible = (F.when(k % 4 == 0, F.array(F.concat(F.lit("Ann "), n), F.lit("Bee Gee"))).when(k % 4 == 1, F.array(F.lit("AnnaĆustomer")))
               .when(k % 4 == 2, F.array(F.lit("Ann Nr"), F.lit("Someone Else"))).otherwise(F.array(F.lit("Ann Nr"), F.lit("Extra"))))
    found = RC.reconcile_authors(c.withColumn("cited", cited).withColumn("visible", visible), "cited", "visible")
    return found.select("c_custkey", F.array_join("authors", "").alias("authors"))


@query("j12_paper_details", f"""WITH {PAPERS}, r AS (SELECT *, row_number() OVER (PARTITION BY report_date, slug ORDER BY total DESC, broad DESC, orig DESC, tech DESC, cat DESC, arxiv_id) AS rank FROM papers)
  SELECT arxiv_id, rank, basis FROM r WHERE rank > 10""")
def paper_details(spark, folder):
    from dayfolio.operators.ranking import rank_papers
    p = papers(spark, folder)
    found = RC.paper_details(rank_papers(p).where("rank > 10"), p, columns=["evaluationBasis"])
    return found.select(F.col("arxivId").alias("arxiv_id"), F.col("rank").cast("bigint").alias("rank"), F.col("evaluationBasis").alias("basis"))


@query("j13_project_correction", f"WITH {PAPERS} SELECT arxiv_id, CASE WHEN idx % 2 = 0 THEN 'new ' || idx END AS curiosity FROM papers")
def project_correction(spark, folder):
    p = papers(spark, folder).select("report_date", "slug", "arxivId", "index")
    shown = p.withColumn("curiosity", F.when(F.col("index") % 2 == 0, F.lit("old")))
    fresh = p.withColumn("curiosity", F.concat(F.lit("new "), F.col("index").cast("string")))
    return RC.project_correction(shown, fresh, ["curiosity"]).select(F.col("arxivId").alias("arxiv_id"), "curiosity")


def receipted(spark, folder):
    """Documents as records; labelled ones have receipts, some of them stale."""
    d = table(spark, folder, "documents").select("doc_id", F.col("text").alias("payload"))
    held = table(spark, folder, "labels").select("doc_id").distinct()
    stale = F.col("doc_id") % 10 == 3
    r = d.join(held, "doc_id").select("doc_id", F.sha2(F.when(stale, F.concat("payload", F.lit("!"))).otherwise(F.col("payload")), 256).alias("sha256"),
                                      F.octet_length("payload").cast("bigint").alias("bytes"))
    return d, r


STATE_SQL = """r AS (SELECT doc_id, text, CASE WHEN doc_id NOT IN (SELECT doc_id FROM labels) THEN 'incomplete' WHEN doc_id % 10 = 3 THEN 'changed' ELSE 'verified' END AS receipt_state FROM documents)"""


@query("j14_verify_receipts", f"WITH {STATE_SQL} SELECT doc_id, receipt_state FROM r")
def verify_receipts(spark, folder):
    return RC.verify_receipts(*receipted(spark, folder), ["doc_id"]).select("doc_id", "receipt_state")


@query("r7_repair_receipts", f"WITH {STATE_SQL} SELECT doc_id, sha256(text) AS sha256, octet_length(encode(text))::BIGINT AS bytes FROM r WHERE receipt_state = 'incomplete' AND length(text) > 100")
def repair_receipts(spark, folder):
    return J.repair_receipts(*receipted(spark, folder), ["doc_id"], lambda df: F.char_length("payload") > 100)


@query("s14_complete_set", f"""WITH {PAPERS}, r AS (SELECT idx // 3 AS job, slug, string_agg(arxiv_id, ',' ORDER BY arxiv_id) AS payload FROM papers GROUP BY 1, 2), v AS (SELECT * FROM r WHERE NOT (job % 5 = 0 AND slug = 'gr-qc') AND NOT (job % 7 = 0 AND slug = 'hep-th'))
  SELECT job, slug, payload FROM v WHERE job IN (SELECT job FROM v GROUP BY 1 HAVING count(*) = 3)""")
def whole_sets(spark, folder):
    """Exported and read back: a record without a receipt or with a stale one holds its whole job back."""
    from dayfolio.sources.writers import complete_set
    from dayfolio.workload.derive import scratch
    records = papers(spark, folder).groupBy(F.floor(F.col("index") / 3).cast("bigint").alias("job"), "slug").agg(F.array_join(F.sort_array(F.collect_list("arxivId")), ",").alias("payload"))
    stale = (F.col("job") % 5 == 0) & (F.col("slug") == "gr-qc")
    receipts = records.where(~((F.col("job") % 7 == 0) & (F.col("slug") == "hep-th"))).select(
        "job", "slug", F.sha2(F.when(stale, F.concat("payload", F.lit("!"))).otherwise(F.col("payload")), 256).alias("sha256"), F.octet_length("payload").cast("bigint").alias("bytes"))
    path = scratch(spark, "complete")
    complete_set(records, receipts, ["job"]).write.parquet(path)  # a folder per job, as the export writes, would be thousands here
    return spark.read.parquet(path).select("job", "slug", "payload")


@query("j15_verify_resume", f"""WITH {PAPERS}, m AS (SELECT *, idx % 2 = 0 AS candidate, idx % 13 = 0 AS flipped FROM papers)
  SELECT arxiv_id AS id, 'protected' AS kind FROM m WHERE NOT candidate AND (idx % 17 = 0 OR flipped) UNION ALL
  SELECT arxiv_id, 'candidate' FROM m WHERE (full_text <> flipped) AND NOT candidate UNION ALL SELECT arxiv_id, 'candidate' FROM m WHERE NOT (full_text <> flipped) AND candidate""")
def verify_resume(spark, folder):
    p = papers(spark, folder).withColumn("title", F.lit("t")).withColumn("authors", F.array(F.lit("a"))).withColumn("primaryCategory", F.col("slug"))
    after = p.withColumn("totalScore", F.col("totalScore") + F.when(when_key(17), 1).otherwise(0)).withColumn("fullTextEvaluated", F.col("fullTextEvaluated") != when_key(13))
    candidates = p.where(F.col("o_orderkey") % 2 == 0)
    return issue_rows(RC.verify_resume(p, after, candidates), "id", "kind")


CHAIN_SQL = """d AS (SELECT DISTINCT o_custkey, o_orderdate::DATE AS day FROM orders), e AS (SELECT o_custkey, day AS anchor, lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS target FROM d),
  edges AS (SELECT * FROM e WHERE target IS NOT NULL AND target - anchor <= 300)"""


def chain(spark, folder):
    """Per customer, consecutive order days no more than 300 days apart."""
    from dayfolio.operators.ordering import with_previous
    days = table(spark, folder, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("target")).distinct()
    edges = with_previous(days, ["o_custkey"], ["target"], {"anchor": "target"})
    return edges.where("anchor is not null and datediff(target, anchor) <= 300").select("o_custkey", "anchor", "target"), days


@query("j16_walk_chain", f"""WITH RECURSIVE {CHAIN_SQL}, walk AS (SELECT o_custkey, min(day) AS node, 0 AS step FROM d GROUP BY 1
  UNION ALL SELECT w.o_custkey, edges.target, step + 1 FROM walk w JOIN edges ON edges.o_custkey = w.o_custkey AND edges.anchor = w.node)
  SELECT o_custkey, node::VARCHAR AS node, step::BIGINT AS step FROM walk""")
def walk_chain(spark, folder):
    edges, days = chain(spark, folder)
    starts = days.groupBy("o_custkey").agg(F.min("target").alias("anchor"))
    return RC.walk_chain(edges, starts, ["o_custkey"]).select("o_custkey", F.col("node").cast("string").alias("node"), "step")


@query("w12_check_chain", """SELECT o_custkey::VARCHAR AS id, o_orderkey AS position, 'chain' AS kind FROM (SELECT *, lag(o_orderkey % 100) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders)
  WHERE before IS NOT NULL AND (o_orderkey // 100) % 100 <> before UNION ALL SELECT o_custkey::VARCHAR, o_orderkey, 'chain' FROM orders WHERE NOT o_orderkey % 100 > (o_orderkey // 100) % 100""")
def check_chain(spark, folder):
    k = F.col("o_orderkey")
    entries = table(spark, folder, "orders").select("o_custkey", "o_orderkey", (F.floor(k / 100) % 100).alias("anchor"), (k % 100).alias("target"))
    return issue_rows(B.check_chain(entries, ["o_custkey"], "o_orderkey", issue_keys={"id": "o_custkey", "position": "o_orderkey"}), "id", "position", "kind")


@query("j17_verify_plan", """WITH d AS (SELECT DISTINCT o_orderdate::DATE AS anchor FROM orders), c AS (SELECT anchor, lead(anchor) OVER (ORDER BY anchor) AS target, row_number() OVER (ORDER BY anchor) AS n, count(*) OVER () AS k FROM d),
  e AS (SELECT * FROM c WHERE target IS NOT NULL), p AS (SELECT * FROM e WHERE n BETWEEN k // 4 AND k // 2)
  SELECT anchor::VARCHAR AS anchor, CASE WHEN n BETWEEN k // 4 AND k // 2 THEN CASE WHEN n % 10 = 0 THEN 'left_only' WHEN n % 7 = 0 THEN 'changed' ELSE 'same' END
    WHEN n < k // 4 THEN 'earlier' WHEN (SELECT min(n) FROM e WHERE n > k // 2 AND n % 10 = 0) > n THEN 'extension' ELSE 'intruder' END AS state
  FROM e WHERE n BETWEEN k // 4 AND k // 2 OR n % 10 <> 0""")
def verify_plan(spark, folder):
    from dayfolio.operators.ordering import with_position, with_previous
    days = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("target")).distinct()
    size = days.agg(F.count(F.lit(1)).alias("k"))
    edges = with_position(with_previous(days, [], ["target"], {"anchor": "target"}), [], ["target"], "m").where("anchor is not null")
    edges = attach_row(edges.withColumn("n", F.col("m") - 1), size).withColumn("digest", F.col("target").cast("string"))
    plan = edges.where("n between floor(k / 4) and floor(k / 2)")
    queue = edges.where("n % 10 <> 0").withColumn("digest", F.when(F.col("n") % 7 == 0, "other").otherwise(F.col("digest")))
    pick = lambda df: df.select("anchor", "target", "digest")
    return RC.verify_plan(pick(plan), pick(queue), ["target", "digest"]).select(F.col("anchor").cast("string").alias("anchor"), "state")


@query("h20_canonical_json", """SELECT p_partkey, sha256('{"a_size":' || p_size || ',"inner":{"brand":"' || p_brand || '","name":"' || p_name || '"},"type":"' || p_type || '"}') AS digest FROM part""")
def canonical_json(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", F.col("p_type").alias("type"), F.struct(F.col("p_name").alias("name"), F.col("p_brand").alias("brand")).alias("inner"), F.col("p_size").alias("a_size"))
    return df.select("p_partkey", R.canonical_digest(df, ["type", "inner", "a_size"]).alias("digest"))


@query("h21_first_difference", f"WITH {PAPERS} SELECT arxiv_id, CASE WHEN idx % 3 = 0 THEN 'paper.lines[1]' WHEN idx % 5 = 0 THEN 'paper.lines[2]' WHEN idx % 7 = 0 THEN 'paper.scores.tech' END AS path FROM papers")
def first_difference(spark, folder):
    p = papers(spark, folder)
    i = F.col("index")
    lines = lambda changed: F.array(F.lit("a"), F.when(changed & (i % 3 == 0), "x").otherwise("b"), F.when(changed & ((i % 3 == 0) | (i % 5 == 0)), "y").otherwise("c"))
    side = lambda changed: F.struct(lines(changed).alias("lines"), F.struct((F.col("scores.technicalStrength") + F.when(changed & (i % 7 == 0), 1).otherwise(0)).alias("tech")).alias("scores"))
    both = p.select("arxivId", side(F.lit(False)).alias("l"), side(F.lit(True)).alias("r"))
    return both.select(F.col("arxivId").alias("arxiv_id"), R.first_difference(F.col("l"), F.col("r"), both.schema["l"].dataType, "paper").alias("path"))
