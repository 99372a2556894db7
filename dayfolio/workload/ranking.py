"""Ranking, order checks and top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfolio.operators import ranking as K
from dayfolio.operators.ordering import with_position
from dayfolio.workload.derive import PAPER_ORDER_SQL, PAPERS, issue_rows, papers, stored_rank
from dayfolio.workload.registry import query, table

RANKED = f"""WITH {PAPERS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY report_date, slug ORDER BY {PAPER_ORDER_SQL}) AS rank FROM papers)"""


@query("w1_rank_papers", f"{RANKED} SELECT report_date, slug, arxiv_id, total::BIGINT AS total, rank FROM ranked")
def rank_papers(spark, folder):
    return K.rank_papers(papers(spark, folder)).select(
        "report_date", "slug", F.col("arxivId").alias("arxiv_id"), F.col("totalScore").cast("bigint").alias("total"), F.col("rank").cast("bigint").alias("rank"))


@query("w1_rank_orders_in_large_groups", """SELECT o_orderkey, o_orderstatus,
  row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders""")
def rank_orders(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    # Each status holds about a third of the rows; its ranges are numbered by many tasks.
    ranked = with_position(o, ["o_orderstatus"], [-F.col("o_totalprice"), F.col("o_orderkey")], "position")
    return ranked.select("o_orderkey", "o_orderstatus", F.col("position").cast("bigint").alias("position"))


@query("w2_check_rank", f"""{RANKED}, stored AS (SELECT *, rank() OVER (PARTITION BY report_date, slug ORDER BY total DESC) AS held FROM ranked),
 used AS (SELECT report_date, slug, held, count(*) AS n FROM stored GROUP BY ALL HAVING count(*) > 1)
 SELECT report_date AS date, slug, arxiv_id AS id, 'invariant' AS kind, 'must be deterministic rank ' || rank AS message FROM stored WHERE held <> rank
 UNION ALL SELECT report_date, slug, NULL, 'invariant', 'rank ' || held || ' is used ' || n || ' times' FROM used""")
def check_rank(spark, folder):
    return issue_rows(K.check_rank(stored_rank(papers(spark, folder))), "date", "slug", "id", "kind", "message")


@query("w3_check_monotone", f"""WITH {PAPERS} SELECT report_date AS date, slug, arxiv_id AS id, idx AS position FROM (
  SELECT *, lag(total) OVER (PARTITION BY report_date, slug ORDER BY idx) AS before FROM papers) WHERE before < total""")
def check_monotone(spark, folder):
    return issue_rows(K.check_monotone(papers(spark, folder), along=["index"]), "date", "slug", "id", "position")


@query("w4_check_order", """SELECT o_custkey::VARCHAR AS id, o_orderkey AS position FROM (
  SELECT *, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders) WHERE before IS NOT NULL AND NOT before > o_orderdate""")
def check_order(spark, folder):
    o = table(spark, folder, "orders")
    return issue_rows(K.check_order(o, ["o_custkey"], ["o_orderkey"], "o_orderdate", keys={"id": "o_custkey", "position": "o_orderkey"}), "id", "position")


@query("k1_order_papers", f"WITH {PAPERS} SELECT report_date, slug, arxiv_id FROM papers")
def order_papers(spark, folder):
    return K.order_papers(papers(spark, folder)).select("report_date", "slug", F.col("arxivId").alias("arxiv_id"))


@query("k2_split_top", f"{RANKED} SELECT report_date, slug, arxiv_id, rank, rank <= 10 AS is_top FROM ranked")
def split_top(spark, folder):
    top, rest = K.split_top(papers(spark, folder))
    pick = lambda df, flag: df.select("report_date", "slug", F.col("arxivId").alias("arxiv_id"), F.col("rank").cast("bigint").alias("rank"), F.lit(flag).alias("is_top"))
    return pick(top, True).unionByName(pick(rest, False))


@query("k3_shortlist", f"{RANKED} SELECT report_date, slug, arxiv_id, rank FROM ranked WHERE rank <= 12")
def shortlist(spark, folder):
    return K.shortlist(papers(spark, folder)).select("report_date", "slug", F.col("arxivId").alias("arxiv_id"), F.col("rank").cast("bigint").alias("rank"))


@query("p15_top_and_rest", f"""{RANKED} SELECT report_date, slug, rank, rank <= 10 AS is_top, CASE WHEN rank <= 10 THEN basis END AS full_basis,
  CASE WHEN rank > 10 THEN arxiv_id END AS summary_id FROM ranked""")
def top_and_rest(spark, folder):
    ranked = K.rank_papers(papers(spark, folder))
    split = K.top_and_rest(ranked, ["arxivId", "scores", "evaluationBasis"], ["arxivId", "url", "totalScore"])
    return split.select("report_date", "slug", F.col("rank").cast("bigint").alias("rank"), "is_top",
                        F.col("full.evaluationBasis").alias("full_basis"), F.col("summary.arxivId").alias("summary_id"))


@query("w11_projected_budget", f"""{RANKED} SELECT report_date, slug, count(*) AS papers, count(*) FILTER (full_text) AS flagged,
  count(*) FILTER (full_text OR rank <= 10) AS projected, count(*) FILTER (full_text OR rank <= 10) > least(12, count(*)) AS over_budget FROM ranked GROUP BY ALL""")
def projected_budget(spark, folder):
    p = papers(spark, folder)
    limits = p.groupBy("report_date", "slug").agg(F.least(F.lit(12), F.count(F.lit(1))).alias("full_text_limit"))
    return K.projected_budget(p, limits).select("report_date", "slug", "papers", "flagged", "projected", "over_budget")
