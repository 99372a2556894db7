"""Sinks over the supplied tables: written to the shared folder, refused where they must be, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfolio.sources import writers as S
from dayfolio.workload.derive import scratch
from dayfolio.workload.registry import query, table


def refused(write) -> bool:
    """Whether a write is turned away."""
    try:
        write()
    except S.RefusedWrite:
        return True
    return False


@query("s10_write_edition", "SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS date, o_totalprice + CASE WHEN month(o_orderdate) = 1 THEN 1 ELSE 0 END AS price FROM orders")
def write_edition(spark, folder):
    """Dates written again replace their own folder and no other."""
    o = table(spark, folder, "orders").select("o_orderkey", F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd").alias("date"), F.col("o_totalprice").alias("price"))
    path = scratch(spark, "editions")
    S.write_edition(o, path)
    S.write_edition(o.where("substr(date, 6, 2) = '01'").withColumn("price", F.col("price") + 1), path)
    return S.read_edition_table(spark, path, "o_orderkey bigint, price double, date string").select("o_orderkey", F.col("date").cast("string").alias("date"), "price")


@query("s11_write_immutable", "SELECT o_orderkey, o_orderstatus, true AS refused, 0 AS again FROM orders")
def write_immutable(spark, folder):
    """The same content again writes nothing, other content is refused."""
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    path = scratch(spark, "immutable")
    S.write_immutable(o.where("o_orderstatus <> 'P'"), path, ["o_orderstatus"])
    S.write_immutable(o, path, ["o_orderstatus"])
    again = S.write_immutable(o, path, ["o_orderstatus"])
    turned_away = refused(lambda: S.write_immutable(o.withColumn("o_orderkey", F.col("o_orderkey") + 1), path, ["o_orderstatus"]))
    return spark.read.schema(o.schema).parquet(path).select("o_orderkey", "o_orderstatus", F.lit(turned_away).alias("refused"), F.lit(again).alias("again"))


@query("s12_publish", "SELECT 'run-1' AS run_id, c_custkey FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'run-3', c_custkey FROM customer WHERE c_custkey % 2 = 1")
def publish(spark, folder):
    """A run that fails its audit stays unseen."""
    c = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    root = scratch(spark, "published")
    S.publish({"even": c.where("c_custkey % 2 = 0"), "all": c}, root, "run-1", lambda t: t["even"].where("c_custkey % 2 = 1"))
    refused(lambda: S.publish({"even": c}, root, "run-2", lambda t: t["even"].where("c_custkey % 2 = 1")))
    S.publish({"even": c.where("c_custkey % 2 = 1")}, root, "run-3")
    return S.read_published(spark, root, "even").select("run_id", "c_custkey")


@query("s13_append_event", "SELECT event_id, user_id, true AS refused FROM events WHERE event_type <> 'purchase'")
def append_event(spark, folder):
    """A published job takes no more events."""
    e = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    path = scratch(spark, "events")
    S.append_event(e.where("event_type = 'click'"), path, ["user_id"])
    S.append_event(e.where("event_type not in ('click', 'purchase')"), path, ["user_id"])
    late = e.where("event_type = 'purchase'")
    turned_away = refused(lambda: S.append_event(late, path, ["user_id"], late))
    return spark.read.schema(e.schema).json(path).select("event_id", "user_id", F.lit(turned_away).alias("refused"))


@query("s15_write_issues", "SELECT c_mktsegment AS slug, c_custkey::VARCHAR AS id, 'balance' AS kind FROM customer WHERE c_acctbal < 0")
def write_issues(spark, folder):
    c = table(spark, folder, "customer").where("c_acctbal < 0")
    path = scratch(spark, "issues")
    S.write_issues(c.select(F.lit("2020-01-01").alias("date"), F.col("c_mktsegment").alias("slug"), F.col("c_custkey").cast("string").alias("id"), F.lit("balance").alias("kind")), path)
    return spark.read.schema("id string, kind string, date string, slug string").json(path).select("slug", "id", "kind")


@query("s17_write_source_text", "SELECT doc_id::VARCHAR AS id, 'a/' || (doc_id % 3) || '.tex' AS path, text, true AS refused FROM documents")
def write_source_text(spark, folder):
    """An id that is published is refused as a whole."""
    d = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("id"), F.concat(F.lit("a/"), (F.col("doc_id") % 3).cast("string"), F.lit(".tex")).alias("path"), "text")
    root = scratch(spark, "sources")
    S.write_source_text(d, root, "run-1")
    turned_away = refused(lambda: S.write_source_text(d.where("id = '3'"), root, "run-2"))
    return S.read_published(spark, root, "source_text").select("id", "path", "text", F.lit(turned_away).alias("refused"))


@query("s16_check_bundle", """WITH d AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders), p AS (SELECT day, unnest(['data/reports/' || day || '-quant-ph.json', 'data/reports/' || day || '-gr-qc.json', 'data/reports/' || day || '-hep-th.json', 'public/data/' || day || '.json', 'public/data/current.json', 'public/data/index.json']) AS path FROM d)
  SELECT day, path, 'missing' AS side FROM p WHERE day LIKE '%-05' AND path LIKE '%gr-qc%' UNION ALL SELECT day, 'public/data/' || day || '.bak', 'not allowed' FROM d WHERE day LIKE '%-07'""")
def check_bundle(spark, folder):
    """Each day's bundle against the paths that it may and must touch."""
    days = table(spark, folder, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).distinct()
    allowed = S.publication_allowlist(days, date="day")
    extra = days.where("day like '%-07'").select("day", F.concat(F.lit("public/data/"), "day", F.lit(".bak")).alias("path"))
    actual = allowed.where("not (day like '%-05' and path like '%gr-qc%')").unionByName(extra)
    return S.check_bundle(actual, allowed, ["day", "path"]).select("day", "path", "side")
