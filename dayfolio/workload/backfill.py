"""Selection queries: one window of days per user, built from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfolio.functions import records as R, text as X, times
from dayfolio.operators import reconcile as RC
from dayfolio.plans import backfill as B
from dayfolio.workload.derive import ANNOUNCED, announcements, issue_rows
from dayfolio.workload.registry import query, spread, table

SLUGS = "(VALUES ('quant-ph'), ('gr-qc'), ('hep-th')) AS v(slug)"
TODAY = "2024-01-31"


def observed(spark, folder):
    """Listings and ids of the last eight days of every user; the oldest day is partial."""
    a = announcements(spark, folder)
    days = a.select("key", "date").distinct()
    newest = days.groupBy("key").agg(F.max("date").alias("newest"))
    week = days.join(newest, "key").where(F.datediff("newest", "date") < 8)
    oldest = week.groupBy("key").agg(F.min("date").alias("oldest"))
    slugs = spark.createDataFrame([("quant-ph",), ("gr-qc",), ("hep-th",)], "slug string")
    grid = week.select("key", "date", F.explode(F.array(*[F.lit(s) for s in ("quant-ph", "gr-qc", "hep-th")])).alias("slug")).join(oldest, "key")
    counts = a.groupBy("key", "date", "slug").agg(F.count_if(~F.col("crosslist")).alias("new_count"), F.count_if("crosslist").alias("crosslist_count"))
    complete = (F.col("date") != F.col("oldest")) | (F.col("key") % 3 == 0)
    listings = grid.join(counts, ["key", "date", "slug"], "left").fillna(0, ["new_count", "crosslist_count"]).withColumn("complete", complete).withColumn(
        "source_url", R.listing_url("slug", "pastweek")).drop("oldest")
    ids = a.where("not crosslist").join(week.select("key", "date"), ["key", "date"], "left_semi").select("key", "date", "slug", "id")
    return listings, ids


OBSERVED = f"""{ANNOUNCED}, days AS (SELECT DISTINCT key, date FROM announced), nw AS (SELECT key, max(date) AS newest FROM days GROUP BY 1),
  week AS (SELECT days.* FROM days JOIN nw USING (key) WHERE newest - date < 8), od AS (SELECT key, min(date) AS oldest, max(date) AS newest, count(*) AS n FROM week GROUP BY 1),
  snap AS (SELECT w.key, w.date, count(a.id) FILTER (NOT crosslist) AS new_count, count(a.id) FILTER (crosslist) AS crosslist_count, w.date <> oldest OR w.key % 3 = 0 AS complete
    FROM week w JOIN od USING (key) LEFT JOIN announced a ON a.key = w.key AND a.date = w.date GROUP BY ALL)"""


@query("b1_build_snapshot", f"WITH {OBSERVED} SELECT key, date::VARCHAR AS date, new_count, crosslist_count, complete FROM snap")
def build_snapshot(spark, folder):
    found = B.build_snapshot(*observed(spark, folder), keys=["key"])
    return found.select("key", F.col("date").cast("string").alias("date"), "new_count", "crosslist_count", "complete")


def windows(spark, folder):
    return B.build_window(B.build_snapshot(*observed(spark, folder), keys=["key"]), ["key"])


@query("b2_build_window", f"WITH {OBSERVED} SELECT key, string_agg(date::VARCHAR || ':' || new_count, ',' ORDER BY date DESC) AS dates, NULL::VARCHAR AS reject FROM snap GROUP BY 1")
def build_window(spark, folder):
    dates = F.transform("window", lambda d: F.concat(d["date"].cast("string"), F.lit(":"), d["new_count"].cast("string")))
    return windows(spark, folder).select("key", F.array_join(dates, ",").alias("dates"), "reject")


def requests(spark, folder):
    """A request per user: published three to six listed days ago, or not listed at all."""
    w = windows(spark, folder)
    dates = F.transform("window", lambda d: d["date"])
    newest = F.get("window", F.lit(0))
    latest = F.coalesce(F.get(dates, (F.col("key") % 6).cast("int")), F.date_sub(F.get(dates, F.lit(0)), 30))
    head = F.struct(newest["date"].alias("date"), newest["digest"].alias("digest"),
                    F.when(F.col("key") % 11 == 0, "other").otherwise(newest["content_digest"]).alias("content_digest"))
    return w.select("key", "window", head.alias("head"), latest.alias("latest_date"), F.lit(TODAY).cast("date").alias("today"))


SELECT_BASE = f"""{OBSERVED}, listed AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY date DESC) - 1 AS place FROM snap),
  anchor AS (SELECT od.*, coalesce(l.date, od.newest - 30) AS latest, l.date IS NOT NULL AS in_window FROM od LEFT JOIN listed l ON l.key = od.key AND l.place = od.key % 6),
  pend AS (SELECT a.key, a.latest, a.newest, a.in_window, a.oldest, a.n, list(l.date ORDER BY l.date) FILTER (l.date > a.latest AND l.complete AND l.new_count > 0) AS eligible,
    bool_or(l.date > a.latest AND NOT l.complete) AS partial FROM anchor a JOIN listed l USING (key) GROUP BY ALL),
  sel AS (SELECT *, CASE WHEN newest = latest THEN 'nothing' WHEN key % 11 = 0 OR (n = 1 AND key % 3 <> 0) THEN 'head mismatch' WHEN NOT in_window THEN 'published date outside the window'
    WHEN partial THEN 'a pending date is incomplete' WHEN len(coalesce(eligible, [])) = 0 THEN 'nothing' ELSE 'selected' END AS status FROM pend)"""


@query("b4_select_backfill", f"""WITH {SELECT_BASE} SELECT key, status, CASE WHEN status = 'selected' THEN eligible[1]::VARCHAR END AS target, CASE WHEN status = 'selected' THEN len(eligible) ELSE 0 END::BIGINT AS pending FROM sel""")
def select_backfill(spark, folder):
    found = requests(spark, folder).withColumn("s", B.select_backfill())
    return found.select("key", F.col("s.status").alias("status"), F.col("s.target_date").cast("string").alias("target"), F.col("s.pending_count").cast("bigint").alias("pending"))


@query("b3_classify_date", f"WITH {OBSERVED} SELECT key, date::VARCHAR AS date, CASE WHEN date > DATE '2024-01-28' THEN 'future' WHEN date < newest - 4 THEN 'stale' WHEN date = newest - 4 THEN 'current' ELSE 'new' END AS kind FROM snap JOIN od USING (key)")
def classify_date(spark, folder):
    listings, _ = observed(spark, folder)
    days = listings.select("key", "date").distinct()
    newest = days.groupBy("key").agg(F.max("date").alias("newest"))
    kind = B.classify_date(F.col("date"), F.date_sub("newest", 4), F.lit("2024-01-28").cast("date"))
    return days.join(newest, "key").select("key", F.col("date").cast("string").alias("date"), kind.alias("kind"))


@query("j10_verify_head", f"WITH {OBSERVED} SELECT key, key % 11 <> 0 AND (key % 3 = 0 OR n > 1) AS matches FROM od")
def verify_head(spark, folder):
    return requests(spark, folder).select("key", B.verify_head().alias("matches"))


def stored(spark, folder):
    """Requests with a stored date: the oldest complete one, sometimes changed."""
    r = requests(spark, folder)
    complete = F.filter("window", lambda d: d["complete"])
    oldest = F.get(complete, F.size(complete) - 1)
    held = F.struct(oldest["date"].alias("date"), oldest["new_count"].alias("new_count"),
                    F.when(F.col("key") % 7 == 0, "changed").otherwise(oldest["digest"]).alias("digest"))
    return r.withColumn("stored", held).withColumn("latest_date", F.when(F.col("key") % 2 == 0, F.date_sub(oldest["date"], 1)).otherwise(F.date_sub(oldest["date"], 2)))


STORED_BASE = f"""{OBSERVED}, c AS (SELECT key, min(date) FILTER (complete) AS target FROM snap GROUP BY 1), q AS (SELECT od.*, target, CASE WHEN key % 2 = 0 THEN target - 1 ELSE target - 2 END AS latest FROM od JOIN c USING (key)),
  w AS (SELECT q.*, CASE dayofweek(latest) WHEN 5 THEN latest + 3 WHEN 6 THEN latest + 2 ELSE latest + 1 END AS following, (SELECT count(*) FROM snap s WHERE s.key = q.key AND s.date > q.latest AND s.date < q.target) AS between_dates,
    EXISTS (SELECT 1 FROM snap s WHERE s.key = q.key AND s.date = q.latest) AS live, (SELECT count(*) FROM snap s WHERE s.key = q.key AND s.date >= q.target AND s.complete AND s.new_count > 0) AS eligible FROM q)"""


RECOVERY_STATUS = """CASE WHEN target IS NULL OR key % 11 = 0 THEN 'head mismatch' WHEN between_dates > 0 OR (NOT live AND following <> target) THEN 'target would skip a date'
    WHEN key % 7 = 0 THEN 'target changed' WHEN eligible = 0 THEN 'no papers' ELSE 'selected' END"""


@query("b5_select_recovery", f"WITH {STORED_BASE} SELECT key, {RECOVERY_STATUS} AS status FROM w")
def select_recovery(spark, folder):
    return stored(spark, folder).select("key", B.select_recovery()["status"].alias("status"))


@query("b10_revalidate", f"WITH {STORED_BASE} SELECT key, CASE WHEN target IS NULL THEN 'gone' WHEN key % 7 = 0 THEN 'changed' ELSE 'unchanged' END AS state FROM w")
def revalidate(spark, folder):
    return stored(spark, folder).select("key", B.revalidate().alias("state"))


def aged(spark, folder):
    """Requests whose stored date lies before the window; every window date counts as complete."""
    r = requests(spark, folder)
    whole = F.transform("window", lambda d: d.withField("complete", F.lit(True)))
    oldest = F.get("window", F.size("window") - 1)["date"]
    gap = (1 + F.col("key") % 3).cast("int")
    target = F.date_sub(oldest, gap)
    held = F.struct(target.alias("date"), (F.col("key") % 5).cast("bigint").alias("new_count"), F.sha2(F.col("key").cast("string"), 256).alias("digest"))
    return r.withColumn("window", whole).withColumn("stored", held).withColumn("latest_date", F.date_sub(target, (1 + F.col("key") % 2).cast("int")))


def following_sql(day: str) -> str:
    return f"(CASE dayofweek({day}) WHEN 5 THEN {day} + 3 WHEN 6 THEN {day} + 2 ELSE {day} + 1 END)"


AGED_BASE = f"""{OBSERVED}, q AS (SELECT *, oldest - (1 + key % 3)::INT AS target, oldest - (1 + key % 3)::INT - (1 + key % 2)::INT AS latest FROM od)"""
AGED_STATUS = f"""CASE WHEN key % 11 = 0 THEN 'head mismatch' WHEN {following_sql('latest')} <> target THEN 'target does not follow the published date'
  WHEN {following_sql('target')} <> oldest THEN 'window does not follow the target' WHEN key % 5 = 0 THEN 'no papers' ELSE 'selected' END"""


@query("b6_select_aged", f"WITH {AGED_BASE} SELECT key, {AGED_STATUS} AS status FROM q")
def select_aged(spark, folder):
    return aged(spark, folder).select("key", B.select_aged()["status"].alias("status"))


AGED_NEXT = f"""{AGED_BASE}, t AS (SELECT key, min(date) FILTER (new_count > 0) AS first FROM snap GROUP BY 1), z AS (SELECT q.key, target, oldest, newest, first FROM q JOIN t USING (key)),
  s AS (SELECT key, first, target, newest, CASE WHEN key % 11 = 0 THEN 'head mismatch' WHEN {following_sql('target')} <> oldest THEN 'window does not follow the anchor' WHEN first IS NULL THEN 'nothing' ELSE 'selected' END AS status FROM z)"""


@query("b7_select_aged_next", f"WITH {AGED_NEXT} SELECT key, status, CASE WHEN status = 'selected' THEN first::VARCHAR END AS target FROM s")
def select_aged_next(spark, folder):
    r = aged(spark, folder).withColumn("latest_date", F.col("stored.date")).withColumn("s", B.select_aged_next())
    return r.select("key", F.col("s.status").alias("status"), F.col("s.target_date").cast("string").alias("target"))


def evidenced(spark, folder):
    """Selections of all four modes with their evidence."""
    normal = requests(spark, folder).withColumn("s", B.select_backfill())
    recovery = stored(spark, folder).withColumn("s", B.select_recovery())
    old = aged(spark, folder).withColumn("s", B.select_aged())
    following = aged(spark, folder).withColumn("latest_date", F.col("stored.date")).withColumn("s", B.select_aged_next())
    pick = lambda df: df.withColumn("evidence", B.selection_evidence(F.col("s"))).where("evidence is not null").select(
        "key", F.col("s.mode").alias("mode"), F.col("s.target_date").alias("target"), "latest_date", "window", "head", "today", "s", "evidence")
    return pick(normal).unionByName(pick(recovery)).unionByName(pick(old)).unionByName(pick(following))


EVIDENCED = f"""ev AS (
  (WITH {SELECT_BASE} SELECT key, 'normal' AS mode, eligible[1] AS target, latest AS anchor, newest AS head, true AS live FROM sel WHERE status = 'selected')
  UNION ALL (WITH {STORED_BASE}, z AS (SELECT *, {RECOVERY_STATUS} AS status FROM w) SELECT key, 'checkpoint_recovery', target, latest, newest, true FROM z WHERE status = 'selected')
  UNION ALL (WITH {AGED_BASE}, z AS (SELECT *, {AGED_STATUS} AS status FROM q) SELECT key, 'aged_checkpoint_recovery', target, latest, newest, false FROM z WHERE status = 'selected')
  UNION ALL (WITH {AGED_NEXT} SELECT key, 'aged_window_continuation', first, target, newest, true FROM s WHERE status = 'selected'))"""


@query("b9_selection_evidence", f"WITH {EVIDENCED} SELECT key, mode, target::VARCHAR AS target, anchor::VARCHAR AS anchor, head::VARCHAR AS head FROM ev")
def selection_evidence(spark, folder):
    e = F.col("evidence")
    return evidenced(spark, folder).select("key", "mode", e["targetDate"].cast("string").alias("target"), e["expectedLatestDate"].cast("string").alias("anchor"), e["officialHeadDate"].cast("string").alias("head"))


@query("p24_check_selection_evidence", f"""WITH {EVIDENCED} SELECT key AS position, 'evidence.schemaVersion' AS path FROM ev WHERE key % 2 = 0
  UNION ALL SELECT key, 'evidence.officialHeadDate' FROM ev WHERE key % 5 = 2 UNION ALL SELECT key, 'evidence' FROM ev WHERE key % 7 = 3
  UNION ALL SELECT key, 'evidence' FROM ev WHERE key % 9 = 4 AND mode IN ('normal', 'checkpoint_recovery')""")
def check_selection_evidence(spark, folder):
    """Evidence of all modes, with another version, another head, a broken digest or a target that is not listed."""
    k, e = F.col("key"), F.col("evidence")
    broken = e.withField("schemaVersion", F.when(k % 2 == 0, "0.9").otherwise("1.0")).withField(
        "officialHeadDate", F.when(k % 5 == 2, F.date_add(e["officialHeadDate"], 1)).otherwise(e["officialHeadDate"])).withField(
        "officialHeadFingerprint", F.when(k % 7 == 3, "x").otherwise(e["officialHeadFingerprint"])).withField(
        "completeSnapshotDates", F.when((k % 9 == 4) & e["selectionMode"].isin("normal", "checkpoint_recovery"), F.array_remove(e["completeSnapshotDates"], e["targetDate"])).otherwise(e["completeSnapshotDates"]))
    found = B.check_selection_evidence(evidenced(spark, folder).withColumn("evidence", broken), keys={"position": "key"})
    return issue_rows(found, "position", "path")


@query("b8_select_authorized", f"WITH {EVIDENCED} SELECT key, mode, CASE WHEN key % 4 = 1 THEN 'head changed' ELSE 'selected' END AS status, CASE WHEN key % 4 <> 1 THEN live END AS still_live FROM ev")
def select_authorized(spark, folder):
    """Authorisations of all modes, some of them given under another head."""
    r = evidenced(spark, folder).withColumn("stored", F.struct(F.col("target").alias("date"), F.lit(1).cast("bigint").alias("new_count"), F.col("s.target_digest").alias("digest")))
    moved = r.withColumn("head", F.col("head").withField("digest", F.when(F.col("key") % 4 == 1, "moved").otherwise(F.col("head.digest"))))
    found = moved.withColumn("a", B.select_authorized())
    return found.select("key", "mode", F.col("a.status").alias("status"), F.col("a.still_live").alias("still_live"))


def valid_id(key: str):
    """An id of its own for each key: five digits in a month, then the next month."""
    month = F.expr(f"1000 + {key} div 1200000 * 100 + {key} div 100000 % 12 + 1")
    return F.format_string("%04d.%05d", month, F.col(key) % 100000)


def chained(spark, folder):
    """Pending days per user and the day published last."""
    days = announcements(spark, folder).select("key", "date").distinct()
    bounds = days.groupBy("key").agg(F.min("date").alias("first"))
    latest = bounds.select("key", F.date_add("first", (F.col("key") % 4).cast("int")).alias("latest_date"))
    pending = days.join(latest, "key").where("date > latest_date").select("key", "date", F.sha2(F.concat_ws("/", "key", "date"), 256).alias("digest"))
    return days, latest, pending


CHAINED = f"""{ANNOUNCED}, days AS (SELECT DISTINCT key, date FROM announced), lt AS (SELECT key, min(date) + (key % 4)::INT AS latest FROM days GROUP BY 1),
  pd AS (SELECT days.*, latest, row_number() OVER (PARTITION BY key ORDER BY date) - 1 AS position, lag(date) OVER (PARTITION BY key ORDER BY date) AS before FROM days JOIN lt USING (key) WHERE date > latest)"""


@query("w10_pending_dates", f"WITH {CHAINED} SELECT key, date::VARCHAR AS date, position + 1 AS position FROM pd")
def pending_dates(spark, folder):
    days, latest, _ = chained(spark, folder)
    found = B.pending_dates(days, latest, ["key"])
    return found.select("key", F.col("date").cast("string").alias("date"), F.col("position").cast("bigint").alias("position"))


@query("k7_next_date", f"WITH {CHAINED} SELECT key, date::VARCHAR AS next_date FROM pd WHERE position = 0")
def next_date(spark, folder):
    _, _, pending = chained(spark, folder)
    return B.next_date(pending, ["key"]).select("key", F.col("next_date").cast("string").alias("next_date"))


@query("b12_plan_entries", f"""WITH {CHAINED} SELECT key, position, CASE position WHEN 0 THEN 'aged_checkpoint_recovery' WHEN 1 THEN 'aged_window_continuation' ELSE 'normal' END AS mode,
  coalesce(before, latest)::VARCHAR AS anchor, date::VARCHAR AS target FROM pd""")
def plan_entries(spark, folder):
    _, latest, pending = chained(spark, folder)
    found = B.plan_entries(pending, latest, ["key"])
    return found.select("key", F.col("position").cast("bigint").alias("position"), "mode", F.col("anchor").cast("string").alias("anchor"), F.col("target").cast("string").alias("target"))


def authorised(spark, folder):
    """Stored authorisations: the first few pending days of each user, some with other content."""
    _, latest, pending = chained(spark, folder)
    plan = B.plan_entries(pending, latest, ["key"])
    return plan.where(F.col("position") < F.col("key") % 5).withColumn("digest", F.when((F.col("key") % 9 == 0) & (F.col("position") == 1), "other").otherwise(F.col("digest")))


@query("b13_active_record", f"WITH {CHAINED} SELECT key, date::VARCHAR AS target FROM pd WHERE position = 0 AND key % 5 > 0")
def active_record(spark, folder):
    _, latest, _ = chained(spark, folder)
    active, _ = B.active_record(authorised(spark, folder), latest, ["key"])
    return active.select("key", F.col("target").cast("string").alias("target"))


@query("b11_continuation_queue", f"""WITH {CHAINED}, x AS (SELECT *, position < key % 5 AS authorised, key % 5 = 0 OR key % 2 = 0 AS extends FROM pd)
  SELECT key, position, coalesce(before, latest)::VARCHAR AS anchor, date::VARCHAR AS target, authorised, CASE WHEN authorised AND key % 9 = 0 AND position = 1 THEN 'live and queued content differ' END AS problem
  FROM x WHERE authorised OR extends""")
def continuation_queue(spark, folder):
    days, latest, pending = chained(spark, folder)
    listed = days.where(F.col("key") % 2 == 0)
    found = B.continuation_queue(pending, authorised(spark, folder), latest, listed, ["key"])
    return found.select("key", F.col("position").cast("bigint").alias("position"), F.col("anchor").cast("string").alias("anchor"), F.col("target").cast("string").alias("target"), "authorised", "problem")


@query("p25_check_plan", f"""WITH {CHAINED}, e AS (SELECT *, coalesce(before, latest) AS anchor FROM pd), k AS (SELECT key, max(date) AS last, list(date ORDER BY date DESC) FILTER (position > 0) AS dates FROM e GROUP BY 1 HAVING count(*) > 1)
  SELECT e.key::VARCHAR AS id, e.position, 'mode' AS path FROM e JOIN k USING (key) WHERE e.position = 2
  UNION ALL SELECT e.key::VARCHAR, e.position, 'target' FROM e JOIN k USING (key) WHERE e.position = 0 AND NOT ({following_sql('anchor')} = date AND {following_sql('date')} = list_min(dates))""")
def check_plan(spark, folder):
    _, latest, pending = chained(spark, folder)
    plan = B.plan_entries(pending, latest, ["key"])
    shared = plan.groupBy("key").agg(F.sort_array(F.collect_list(F.when(F.col("position") > 0, F.col("target"))), asc=False).alias("dates"), F.count(F.lit(1)).alias("n")).where("n > 1")
    e = plan.join(shared, "key").withColumn("new_count", F.lit(1)).withColumn("evidence", F.struct(
        F.lit("1.0").alias("schemaVersion"), F.col("mode").alias("selectionMode"), F.col("anchor").alias("expectedLatestDate"), F.col("target").alias("targetDate"),
        F.col("digest").alias("targetSnapshotFingerprint"), F.get("dates", F.lit(0)).alias("officialHeadDate"), F.lit("h").alias("officialHeadFingerprint"),
        F.col("dates").alias("pastweekAnnouncementDates"), F.col("dates").alias("completeSnapshotDates")))
    broken = e.withColumn("mode", F.when(F.col("position") == 2, "aged_window_continuation").otherwise(F.col("mode"))).withColumn(
        "evidence", F.col("evidence").withField("selectionMode", F.col("mode")))
    return issue_rows(B.check_plan(broken, ["key"]), "id", "position", "path")


# Dates and times ---------------------------------------------------------------------------------------------

@query("h12_parse_date", "SELECT o_orderkey, try_cast(CASE WHEN o_orderkey % 9 = 0 THEN strftime(o_orderdate, '%Y-%m') || '-31' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE)::VARCHAR AS day FROM orders")
def parse_date(spark, folder):
    text = F.when(F.col("o_orderkey") % 9 == 0, F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-31"))).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, folder, "orders").select("o_orderkey", times.parse_date(text).cast("string").alias("day"))


@query("h13_parse_jst", "SELECT event_id, CASE WHEN event_id % 8 <> 5 THEN strftime(date_trunc('second', ts) - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') END AS utc FROM events")
def parse_jst(spark, folder):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 8 == 5, "Z").otherwise("+09:00"))
    return table(spark, folder, "events").select("event_id", F.date_format(times.parse_jst(text), "yyyy-MM-dd HH:mm:ss").alias("utc"))


@query("h14_jst_date", "SELECT event_id, (ts + INTERVAL 9 HOUR)::DATE::VARCHAR AS day, ts >= (ts + INTERVAL 9 HOUR)::DATE - INTERVAL 9 HOUR AND ts < (ts + INTERVAL 9 HOUR)::DATE + INTERVAL 15 HOUR AS inside FROM events")
def jst_date(spark, folder):
    e = table(spark, folder, "events").withColumn("day", times.jst_date("ts")).withColumn("b", times.jst_bounds("day"))
    return e.select("event_id", F.col("day").cast("string").alias("day"), ((F.col("ts") >= F.col("b.start")) & (F.col("ts") < F.col("b.end"))).alias("inside"))


@query("h15_headings", "SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 1 THEN o_orderdate::DATE::VARCHAR END AS long_day, CASE WHEN o_orderkey % 6 <> 1 THEN o_custkey END AS shown, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS total FROM orders")
def headings(spark, folder):
    o = table(spark, folder, "orders")
    wrong = F.col("o_orderkey") % 6 == 1
    day = F.when(wrong, F.date_add("o_orderdate", 1)).otherwise(F.col("o_orderdate").cast("date"))
    n = F.col("o_custkey").cast("string")
    long = F.concat(F.lit("Showing new listings for "), F.date_format(day, "EEEE"), F.lit(", "), F.date_format("o_orderdate", "d MMMM yyyy"))
    short = F.concat(F.date_format(day, "EEE"), F.lit(", "), F.date_format("o_orderdate", "d MMM yyyy"), F.lit(" (showing "), n, F.lit(" of "), n, F.lit(" entries )"))
    section = F.concat(F.lit("New submissions (showing "), n, F.lit(" of "), F.when(F.col("o_orderkey") % 2 == 0, n).otherwise(F.concat(n, F.lit("1"))), F.lit(" entries)"))
    read = o.select("o_orderkey", times.long_heading(long).cast("string").alias("long_day"), times.short_heading(short)["shown"].alias("shown"), times.section_heading(section)["total"].alias("total"))
    return read


@query("h16_next_weekday", f"SELECT DISTINCT o_orderdate::DATE::VARCHAR AS day, {following_sql('o_orderdate::DATE')}::VARCHAR AS following FROM orders")
def next_weekday(spark, folder):
    d = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return d.select(F.col("d").cast("string").alias("day"), times.next_weekday("d").cast("string").alias("following"))


@query("h28_run_time", "SELECT event_id, CASE WHEN event_id % 5 <> 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS started FROM events")
def run_time(spark, folder):
    text = F.concat(F.lit("run-"), F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"), F.when(F.col("event_id") % 5 == 2, "-XYZ").otherwise("-0123456789ab"))
    return table(spark, folder, "events").select("event_id", F.date_format(times.run_time(text), "yyyy-MM-dd HH:mm:ss").alias("started"))


@query("h18_backoff", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN [0.25, 4, 18, 36, 72][least(p_size, 5)] ELSE [1, 4, 12, 24][least(p_size, 4)] END::DOUBLE AS hours, p_size + 1 >= 3 AND (p_size - 2) % 3 = 0 AS attention FROM part")
def backoff(spark, folder):
    p = table(spark, folder, "part")
    return p.select("p_partkey", times.backoff_hours(F.col("p_partkey") % 2 == 0, F.col("p_size")).alias("hours"), times.needs_attention("p_size").alias("attention"))


@query("h26_classify_readiness", """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'N' THEN 'ready' WHEN l_returnflag = 'R' AND l_linenumber > 5 THEN 'ready_pdf_fallback'
  WHEN l_quantity < 10 THEN 'defer' WHEN l_quantity < 20 THEN 'defer' WHEN l_quantity < 30 AND l_linestatus = 'O' THEN 'defer' ELSE 'fail' END AS state FROM lineitem""")
def classify_readiness(spark, folder):
    q = F.col("l_quantity")
    status = F.when(q < 10, F.lit(None).cast("int")).when(q < 20, 503).when(q < 30, 404).otherwise(403)
    state = R.classify_readiness(status, F.when(F.col("l_returnflag") == "R", "source").otherwise("pdf"), F.col("l_returnflag") == "N", F.col("l_linenumber") > 5, F.col("l_linestatus") == "O")
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", state.alias("state"))


@query("h17_urls_and_ids", """SELECT p_partkey, 'https://arxiv.org/abs/' || lpad((1000 + p_partkey // 1200000 * 100 + p_partkey // 100000 % 12 + 1)::VARCHAR, 4, '0') || '.' || lpad((p_partkey % 100000)::VARCHAR, 5, '0') || 'v1' AS url,
  (1000 + p_partkey // 1200000 * 100 + p_partkey // 100000 % 12 + 1)::BIGINT * 1000000 + p_partkey % 100000 AS place FROM part""")
def urls_and_ids(spark, folder):
    p = table(spark, folder, "part")
    number = valid_id("p_partkey")
    key = R.id_sort_key(number)
    return p.select("p_partkey", R.abs_url_v1(number).alias("url"), (key["month"].cast("bigint") * 1000000 + key["sequence"]).alias("place"))


@query("h25_ratio", "SELECT p_brand, floor(count(*) FILTER (p_size > 25) / count(*)::DOUBLE * 100 + 0.5)::INT AS percent, count(*) FILTER (p_size > 25) / count(*)::DOUBLE > 0.5 AS above FROM part GROUP BY 1")
def ratio(spark, folder):
    g = table(spark, folder, "part").groupBy("p_brand").agg(F.count_if(F.col("p_size") > 25).alias("a"), F.count(F.lit(1)).alias("b"))
    return g.select("p_brand", R.percent(F.col("a"), F.col("b")).alias("percent"), (R.ratio(F.col("a"), F.col("b")) > 0.5).alias("above"))


@query("h22_blocker_codec", """SELECT event_id, event_id % 3 = 0 AS held, event_id % 3 = 1 AS malformed, CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS observed FROM events""")
def blocker_codec(spark, folder):
    e = spread(table(spark, folder, "events"), "event_id")
    number = valid_id("event_id")
    receipt = F.struct(F.lit("1.0").alias("schemaVersion"), F.lit("source_incomplete").alias("status"), number.alias("arxivId"), F.lit(R.config.PROBE_FAILURE).alias("failureClass"), F.array(number).alias("provisionalCandidateIds"))
    good = R.encode_blocker(receipt, F.date_trunc("second", F.col("ts")).cast("timestamp_ntz"))
    text = F.when(F.col("event_id") % 3 == 0, good).when(F.col("event_id") % 3 == 1, F.concat(F.substr(good, F.lit(1), F.length(good) - 3), F.lit("}"))).otherwise("plain words")
    d = X.once(e, d=R.decode_blocker(text))
    return d.select("event_id", F.col("d.blocker").isNotNull().alias("held"), F.col("d.malformed").alias("malformed"), F.date_format(R.parse_iso("d.blocker.observedAt"), "yyyy-MM-dd HH:mm:ss").alias("observed"))
