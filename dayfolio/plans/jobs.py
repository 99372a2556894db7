"""Retry, publication and draft state from append-only events.

Everything per key is an aggregate over order structs (``max_by``, conditional
``max``), so events combine before the shuffle and a key with very many events
is never sorted in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dayfolio import config, schemas
from dayfolio.functions import records as R, times
from dayfolio.operators.checks import cap_rules, effective_limit, evidence_rules, identity_rules, score_rules
from dayfolio.operators.issues import Rule, as_issue, find_issues, union_all
from dayfolio.operators.ordering import top_rows
from dayfolio.operators.ranking import GROUP, check_rank, paper_order
from dayfolio.operators.reconcile import reconcile_ids, reconcile_reports, verify_receipts
from dayfolio.operators.skew import salted_join, small_or_plain

JOB = ("reportDate", "snapshotFingerprint", "runtimeFingerprint")
KEYS = (*JOB, "category")


def attempt_rows(events: DataFrame, prefix: str = R.BLOCKER_PREFIX) -> DataFrame:
    """Attempt events in working form: times, whether a receipt is attached."""
    decoded = events.withColumn("_m", R.decode_blocker("message", prefix))
    at = R.parse_iso("at")
    structured = F.col("_m.blocker").isNotNull()
    return decoded.select(
        *KEYS, F.col("attemptId").alias("attempt_id"), F.col("eventId").alias("event_id"), "stage", "status", at.alias("at"),
        structured.alias("structured"), F.coalesce(R.parse_iso("_m.blocker.observedAt"), at).alias("observed_at"),
        F.col("_m.blocker.receipt").alias("receipt"), F.col("_m.malformed").alias("malformed"))


ORDER = ("at", "event_id")


def since_last_success(events: DataFrame, keys: Sequence[str], completed: Column | None = None) -> DataFrame:
    """Events after the last completed one of their key."""
    done = (F.col("status") == "completed") if completed is None else completed
    order = F.struct(*ORDER)
    last = events.where(done).groupBy(*keys).agg(F.max(order).alias("_done"))
    joined = salted_join(events, last, keys)
    return joined.where(F.col("_done").isNull() | (order > F.col("_done"))).drop("_done")


def dedupe_attempts(events: DataFrame, keys: Sequence[str], attempt: str = "attempt_id") -> DataFrame:
    """One failure per attempt: with a receipt first, then observed later, then later in order."""
    failed = events.where("status = 'failed'").where(F.col("structured") | F.col("stage").isin(*config.RETRY_STAGES))
    order = F.struct(F.coalesce("structured", F.lit(False)), "observed_at", *ORDER)
    return failed.groupBy(*keys, attempt).agg(F.max_by(F.struct("structured", "observed_at", *ORDER, "stage"), order).alias("_b")).select(
        *keys, attempt, "_b.*")


def attempt_outcomes(events: DataFrame, keys: Sequence[str], now: Column, attempt: str = "attempt_id",
                     orphan_hours: float = config.ORPHAN_HOURS) -> DataFrame:
    """Counted failures after the last success, orphaned starts included.

    One row per attempt: ``kind``, ``structured``, ``observed_at``, order.
    """
    recent = since_last_success(events, keys)
    order = F.struct(*ORDER)
    failed = F.col("status") == "failed"
    counted = failed & (F.coalesce("structured", F.lit(False)) | F.col("stage").isin(*config.RETRY_STAGES))
    started = (F.col("status") == "started") & F.col("stage").isin(*config.START_STAGES)
    rank = F.struct(F.coalesce("structured", F.lit(False)).alias("s"), "observed_at", *ORDER)
    per_attempt = recent.groupBy(*keys, attempt).agg(
        F.max(F.when(counted, F.struct(*[rank[f].alias(f) for f in ("s", "observed_at", *ORDER)], F.col("stage")))).alias("_f"),
        F.max(F.when(started, order)).alias("_s"), F.max(F.when(failed, order)).alias("_t"))
    pending = F.col("_s").isNotNull() & (F.col("_t").isNull() | (F.col("_s") > F.col("_t")))
    orphan = F.col("_f").isNull() & pending & (F.col("_s.at") + F.make_dt_interval(hours=F.lit(int(orphan_hours))) <= now)
    kind = (F.when(orphan, "generation_failure").when(F.col("_f.s"), "source_incomplete")
            .when(F.col("_f.stage") == "category_repair", "repair_failure").otherwise("generation_failure"))
    return per_attempt.where(F.col("_f").isNotNull() | orphan).select(
        *keys, attempt, kind.alias("kind"), F.coalesce("_f.s", F.lit(False)).alias("structured"),
        F.coalesce("_f.observed_at", "_s.at").alias("observed_at"),
        F.coalesce("_f.at", "_s.at").alias("at"), F.coalesce("_f.event_id", "_s.event_id").alias("event_id"), orphan.alias("orphan"))


def orphan_starts(events: DataFrame, keys: Sequence[str], now: Column, attempt: str = "attempt_id") -> DataFrame:
    """Starts without an end that are older than the orphan age."""
    return attempt_outcomes(events, keys, now, attempt).where("orphan").select(*keys, attempt, F.col("observed_at").alias("started_at"))


def latest_failure(outcomes: DataFrame, keys: Sequence[str], attempt: str = "attempt_id") -> DataFrame:
    """The latest failure of each key and the counts that place it in its schedule."""
    order = F.struct("observed_at", *ORDER)
    return outcomes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("failure_count"), F.count_if("structured").alias("source_failure_count"),
        F.max_by(F.struct("kind", "structured", "observed_at", F.col(attempt).alias("latest_attempt_id")), order).alias("_l")).select(
        *keys, "failure_count", "source_failure_count", "_l.*")


def retry_state(events: DataFrame, keys: Sequence[str] = KEYS, now: Column | None = None, attempt: str = "attempt_id") -> DataFrame:
    """Whether each key must wait, since when, and until when.

    The kind of the latest failure picks the schedule, and only failures of
    that kind advance it. Keys without a counted failure have no row.
    """
    now = times.utc_time(F.current_timestamp()) if now is None else now
    latest = latest_failure(attempt_outcomes(events, keys, now, attempt), keys, attempt)
    ordinary = F.col("failure_count") - F.col("source_failure_count")
    delay = times.backoff_hours(F.col("structured"), F.when(F.col("structured"), F.col("source_failure_count")).otherwise(ordinary))
    retry_at = F.col("observed_at") + F.make_dt_interval(secs=(delay * 3600).cast("decimal(18,6)"))
    return (latest.withColumn("delay_hours", delay).withColumn("retry_at", retry_at)
            .withColumn("remaining_seconds", F.greatest(F.lit(0), F.unix_timestamp(F.col("retry_at").cast("timestamp")) - F.unix_timestamp(now.cast("timestamp"))))
            .withColumn("should_defer", F.col("retry_at") > now))


def deferral(mode: Column, should_defer: Column, structured: Column) -> Column:
    """``struct<defer, cooldown_bypassed>``: repairs never wait, resumes with a receipt neither."""
    bypass = (mode == "source_resume") & F.coalesce(structured, F.lit(False))
    wait = F.coalesce(should_defer, F.lit(False))
    return F.struct(F.when((mode == "repair") | bypass, F.lit(False)).otherwise(wait).alias("defer"), (bypass & wait).alias("cooldown_bypassed"))


def latest_draft(drafts: DataFrame, keys: Sequence[str], order: Sequence[str] = ("at", "event_id")) -> DataFrame:
    """The last draft of each key in event order."""
    columns = [c for c in drafts.columns if c not in keys]
    return drafts.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_d")).select(*keys, "_d.*")


def repair_failures(events: DataFrame, keys: Sequence[str], attempt: str = "attempt_id") -> DataFrame:
    failed = events.where("stage = 'category_repair' and status = 'failed'")
    return failed.groupBy(*keys, attempt).agg(F.count(F.lit(1)).alias("_n")).groupBy(*keys).agg(F.count(F.lit(1)).alias("repair_failures"))


def next_action(jobs: DataFrame, complete: DataFrame, drafts: DataFrame, events: DataFrame, keys: Sequence[str] = KEYS,
                repair_limit: int = config.REPAIR_LIMIT) -> DataFrame:
    """reuse, resume, repair, regenerate or generate for every job and category.

    ``complete``: keys with a finished report. ``drafts``: keys, order columns
    and ``has_receipt``.
    """
    latest = latest_draft(drafts, keys).select(*keys, "has_receipt")
    state = (jobs.select(*keys).join(complete.select(*keys).distinct().withColumn("_done", F.lit(True)), list(keys), "left")
             .join(latest, list(keys), "left").join(repair_failures(events, keys), list(keys), "left"))
    action = (F.when(F.col("_done"), "reuse").when(F.col("has_receipt").isNull(), "generate").when(F.col("has_receipt"), "resume")
              .when(F.coalesce("repair_failures", F.lit(0)) >= repair_limit, "regenerate").otherwise("repair"))
    return state.select(*keys, action.alias("action"), F.coalesce("repair_failures", F.lit(0)).alias("repair_failures"))


def open_jobs(existing: DataFrame, requested: DataFrame, keys: Sequence[str] = JOB, run: str = "evaluationRunId", created: str = "createdAt",
              content: str = "snapshotSha256") -> tuple[DataFrame, DataFrame]:
    """One job per key with its first run id, and refused requests.

    A stored run id wins over a requested one. A request whose snapshot content
    differs under the same key is refused.
    """
    stored = existing.groupBy(*keys).agg(F.min_by(F.struct(run, created, content), created).alias("_s"))
    joined = requested.join(stored, list(keys), "left")
    refused = joined.where(F.col("_s").isNotNull() & (F.col(f"_s.{content}") != F.col(content))).select(*keys, run, content)
    first = requested.groupBy(*keys).agg(F.min_by(F.struct(run, created, content), F.struct(created, run)).alias("_s"))
    fresh = first.join(stored.select(*keys), list(keys), "left_anti")
    jobs = stored.withColumn("opened", F.lit(False)).unionByName(fresh.withColumn("opened", F.lit(True)))
    return jobs.select(*keys, "_s.*", "opened"), refused


def check_job(jobs: DataFrame, snapshots: DataFrame, events: DataFrame, keys: Sequence[str] = JOB) -> DataFrame:
    """Manifests against their snapshot and against the events of the job.

    ``jobs``: keys, evaluationRunId, snapshotSha256. ``snapshots``: reportDate,
    snapshotFingerprint, sha256.
    """
    held = jobs.join(snapshots.select("reportDate", "snapshotFingerprint", F.col("sha256").alias("_sha")), ["reportDate", "snapshotFingerprint"], "left")
    rows = find_issues(held, [
        Rule("snapshot", "missing", "snapshot is missing", F.col("_sha").isNotNull()),
        Rule("snapshotSha256", "digest", "snapshot digest changed", F.col("_sha") == F.col("snapshotSha256"), applies=F.col("_sha").isNotNull()),
        Rule("evaluationRunId", "value", "is not a safe id", F.col("evaluationRunId").rlike(config.SAFE_ID_PATTERN)),
    ], {"date": "reportDate", "id": "evaluationRunId"}, "job")
    runs = events.groupBy(*keys, "evaluationRunId").agg(F.count(F.lit(1)).alias("_n"))
    known = jobs.select(*keys, F.col("evaluationRunId").alias("_run")).groupBy(*keys).agg(F.min("_run").alias("_run"))
    judged = runs.join(known, list(keys), "left")
    return union_all([rows, find_issues(judged, [
        Rule("event", "unknown", "belongs to no job", F.col("_run").isNotNull()),
        Rule("event", "run", "does not use the job's run id", F.col("_run") == F.col("evaluationRunId"), applies=F.col("_run").isNotNull()),
    ], {"date": "reportDate", "id": "evaluationRunId", "position": "_n"}, "event")])


# Drafts and receipts -------------------------------------------------------------------------------------------

def check_receipt(receipts: DataFrame, announced: DataFrame, keys: Sequence[str] = ("report_date", "slug"), size: int = config.SHORTLIST_SIZE) -> DataFrame:
    """Candidate receipts against the announced ids of their category.

    ``receipts``: keys, arxivId, failureClass, provisionalCandidateIds.
    """
    totals = announced.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"))
    ids = F.col("provisionalCandidateIds")
    listed = receipts.select(*keys, "arxivId", F.explode("provisionalCandidateIds").alias("_id"))
    unknown = listed.join(announced.select(*keys, F.col("id").alias("_id")), [*keys, "_id"], "left_anti")
    issue_keys = {"date": keys[0], "slug": keys[1], "id": "arxivId"} if len(keys) == 2 else {"id": "arxivId"}
    rows = find_issues(receipts.join(totals, list(keys), "left"), [
        Rule("failureClass", "value", "is not a known failure class", F.col("failureClass").isin(config.MODEL_FAILURE, config.PROBE_FAILURE)),
        Rule("provisionalCandidateIds", "value", "must not contain duplicates", F.size(F.array_distinct(ids)) == F.size(ids)),
        Rule("provisionalCandidateIds", "value", f"must contain exactly min({size}, total) ids",
             F.size(ids) == F.least(F.lit(size), F.coalesce("_total", F.lit(0)))),
        Rule("arxivId", "value", "must be one of the candidates", F.array_contains(ids, F.col("arxivId"))),
    ], issue_keys, "receipt")
    return union_all([rows, as_issue(unknown, "unknown", F.concat(F.lit("candidate "), F.col("_id"), F.lit(" is not announced")),
                                     "provisionalCandidateIds", issue_keys, "receipt")])


def probe_failure(receipts: DataFrame, failed: DataFrame, keys: Sequence[str] = ("report_date", "slug")) -> tuple[DataFrame, DataFrame]:
    """Receipts for failed probes: only the failed id and the class change.

    A failed id that is not a candidate is returned as refused.
    """
    joined = failed.select(*keys, F.col("arxivId").alias("_failed")).join(receipts, list(keys))
    inside = F.array_contains("provisionalCandidateIds", F.col("_failed"))
    made = joined.where(inside).withColumn("arxivId", F.col("_failed")).withColumn("failureClass", F.lit(config.PROBE_FAILURE)).drop("_failed")
    return made, joined.where(~inside).select(*keys, F.col("_failed").alias("arxivId"))


def check_draft(papers: DataFrame, reports: DataFrame, listings: DataFrame, announced: DataFrame, exceptions: DataFrame,
                runs: DataFrame) -> DataFrame:
    """A draft belongs to its job and holds together.

    Version, submission type and URL may be absent; full text of the top list
    is optional. ``runs``: report_date, slug, run_id of the job.
    """
    filled = papers.withColumn("url", F.coalesce("url", R.abs_url("arxivId")))
    optional = [
        Rule("arxivVersion", "value", "must be v1", F.col("arxivVersion").isNull() | (F.col("arxivVersion") == "v1")),
        Rule("submissionType", "value", "must be new", F.col("submissionType").isNull() | (F.col("submissionType") == "new")),
        Rule("primaryCategory", "value", "must equal the category", F.col("primaryCategory") == F.col("slug")),
    ]
    keys = {"date": "report_date", "slug": "slug", "id": "arxivId", "position": "index"}
    rows = find_issues(filled, identity_rules() + optional + score_rules() + evidence_rules() + cap_rules(), keys)
    flags = papers.groupBy("report_date", "slug").agg(F.count_if("fullTextEvaluated").alias("_full"))
    limits = effective_limit(reports, exceptions).join(flags, ["report_date", "slug"], "left").join(
        runs.select("report_date", "slug", F.col("run_id").alias("_run")), ["report_date", "slug"], "left")
    shape = find_issues(limits, [
        Rule("evaluationRun.runId", "run", "does not match the job", F.col("evaluationRun.runId") == F.col("_run")),
        Rule("fullTextEvaluatedCount", "invariant", "does not match the flags", F.col("fullTextEvaluatedCount") == F.coalesce("_full", F.lit(0))),
        Rule("fullTextEvaluatedCount", "resource_budget", "is outside the allowed bounds", F.col("fullTextEvaluatedCount").between(0, F.col("full_text_limit"))),
    ], {"date": "report_date", "slug": "slug"}, "report")
    return union_all([rows, shape, check_rank(papers), reconcile_ids(papers, announced), reconcile_reports(reports, listings)])


def check_resume_draft(papers: DataFrame, receipts: DataFrame, candidate_order: bool = False, group: Sequence[str] = GROUP) -> DataFrame:
    """The failed paper keeps its abstract-only tuple; full text stays among the candidates.

    With ``candidate_order`` the candidates must be the initial top list in order.
    """
    held = receipts.select(*group, F.col("arxivId").alias("_failed"), F.col("provisionalCandidateIds").alias("_ids"))
    joined = papers.join(small_or_plain(held), list(group))
    target = F.col("arxivId") == F.col("_failed")
    bare = (~F.col("fullTextEvaluated") & (F.col("evaluationBasis") == config.ABSTRACT_BASIS) & F.col("fullTextReviewStatus").isNull()
            & (F.col("sourceUrls") == F.array(R.abs_url_v1("arxivId"))))
    keys = {"date": "report_date", "slug": "slug", "id": "arxivId"}
    rows = find_issues(joined, [
        Rule("fullTextEvaluated", "receipt", "must retain the abstract-only tuple", bare, applies=target),
        Rule("fullTextEvaluated", "candidate", "is full text but not a candidate", F.array_contains("_ids", F.col("arxivId")), applies=F.col("fullTextEvaluated")),
    ], keys)
    if not candidate_order:
        return rows
    top = top_rows(papers, group, paper_order(), config.SHORTLIST_SIZE, "_place")
    placed = F.transform(F.sort_array(F.collect_list(F.struct("_place", "arxivId"))), lambda p: p["arxivId"])
    lists = top.groupBy(*group).agg(placed.alias("_top")).join(held, list(group))
    return union_all([rows, find_issues(lists, [
        Rule("provisionalCandidateIds", "order", "must be the initial top list in order",
             F.slice("_top", F.lit(1), F.greatest(F.size("_ids"), F.lit(1))) == F.col("_ids"))], {"date": "report_date", "slug": "slug"}, "receipt")])


# Receipts and imports ------------------------------------------------------------------------------------------------

def repair_receipts(records: DataFrame, receipts: DataFrame, keys: Sequence[str], check: Callable[[DataFrame], Column] | None = None,
                    payload: str = "payload") -> DataFrame:
    """New receipts for records that lack one and pass ``check``."""
    incomplete = verify_receipts(records, receipts, keys, payload).where("receipt_state = 'incomplete'")
    if check is not None:
        incomplete = incomplete.where(F.coalesce(check(incomplete), F.lit(False)))
    return incomplete.select(*keys, F.sha2(F.col(payload), 256).alias("sha256"), F.octet_length(payload).cast("bigint").alias("bytes"))


def reduced_arrivals(records: DataFrame, keys: Sequence[str], checks: Sequence[Callable[[DataFrame], Column]] = (), payload: str = "payload") -> DataFrame:
    """One row per key: the record with the smallest digest (sha256), the largest digest (high) and whether all arrivals pass the checks (valid)."""
    passed = F.lit(True)
    for check in checks:
        passed = passed & F.coalesce(check(records), F.lit(False))
    columns = [c for c in records.columns if c not in keys]
    marked = records.withColumn("sha256", F.sha2(F.col(payload), 256)).withColumn("_ok", passed)
    return marked.groupBy(*keys).agg(
        F.min_by(F.struct(*columns), "sha256").alias("_r"), F.min("sha256").alias("sha256"), F.max("sha256").alias("high"), F.every("_ok").alias("valid"),
    ).select(*keys, *[F.col("_r")[c].alias(c) for c in columns], "sha256", "high", "valid")


def import_records(records: DataFrame, stored: DataFrame, keys: Sequence[str], checks: Sequence[Callable[[DataFrame], Column]] = (),
                   transform: Callable[[DataFrame], DataFrame] | None = None, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Records to add, and refused ones with a reason.

    ``transform`` normalises before anything is stored; each check is a boolean
    column. The same bytes again are accepted without effect, other bytes for
    a stored key are refused. ``stored``: keys and sha256.
    """
    given = records.transform(transform) if transform else records
    passed = F.lit(True)
    for check in checks:
        passed = passed & F.coalesce(check(given), F.lit(False))
    marked = given.withColumn("sha256", F.sha2(F.col(payload), 256)).withColumn("_ok", passed)
    # Several arrivals of one key are reduced to their distinct digests first.
    spread = marked.groupBy(*keys).agg(F.min("sha256").alias("_low"), F.max("sha256").alias("_high"), F.every("_ok").alias("_valid"))
    held = stored.groupBy(*keys).agg(F.min("sha256").alias("_held"))
    judged = spread.join(held, list(keys), "left").withColumn("reason", (
        F.when(~F.col("_valid"), "failed validation").when(F.col("_low") != F.col("_high"), "conflicting arrivals")
        .when(F.col("_held") != F.col("_low"), "differs from the stored record")))
    accepted = judged.where("reason is null and _held is null").select(*keys)
    fresh = marked.join(accepted, list(keys), "left_semi").drop("_ok").dropDuplicates(list(keys))
    return fresh, judged.where("reason is not null").select(*keys, "reason")
