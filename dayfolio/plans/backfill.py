"""Which announcement date to process next.

A window is one landed observation of the listing: about a week of dates, held
as one array. A request pairs a window with the date published last. Every
selection is an expression over one request row, so any number of requests is
decided in one pass and without a join.

Request columns: ``window`` (array<struct<date, complete, new_count, digest,
content_digest>>, newest first), ``head`` (struct<date, digest,
content_digest>), ``latest_date``, ``today`` and, for recovery, ``stored``
(struct<date, new_count, digest>).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from dayfolio import config
from dayfolio.functions import records as R, times
from dayfolio.operators.issues import Rule, as_issue, find_issues, union_all
from dayfolio.operators.ordering import with_position, with_previous
from dayfolio.operators.reconcile import walk_chain
from dayfolio.operators.skew import salted_join
from dayfolio.session import cut_lineage

MODES = ("normal", "checkpoint_recovery", "aged_checkpoint_recovery", "aged_window_continuation")
NOTHING, SELECTED = "nothing", "selected"


# Snapshots and windows ------------------------------------------------------------------------------

def build_snapshot(listings: DataFrame, ids: DataFrame, keys: Sequence[str] = (), categories: Sequence[str] = config.CATEGORIES) -> DataFrame:
    """One row per date: counts, both digests and why it cannot be used.

    ``listings``: keys, date, slug, source_url, new_count, crosslist_count,
    complete. ``ids``: keys, date, slug, id. Ids are hashed one by one and
    added up, so a date may hold any number of them.
    """
    on = [*keys, "date"]
    per_id = ids.groupBy(*on, "id").agg(F.count(F.lit(1)).alias("_n"))
    shared = per_id.groupBy(*on).agg(F.sum(F.when(F.col("_n") > 1, 1).otherwise(0)).alias("shared_ids"))
    measured = ids.groupBy(*on, "slug").agg(F.count(F.lit(1)).alias("_ids"), R.set_digest(F.col("id")).alias("_digest"))
    empty = F.sha2(F.lit("0/0/0/0/0"), 256)
    rows = (listings.join(measured, [*on, "slug"], "left").withColumn("_ids", F.coalesce("_ids", F.lit(0)))
            .withColumn("_digest", F.coalesce("_digest", empty)))
    content = [F.col(c) for c in ("slug", "new_count", "crosslist_count", "_digest")]
    dated = rows.groupBy(*on).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_distinct("slug").alias("_slugs"), F.sum("new_count").alias("new_count"),
        F.sum("crosslist_count").alias("crosslist_count"), F.every(F.col("complete")).alias("_complete"),
        F.every(F.col("_ids") == F.col("new_count")).alias("_counted"),
        R.set_digest(*content).alias("content_digest"), R.set_digest(F.col("source_url"), *content).alias("digest"))
    n = len(categories)
    problem = (F.when((F.col("_rows") != n) | (F.col("_slugs") != n), "needs each category once")
               .when(F.col("_complete") & ~F.col("_counted"), "counts differ from the ids")
               .when(F.coalesce("shared_ids", F.lit(0)) > 0, "an id appears more than once"))
    return (dated.join(shared, on, "left").withColumn("problem", problem)
            .withColumn("complete", F.col("_complete") & F.col("problem").isNull())
            .select(*on, "new_count", "crosslist_count", "complete", "content_digest", "digest", "problem"))


def build_window(snapshots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per observation with its dates newest first, and a reject.

    Only the oldest date may be incomplete. An observation is one landed page
    per category, so its dates fit an array.
    """
    date = F.struct("date", "complete", "new_count", "digest", "content_digest", "problem")
    windows = snapshots.groupBy(*keys).agg(F.sort_array(F.collect_list(date), asc=False).alias("window"))
    newer = F.slice("window", F.lit(1), F.size("window") - 1)
    reject = (F.when(F.exists("window", lambda d: d["problem"].isNotNull()), "a date has a problem")
              .when(F.exists(newer, lambda d: ~d["complete"]), "a newer date is partial"))
    bare = F.transform("window", lambda d: F.struct(d["date"].alias("date"), d["complete"].alias("complete"), d["new_count"].alias("new_count"),
                                                    d["digest"].alias("digest"), d["content_digest"].alias("content_digest")))
    return windows.withColumn("reject", reject).withColumn("window", bare)


def verify_head() -> Column:
    """The newest window date is the current listing, by content."""
    newest = F.get("window", F.lit(0))
    return F.coalesce((newest["date"] == F.col("head.date")) & newest["complete"]
                      & (newest["content_digest"] == F.col("head.content_digest")), F.lit(False))


# Selections --------------------------------------------------------------------------------------------

def classify_date(date: Column, latest: Column, today: Column) -> Column:
    """current, new, stale (older than published) or future."""
    return F.when(date > today, "future").when(date < latest, "stale").when(date == latest, "current").otherwise("new")


def _dates(entries: Column) -> Column:
    return F.transform(entries, lambda d: d["date"])


def _eligible(entries: Column) -> Column:
    return F.filter(entries, lambda d: d["complete"] & (d["new_count"] > 0))


def _selection(mode: str, status: Column, chosen: Column, pending: Column) -> Column:
    """``pending`` is a date array; both are empty unless a date is selected."""
    taken = status == SELECTED
    return F.struct(
        F.lit(mode).alias("mode"), status.alias("status"), F.when(taken, chosen["date"]).alias("target_date"),
        F.when(taken, chosen["digest"]).alias("target_digest"), F.when(taken, F.size(pending)).otherwise(0).alias("pending_count"),
        F.when(taken, F.sort_array(pending)).alias("pending_dates"))


def _gate(current_status: str) -> Column:
    """Shared first checks; null when the request may be decided."""
    kind = classify_date(F.col("head.date"), F.col("latest_date"), F.col("today"))
    return (F.when(kind == "future", "future").when(kind == "stale", "stale").when(kind == "current", current_status)
            .when(~verify_head(), "head mismatch"))


def select_backfill() -> Column:
    """The oldest unpublished date with papers, after the published one."""
    latest = F.col("latest_date")
    pending = F.filter("window", lambda d: d["date"] > latest)
    eligible = _eligible(pending)
    status = F.coalesce(
        _gate(NOTHING),
        F.when(~F.array_contains(_dates(F.col("window")), latest), "published date outside the window"),
        F.when(F.exists(pending, lambda d: ~d["complete"]), "a pending date is incomplete"),
        F.when(F.size(eligible) == 0, NOTHING), F.lit(SELECTED))
    return _selection("normal", status, F.get(eligible, F.size(eligible) - 1), _dates(eligible))


def select_recovery() -> Column:
    """A stored date: nothing skipped, unchanged, the oldest complete one."""
    latest, stored = F.col("latest_date"), F.col("stored")
    dates = _dates(F.col("window"))
    between = F.filter(dates, lambda d: (d > latest) & (d < stored["date"]))
    live = F.array_contains(dates, latest)
    fresh = F.get(F.filter("window", lambda d: (d["date"] == stored["date"]) & d["complete"]), F.lit(0))
    complete = F.filter("window", lambda d: d["complete"])
    eligible = F.filter(_eligible(F.col("window")), lambda d: d["date"] >= stored["date"])
    status = F.coalesce(
        _gate("already published"),
        F.when(~F.coalesce(stored["date"] > latest, F.lit(False)), "target is not newer"),
        F.when((F.size(between) > 0) | (~live & (times.next_weekday(latest) != stored["date"])), "target would skip a date"),
        F.when(fresh.isNull() | (fresh["digest"] != stored["digest"]), "target changed"),
        F.when(F.get(complete, F.size(complete) - 1)["date"] != stored["date"], "target is not the oldest complete date"),
        F.when(F.size(eligible) == 0, "no papers"), F.lit(SELECTED))
    return _selection("checkpoint_recovery", status, fresh, _dates(eligible))


def select_aged() -> Column:
    """A stored date one weekday before a fully complete window."""
    latest, stored = F.col("latest_date"), F.col("stored")
    oldest = F.get("window", F.size("window") - 1)["date"]
    newer = _eligible(F.col("window"))
    status = F.coalesce(
        _gate("already published"),
        F.when(~F.coalesce((stored["date"] > latest) & (times.next_weekday(latest) == stored["date"]), F.lit(False)), "target does not follow the published date"),
        F.when(F.exists("window", lambda d: ~d["complete"]) | (oldest <= stored["date"]) | (times.next_weekday(stored["date"]) != oldest),
               "window does not follow the target"),
        F.when(~(stored["new_count"] > 0), "no papers"), F.lit(SELECTED))
    return _selection("aged_checkpoint_recovery", status, stored, F.concat(F.array(stored["date"]), _dates(newer)))


def select_aged_next() -> Column:
    """The oldest date of a complete window that begins right after the anchor."""
    latest = F.col("latest_date")
    oldest = F.get("window", F.size("window") - 1)["date"]
    eligible = _eligible(F.col("window"))
    status = F.coalesce(
        _gate("already published"),
        F.when(F.exists("window", lambda d: ~d["complete"]) | (oldest <= latest) | (times.next_weekday(latest) != oldest), "window does not follow the anchor"),
        F.when(F.size(eligible) == 0, NOTHING), F.lit(SELECTED))
    return _selection("aged_window_continuation", status, F.get(eligible, F.size(eligible) - 1), _dates(eligible))


SELECTORS = {"normal": select_backfill, "checkpoint_recovery": select_recovery,
             "aged_checkpoint_recovery": select_aged, "aged_window_continuation": select_aged_next}


def selection_evidence(selection: Column) -> Column:
    """What a selection was based on; null unless a date was selected."""
    complete = F.filter("window", lambda d: d["complete"])
    return F.when(selection["status"] == SELECTED, F.struct(
        F.lit("1.0").alias("schemaVersion"), selection["mode"].alias("selectionMode"), F.col("latest_date").alias("expectedLatestDate"),
        selection["target_date"].alias("targetDate"), selection["target_digest"].alias("targetSnapshotFingerprint"),
        F.col("head.date").alias("officialHeadDate"), F.col("head.digest").alias("officialHeadFingerprint"),
        _dates(F.col("window")).alias("pastweekAnnouncementDates"), _dates(complete).alias("completeSnapshotDates")))


def select_authorized() -> Column:
    """Continues a stored authorisation; needs ``stored`` and ``evidence``."""
    latest, stored, proof = F.col("latest_date"), F.col("stored"), F.col("evidence")
    fresh = F.get(F.filter("window", lambda d: (d["date"] == stored["date"]) & d["complete"]), F.lit(0))
    newer = F.filter(_eligible(F.col("window")), lambda d: d["date"] > stored["date"])
    complete = F.filter("window", lambda d: d["complete"])
    same_head = F.col("head.date") == proof["officialHeadDate"]
    resumed = select_aged_next()
    aged_next = (proof["selectionMode"] == "aged_window_continuation") & same_head
    status = F.coalesce(
        F.when(~evidence_holds(proof), "evidence is invalid"),
        F.when((proof["expectedLatestDate"] != latest) | (proof["targetDate"] != stored["date"])
               | (proof["targetSnapshotFingerprint"] != stored["digest"]), "evidence does not match the authorisation"),
        _gate("already published"),
        F.when(~F.coalesce(stored["date"] > latest, F.lit(False)), "target is not newer"),
        F.when((F.col("head.date") < proof["officialHeadDate"]) | (F.col("head.date") < stored["date"]), "head moved back"),
        F.when(same_head & (F.col("head.digest") != proof["officialHeadFingerprint"]), "head changed"),
        F.when(aged_next & ((_dates(F.col("window")) != proof["pastweekAnnouncementDates"]) | (_dates(complete) != proof["completeSnapshotDates"])
                            | ~F.coalesce((resumed["target_date"] == stored["date"]) & (resumed["target_digest"] == stored["digest"]), F.lit(False))),
               "window changed"),
        F.when(fresh["digest"] != stored["digest"], "target changed"),
        F.when(fresh.isNull() & ((F.col("head.date") <= stored["date"]) | F.exists("window", lambda d: d["date"] <= stored["date"])),
               "target is absent but not aged out"),
        F.lit(SELECTED))
    pending = F.concat(F.array(stored["date"]), _dates(newer))
    return F.struct(*[_selection("authorized", status, stored, pending)[f].alias(f) for f in
                      ("mode", "status", "target_date", "target_digest", "pending_count", "pending_dates")],
                    F.when(status == SELECTED, fresh.isNotNull()).alias("still_live"))


def revalidate() -> Column:
    """The stored date is still complete and unchanged: unchanged, changed or gone."""
    stored = F.col("stored")
    fresh = F.get(F.filter("window", lambda d: (d["date"] == stored["date"]) & d["complete"]), F.lit(0))
    return F.when(fresh.isNull(), "gone").when(fresh["digest"] == stored["digest"], "unchanged").otherwise("changed")


# Evidence, plans and queues ---------------------------------------------------------------------------------

def _newest_first(dates: Column) -> Column:
    return (F.size(dates) > 0) & (F.size(F.array_distinct(dates)) == F.size(dates)) & (F.sort_array(dates, asc=False) == dates) \
        & F.forall(dates, lambda d: d.isNotNull())


def evidence_rules(e: Column) -> list[Rule]:
    """Requirements on an evidence struct, including those of its mode."""
    mode, anchor, target = e["selectionMode"], e["expectedLatestDate"], e["targetDate"]
    dates, complete = e["pastweekAnnouncementDates"], e["completeSnapshotDates"]
    oldest = F.get(complete, F.size(complete) - 1)
    listed = F.array_contains(dates, target) & F.array_contains(complete, target)
    between = F.filter(dates, lambda d: (d > anchor) & (d < target))
    digests = e["targetSnapshotFingerprint"].rlike(config.SHA256_PATTERN) & e["officialHeadFingerprint"].rlike(config.SHA256_PATTERN)
    aged = (complete == dates) & ~F.array_contains(dates, target) & F.forall(dates, lambda d: d > target) \
        & (times.next_weekday(anchor) == target) & (times.next_weekday(target) == oldest)
    follows = (complete == dates) & listed & F.forall(dates, lambda d: d > anchor) & (times.next_weekday(anchor) == oldest)
    return [
        Rule("evidence.schemaVersion", "value", "must be 1.0", e["schemaVersion"] == "1.0"),
        Rule("evidence.selectionMode", "value", "is not a known mode", mode.isin(*MODES)),
        Rule("evidence", "value", "needs its three dates", anchor.isNotNull() & target.isNotNull() & e["officialHeadDate"].isNotNull()),
        Rule("evidence", "value", "digests must be lower-case SHA-256", digests),
        Rule("evidence.pastweekAnnouncementDates", "order", "must be unique and newest first", _newest_first(dates)),
        Rule("evidence.completeSnapshotDates", "order", "must be unique and newest first", _newest_first(complete)),
        Rule("evidence.officialHeadDate", "invariant", "must be the newest date and not before the target",
             (F.get(dates, F.lit(0)) == e["officialHeadDate"]) & (e["officialHeadDate"] >= target)),
        Rule("evidence", "mode", "must bridge two weekday boundaries into a complete window", aged, applies=mode == "aged_checkpoint_recovery"),
        Rule("evidence", "mode", "must begin right after its anchor", follows, applies=mode == "aged_window_continuation"),
        Rule("evidence", "mode", "target must be a listed complete date", listed, applies=mode.isin("normal", "checkpoint_recovery")),
        Rule("evidence", "mode", "must include its anchor", F.array_contains(dates, anchor), applies=mode == "normal"),
        Rule("evidence", "mode", "may not skip a listed date",
             (F.size(between) == 0) & (F.array_contains(dates, anchor) | (times.next_weekday(anchor) == target)), applies=mode == "checkpoint_recovery"),
    ]


def evidence_holds(e: Column) -> Column:
    holds = F.lit(True)
    for rule in evidence_rules(e):
        good = F.coalesce(rule.holds, F.lit(False))
        holds = holds & (good if rule.applies is None else good | ~F.coalesce(rule.applies, F.lit(False)))
    return holds


def check_selection_evidence(df: DataFrame, evidence: str = "evidence", keys: Mapping[str, str] | None = None) -> DataFrame:
    return find_issues(df, evidence_rules(F.col(evidence)), keys or {}, "evidence")


def check_chain(entries: DataFrame, keys: Sequence[str], position: str = "position", anchor: str = "anchor", target: str = "target",
                issue_keys: Mapping[str, str] | None = None) -> DataFrame:
    """Each anchor is the previous target, and targets move forward."""
    issue_keys = issue_keys or {"id": keys[0], "position": position} if keys else {"position": position}
    narrow = entries.select(*dict.fromkeys([*keys, position, anchor, target, *issue_keys.values()]))
    stepped = with_previous(narrow, keys, [position], {"_before": target})
    first = F.col("_before").isNull()
    return find_issues(stepped, [
        Rule(anchor, "chain", "must be the previous target", F.col(anchor) == F.col("_before"), applies=~first),
        Rule(target, "chain", "must be newer than its anchor", F.col(target) > F.col(anchor)),
    ], issue_keys, "entry")


def position_mode(position: Column) -> Column:
    """Mode of the n-th (0-based) entry of a recovery plan."""
    return F.when(position == 0, "aged_checkpoint_recovery").when(position == 1, "aged_window_continuation").otherwise("normal")


def check_plan(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entries of recovery plans: modes, chain, one shared window, both bridges.

    Columns: keys, position (0-based), mode, anchor, target, digest, new_count,
    evidence.
    """
    issue_keys = {"id": keys[0], "position": "position"}
    e = F.col("evidence")
    dates = e["pastweekAnnouncementDates"]
    oldest = F.get(e["completeSnapshotDates"], F.size(e["completeSnapshotDates"]) - 1)
    head, second = F.col("position") == 0, F.col("position") == 1
    rows = find_issues(entries, [
        Rule("mode", "value", "does not fit the position", F.col("mode") == position_mode(F.col("position"))),
        Rule("target", "value", "may not be an empty date", F.col("new_count") > 0),
        Rule("evidence", "invariant", "does not match its entry",
             (e["selectionMode"] == F.col("mode")) & (e["expectedLatestDate"] == F.col("anchor")) & (e["targetDate"] == F.col("target"))
             & (e["targetSnapshotFingerprint"] == F.col("digest")) & (e["completeSnapshotDates"] == dates)
             & (F.get(dates, F.lit(0)) == e["officialHeadDate"])),
        Rule("target", "bridge", "must bridge two weekday boundaries",
             F.forall(dates, lambda d: d > F.col("target")) & (times.next_weekday(F.col("anchor")) == F.col("target"))
             & (times.next_weekday(F.col("target")) == oldest), applies=head),
        Rule("target", "window", "must lie in the window", F.array_contains(dates, F.col("target")), applies=~head),
        Rule("anchor", "window", "must lie in the window", F.array_contains(dates, F.col("anchor")), applies=~head & ~second),
    ], issue_keys, "entry")
    shared = R.row_lanes(F.to_json(F.struct(e["officialHeadDate"], e["officialHeadFingerprint"], dates, e["completeSnapshotDates"])))
    lanes = [f"_shared{i}" for i in range(len(shared))]
    # Windows leave here as numbers: plans are compared, and chains followed, without sorting a window per entry.
    narrow = cut_lineage(entries.select(*keys, "position", "anchor", "target", *[lane.cast("bigint").alias(name) for lane, name in zip(shared, lanes)]))
    differs = [F.min(name) != F.max(name) for name in lanes]
    mixed = narrow.groupBy(*keys).agg(reduce(or_, differs).alias("mixed")).where("mixed")
    return union_all([rows, check_chain(narrow, keys, issue_keys=issue_keys),
                      as_issue(mixed, "window", "entries must share one window", "entries", {"id": keys[0]}, "plan")])


def plan_entries(pending: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pending dates as chained entries: position, mode, anchor, target.

    ``pending``: keys, date, digest. ``latest``: keys, latest_date.
    """
    placed = with_position(pending, keys, ["date"], "_place")
    chained = with_previous(placed, keys, ["date"], {"_before": "date"})
    joined = chained.join(latest, list(keys), "left")
    position = (F.col("_place") - 1).cast("int")
    return joined.select(*keys, position.alias("position"), position_mode(position).alias("mode"),
                         F.coalesce("_before", "latest_date").alias("anchor"), F.col("date").alias("target"), "digest")


def pending_dates(dates: DataFrame, latest: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """Dates newer than the published one, numbered from the oldest."""
    newer = dates.join(latest, list(keys)).where(F.col(date) > F.col("latest_date")).drop("latest_date")
    return with_position(newer, keys, [date], "position")


def next_date(pending: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """Only the oldest pending date: one per run."""
    return pending.groupBy(*keys).agg(F.min(date).alias("next_date"))


def active_record(records: DataFrame, latest: DataFrame, keys: Sequence[str], anchor: str = "anchor") -> tuple[DataFrame, DataFrame]:
    """The record whose anchor is the published date, and anchors used twice."""
    repeated = records.groupBy(*keys, anchor).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    active = records.join(latest, list(keys)).where(F.col(anchor) == F.col("latest_date")).drop("latest_date")
    return active, repeated


def continuation_queue(pending: DataFrame, authorisations: DataFrame, latest: DataFrame, windows: DataFrame, keys: Sequence[str],
                       mode: str = "normal") -> DataFrame:
    """The ordered targets to work through, per key.

    Stored authorisations come first, in chain order; newer pending dates extend
    the chain when it is empty or its end is still listed. ``problem`` names
    the first broken requirement of a row. ``windows``: keys and listed dates.
    """
    starts = latest.select(*keys, F.col("latest_date").alias("anchor"))
    chain = walk_chain(authorisations, starts, keys)
    steps = (chain.where("step > 0").select(*keys, F.col("node").alias("date"), "step", "cycle")
             .join(authorisations.select(*keys, F.col("target").alias("date"), F.col("digest").alias("chain_digest")), [*keys, "date"]))
    ends = chain.groupBy(*keys).agg(F.max_by("node", "step").alias("end"), F.max("step").alias("length"), F.max("cycle").alias("cycle"))
    listed = ends.join(windows.select(*keys, F.col("date").alias("end"), F.lit(True).alias("end_listed")).distinct(), [*keys, "end"], "left")
    rows = salted_join(steps.drop("cycle").join(pending, [*keys, "date"], "full_outer"), listed, list(keys))
    extends = (F.col("length") == 0) | F.coalesce("end_listed", F.lit(False))
    late = F.col("date") > F.col("end")
    problem = (F.when(F.col("cycle"), "the chain has a cycle")
               .when(F.col("step").isNull() & ~late, "a pending date is not in the chain")
               .when(F.col("step").isNotNull() & F.col("digest").isNotNull() & (F.col("digest") != F.col("chain_digest")), "live and queued content differ"))
    kept = rows.withColumn("problem", problem).where(F.col("step").isNotNull() | F.col("problem").isNotNull() | extends)
    ordered = with_previous(with_position(kept, keys, ["date"], "_p"), keys, ["date"], {"_before": "date"})
    position = (F.col("_p") - 1).cast("int")
    later = F.when((F.lit(mode) == "aged_checkpoint_recovery") & (position == 1), "aged_window_continuation").otherwise("normal")
    return salted_join(ordered, latest, list(keys), "inner").select(
        *keys, position.alias("position"), F.when(position == 0, mode).otherwise(later).alias("mode"),
        F.coalesce("_before", "latest_date").alias("anchor"), F.col("date").alias("target"),
        F.coalesce("chain_digest", "digest").alias("digest"), F.col("step").isNotNull().alias("authorised"), "problem")
