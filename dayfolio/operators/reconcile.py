"""Bringing two sides together: binding, verification, receipts, chains.

Comparisons of two sides use one grouped pass over both (``pair_up``). Repeated
keys show up as counts instead of multiplying in a join, and partial
aggregation keeps a hot key from moving as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from dayfolio import config, schemas
from dayfolio.functions import records as R, text as X
from dayfolio.operators.checks import PAPER_ISSUE_KEYS
from dayfolio.operators.issues import Rule, as_issue, find_issues, union_all
from dayfolio.operators.skew import BROADCAST_BYTES, attach_row, is_small, salted_join
from dayfolio.session import cut_lineage, write_columns

PAPER_KEYS = ("report_date", "slug", "arxivId")


def pair_up(left: DataFrame, right: DataFrame, keys: Sequence[str], left_columns: Sequence[str],
            right_columns: Sequence[str]) -> DataFrame:
    """Per key: structs ``l`` and ``r`` and the row counts of both sides.

    A key that is repeated on a side gets that side's smallest struct.
    """
    empty_l = F.lit(None).cast(left.select(F.struct(*left_columns).alias("s")).schema["s"].dataType)
    empty_r = F.lit(None).cast(right.select(F.struct(*right_columns).alias("s")).schema["s"].dataType)
    both = left.select(*keys, F.struct(*left_columns).alias("l"), empty_r.alias("r"), F.lit(1).alias("ln"), F.lit(0).alias("rn")).union(
        right.select(*keys, empty_l.alias("l"), F.struct(*right_columns).alias("r"), F.lit(0).alias("ln"), F.lit(1).alias("rn")))
    return both.groupBy(*keys).agg(F.min("l").alias("l"), F.min("r").alias("r"),
                                   F.sum("ln").alias("left_rows"), F.sum("rn").alias("right_rows"))


def _presence_rules(left: str, right: str) -> list[Rule]:
    return [
        Rule("arxivId", "missing", f"occurs in {right} but not in {left}", F.col("left_rows") > 0),
        Rule("arxivId", "unknown", f"occurs in {left} but not in {right}", F.col("right_rows") > 0),
        Rule("arxivId", "duplicate", f"is repeated in {left}", F.col("left_rows") <= 1),
        Rule("arxivId", "duplicate", f"is repeated in {right}", F.col("right_rows") <= 1),
    ]


def bind_metadata(papers: DataFrame, metadata: DataFrame, fields: Sequence[str] = schemas.BIBLIOGRAPHIC,
                  keys: Sequence[str] = PAPER_KEYS) -> tuple[DataFrame, DataFrame]:
    """Papers with canonical bibliographic columns, and the mismatches.

    ``corrected_fields`` counts the values a paper had wrong. Papers without
    metadata keep their own values and are reported.
    """
    canonical = metadata.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_m"))
    joined = papers.join(canonical, list(keys), "left")
    changed = sum((F.when(F.col("_m").isNotNull() & ~F.col(f).eqNullSafe(F.col(f"_m.{f}")), 1).otherwise(0) for f in fields), F.lit(0))
    bound = joined.withColumn("corrected_fields", changed)
    for field in fields:
        bound = bound.withColumn(field, F.when(F.col("_m").isNotNull(), F.col(f"_m.{field}")).otherwise(F.col(field)))
    pairs = pair_up(papers, metadata, keys, [keys[-1]], [keys[-1]])
    issues = find_issues(pairs, _presence_rules("the report", "the metadata"),
                         {"date": keys[0], "slug": keys[1], "id": keys[2]} if len(keys) == 3 else {"id": keys[-1]})
    return bound.drop("_m"), issues


def binding_summary(bound: DataFrame, before: DataFrame, group: Sequence[str] = ("report_date", "slug"),
                    fields: Sequence[str] = schemas.BIBLIOGRAPHIC, paper_id: str = "arxivId") -> DataFrame:
    """Corrected values per group, and digests of the rows before and after."""
    columns = [paper_id, *fields]
    old = before.groupBy(*group).agg(R.set_digest(R.canonical_json(before, columns)).alias("digest_before"))
    new = bound.groupBy(*group).agg(F.sum("corrected_fields").alias("corrected_fields"),
                                    R.set_digest(R.canonical_json(bound, columns)).alias("digest_after"))
    return old.join(new, list(group))


def verify_metadata(papers: DataFrame, metadata: DataFrame, fields: Sequence[str] = schemas.BIBLIOGRAPHIC,
                    keys: Sequence[str] = PAPER_KEYS) -> DataFrame:
    """Papers whose bibliographic columns are not exactly the canonical ones."""
    pairs = pair_up(papers, metadata, keys, list(fields), list(fields))
    both = (F.col("left_rows") > 0) & (F.col("right_rows") > 0)
    rules = _presence_rules("the report", "the metadata") + [
        Rule(f, "mismatch", "does not exactly match the canonical metadata", F.col(f"l.{f}").eqNullSafe(F.col(f"r.{f}")), applies=both)
        for f in fields]
    return find_issues(pairs, rules, {"date": keys[0], "slug": keys[1], "id": keys[2]} if len(keys) == 3 else {"id": keys[-1]})


def reconcile_ids(papers: DataFrame, announced: DataFrame, keys: Sequence[str] = PAPER_KEYS) -> DataFrame:
    """Report ids against announced ids, both ways, with repeats."""
    pairs = pair_up(papers, announced, keys, [keys[-1]], [keys[-1]])
    return find_issues(pairs, _presence_rules("the report", "the announcement"),
                       {"date": keys[0], "slug": keys[1], "id": keys[2]} if len(keys) == 3 else {"id": keys[-1]})


def reconcile_reports(reports: DataFrame, listings: DataFrame) -> DataFrame:
    """Counts, address and date of each report against its listing."""
    pairs = pair_up(reports, listings, ["report_date", "slug"],
                    ["totalNew", "evaluatedCount", "crosslistsExcluded", "audit"], ["newCount", "crosslistCount", "sourceUrl"])
    both = (F.col("left_rows") > 0) & (F.col("right_rows") > 0)
    counts = lambda name: F.col(f"l.audit.sourceCounts.{name}")
    checks = [
        ("totalNew", F.col("l.totalNew"), F.col("r.newCount")), ("evaluatedCount", F.col("l.evaluatedCount"), F.col("r.newCount")),
        ("crosslistsExcluded", F.col("l.crosslistsExcluded"), F.col("r.crosslistCount")),
        ("audit.listingUrl", F.col("l.audit.listingUrl"), F.col("r.sourceUrl")),
        ("audit.announcementDate", F.col("l.audit.announcementDate"), F.col("report_date").cast("string")),
        ("audit.sourceCounts.newPrimary", counts("newPrimary"), F.col("r.newCount")),
        ("audit.sourceCounts.crosslistsExcluded", counts("crosslistsExcluded"), F.col("r.crosslistCount")),
        ("audit.sourceCounts.titleAuthorAbstractEvaluated", counts("titleAuthorAbstractEvaluated"), F.col("r.newCount")),
    ]
    rules = [Rule("report", "missing", "has no report", F.col("left_rows") > 0), Rule("report", "unknown", "has no listing", F.col("right_rows") > 0)]
    rules += [Rule(p, "mismatch", F.concat(F.lit("must equal "), want.cast("string")), have.eqNullSafe(want), applies=both) for p, have, want in checks]
    return find_issues(pairs, rules, {"date": "report_date", "slug": "slug"}, "report")


def _author_badges(badges: dict[tuple[str, str], dict], label: str):
    """For an array of names and a category: the badge of each name that is known there, in the names' order."""
    @F.pandas_udf(T._parse_datatype_string(f"array<{schemas.BADGE}>"))
    def found(names: pd.Series, tags: pd.Series) -> pd.Series:
        keys = X.AuthorKeys()

        def each(listed, tag):
            hits = ((n, badges.get((keys[n], tag))) for n in (listed if listed is not None else ()) if n is not None)
            return [{"authorName": n, "label": label, **known} for n, known in hits if known is not None]

        return pd.Series([each(*row) for row in zip(names, tags, strict=True)], dtype=object)

    return found


def match_authors(papers: DataFrame, registry: DataFrame, keys: Sequence[str] = PAPER_KEYS, authors: str = "authors",
                  slug: str = "slug", label: str = "著名著者", name: str = "eminentAuthors", registry_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Adds the badges of authors the registry knows for the paper's category.

    Names are compared without accents, case and punctuation. The first
    registry entry that fits wins, and badges keep the author order.
    ``registry`` needs a column ``entry`` with each row's place.

    Papers are looked up where they are: a registry whose bytes are few goes to
    the tasks as a dictionary, each distinct name is normalised once, and no
    paper moves. A larger one is joined by name, with a number for each row of
    ``papers``, so a paper that is listed twice is two papers either way.
    """
    names = F.concat(F.array("canonicalName"), F.coalesce("aliases", F.array().cast("array<string>")))
    why = F.struct(F.col("distinction").alias("reason"), "identityEvidence", F.col("officialUrls").alias("evidenceUrls"))
    entries = registry.select("entry", names.alias("_names"), "fieldTags", why.alias("_why"))
    badge = lambda author, known: F.struct(
        author.alias("authorName"), F.lit(label).alias("label"), known["reason"].alias("reason"), known["identityEvidence"].alias("identityEvidence"), known["evidenceUrls"].alias("evidenceUrls"))
    if is_small(entries, registry_bytes):
        keyed, badges = X.AuthorKeys(), {}
        for row in sorted(entries.collect(), key=lambda r: r["entry"]):  # their bytes were summed above
            for who in row["_names"]:
                for tag in row["fieldTags"] or ():
                    if who is not None:
                        badges.setdefault((keyed[who], tag), row["_why"].asDict())
        return papers.withColumn(name, _author_badges(badges, label)(F.col(authors), F.col(slug)))
    known = (entries.select(F.explode(X.author_keys("_names")).alias("_name"), "entry", F.explode("fieldTags").alias("_tag"), "_why")
             .groupBy("_name", "_tag").agg(F.min_by("_why", "entry").alias("_why")))
    numbered = write_columns(papers.withColumn("_paper", F.monotonically_increasing_id()))
    listed = numbered.select("_paper", F.col(slug).alias("_tag"), F.posexplode(F.arrays_zip(
        F.col(authors).alias("author"), X.author_keys(authors).alias("key"))).alias("_place", "_a")).withColumn("_name", F.col("_a.key"))
    hits = listed.join(known, ["_name", "_tag"]).groupBy("_paper").agg(F.sort_array(F.collect_list(F.struct(
        "_place", badge(F.col("_a.author"), F.col("_why")).alias("badge")))).alias("_hits"))
    badges = F.transform("_hits", lambda h: h["badge"])
    return numbered.join(hits, "_paper", "left").withColumn(name, F.coalesce(badges, F.array().cast(f"array<{schemas.BADGE}>"))).drop("_hits", "_paper")


def registry_issues(registry: DataFrame, categories: Sequence[str] = config.CATEGORIES) -> DataFrame:
    """Entry checks plus identities that several names share."""
    from dayfolio.functions import times

    rows = find_issues(registry, [
        Rule("canonicalName", "value", "must be a non-empty string", ~X.is_blank("canonicalName")),
        Rule("aliases", "value", "must be an array of non-empty strings", F.forall("aliases", lambda a: ~X.is_blank(a))),
        Rule("fieldTags", "value", "must contain only known categories",
             (F.size("fieldTags") > 0) & (F.size(F.array_except("fieldTags", F.array(*[F.lit(c) for c in categories]))) == 0)),
        Rule("distinction", "value", "must be a non-empty string", ~X.is_blank("distinction")),
        Rule("identityEvidence", "value", "must be a non-empty string", ~X.is_blank("identityEvidence")),
        Rule("officialUrls", "value", "must contain official HTTPS sources",
             (F.size("officialUrls") > 0) & F.forall("officialUrls", lambda u: u.startswith("https://"))),
        Rule("lastVerified", "value", "must be a real date", times.parse_date("lastVerified").isNotNull()),
    ], {"id": "canonicalName", "position": "entry"}, "registry")
    names = F.concat(F.array("canonicalName"), F.coalesce("aliases", F.array().cast("array<string>")))
    keys = registry.select(F.explode(X.author_keys(names)).alias("key"))
    repeated = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return union_all([rows, as_issue(repeated, "duplicate", F.concat(F.lit("duplicate registry identity "), F.col("key")), "authors", {}, "registry")])


def reconcile_authors(df: DataFrame, citation: str, visible: str, name: str = "authors") -> DataFrame:
    """Visible names when every one is a rendering of the citation name.

    A pair agrees when both have the same name tokens, or when moving the part
    before the only comma to the end rebuilds the visible name letter by letter.
    Otherwise the citation list is kept.
    """
    prepared = df.withColumn("_c", X.nfc_list(citation)).withColumn("_v", X.nfc_list(visible))

    def agrees(c: Column, v: Column) -> Column:
        parts = F.split(c, ",")
        head, tail = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
        rotated = (F.size(parts) == 2) & ~X.is_blank(head) & ~X.is_blank(tail)
        moved = X._compact(F.concat(tail, F.lit(" "), head))
        tokens = X._signature(c)
        return ((tokens == X._signature(v)) & (tokens != "")) | (rotated & (moved == X._compact(v)))

    same = (F.size("_c") == F.size("_v")) & F.forall(F.zip_with("_c", "_v", agrees), lambda ok: F.coalesce(ok, F.lit(False)))
    return prepared.withColumn(name, F.when(F.coalesce(same, F.lit(False)), F.col("_v")).otherwise(F.col("_c"))).drop("_c", "_v")


def verify_receipts(records: DataFrame, receipts: DataFrame, keys: Sequence[str], payload: str = "payload") -> DataFrame:
    """Adds ``receipt_state``: verified, changed or incomplete (no receipt).

    The payload is hashed where it is read; only digest and size are compared.
    """
    measured = records.withColumn("_sha", F.sha2(F.col(payload), 256)).withColumn("_bytes", F.octet_length(payload))
    held = receipts.select(*keys, F.col("sha256").alias("_rsha"), F.col("bytes").alias("_rbytes"))
    joined = measured.join(held, list(keys), "left")
    state = (F.when(F.col("_rsha").isNull(), "incomplete")
             .when((F.col("_sha") == F.col("_rsha")) & (F.col("_bytes") == F.col("_rbytes")), "verified").otherwise("changed"))
    return joined.withColumn("receipt_state", state).drop("_sha", "_bytes", "_rsha", "_rbytes")


def orphan_dates(reports: DataFrame, editions: DataFrame, date: str = "report_date", slug: str = "slug",
                 categories: Sequence[str] = config.CATEGORIES) -> DataFrame:
    """Reports without an edition, and editions without all their reports."""
    have = reports.groupBy(date).agg(F.count_distinct(slug).alias("_n"))
    dates = editions.select(date).distinct()
    left = have.join(dates, date, "left_anti").select(date, F.lit("reports have no edition").alias("problem"))
    right = dates.join(have.where(F.col("_n") == len(categories)), date, "left_anti").select(
        date, F.lit("edition lacks its reports").alias("problem"))
    return left.unionByName(right)


def protected_projection(df: DataFrame, columns: Sequence[str] = schemas.PROTECTED_PAPER) -> Column:
    """Canonical JSON of the columns a repair may not change."""
    return R.canonical_json(df, columns)


def verify_repair(before: DataFrame, after: DataFrame, keys: Sequence[str] = PAPER_KEYS,
                  columns: Sequence[str] = schemas.PROTECTED_PAPER) -> DataFrame:
    """Rows whose protected columns a repair changed, added or dropped."""
    ours = before.withColumn("_d", F.sha2(protected_projection(before, columns), 256))
    theirs = after.withColumn("_d", F.sha2(protected_projection(after, columns), 256))
    pairs = pair_up(ours, theirs, keys, ["_d"], ["_d"])
    return find_issues(pairs, [
        Rule("paper", "missing", "was dropped by the repair", F.col("right_rows") > 0),
        Rule("paper", "unknown", "was added by the repair", F.col("left_rows") > 0),
        Rule("paper", "duplicate", "is repeated", (F.col("left_rows") <= 1) & (F.col("right_rows") <= 1)),
        Rule("paper", "protected", "changed a protected column", F.col("l._d") == F.col("r._d"),
             applies=(F.col("left_rows") > 0) & (F.col("right_rows") > 0)),
    ], {"date": keys[0], "slug": keys[1], "id": keys[2]} if len(keys) == 3 else {"id": keys[-1]})


def verify_resume(before: DataFrame, after: DataFrame, candidates: DataFrame, keys: Sequence[str] = PAPER_KEYS,
                  require_complete: bool = True) -> DataFrame:
    """Candidates keep their identity; all other papers keep their scores too.

    Full-text papers must be candidates; with ``require_complete`` every
    candidate must be one.
    """
    def sided(df: DataFrame) -> DataFrame:
        return df.select(*keys, F.sha2(R.canonical_json(df, schemas.CANDIDATE_PAPER), 256).alias("identity"),
                         F.sha2(R.canonical_json(df, schemas.OTHER_PAPER), 256).alias("whole"),
                         F.col("fullTextEvaluated").alias("full_text"))

    pairs = pair_up(sided(before), sided(after), keys, ["identity", "whole"], ["identity", "whole", "full_text"])
    marked = pairs.join(candidates.select(*keys).distinct().withColumn("_c", F.lit(True)), list(keys), "left")
    candidate = F.coalesce("_c", F.lit(False))
    both = (F.col("left_rows") > 0) & (F.col("right_rows") > 0)
    return find_issues(marked, [
        Rule("paper", "ids", "the id set changed", both & (F.col("left_rows") == 1) & (F.col("right_rows") == 1)),
        Rule("paper", "protected", "changed the identity of a candidate", F.col("l.identity") == F.col("r.identity"), applies=both & candidate),
        Rule("paper", "protected", "changed a paper that is not a candidate", F.col("l.whole") == F.col("r.whole"), applies=both & ~candidate),
        Rule("fullTextEvaluated", "candidate", "is full text but not a candidate", candidate, applies=F.col("r.full_text")),
        Rule("fullTextEvaluated", "candidate", "candidate lacks full-text review", F.col("r.full_text"),
             applies=candidate & F.lit(require_complete)),
    ], {"date": keys[0], "slug": keys[1], "id": keys[2]} if len(keys) == 3 else {"id": keys[-1]})


def walk_chain(edges: DataFrame, starts: DataFrame, keys: Sequence[str], anchor: str = "anchor", target: str = "target") -> DataFrame:
    """All nodes reachable from each start by following anchor -> target.

    Returns keys, ``node``, ``step`` (0 is the start) and ``cycle``. The number
    of rounds is the logarithm of the longest chain: each round doubles the
    length of the known jumps, and is written to the shared folder before the
    next one reads it. Anchors must be unique within the keys.
    """
    total = edges.count()
    jumps = cut_lineage(edges.select(*keys, F.col(anchor).alias("node"), F.col(target).alias("next")))
    reached = cut_lineage(starts.select(*keys, F.col(anchor).alias("node"), F.lit(0).cast("bigint").alias("step")))
    length, known = 1, reached.count()
    while length <= 2 * max(total, 1):
        farther = reached.join(jumps, [*keys, "node"]).select(*keys, F.col("next").alias("node"), (F.col("step") + length).alias("step"))
        merged = cut_lineage(reached.unionByName(farther).groupBy(*keys, "node").agg(F.min("step").alias("step")))
        size = merged.count()
        if size == known:
            break
        reached, known = merged, size
        ahead = jumps.select(*keys, F.col("node").alias("next"), F.col("next").alias("_after"))
        jumps = cut_lineage(jumps.join(ahead, [*keys, "next"]).select(*keys, "node", F.col("_after").alias("next")))
        length *= 2
    # A chain has one node fewer among the targets than it has nodes; a cycle
    # is a reached node whose target was reached at an earlier or equal step.
    back = (edges.select(*keys, F.col(anchor).alias("node"), F.col(target).alias("_t"))
            .join(reached, [*keys, "node"])
            .join(reached.select(*keys, F.col("node").alias("_t"), F.col("step").alias("_ts")), [*keys, "_t"])
            .where("_ts <= step").select(*keys).distinct().withColumn("_cycle", F.lit(True)))
    return salted_join(reached, back, list(keys)).withColumn("cycle", F.coalesce("_cycle", F.lit(False))).drop("_cycle") if keys else \
        reached.withColumn("cycle", F.lit(not back.isEmpty()))


def compare_records(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key: same, changed, left_only, right_only or repeated."""
    ours = left.withColumn("_d", F.sha2(R.canonical_json(left, columns), 256))
    theirs = right.withColumn("_d", F.sha2(R.canonical_json(right, columns), 256))
    pairs = pair_up(ours, theirs, keys, ["_d"], ["_d"])
    state = (F.when((F.col("left_rows") > 1) | (F.col("right_rows") > 1), "repeated").when(F.col("right_rows") == 0, "left_only")
             .when(F.col("left_rows") == 0, "right_only").when(F.col("l._d") == F.col("r._d"), "same").otherwise("changed"))
    return pairs.select(*keys, state.alias("state"))


def verify_plan(plan: DataFrame, queue: DataFrame, columns: Sequence[str], anchor: str = "anchor") -> DataFrame:
    """A plan's entries against the queue, by anchor date.

    Queue entries past the plan's end are extensions when they continue the
    chain; any other entry at or after the plan's head is an intruder.
    """
    compared = compare_records(plan, queue, [anchor], columns)
    bounds = plan.agg(F.min(anchor).alias("_head"), F.max("target").alias("_end"))
    tail = queue.join(plan.select(anchor), [anchor], "left_anti")
    starts = bounds.select(F.col("_end").alias(anchor))
    chain = walk_chain(tail, starts, [], anchor).select(F.col("node").alias(anchor), F.lit(True).alias("_ext"))
    marked = attach_row(compared.join(chain, [anchor], "left"), bounds)
    state = (F.when(F.col("state") != "right_only", F.col("state")).when(F.coalesce("_ext", F.lit(False)), "extension")
             .when(F.col(anchor) < F.col("_head"), "earlier").otherwise("intruder"))
    return marked.select(anchor, state.alias("state"))


def paper_details(summaries: DataFrame, papers: DataFrame, keys: Sequence[str] = PAPER_KEYS, columns: Sequence[str] = schemas.PAPER_KEYS) -> DataFrame:
    """The full record behind each summary row."""
    wanted = [c for c in columns if c not in keys and c not in ("rank",)]
    return summaries.select(*keys, "rank").join(papers.select(*keys, *wanted), list(keys))


def project_correction(edition: DataFrame, papers: DataFrame, columns: Sequence[str], keys: Sequence[str] = PAPER_KEYS) -> DataFrame:
    """Copies corrected prose into the edition rows that show it (non-null there)."""
    fresh = papers.select(*keys, *[F.col(c).alias("_n_" + c) for c in columns])
    joined = edition.join(fresh, list(keys), "left")
    for c in columns:
        joined = joined.withColumn(c, F.when(F.col(c).isNotNull(), F.coalesce("_n_" + c, F.col(c))))
    return joined.drop(*["_n_" + c for c in columns])


def apply_prose_patch(base: DataFrame, patch: DataFrame, columns: Sequence[str], keys: Sequence[str] = PAPER_KEYS) -> tuple[DataFrame, DataFrame]:
    """Takes the allowed columns from the patch; any other difference is an issue.

    ``fullTextReviewStatus`` may also be removed by the patch.
    """
    others = [c for c in base.columns if c not in keys and c not in columns]
    pairs = pair_up(base, patch, keys, others, others)
    both = (F.col("left_rows") > 0) & (F.col("right_rows") > 0)
    kind = base.select(F.struct(*others).alias("s")).schema["s"].dataType
    place = R.first_difference(F.col("l"), F.col("r"), kind, "paper")
    issues = find_issues(pairs, [
        Rule("paper", "ids", "the patch must hold the same papers once", both & (F.col("left_rows") == 1) & (F.col("right_rows") == 1)),
        Rule(F.coalesce(place, F.lit("paper")), "allowlist", "is not in the prose allow-list", F.col("l").eqNullSafe(F.col("r")), applies=both),
    ], {"date": keys[0], "slug": keys[1], "id": keys[2]} if len(keys) == 3 else {"id": keys[-1]})
    given = patch.select(*keys, F.lit(True).alias("_given"), *[F.col(c).alias("_p_" + c) for c in columns])
    joined = base.join(given, list(keys), "left")
    for c in columns:
        fresh = F.col("_p_" + c) if c == "fullTextReviewStatus" else F.coalesce("_p_" + c, F.col(c))
        joined = joined.withColumn(c, F.when(F.col("_given"), fresh).otherwise(F.col(c)))
    return joined.drop("_given", *["_p_" + c for c in columns]), issues
