"""Row predicates over reports and papers, as rules for ``find_issues``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from dayfolio import config, schemas
from dayfolio.functions import records as R, text as X, times
from dayfolio.operators.issues import Rule, find_issues, union_all
from dayfolio.operators.skew import attach_row, small_or_plain

PAPER_ISSUE_KEYS = {"date": "report_date", "slug": "slug", "id": "arxivId", "position": "index"}
REPORT_ISSUE_KEYS = {"date": "report_date", "slug": "slug"}


def explode_papers(reports: DataFrame) -> DataFrame:
    """One row per paper: report_date, slug, 0-based index and the record."""
    return (
        reports.select(F.col("reportDate").alias("report_date"), "slug", F.posexplode("papers").alias("index", "paper"))
        .select("report_date", "slug", "index", "paper.*")
    )


def report_rows(reports: DataFrame) -> DataFrame:
    """The report without its papers, plus how many there are."""
    return reports.withColumn("report_date", F.col("reportDate")).withColumn("paper_count", F.size("papers")).drop("papers")


# Keys and scalars of raw JSON -----------------------------------------------------------

def check_keys(df: DataFrame, raw: str, required: Sequence[str], allowed: Sequence[str] | None = None,
               at: str = "$", keys: Mapping[str, str] | None = None, path: str = "report") -> DataFrame:
    """Missing and unknown keys of the object found at a JSON path.

    Works on the text, because a typed parse drops unknown keys silently.
    """
    found = F.json_object_keys(F.get_json_object(F.col(raw), at) if at != "$" else F.col(raw))
    lit = lambda names: F.array(*[F.lit(n) for n in names])
    missing = F.transform(F.array_except(lit(required), found),
                          lambda k: F.struct(k.alias("key"), F.lit("missing_key").alias("kind")))
    extra = F.transform(F.array_except(found, lit(allowed or required)),
                        lambda k: F.struct(k.alias("key"), F.lit("extra_key").alias("kind")))
    wrong = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit("type").alias("kind")))
    listed = df.withColumn("_found", F.explode(F.when(found.isNull(), wrong).otherwise(F.concat(missing, extra))))
    place = F.when(F.col("_found.key").isNull(), F.lit(path)).otherwise(F.concat(F.lit(path + "."), F.col("_found.key")))
    message = (F.when(F.col("_found.kind") == "missing_key", "required key is missing")
               .when(F.col("_found.kind") == "extra_key", "unknown key is not allowed")
               .otherwise("must be an object"))
    issues = find_issues(listed, [Rule(place, "key", message, F.lit(False), fragment=F.col("_found.kind"))], keys or {},
                         scope="report")
    return issues.withColumn("kind", F.col("fragment")).withColumn("rule", F.col("kind")) \
                 .withColumn("fragment", F.lit(None).cast("string"))


def json_type(raw: Column | str, at: str) -> Column:
    """Type of the JSON value at a path: STRING, BIGINT, BOOLEAN, ARRAY<..> and so on."""
    column = F.col(raw) if isinstance(raw, str) else raw
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(column), at, "variant"))


def scalar_rule(value: Column, path: str, kind: str, expected=None) -> Rule:
    """``non_empty``, ``non_negative``, ``equal`` or ``one_of``."""
    if kind == "non_empty":
        return Rule(path, "value", "must be a non-empty string", ~X.is_blank(value), name=kind)
    if kind == "non_negative":
        return Rule(path, "value", "must be a non-negative integer", value >= 0, name=kind)
    if kind == "equal":
        shown = F.lit(str(expected)) if not isinstance(expected, Column) else expected.cast("string")
        return Rule(path, "value", F.concat(F.lit("must equal "), shown), value.eqNullSafe(
            expected if isinstance(expected, Column) else F.lit(expected)), name=kind)
    if kind == "one_of":
        return Rule(path, "value", "must be one of " + ", ".join(map(str, expected)), value.isin(*expected), name=kind)
    raise ValueError(kind)


def check_scalar(df: DataFrame, column: str, kind: str, expected=None, keys: Mapping[str, str] | None = None) -> DataFrame:
    return find_issues(df, [scalar_rule(F.col(column), column, kind, expected)], keys or PAPER_ISSUE_KEYS)


# Papers -----------------------------------------------------------------------------------

def identity_rules() -> list[Rule]:
    valid = R.is_paper_id("arxivId")
    return [
        Rule("arxivId", "value", "must be an unversioned modern id", valid, name="identity"),
        Rule("url", "value", F.concat(F.lit("must equal "), R.abs_url("arxivId")),
             F.col("url") == R.abs_url("arxivId"), applies=valid, name="identity"),
    ]


def scalar_rules() -> list[Rule]:
    fixed = [scalar_rule(F.col("arxivVersion"), "arxivVersion", "equal", "v1"),
             scalar_rule(F.col("submissionType"), "submissionType", "equal", "new"),
             scalar_rule(F.col("primaryCategory"), "primaryCategory", "equal", F.col("slug"))]
    texts = [scalar_rule(F.col(f), f, "non_empty") for f in schemas.TEXT_FIELDS]
    reasons = [scalar_rule(F.col(f"scoreReasons.{k}"), f"scoreReasons.{k}", "non_empty") for k in config.SCORE_KEYS]
    lines = [Rule("abstractLines", "value", "must contain exactly three lines", F.size("abstractLines") == 3)]
    lines += [Rule(f"abstractLines[{i}]", "value", "must be a non-empty string",
                   ~X.is_blank(F.try_element_at("abstractLines", F.lit(i + 1))), applies=F.size("abstractLines") == 3)
              for i in range(3)]
    return fixed + texts + reasons + lines


def axis(key: str) -> Column:
    return F.col(f"scores.{key}")


def total_score() -> Column:
    """Sum of the four axes."""
    total = axis(config.SCORE_KEYS[0])
    for key in config.SCORE_KEYS[1:]:
        total = total + axis(key)
    return total


def scores_valid() -> Column:
    valid = F.lit(True)
    for key in config.SCORE_KEYS:
        valid = valid & F.coalesce(axis(key).between(0, config.AXIS_MAXIMUM), F.lit(False))
    return valid


def score_rules() -> list[Rule]:
    axes = [Rule(f"scores.{k}", "value", "must be an integer from 0 through 25", axis(k).between(0, config.AXIS_MAXIMUM),
                 name="score") for k in config.SCORE_KEYS]
    return axes + [
        Rule("totalScore", "value", "must be an integer from 0 through 100",
             F.col("totalScore").between(0, config.TOTAL_MAXIMUM), name="score"),
        Rule("totalScore", "invariant", F.concat(F.lit("must equal the four-score sum "), total_score().cast("string")),
             F.col("totalScore") == total_score(), applies=scores_valid(), name="score_sum"),
    ]


def expected_urls(full_text: Column) -> Column:
    abstract = F.array(R.abs_url_v1("arxivId"))
    return F.when(full_text, F.concat(abstract, F.array(R.pdf_url_v1("arxivId")))).otherwise(abstract)


def evidence_rules(full_text: Column | None = None, kind: str = "invariant") -> list[Rule]:
    """Flag, basis, review status and URL set must agree.

    ``full_text`` is the state to check against; by default the stored flag.
    """
    target = F.col("fullTextEvaluated") if full_text is None else full_text
    known = target.isNotNull()
    basis = F.when(target, config.FULL_TEXT_BASIS).otherwise(config.ABSTRACT_BASIS)
    urls = expected_urls(target)
    return [
        Rule("fullTextEvaluated", "type", "must be a boolean", F.col("fullTextEvaluated").isNotNull(), name="evidence"),
        Rule("evaluationBasis", kind, F.concat(F.lit("must equal "), basis), F.col("evaluationBasis") == basis,
             applies=known, name="evidence"),
        Rule("fullTextReviewStatus", kind, "must contain a non-empty review status after full-text review",
             ~X.is_blank("fullTextReviewStatus"), applies=target, name="evidence"),
        Rule("fullTextReviewStatus", "extra_key", "must be omitted when fullTextEvaluated is false",
             F.col("fullTextReviewStatus").isNull(), applies=~target, name="evidence"),
        Rule("sourceUrls", kind, F.concat(F.lit("must contain exactly "), F.array_join(urls, " and ")),
             (F.size("sourceUrls") == F.size(urls)) & (F.size(F.array_except(urls, F.col("sourceUrls"))) == 0),
             applies=known & R.is_paper_id("arxivId"), name="evidence"),
    ]


def cap_rules(limit: int = config.UNREVIEWED_AXIS_LIMIT,
              technical: int = config.UNREVIEWED_TECHNICAL_MAXIMUM) -> list[Rule]:
    """Scores a paper may not reach without full-text review."""
    unreviewed = ~F.col("fullTextEvaluated") & scores_valid()
    rules = [Rule(f"scores.{k}", "invariant", f"must be below {limit} without full-text review", axis(k) < limit,
                  applies=unreviewed, name="evidence_cap") for k in config.SCORE_KEYS]
    return rules + [Rule("scores.technicalStrength", "invariant", f"must be at most {technical} without full-text review",
                         axis("technicalStrength") <= technical, applies=unreviewed, name="technical_cap")]


def author_rules(keys: str = "_author_keys") -> list[Rule]:
    """Needs the normalised names in ``keys``; see ``with_author_keys``."""
    listed = F.coalesce(F.size("authors") > 0, F.lit(False))
    named = F.filter(F.col("authors"), lambda a: ~X.is_blank(a))
    return [
        Rule("authors", "value", "must be a non-empty array", listed, name="authors"),
        Rule("authors", "value", "must contain only non-empty strings", F.size(named) == F.size("authors"),
             applies=listed, name="authors"),
        Rule("authors", "invariant", "contains a duplicate author",
             F.size(F.array_distinct(F.col(keys))) == F.size(keys), applies=listed, name="authors"),
    ]


def with_author_keys(df: DataFrame, authors: str = "authors", name: str = "_author_keys") -> DataFrame:
    return df.withColumn(name, X.author_keys(authors))


def character_rules(caps: Mapping[str, int] = config.MAX_CHARACTERS) -> list[Rule]:
    """Length caps in code points."""
    fields: list[tuple[str, Column, int]] = [
        (f, F.col(f), caps[f]) for f in ("titleJa", "curiosity", "concept", "conclusion", "assessment", "fullTextReviewStatus")]
    fields += [(f"abstractLines[{i}]", F.try_element_at("abstractLines", F.lit(i + 1)), caps["abstractLine"]) for i in range(3)]
    fields += [(f"scoreReasons.{k}", F.col(f"scoreReasons.{k}"), caps["scoreReason"]) for k in config.SCORE_KEYS]
    return [max_character_rule(path, value, cap) for path, value, cap in fields]


def max_character_rule(path: str, value: Column, cap: int) -> Rule:
    return Rule(path, "length", F.concat(F.lit(f"must be at most {cap} characters (got "),
                                         F.char_length(value).cast("string"), F.lit(")")),
                F.char_length(value) <= cap, applies=value.isNotNull(), name="max_chars")


def check_max_chars(df: DataFrame, caps: Mapping[str, int], keys: Mapping[str, str]) -> DataFrame:
    return find_issues(df, [max_character_rule(c, F.col(c), n) for c, n in caps.items()], keys)


def badge_rules(badges: str = "eminentAuthors") -> list[Rule]:
    """Needs ``_author_keys`` and ``_badge_keys``."""
    held = F.col(badges)
    ours = F.col("_badge_keys")
    return [
        Rule(badges, "value", "must identify one listed author once",
             (F.size(F.array_except(ours, F.col("_author_keys"))) == 0) & (F.size(F.array_distinct(ours)) == F.size(ours))
             & ~F.array_contains(ours, ""), applies=held.isNotNull(), name="badge"),
        Rule(badges, "value", "must contain a label, a reason and identity evidence",
             F.forall(held, lambda b: (b["label"] == "著名著者") & ~X.is_blank(b["reason"]) & ~X.is_blank(b["identityEvidence"])),
             name="badge"),
        Rule(badges, "value", "must contain official HTTPS evidence",
             F.forall(held, lambda b: (F.size(b["evidenceUrls"]) > 0) & F.forall(b["evidenceUrls"], lambda u: u.startswith("https://"))),
             name="badge"),
    ]


def check_badges(df: DataFrame, badges: str = "eminentAuthors", keys: Mapping[str, str] = PAPER_ISSUE_KEYS) -> DataFrame:
    keyed = with_author_keys(df).withColumn(
        "_badge_keys", X.author_keys(F.transform(F.col(badges), lambda b: b["authorName"])))
    return find_issues(keyed, badge_rules(badges), keys)


def check_identity(df: DataFrame) -> DataFrame:
    return find_issues(df, identity_rules(), PAPER_ISSUE_KEYS)


def check_scores(df: DataFrame) -> DataFrame:
    return find_issues(df, score_rules(), PAPER_ISSUE_KEYS)


def check_evidence(df: DataFrame) -> DataFrame:
    return find_issues(df, evidence_rules(), PAPER_ISSUE_KEYS)


def check_score_caps(df: DataFrame, **caps: int) -> DataFrame:
    return find_issues(df, cap_rules(**caps), PAPER_ISSUE_KEYS)


def check_authors(df: DataFrame, keys: Mapping[str, str] = PAPER_ISSUE_KEYS) -> DataFrame:
    return find_issues(with_author_keys(df), author_rules(), keys)


# Reports ----------------------------------------------------------------------------------------

def audit_rules(rubric_prefix: str | None = None) -> list[Rule]:
    audit = lambda name: F.col(f"audit.{name}")
    counts = lambda name: F.col(f"audit.sourceCounts.{name}")
    slug = F.col("slug")
    rules = [
        Rule("audit.listingUrl", "value", "must be an official listing URL",
             (audit("listingUrl") == R.listing_url(slug, "new")) | (audit("listingUrl") == R.listing_url(slug, "pastweek")),
             name="audit"),
        Rule("audit.announcementDate", "value", "must equal the report date", audit("announcementDate") == F.col("reportDate"), name="audit"),
        Rule("audit.generatedAtJst", "value", "must be a valid time with the +09:00 offset",
             times.parse_jst(audit("generatedAtJst")).isNotNull(), name="audit"),
        Rule("audit.fullTextEvaluatedCount", "invariant", "must equal the report count",
             audit("fullTextEvaluatedCount") == F.col("fullTextEvaluatedCount"), name="audit"),
        Rule("audit.sourceCounts.newPrimary", "value", "must equal totalNew", counts("newPrimary") == F.col("totalNew"), name="audit"),
        Rule("audit.sourceCounts.crosslistsExcluded", "value", "must equal crosslistsExcluded",
             counts("crosslistsExcluded") == F.col("crosslistsExcluded"), name="audit"),
        Rule("audit.sourceCounts.titleAuthorAbstractEvaluated", "value", "must equal totalNew",
             counts("titleAuthorAbstractEvaluated") == F.col("totalNew"), name="audit"),
    ]
    rules += [scalar_rule(audit(k), f"audit.{k}", "non_empty") for k in schemas.AUDIT_TEXT_KEYS]
    if rubric_prefix is not None:
        rules.append(Rule("audit.scoreRubric", "value", f"must start with {rubric_prefix}",
                          audit("scoreRubric").startswith(rubric_prefix), name="audit"))
    return rules


def report_rules(schema_version: str = config.CURRENT_SCHEMA) -> list[Rule]:
    return [
        scalar_rule(F.col("schemaVersion"), "schemaVersion", "equal", schema_version),
        scalar_rule(F.col("slug"), "slug", "one_of", config.CATEGORIES),
        Rule("reportDate", "value", "must be a real date", times.parse_date("reportDate").isNotNull()),
        scalar_rule(F.col("label"), "label", "non_empty"),
        *[scalar_rule(F.col(c), c, "non_negative") for c in ("totalNew", "crosslistsExcluded", "evaluatedCount", "fullTextEvaluatedCount")],
        Rule("evaluatedCount", "invariant", "must equal totalNew", F.col("evaluatedCount") == F.col("totalNew")),
        Rule("papers", "invariant", "must contain totalNew papers", F.col("paper_count") == F.col("totalNew")),
    ]


def policy_exceptions(policy: DataFrame) -> DataFrame:
    """Dated exceptions as rows: report_date, run_id, slug, effort, limit."""
    one = policy.select(F.explode("historicalRunExceptions").alias("e"))
    return one.select(
        F.col("e.reportDate").alias("report_date"), F.col("e.runId").alias("run_id"),
        F.col("e.reasoningEffort").alias("effort"), F.explode("e.maximumFullTextEvaluated").alias("slug", "full_text_limit"))


def effective_limit(reports: DataFrame, exceptions: DataFrame, run: str = "evaluationRun.runId",
                    default_effort: str = "high") -> DataFrame:
    """Adds the effort and the full-text limit that apply to each report."""
    table = small_or_plain(exceptions)
    ours = reports.withColumn("_run", F.col(run))
    joined = ours.join(
        table.withColumnsRenamed({"report_date": "_date", "run_id": "_run_id", "slug": "_slug", "effort": "_effort"}),
        (F.col("report_date") == F.col("_date")) & (F.col("_run") == F.col("_run_id")) & (F.col("slug") == F.col("_slug")), "left")
    limit = F.least(F.coalesce("full_text_limit", F.lit(config.SHORTLIST_SIZE)), F.col("totalNew"))
    return (joined.withColumn("full_text_limit", limit)
            .withColumn("expected_effort", F.coalesce("_effort", F.lit(default_effort)))
            .drop("_run", "_date", "_run_id", "_slug", "_effort"))


def run_rules(model_id: str, model_name: str) -> list[Rule]:
    """Needs ``expected_effort`` from ``effective_limit``."""
    run = lambda name: F.col(f"evaluationRun.{name}")
    return [
        scalar_rule(run("modelId"), "evaluationRun.modelId", "equal", model_id),
        scalar_rule(run("modelDisplayName"), "evaluationRun.modelDisplayName", "equal", model_name),
        scalar_rule(run("reasoningEffort"), "evaluationRun.reasoningEffort", "equal", F.col("expected_effort")),
        scalar_rule(run("modelSelectionVerified"), "evaluationRun.modelSelectionVerified", "equal", True),
        Rule("evaluationRun.runId", "value", "must be a stable run identifier", run("runId").rlike(config.RUN_ID_PATTERN)),
    ]


def check_run(reports: DataFrame, exceptions: DataFrame, model_id: str, model_name: str) -> DataFrame:
    return find_issues(effective_limit(reports, exceptions), run_rules(model_id, model_name), REPORT_ISSUE_KEYS, "report")


def check_audit(reports: DataFrame, rubric_prefix: str | None = None) -> DataFrame:
    return find_issues(reports, audit_rules(rubric_prefix), REPORT_ISSUE_KEYS, "report")


# Dated rule families and schema versions ---------------------------------------------------------

def rules_in_force(df: DataFrame, rules: DataFrame, exempt: DataFrame | None = None,
                   date: str = "report_date") -> DataFrame:
    """Pairs each row with the rule families whose start date it has reached.

    ``rules`` holds (rule, valid_from) and is small; it travels as one array, so
    the date comparison needs no join.
    """
    families = rules.agg(F.sort_array(F.collect_list(F.struct("valid_from", "rule"))).alias("_rules"))
    reached = F.filter("_rules", lambda r: r["valid_from"].cast("string") <= F.col(date).cast("string"))
    paired = (
        attach_row(df, families).withColumn("rule", F.explode(F.transform(reached, lambda r: r["rule"]))).drop("_rules")
    )
    if exempt is None:
        return paired
    return paired.join(exempt, [c for c in exempt.columns], "left_anti")


def legacy_only_rules() -> list[Rule]:
    """What the oldest schema asks besides identity and scores: texts, basis and lines, leniently."""
    basis = F.when(F.col("fullTextEvaluated"), config.FULL_TEXT_BASIS).otherwise(config.ABSTRACT_BASIS)
    urls = F.col("sourceUrls")
    return [
        *[scalar_rule(F.col(f), f, "non_empty") for f in schemas.TEXT_FIELDS],
        scalar_rule(F.col("primaryCategory"), "primaryCategory", "equal", F.col("slug")),
        Rule("abstractLines", "value", "must contain exactly three lines", F.size("abstractLines") == 3),
        Rule("evaluationBasis", "invariant", F.concat(F.lit("must equal "), basis), F.col("evaluationBasis") == basis),
        Rule("fullTextReviewStatus", "invariant", "must contain a non-empty review status after full-text review",
             ~X.is_blank("fullTextReviewStatus"), applies=F.col("fullTextEvaluated")),
        Rule("sourceUrls", "value", "may contain only HTTPS URLs when present",
             urls.isNull() | F.forall(urls, lambda u: u.startswith("https://"))),
    ]


def legacy_rules() -> list[Rule]:
    """The lenient set for the oldest schema: identity, scores, texts, basis and lines."""
    return [*identity_rules(), *score_rules(), *legacy_only_rules()]


def guarded(rules: Sequence[Rule], condition: Column) -> list[Rule]:
    """The rules for the rows that meet a condition, so that several sets go through a table in one pass."""
    return [replace(r, applies=condition if r.applies is None else condition & F.coalesce(r.applies, F.lit(False))) for r in rules]


def validate_by_version(papers: DataFrame, version: str = "schema_version",
                        keys: Mapping[str, str] = PAPER_ISSUE_KEYS) -> DataFrame:
    """Applies to each paper the rules of its own schema version, all in one pass."""
    held = lambda *versions: F.coalesce(F.col(version).isin(*versions), F.lit(False))
    legacy, later, current = held(config.LEGACY_SCHEMA), held(config.PREVIOUS_SCHEMA, config.CURRENT_SCHEMA), held(config.CURRENT_SCHEMA)
    return find_issues(papers, [
        *guarded([*identity_rules(), *score_rules()], legacy | later), *guarded(legacy_only_rules(), legacy),
        *guarded(evidence_rules(), later), *guarded(cap_rules(), current),
        Rule("schemaVersion", "value", "is not supported", legacy | later),
    ], keys)


# Listings, metadata, events -------------------------------------------------------------------------

def listing_rules() -> list[Rule]:
    """For one row per (date, slug) with counts measured from its ids."""
    slug = F.col("slug")
    return [
        scalar_rule(slug, "slug", "one_of", config.CATEGORIES),
        Rule("sourceUrl", "value", "must be an official listing URL",
             (F.col("sourceUrl") == R.listing_url(slug, "new")) | (F.col("sourceUrl") == R.listing_url(slug, "pastweek"))),
        scalar_rule(F.col("newCount"), "newCount", "non_negative"),
        scalar_rule(F.col("crosslistCount"), "crosslistCount", "non_negative"),
        Rule("newIds", "invariant", "must contain exactly newCount ids", F.col("id_count") == F.col("newCount")),
        Rule("newIds", "value", "contains an invalid id", F.col("invalid_count") == 0),
        Rule("newIds", "invariant", "contains duplicates", F.col("distinct_count") == F.col("id_count")),
    ]


def measure_ids(listings: DataFrame, ids: DataFrame) -> DataFrame:
    """Adds id_count, invalid_count and distinct_count per (date, slug)."""
    per_id = ids.groupBy("date", "slug", "id").agg(F.count(F.lit(1)).alias("_n"))
    measured = per_id.groupBy("date", "slug").agg(
        F.sum("_n").alias("id_count"), F.count(F.lit(1)).alias("distinct_count"),
        F.sum(F.when(R.is_paper_id("id"), 0).otherwise(F.col("_n"))).alias("invalid_count"))
    return listings.join(measured, ["date", "slug"], "left").fillna(0, ["id_count", "distinct_count", "invalid_count"])


def check_snapshot(listings: DataFrame, ids: DataFrame) -> DataFrame:
    return find_issues(measure_ids(listings, ids), listing_rules(), {"date": "date", "slug": "slug"}, "listing")


def metadata_rules() -> list[Rule]:
    """Needs the canonical forms ``_title``, ``_abstract``, ``_comments``, ``_authors``."""
    limits = config.METADATA_LIMITS
    return [
        *identity_rules(),
        Rule("arxivVersion", "value", "must equal v1", F.col("arxivVersion") == "v1"),
        Rule("submissionType", "value", "must equal new", F.col("submissionType") == "new"),
        Rule("sourceUrl", "value", "must be the version-fixed address", F.col("sourceUrl") == R.abs_url_v1("arxivId")),
        Rule("title", "value", "must be canonical non-empty text", F.col("title") == F.col("_title")),
        Rule("abstract", "value", "must be canonical non-empty text", F.col("abstract") == F.col("_abstract")),
        Rule("comments", "value", "must be canonical non-empty text", F.col("comments").isNull() | (F.col("comments") == F.col("_comments"))),
        Rule("authors", "value", f"must contain 1 through {limits['authors']} names", F.size("authors").between(1, limits["authors"])),
        Rule("authors", "value", "must be canonical non-empty text", F.col("authors") == F.col("_authors")),
        Rule("primaryCategory", "value", "must equal the category", F.col("primaryCategory") == F.col("slug")),
    ]


def check_metadata(metadata: DataFrame, maximum_bytes: int = config.MAX_METADATA_BYTES) -> DataFrame:
    """Record checks, sorted unique ids and the size of each (date, slug)."""
    from dayfolio.operators.ordering import with_previous

    limits = config.METADATA_LIMITS
    names = F.transform(X.nfc_list("authors"), X.squeeze_space)
    clean = F.when(~F.exists(names, lambda n: (n == "") | (F.char_length(n) > limits["author"])), names)
    prepared = (
        metadata.withColumn("_title", X.canonical_text("title", limits["title"]))
        .withColumn("_abstract", X.canonical_text("abstract", limits["abstract"]))
        .withColumn("_comments", X.canonical_text("comments", limits["comments"]))
        .withColumn("_authors", clean))
    keys = {"date": "report_date", "slug": "slug", "id": "arxivId", "position": "position"}
    rows = find_issues(prepared, metadata_rules(), keys)
    ordered = with_previous(metadata, ["report_date", "slug"], ["position"], {"_previous": "arxivId"})
    order = find_issues(ordered, [Rule("papers", "order", "must be unique and in sorted order", F.col("_previous") < F.col("arxivId"),
                                       applies=F.col("_previous").isNotNull())], keys)
    fields = [c for c in metadata.columns if c not in ("report_date", "slug", "position")]
    sizes = metadata.groupBy("report_date", "slug").agg(F.sum(F.octet_length(F.to_json(F.struct(*fields)))).alias("bytes"))
    size = find_issues(sizes, [Rule("papers", "size", f"exceeds {maximum_bytes} bytes", F.col("bytes") <= maximum_bytes)],
                       REPORT_ISSUE_KEYS, "category")
    return union_all([rows, order, size])


def event_rules(kind: str) -> list[Rule]:
    statuses = {"attempt": ("started", "resumed", "completed", "failed", "deferred"),
                "publication": ("pending", "publishing", "published", "failed", "deferred")}[kind]
    rules = [
        Rule("kind", "value", f"must be {kind}", F.col("kind") == kind),
        Rule("eventId", "value", "must be 32 lower-case hexadecimal characters", F.col("eventId").rlike(config.EVENT_ID_PATTERN)),
        Rule("attemptId", "value", "is not a safe id", F.col("attemptId").rlike(config.SAFE_ID_PATTERN)),
        Rule("at", "value", "must be a canonical UTC time", R.parse_iso("at").isNotNull()),
        Rule("message", "value", "is too long or unsafe",
             (F.char_length("message") <= config.MAX_MESSAGE_CHARACTERS) & ~F.col("message").rlike(R.UNSAFE_TEXT)),
        Rule("status", "value", "is not a known status", F.col("status").isin(*statuses)),
    ]
    if kind == "attempt":
        return rules + [
            Rule("stage", "value", "is not a safe id", F.col("stage").rlike(config.SAFE_ID_PATTERN)),
            Rule("category", "value", "is not a known category", F.col("category").isNull() | F.col("category").isin(*config.CATEGORIES)),
        ]
    published = F.col("status") == "published"
    return rules + [
        Rule("commit", "value", "is required for published status", F.col("commit").rlike(config.COMMIT_PATTERN), applies=published),
        Rule("commit", "value", "must be null unless published", F.col("commit").isNull(), applies=~published),
    ]


def check_events(events: DataFrame, kind: str = "attempt") -> DataFrame:
    return find_issues(events, event_rules(kind), {"date": "reportDate", "id": "eventId"}, "event")


# Cross-list markers ---------------------------------------------------------------------------------

CROSS_MARKER = r"\(cross-list from [a-z][a-z0-9-]*(?:\.[A-Za-z0-9-]+)*\)"


def mark_crosslists(df: DataFrame, text: str) -> DataFrame:
    """Adds ``crosslist`` and ``marker_error`` (repeated or malformed marker)."""
    marks = F.regexp_count(F.col(text), F.lit(CROSS_MARKER))
    rest = F.lower(F.regexp_replace(F.col(text), CROSS_MARKER, "")).contains("cross-list")
    return df.withColumn("crosslist", marks == 1).withColumn("marker_error", (marks > 1) | rest)


def primary_only(df: DataFrame, text: str) -> DataFrame:
    """Entries without a cross-list marker; broken markers are dropped here and reported by ``mark_crosslists``."""
    return mark_crosslists(df, text).where("not crosslist and not marker_error").drop("crosslist", "marker_error")
