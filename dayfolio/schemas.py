"""Explicit schemas; nothing is inferred from data."""

from __future__ import annotations

# Names and types of the columns of stored records.
AXES = "broadImpact {t}, categoryImpact {t}, originality {t}, technicalStrength {t}"


def _struct(fields: str) -> str:
    return "STRUCT<" + ", ".join(f.strip().replace(" ", ": ", 1) for f in fields.split(",")) + ">"


SCORES = _struct(AXES.format(t="INT"))
REASONS = _struct(AXES.format(t="STRING"))
RUN_FIELDS = "modelId STRING, modelDisplayName STRING, reasoningEffort STRING, modelSelectionVerified BOOLEAN, runId STRING"
RUN = _struct(RUN_FIELDS)
SOURCE_COUNTS = _struct("newPrimary INT, crosslistsExcluded INT, titleAuthorAbstractEvaluated INT")
PAPER_FIELDS = (
    "rank INT, arxivId STRING, arxivVersion STRING, submissionType STRING, url STRING, title STRING, titleJa STRING, "
    f"authors ARRAY<STRING>, primaryCategory STRING, paperType STRING, scores {SCORES}, scoreReasons {REASONS}, "
    "totalScore INT, abstractLines ARRAY<STRING>, curiosity STRING, concept STRING, conclusion STRING, assessment STRING, "
    "evaluationBasis STRING, fullTextEvaluated BOOLEAN, fullTextReviewStatus STRING, sourceUrls ARRAY<STRING>"
)
AUDIT_FIELDS = (
    f"listingUrl STRING, announcementDate STRING, selectionRule STRING, sourceCounts {SOURCE_COUNTS}, "
    "evaluationPolicy STRING, scoreRubric STRING, fullTextPolicy STRING, fullTextEvaluatedCount INT, "
    "authorPolicy STRING, rankingTieBreak STRING, generatedAtJst STRING"
)
REPORT_COUNTS = "totalNew INT, crosslistsExcluded INT, evaluatedCount INT, fullTextEvaluatedCount INT"


def _nested(fields: str) -> str:
    """Turns a column list into a struct type, leaving nested types alone."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(fields + ","):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            out.append(fields[start:i].strip().replace(" ", ": ", 1))
            start = i + 1
    return "STRUCT<" + ", ".join(out) + ">"


PAPER = _nested(PAPER_FIELDS)
AUDIT = _nested(AUDIT_FIELDS)
REPORT = (
    f"schemaVersion STRING, reportDate STRING, slug STRING, label STRING, {REPORT_COUNTS}, "
    f"evaluationRun {RUN}, papers ARRAY<{PAPER}>, audit {AUDIT}"
)
BADGE = _struct("authorName STRING, label STRING, reason STRING, identityEvidence STRING, evidenceUrls ARRAY<STRING>")
AUTHOR = (
    "canonicalName STRING, aliases ARRAY<STRING>, fieldTags ARRAY<STRING>, distinction STRING, "
    "identityEvidence STRING, officialUrls ARRAY<STRING>, lastVerified STRING"
)
REGISTRY = f"schemaVersion STRING, authors ARRAY<{_nested(AUTHOR)}>"
EXCEPTION = _nested(
    "runId STRING, reportDate STRING, reasoningEffort STRING, maximumFullTextEvaluated MAP<STRING, INT>, reason STRING"
)
POLICY = (
    "schemaVersion STRING, requiredModelId STRING, requiredModelDisplayName STRING, requiredReasoningEffort STRING, "
    "requireExplicitModelSelection BOOLEAN, qualificationStatus STRING, qualificationRequiredForPublication BOOLEAN, "
    f"historicalRunExceptions ARRAY<{EXCEPTION}>, verificationScope STRING, publicationRule STRING, lastReviewed STRING"
)
EVENT_SHARED = (
    "schemaVersion STRING, kind STRING, eventId STRING, attemptId STRING, reportDate STRING, "
    "snapshotFingerprint STRING, runtimeFingerprint STRING, evaluationRunId STRING, at STRING, status STRING, message STRING"
)
ATTEMPT = f"{EVENT_SHARED}, stage STRING, category STRING"
PUBLICATION = f"{EVENT_SHARED}, commit STRING"
METADATA_FIELDS = (
    "arxivId STRING, arxivVersion STRING, submissionType STRING, url STRING, sourceUrl STRING, title STRING, "
    "authors ARRAY<STRING>, abstract STRING, comments STRING, primaryCategory STRING"
)

SUMMARY = _nested("rank INT, arxivId STRING, url STRING, title STRING, titleJa STRING, authors ARRAY<STRING>, "
                  f"paperType STRING, totalScore INT, eminentAuthors ARRAY<{BADGE}>")
PUBLIC_PAPER = _nested(f"{PAPER_FIELDS}, eminentAuthors ARRAY<{BADGE}>")
CATEGORY = _nested(
    f"schemaVersion STRING, slug STRING, label STRING, {REPORT_COUNTS}, audit {AUDIT}, topPapers ARRAY<{PUBLIC_PAPER}>, "
    f"otherPapers ARRAY<{SUMMARY}>, eminentAuthorPaperCount INT"
)
PIPELINE = _nested(
    f"mode STRING, rubricVersion STRING, scoreMaximum INT, evaluationRun {RUN}, authorPolicy STRING, audit MAP<STRING, {AUDIT}>"
)
EDITION = (
    "schemaVersion STRING, sourceMode STRING, date STRING, status STRING, statusMessage STRING, generatedAtJst STRING, "
    f"lastSuccessfulAtJst STRING, availableDates ARRAY<STRING>, categories MAP<STRING, {CATEGORY}>, pipeline {PIPELINE}"
)
INDEX = "schemaVersion STRING, latestDate STRING, availableDates ARRAY<STRING>, generatedAtJst STRING, lastSuccessfulAtJst STRING"

# Closed key sets.
REPORT_KEYS = ("schemaVersion", "reportDate", "evaluationRun", "slug", "label", "totalNew", "crosslistsExcluded",
               "evaluatedCount", "fullTextEvaluatedCount", "papers", "audit")
PAPER_KEYS = ("rank", "arxivId", "arxivVersion", "submissionType", "url", "title", "titleJa", "authors",
              "primaryCategory", "paperType", "scores", "scoreReasons", "totalScore", "abstractLines", "curiosity",
              "concept", "conclusion", "assessment", "evaluationBasis", "fullTextEvaluated", "sourceUrls")
RUN_KEYS = ("modelId", "modelDisplayName", "reasoningEffort", "modelSelectionVerified", "runId")
AUDIT_KEYS = ("listingUrl", "announcementDate", "selectionRule", "sourceCounts", "evaluationPolicy", "scoreRubric",
              "fullTextPolicy", "fullTextEvaluatedCount", "authorPolicy", "rankingTieBreak", "generatedAtJst")
AUDIT_TEXT_KEYS = ("selectionRule", "evaluationPolicy", "scoreRubric", "fullTextPolicy", "authorPolicy", "rankingTieBreak")
COUNT_KEYS = ("newPrimary", "crosslistsExcluded", "titleAuthorAbstractEvaluated")
SUMMARY_COLUMNS = ("rank", "arxivId", "url", "title", "titleJa", "authors", "paperType", "totalScore", "eminentAuthors")
TEXT_FIELDS = ("title", "titleJa", "paperType", "curiosity", "concept", "conclusion", "assessment")
PROSE_FIELDS = ("titleJa", "curiosity", "concept", "conclusion", "assessment", "fullTextReviewStatus")
BIBLIOGRAPHIC = ("arxivVersion", "submissionType", "url", "title", "authors", "primaryCategory")
PROTECTED_PAPER = ("rank", "arxivId", "title", "authors", "primaryCategory", "scores", "totalScore",
                   "evaluationBasis", "fullTextEvaluated", "sourceUrls")
CANDIDATE_PAPER = ("arxivId", "title", "authors", "primaryCategory")
OTHER_PAPER = (*CANDIDATE_PAPER, "scores", "totalScore", "evaluationBasis", "fullTextEvaluated", "sourceUrls")
