"""Fixed values shared by the operators.

Every function that uses one of these takes it as a default argument, so the
same job runs on other category sets, score axes or thresholds.
"""

from __future__ import annotations

# Category set, score axes and the order used to break ties.
CATEGORIES = ("quant-ph", "gr-qc", "hep-th")
SCORE_KEYS = ("broadImpact", "categoryImpact", "originality", "technicalStrength")
TIE_BREAK_KEYS = ("broadImpact", "originality", "technicalStrength", "categoryImpact")

# Schema versions.
CURRENT_SCHEMA = "1.4"
PREVIOUS_SCHEMA = "1.3"
LEGACY_SCHEMA = "1.2"

# List sizes and evidence caps.
TOP_SIZE = 10
SHORTLIST_SIZE = 12
AXIS_MAXIMUM = 25
TOTAL_MAXIMUM = 100
UNREVIEWED_AXIS_LIMIT = 24
UNREVIEWED_TECHNICAL_MAXIMUM = 17

# Evidence labels.
FULL_TEXT_BASIS = "full_text_major_sections"
ABSTRACT_BASIS = "title_authors_abstract"

# Site addresses used to derive and check URLs.
SITE = "https://arxiv.org"
LISTING_KINDS = ("new", "pastweek")

# Identifier and time patterns.
PAPER_ID_PATTERN = r"^\d{4}\.\d{4,5}$"
JST_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{3})?\+09:00$"
RUN_ID_PATTERN = r"^[A-Za-z0-9][A-Za-z0-9._:-]{7,127}$"
SCHEDULED_RUN_PATTERN = r"^run-(\d{8})T(\d{6})Z-[a-f0-9]{12}$"
SHA256_PATTERN = r"^[a-f0-9]{64}$"
SAFE_ID_PATTERN = r"^[A-Za-z0-9][A-Za-z0-9._:-]{0,127}$"
EVENT_ID_PATTERN = r"^[a-f0-9]{32}$"
COMMIT_PATTERN = r"^[a-f0-9]{40,64}$"

# Dates from which rule families apply.
QUALITY_GATE_DATE = "2026-07-16"
PROSE_GATE_DATE = "2026-08-03"

# Character caps per prose field, in code points.
MAX_CHARACTERS = {
    "titleJa": 100,
    "abstractLine": 120,
    "curiosity": 100,
    "concept": 140,
    "conclusion": 180,
    "scoreReason": 180,
    "assessment": 160,
    "fullTextReviewStatus": 200,
}

# Repetition thresholds. Ratios are strict lower bounds.
IDENTICAL_TEXT = {"matches": 3, "ratio": 0.25}
STRUCTURE = {
    "sample": 16, "ratio": 0.25,
    "long": 20, "long_left": 10, "long_hiragana": 6,
    "short": 12, "short_left": 6, "short_hiragana": 4,
    "gap": 4,
}
TEMPLATE = {
    "sample": 16, "reviewed_sample": 8, "ratio": 0.25,
    "characters": 16, "hiragana": 8, "slots": 3, "punctuation": 2,
    "short_characters": 7, "short_hiragana": 3, "short_slots": 2, "short_punctuation": 2,
    "short_matches": 12, "short_ratio": 0.6,
}
REUSE = {"characters": 24, "gram": 3, "coverage": 0.82}
PLATEAU = {"sample": 16, "matches": 8, "total_ratio": 0.35, "vector_ratio": 0.20}

# Retry delays in hours, orphan age, repair limit.
RETRY_HOURS = (1.0, 4.0, 12.0, 24.0)
PROBE_RETRY_HOURS = (0.25, 4.0, 18.0, 36.0, 72.0)
ORPHAN_HOURS = 5
REPAIR_LIMIT = 4
RETRY_STAGES = ("category_generation", "category_source_resume", "category_repair")
START_STAGES = ("category_generation", "category_source_resume")
MODEL_FAILURE = "all_official_full_text_pathways_unavailable"
PROBE_FAILURE = "host_source_probe_failed"

# Size limits in bytes or counts.
MEBIBYTE = 1 << 20
MAX_JSON_BYTES = 10 * MEBIBYTE
MAX_LISTING_BYTES = 8 * MEBIBYTE
MAX_ABSTRACT_BYTES = 2 * MEBIBYTE
MAX_METADATA_BYTES = 2 * MEBIBYTE
MAX_EVENT_BYTES = 64 * 1024
MAX_MESSAGE_CHARACTERS = 2000
MAX_SCANNED_BYTES = 10 * MEBIBYTE
ARCHIVE = {
    "download": 50 * MEBIBYTE, "unpacked": 192 * MEBIBYTE, "file": 12 * MEBIBYTE,
    "text": 40 * MEBIBYTE, "entries": 10_000, "files": 512,
}
METADATA_LIMITS = {"title": 2000, "abstract": 20000, "comments": 4000, "author": 512, "authors": 5000}

# Audit pass counts.
STRUCTURE_PASSES = 4
LANGUAGE_PASSES = 5
