"""Identifiers, URLs, JSON forms, digests, paths and message codec."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from dayfolio import config
from dayfolio.functions.text import is_blank, let


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Identity and derived addresses -------------------------------------------------

def is_paper_id(c: Column | str) -> Column:
    return F.coalesce(_column(c).rlike(config.PAPER_ID_PATTERN), F.lit(False))


def abs_url(c: Column | str) -> Column:
    return F.concat(F.lit(config.SITE + "/abs/"), _column(c))


def abs_url_v1(c: Column | str) -> Column:
    return F.concat(abs_url(c), F.lit("v1"))


def pdf_url_v1(c: Column | str) -> Column:
    return F.concat(F.lit(config.SITE + "/pdf/"), _column(c), F.lit("v1"))


def listing_url(slug: Column | str, kind: str) -> Column:
    return F.concat(F.lit(config.SITE + "/list/"), _column(slug), F.lit("/" + kind))


def id_sort_key(c: Column | str) -> Column:
    """Numeric order of an id: month, then sequence."""
    parts = F.split(_column(c), "\\.")
    return F.struct(F.try_element_at(parts, F.lit(1)).try_cast("int").alias("month"),
                    F.try_element_at(parts, F.lit(2)).try_cast("long").alias("sequence"))


# Numbers -----------------------------------------------------------------------

def ratio(part: Column, whole: Column) -> Column:
    """A share as a double; null for an empty whole. Compare with ``>``."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """A share in whole percent, halves rounded up."""
    return F.floor(ratio(part, whole) * 100 + 0.5).cast("int")


# Canonical JSON and digests ------------------------------------------------------

def _canonical(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        struct = F.struct(*[_canonical(column[f.name], f.dataType).alias(f.name) for f in fields])
        return F.when(column.isNotNull(), struct)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda item: _canonical(item, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(column),
                              lambda e: F.struct(e["key"].alias("key"),
                                                 _canonical(e["value"], kind.valueType).alias("value")))
        return F.sort_array(entries)
    return column


def canonical_json(df: DataFrame, names: Sequence[str]) -> Column:
    """JSON of the named columns with sorted keys at every level."""
    picked = [(n, df.schema[n].dataType) for n in sorted(names)]
    return F.to_json(F.struct(*[_canonical(F.col(n), kind).alias(n) for n, kind in picked]),
                     {"ignoreNullFields": "false"})


def canonical_digest(df: DataFrame, names: Sequence[str]) -> Column:
    return F.sha2(canonical_json(df, names), 256)


def row_lanes(*parts: Column) -> list[Column]:
    """Four 60-bit numbers from the SHA-256 of a row, for ``set_digest``.

    Each value is preceded by its length, so that different rows cannot join
    to the same text.
    """
    text = F.concat_ws("|", *[F.coalesce(F.concat(F.char_length(p.cast("string")).cast("string"), F.lit(":"),
                                                  p.cast("string")), F.lit("null")) for p in parts])
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, 1 + 15 * lane, 15), 16, 10).cast("decimal(38,0)") for lane in range(4)]


def set_digest(*parts: Column) -> Column:
    """Order-free SHA-256 digest of all rows of a group, as an aggregate.

    Rows are hashed one by one and the hashes added, so partial sums combine
    before the shuffle and no group is ever collected. Repeated rows count.
    """
    sums = [F.coalesce(F.sum(lane), F.lit(0).cast("decimal(38,0)")).cast("string") for lane in row_lanes(*parts)]
    return F.sha2(F.concat_ws("/", F.count(F.lit(1)).cast("string"), *sums), 256)


# Differences between nested values -------------------------------------------------

def flat_values(column: Column, kind: T.DataType, path: str) -> Column:
    """All leaves of a nested value as ``array<struct<path, value>>``."""
    leaf = "array<struct<path:string,value:string>>"
    if isinstance(kind, T.StructType):
        parts = [flat_values(column[f.name], f.dataType, f"{path}.{f.name}")
                 for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.concat(*parts) if parts else F.array().cast(leaf)
    if isinstance(kind, T.ArrayType):
        size = F.array(F.struct(F.lit(f"{path}.length").alias("path"),
                                F.size(column).cast("string").alias("value")))
        if isinstance(kind.elementType, (T.StructType, T.ArrayType)):
            items = F.flatten(F.transform(column, lambda item, i: F.transform(
                flat_values(item, kind.elementType, ""),
                lambda leaf_: F.struct(F.concat(F.lit(path + "["), i.cast("string"), F.lit("]"), leaf_["path"]).alias("path"),
                                       leaf_["value"].alias("value")))))
        else:
            items = F.transform(column, lambda item, i: F.struct(
                F.concat(F.lit(path + "["), i.cast("string"), F.lit("]")).alias("path"),
                item.cast("string").alias("value")))
        return F.concat(size, F.coalesce(items, F.array().cast(leaf)))
    return F.array(F.struct(F.lit(path).alias("path"), column.cast("string").alias("value")))


def first_difference(left: Column, right: Column, kind: T.DataType, path: str = "report") -> Column:
    """The first path, in key order, at which two nested values differ."""
    ours, theirs = flat_values(left, kind, path), flat_values(right, kind, path)
    changed = F.array_union(F.array_except(ours, theirs), F.array_except(theirs, ours))
    return F.try_element_at(F.sort_array(F.transform(changed, lambda leaf: leaf["path"])), F.lit(1))


# Structured messages -----------------------------------------------------------------

BLOCKER_PREFIX = "SOURCE_BLOCKER_V1:"
RECEIPT = "schemaVersion STRING, status STRING, arxivId STRING, failureClass STRING, provisionalCandidateIds ARRAY<STRING>"
BLOCKER = f"schemaVersion STRING, kind STRING, observedAt STRING, receipt STRUCT<{RECEIPT.replace(' STRING', ': STRING').replace(' ARRAY', ': ARRAY')}>"
UNSAFE_TEXT = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f]"
_ISO_Z = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$"


def iso_time(c: Column | str) -> Column:
    """Canonical UTC text with milliseconds of a UTC wall time."""
    return F.date_format(_column(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def parse_iso(c: Column | str) -> Column:
    """A canonical UTC text as UTC wall time; null for any other form."""
    text = _column(c)
    parsed = F.when(text.rlike(_ISO_Z), F.substr(text, F.lit(1), F.lit(23))).try_cast("timestamp_ntz")
    return F.when(iso_time(parsed) == text, parsed)


def receipt_is_valid(receipt: Column) -> Column:
    ids = receipt["provisionalCandidateIds"]
    return F.coalesce(
        (receipt["schemaVersion"] == "1.0") & (receipt["status"] == "source_incomplete")
        & is_paper_id(receipt["arxivId"])
        & receipt["failureClass"].isin(config.MODEL_FAILURE, config.PROBE_FAILURE)
        & F.forall(ids, is_paper_id) & (F.size(F.array_distinct(ids)) == F.size(ids)),
        F.lit(False))


def encode_blocker(receipt: Column, observed_at: Column, prefix: str = BLOCKER_PREFIX) -> Column:
    """Message text for a receipt; null when the receipt or the text is unsafe."""
    payload = F.to_json(F.struct(F.lit("1.0").alias("schemaVersion"), F.lit("source_blocker").alias("kind"),
                                 iso_time(observed_at).alias("observedAt"), receipt.alias("receipt")))
    valid = receipt_is_valid(receipt) & observed_at.isNotNull()
    return let(F.concat(F.lit(prefix), payload), lambda message: F.when(
        valid & (F.char_length(message) <= config.MAX_MESSAGE_CHARACTERS) & ~message.rlike(UNSAFE_TEXT), message))


def decode_blocker(c: Column | str, prefix: str = BLOCKER_PREFIX) -> Column:
    """``struct<blocker, malformed>``: both empty for ordinary text."""
    def decoded(text: Column) -> Column:
        reserved = F.coalesce(text.startswith(prefix), F.lit(False))
        body = F.substr(text, F.lit(len(prefix) + 1))
        # The message is parsed once; the conditions below read its parts.
        parts = F.struct(F.from_json(F.when(reserved, body), BLOCKER).alias("payload"), F.sort_array(F.json_object_keys(body)).alias("keys"),
                         F.sort_array(F.json_object_keys(F.get_json_object(body, "$.receipt"))).alias("receipt_keys"))

        def judged(read: Column) -> Column:
            payload = read["payload"]
            valid = F.coalesce(
                (read["keys"] == F.array(*[F.lit(k) for k in ("kind", "observedAt", "receipt", "schemaVersion")]))
                & (read["receipt_keys"] == F.array(*[F.lit(k) for k in (
                    "arxivId", "failureClass", "provisionalCandidateIds", "schemaVersion", "status")]))
                & (payload["schemaVersion"] == "1.0") & (payload["kind"] == "source_blocker")
                & parse_iso(payload["observedAt"]).isNotNull() & receipt_is_valid(payload["receipt"])
                & (F.char_length(text) <= config.MAX_MESSAGE_CHARACTERS) & ~text.rlike(UNSAFE_TEXT),
                F.lit(False))
            return let(valid, lambda holds: F.struct(F.when(reserved & holds, payload).alias("blocker"), (reserved & ~holds).alias("malformed")))

        return let(parts, judged)

    return let(_column(c), decoded)


# Paths and source text ------------------------------------------------------------------

# Extensions read as text, and those that may be skipped when broken.
TEXT_EXTENSIONS = (".tex", ".ltx", ".bib", ".bbl", ".txt", ".md", ".cls", ".sty", ".def", ".cfg",
                   ".ins", ".dtx", ".json", ".yaml", ".yml")
OPTIONAL_EXTENSIONS = (".bib", ".bbl")


def safe_path(c: Column | str) -> Column:
    """A relative path without dot segments; null when it could escape."""
    text = _column(c)
    # A step up takes the last name away; one that finds none stays and is refused.
    steps = F.filter(F.split(text, "/", -1), lambda s: ~s.isin("", "."))
    bare = F.array_join(F.aggregate(steps, F.array().cast("array<string>"), lambda names, s: F.when(
        (s == "..") & (F.coalesce(F.try_element_at(names, F.lit(-1)), F.lit("..")) != ".."),
        F.slice(names, 1, F.greatest(F.size(names) - 1, F.lit(0)))).otherwise(F.concat(names, F.array(s)))), "/")
    bad = (
        (F.char_length(text) < 1) | (F.char_length(text) > 1024) | text.startswith("/")
        | text.contains("\\") | text.rlike("[\\x00-\\x1f\\x7f]")
        | bare.rlike("(?:^|/)\\.\\.(?:/|$)") | (bare == "") | text.endswith("/")
    )
    return F.when(~F.coalesce(bad, F.lit(True)), bare)


def text_kind(c: Column | str) -> Column:
    """``text``, ``optional``, ``bare`` (no extension) or ``other``."""
    name = F.regexp_extract(_column(c), "([^/]*)$", 1)
    extension = F.lower(F.regexp_extract(name, "^.+(\\.[^.]*)$", 1))
    return (
        F.when(extension.isin(*OPTIONAL_EXTENSIONS), "optional")
        .when(extension.isin(*TEXT_EXTENSIONS), "text")
        .when(extension == "", "bare")
        .otherwise("other")
    )


def is_tex(c: Column | str) -> Column:
    sample = F.substr(_column(c), F.lit(1), F.lit(256 * 1024))
    return sample.rlike("\\\\(?:documentclass|begin\\s*\\{document\\}|section\\s*\\{|title\\s*\\{)")


def clean_source(c: Column | str) -> Column:
    """Repairs two legacy quote controls; null when other controls remain."""
    text = F.translate(_column(c), "\u0093\u0094", "“”")
    return F.when(~text.rlike(UNSAFE_TEXT), text)


# Readiness of a check row ------------------------------------------------------------------

def classify_readiness(status: Column, kind: Column, ready: Column, pdf_ready: Column,
                       is_latest: Column) -> Column:
    """ready / ready_pdf_fallback / defer / fail."""
    temporary = status.isNull() | status.isin(408, 425, 429, 500, 502, 503, 504)
    return (
        F.when(ready, "ready")
        .when((kind == "source") & pdf_ready, "ready_pdf_fallback")
        .when(temporary | ((status == 404) & is_latest), "defer")
        .otherwise("fail")
    )


def check_response(kind: Column, status: Column, content_type: Column, url: Column, expected: Column) -> Column:
    """True / false for a usable check, null for a redirect or wrong type."""
    pdf = content_type.rlike(r"(?i)^application/pdf(?:\s*;|$)")
    source = content_type.rlike(
        r"(?i)^application/(?:gzip|x-gzip|x-eprint|x-eprint-tar|x-tar|octet-stream|pdf)(?:\s*;|$)")
    typed = F.when(kind == "pdf", pdf).otherwise(source)
    return F.when(status != 200, F.lit(False)).when((url == expected) & F.coalesce(typed, F.lit(False)), F.lit(True))


