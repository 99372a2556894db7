"""Dates, Japan time, English date headings and retry delays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from dayfolio import config
from dayfolio.functions.text import let


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str) -> Column:
    """A ``YYYY-MM-DD`` string as a date; null unless it is a real day."""
    text = _column(c)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def parse_jst(c: Column | str) -> Column:
    """A ``+09:00`` time with seconds as UTC wall time; null when malformed."""
    text = _column(c)
    local = F.substr(text, F.lit(1), F.char_length(text) - 6)
    parsed = F.when(text.rlike(config.JST_PATTERN), local).try_cast("timestamp_ntz")
    return parsed - F.expr("interval 9 hours")


def utc_time(c: Column | str) -> Column:
    """An instant as UTC wall time, whatever the session zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), _column(c).cast("timestamp_ntz"))


def jst_date(utc: Column | str) -> Column:
    """The calendar day in Japan of a UTC wall time."""
    return (_column(utc) + F.expr("interval 9 hours")).cast("date")


def jst_bounds(day: Column | str) -> Column:
    """First instant of a Japan day and of the next one, as UTC wall time."""
    start = _column(day).cast("timestamp_ntz") - F.expr("interval 9 hours")
    return F.struct(start.alias("start"), (start + F.expr("interval 1 day")).alias("end"))


def next_weekday(day: Column | str) -> Column:
    """The following day, skipping Saturday and Sunday."""
    d = _column(day)
    step = F.when(F.weekday(d) == 4, 3).when(F.weekday(d) == 5, 2).otherwise(1)
    return F.date_add(d, step)


def _heading_date(parts: Column, pattern: str, name: str) -> Column:
    """Date of (weekday, day, month, year); null when the weekday is wrong."""
    parsed = F.try_to_date(F.concat_ws(" ", parts[1], parts[2], parts[3]), pattern)
    return let(parsed, lambda d: F.when(F.date_format(d, name) == parts[0], d))


def _parts(text: Column, pattern: str, count: int) -> Column:
    return F.array(*[F.regexp_extract(text, pattern, i) for i in range(1, count + 1)])


def long_heading(c: Column | str) -> Column:
    """Date of "Showing new listings for Friday, 10 July 2026"; null if wrong."""
    pattern = r"^Showing new listings for ([A-Z][a-z]+), ([1-9]|[12]\d|3[01]) ([A-Z][a-z]+) (\d{4})$"
    return let(_parts(_column(c), pattern, 4), lambda p: _heading_date(p, "d MMMM yyyy", "EEEE"))


def short_heading(c: Column | str) -> Column:
    """Date and counts of "Fri, 10 Jul 2026 (showing 3 of 5 entries )"."""
    pattern = (
        r"^([A-Z][a-z]{2}), ([1-9]|[12]\d|3[01]) ([A-Z][a-z]{2}) (\d{4}) "
        r"\(showing (0|[1-9]\d*) of (0|[1-9]\d*) entries \)$"
    )
    read = let(_parts(_column(c), pattern, 6), lambda p: F.struct(
        _heading_date(p, "d MMM yyyy", "EEE").alias("date"), p[4].try_cast("long").alias("shown"), p[5].try_cast("long").alias("total")))
    return let(read, lambda h: F.when(h["date"].isNotNull() & (h["shown"] <= h["total"]), h))


def section_heading(c: Column | str) -> Column:
    """Name and count of "New submissions (showing 3 of 3 entries)"; null unless complete."""
    pattern = r"^(New submissions|Cross submissions) \(showing (0|[1-9]\d*) of (0|[1-9]\d*) entries\)$"
    return let(_parts(_column(c), pattern, 3), lambda p: F.when((p[0] != "") & (p[1] == p[2]),
                                                               F.struct(p[0].alias("name"), p[1].try_cast("long").alias("total"))))


def run_time(c: Column | str) -> Column:
    """Start time held in a scheduled run id, as UTC wall time."""
    text = _column(c)
    stamp = F.concat_ws(" ", F.regexp_extract(text, config.SCHEDULED_RUN_PATTERN, 1),
                        F.regexp_extract(text, config.SCHEDULED_RUN_PATTERN, 2))
    parsed = F.try_to_timestamp(stamp, F.lit("yyyyMMdd HHmmss"))
    return F.when(text.rlike(config.SCHEDULED_RUN_PATTERN), parsed.cast("timestamp_ntz"))


def backoff_hours(structured: Column, count: Column) -> Column:
    """Delay after ``count`` failures of one kind; the last delay repeats."""
    ordinary = F.array(*[F.lit(h) for h in config.RETRY_HOURS])
    probe = F.array(*[F.lit(h) for h in config.PROBE_RETRY_HOURS])
    schedule = F.when(structured, probe).otherwise(ordinary)
    return F.try_element_at(schedule, F.least(count, F.size(schedule)).cast("int"))


def needs_attention(failures: Column | str) -> Column:
    """True for the third failure and every third one after it."""
    following = _column(failures) + 1
    return (following >= 3) & ((following - 3) % 3 == 0)
