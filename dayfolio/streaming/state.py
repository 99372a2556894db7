"""Keyed retry, import and publication state over event streams.

The state keeps, per attempt, only what can still matter: its newest start and
end after the last success, and those of its failures that no later one
outranks. Events may arrive twice and as late as they like; the answer depends
on their times, not on their arrival.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from dayfolio import config

cloudpickle.register_pickle_by_value(sys.modules[__name__])

EPOCH = datetime(1970, 1, 1)
EVENT_COLUMNS = ("attempt_id", "event_id", "stage", "status", "at", "structured", "observed_at")
RETRY_OUTPUT = ("{keys}, kind STRING, failure_count BIGINT, source_failure_count BIGINT, delay_hours DOUBLE, "
                "observed_at TIMESTAMP_NTZ, retry_at TIMESTAMP_NTZ, latest_attempt_id STRING, active BOOLEAN, as_of TIMESTAMP_NTZ, "
                "late_event_id STRING, late_event_at TIMESTAMP_NTZ")
#: An attempt's failures (the receipt, when seen, when, which event, at which stage), newest start and newest end.
ATTEMPT_STATE = ("failures ARRAY<STRUCT<structured: BOOLEAN, observed: BIGINT, at: BIGINT, event: STRING, stage: STRING>>, "
                 "start_at BIGINT, start_event STRING, end_at BIGINT, end_event STRING")
RETRY_STAGES, START_STAGES = config.RETRY_STAGES, config.START_STAGES
RETRY_HOURS, PROBE_HOURS, ORPHAN_HOURS = config.RETRY_HOURS, config.PROBE_RETRY_HOURS, config.ORPHAN_HOURS
HOUR = 3_600_000_000


def use_typed_state(spark: SparkSession) -> None:
    """Sets the state store that processors of this module need; Spark's default one cannot hold typed state."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _micros(value: datetime) -> int:
    return (value.replace(tzinfo=None) - EPOCH) // timedelta(microseconds=1)


def _time(micros: int) -> datetime:
    return EPOCH + timedelta(microseconds=micros)


class Attempt:
    """What is known of an attempt since the last success; orders are (time, event)."""

    def __init__(self, value: tuple | None = None):
        failures, start_at, start_event, end_at, end_event = value or (None, None, None, None, None)
        self.failures = [tuple(f) for f in failures or ()]
        self.start = None if start_at is None else (start_at, start_event)
        self.end = None if end_at is None else (end_at, end_event)

    def value(self) -> tuple:
        return (self.failures, *(self.start or (None, None)), *(self.end or (None, None)))

    def add(self, failure: tuple) -> None:
        """Keeps a failure unless one that is no older ranks as high: that one counts whenever this one does."""
        over = lambda a, b: a[:4] >= b[:4] and a[2:4] >= b[2:4]
        if not any(over(f, failure) for f in self.failures):
            self.failures = [f for f in self.failures if not over(failure, f)] + [failure]

    def merge(self, other: Attempt) -> None:
        """Adds what else is known of the attempt."""
        self.start = max(filter(None, (self.start, other.start)), default=None)
        self.end = max(filter(None, (self.end, other.end)), default=None)
        for failure in other.failures:
            self.add(failure)

    def since(self, done: tuple) -> bool:
        """Forgets what is not after the success; whether anything is left."""
        self.failures = [f for f in self.failures if f[2:4] > done]
        self.start = self.start if self.start and self.start > done else None
        self.end = self.end if self.end and self.end > done else None
        return bool(self.failures or self.start or self.end)

    def outcome(self, name: str, now: int) -> tuple | None:
        """(observed, at, event, attempt, structured, kind) of the attempt's failure, or of its start if that has waited too long."""
        if self.failures:
            structured, observed, at, event, stage = max(self.failures, key=lambda f: f[:4])
            kind = "source_incomplete" if structured else "repair_failure" if stage == "category_repair" else "generation_failure"
            return observed, at, event, name, structured, kind
        if self.start and (not self.end or self.start > self.end) and self.start[0] + ORPHAN_HOURS * HOUR <= now:
            return self.start[0], *self.start, name, False, "generation_failure"
        return None


def _summary(attempts: Iterable[tuple[str, Attempt]], now: int) -> tuple | None:
    """Retry answer: kind, failures, those with a receipt, delay, when the latest was seen, retry time, its attempt."""
    outcomes = [o for o in (a.outcome(name, now) for name, a in attempts) if o]
    if not outcomes:
        return None
    latest, structured = max(outcomes), sum(o[4] for o in outcomes)
    schedule, count = (PROBE_HOURS, structured) if latest[4] else (RETRY_HOURS, len(outcomes) - structured)
    delay = schedule[min(count, len(schedule)) - 1]
    return latest[5], len(outcomes), structured, delay, latest[0], latest[0] + int(delay * HOUR), latest[3]


class RetryProcessor(StatefulProcessor):
    """Emits the retry state of a key whenever events or an orphan timeout change it, and each event behind the watermark."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.done = handle.getValueState("done", "at BIGINT, event STRING")
        self.attempts = handle.getMapState("attempts", "attempt STRING", ATTEMPT_STATE)

    def _row(self, key, now: int, answer: tuple | None, late: tuple | None = None) -> Row:
        kind, failures, structured, delay, observed, retry, attempt = answer or (None, 0, 0, None, None, None, None)
        return Row(**dict(zip(self.keys, key)), **{
            "kind": kind, "failure_count": failures, "source_failure_count": structured, "delay_hours": delay,
            "observed_at": None if observed is None else _time(observed), "retry_at": None if retry is None else _time(retry),
            "latest_attempt_id": attempt, "active": answer is not None, "as_of": _time(now),
            "late_event_id": late and late[1], "late_event_at": _time(late[0]) if late else None})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = done = self.done.get()
        newest, watermark = 0, timerValues.getCurrentWatermarkInMs()
        arrived: dict[str, Attempt] = {}
        late: list[tuple] = []
        for e in rows:
            order = (_micros(e.at), str(e.event_id))
            newest = max(newest, order[0])
            if order[0] < watermark * 1000:
                late.append(order)
            status = e.status
            if status == "completed":
                done = max(done, order) if done else order
                continue
            if done and order <= done or status not in ("started", "failed") or status == "started" and e.stage not in START_STAGES:
                continue
            own, structured = arrived.setdefault(str(e.attempt_id), Attempt()), bool(e.structured)
            if status == "started":
                own.start = max(own.start or order, order)
            else:
                own.end = max(own.end or order, order)
                if structured or e.stage in RETRY_STAGES:
                    own.add((structured, _micros(e.observed_at), *order, str(e.stage)))
        # The state is read once, and told only what is left after the newest success.
        held = {name[0]: Attempt(value) for name, value in self.attempts.iterator()}
        stored = {name: own.value() for name, own in held.items()}
        for name, own in arrived.items():
            held.setdefault(name, Attempt()).merge(own)
        if done != before:
            self.done.update(done)
        for name, own in list(held.items()):
            if done and not own.since(done):
                del held[name]
                if name in stored:
                    self.attempts.removeKey((name,))
                continue
            value = own.value()
            if value == stored.get(name):
                continue
            due = own.start and own.start[0] // 1000 + ORPHAN_HOURS * 3_600_000 + 1
            if due and (name not in stored or value[1:3] != stored[name][1:3]) and due > watermark:
                self.handle.registerTimer(due)
            self.attempts.updateValue((name,), value)
        now = max(newest, watermark * 1000)
        yield self._row(key, now, _summary(held.items(), now))
        for event in late:
            yield self._row(key, now, None, event)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        yield self._row(key, now, _summary(((name[0], Attempt(value)) for name, value in self.attempts.iterator()), now))

    def close(self) -> None:
        pass


class ImportProcessor(StatefulProcessor):
    """Adds a record whose key is new; other bytes for a known key are refused. The state is the digest of each key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "sha256 STRING")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.held.get()[0] if self.held.exists() else None
        arrivals = pd.concat(list(rows)).sort_values("batch", kind="stable")
        reasons = []
        for low, high, valid in arrivals[["sha256", "high", "valid"]].itertuples(index=False):
            reason = ("failed validation" if not valid else "conflicting arrivals" if low != high else
                      "differs from the stored record" if held not in (None, low) else "held" if held else None)
            if reason is None:
                held = low
                self.held.update((low,))
            reasons.append(reason)
        arrivals["reason"] = pd.Series(reasons, index=arrivals.index, dtype=object)
        kept = arrivals[arrivals["reason"] != "held"]
        if len(kept):
            yield kept.drop(columns=["high", "valid"])

    def close(self) -> None:
        pass


def _fields(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)


def retry_stream(events: DataFrame, keys: list[str], late: str) -> DataFrame:
    """Stream form of ``retry_state``: one row per change of a key, and one per late event.

    ``events`` needs ``event_time`` (TIMESTAMP) for the watermark besides the
    working columns of ``attempt_rows``. The watermark, ``late`` behind the
    newest event, drives the orphan timers. It drops nothing: an event behind
    it counts as its time says, and is reported in a row of its own with
    ``late_event_id`` (see ``late_events``). Repeated events count once, as the
    state takes the newest of each kind.
    """
    use_typed_state(events.sparkSession)
    processor = RetryProcessor()
    processor.keys = list(keys)
    watched = events.withWatermark("event_time", late)
    # Without the watermark's column the operator has nothing to drop by.
    grouped = watched.select(*keys, *EVENT_COLUMNS).groupBy(*keys)
    return grouped.transformWithState(
        statefulProcessor=processor, outputStructType=T._parse_datatype_string(RETRY_OUTPUT.format(keys=_fields(events, list(keys)))),
        outputMode="Update", timeMode="EventTime")


def late_events(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The events that came behind the watermark, from the rows of ``retry_stream``."""
    return changes.where("late_event_id is not null").select(*keys, F.col("late_event_id").alias("event_id"), F.col("late_event_at").alias("at"), "as_of")


def publication_stream(events: DataFrame, keys: list[str]) -> DataFrame:
    """Stream form of ``publication_state``: columns at, event_id, status, commit.

    Last status and published commit; published is terminal.
    """
    commit = F.when(F.col("status") == "published", F.col("commit"))
    return events.groupBy(*keys).agg(
        F.max_by("status", F.struct("at", "event_id")).alias("last_status"), F.max(commit).alias("published_commit"),
        (F.min(commit) < F.max(commit)).alias("_differ"), F.max(F.col("status") == "published").alias("terminal"),
    ).select(*keys, "last_status", "published_commit", F.coalesce("_differ", F.lit(False)).alias("conflicting"), "terminal")
