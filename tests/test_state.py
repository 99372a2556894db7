"""Retry, publication, drafts and imports; batch against stream."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dayfolio.functions import records as R
from dayfolio.operators import aggregates as A
from dayfolio.plans import jobs as J
from dayfolio.streaming import ingest, state

T0 = datetime(2026, 7, 10, 0, 0)
KEYS = ["job", "category"]
SCHEMA = ("job string, category string, attempt_id string, event_id string, stage string, status string, at timestamp_ntz, "
          "structured boolean, observed_at timestamp_ntz")


def event(n, attempt, status, hours, stage="category_generation", structured=False, observed=None, job="j", category="gr-qc"):
    at = T0 + timedelta(hours=hours)
    return (job, category, attempt, f"{n:032x}", stage, status, at, structured, at if observed is None else T0 + timedelta(hours=observed))


def retry(spark, rows, now_hours, order=None):
    df = spark.createDataFrame(rows if order is None else [rows[i] for i in order], SCHEMA)
    now = F.lit(T0 + timedelta(hours=now_hours)).cast("timestamp_ntz")
    found = J.retry_state(df, KEYS, now).collect()
    return found[0].asDict() if found else None


def test_failures_follow_the_ordinary_schedule(spark):
    rows = [event(i, f"a{i}", "failed", i) for i in range(5)]
    for n, delay in ((1, 1.0), (2, 4.0), (3, 12.0), (4, 24.0), (5, 24.0)):
        got = retry(spark, rows[:n], 5)
        assert (got["failure_count"], got["delay_hours"]) == (n, delay)
        assert got["retry_at"] == T0 + timedelta(hours=n - 1 + delay)


def test_structured_failures_have_their_own_schedule(spark):
    rows = [event(1, "a", "failed", 0), event(2, "b", "failed", 1, structured=True), event(3, "c", "failed", 2, structured=True)]
    got = retry(spark, rows, 2)
    assert (got["kind"], got["source_failure_count"], got["delay_hours"], got["should_defer"]) == ("source_incomplete", 2, 4.0, True)
    got = retry(spark, rows + [event(4, "d", "failed", 3)], 3)
    assert (got["kind"], got["failure_count"], got["delay_hours"]) == ("generation_failure", 4, 4.0)


def test_success_clears_and_duplicates_count_once(spark):
    rows = [event(1, "a", "failed", 0), event(2, "b", "completed", 1), event(3, "c", "failed", 2), event(4, "c", "failed", 3)]
    got = retry(spark, rows, 3)
    assert (got["failure_count"], got["delay_hours"], got["latest_attempt_id"]) == (1, 1.0, "c")
    assert retry(spark, rows[:2], 3) is None
    assert retry(spark, rows, 3, order=[3, 0, 2, 1]) == got


def test_orphans_need_five_hours_and_no_end(spark):
    start = [event(1, "a", "started", 0)]
    assert retry(spark, start, 4.99) is None
    assert retry(spark, start, 5)["kind"] == "generation_failure"
    assert retry(spark, start + [event(2, "a", "failed", 1, stage="publication")], 9) is None
    assert retry(spark, start + [event(2, "a", "failed", 1, stage="category_repair")], 9)["kind"] == "repair_failure"


def test_receipt_beats_ordinary_failure_of_the_same_attempt(spark):
    rows = [event(1, "a", "failed", 0, structured=True, observed=0), event(2, "a", "failed", 3)]
    assert retry(spark, rows, 3)["kind"] == "source_incomplete"
    best = J.dedupe_attempts(spark.createDataFrame(rows, SCHEMA), KEYS).collect()
    assert len(best) == 1 and best[0].structured
    counts = A.failure_counts(spark.createDataFrame(rows, SCHEMA).withColumn("failed", F.col("status") == "failed"), KEYS).first()
    assert (counts.failures, counts.structured_failures, counts.ordinary_failures) == (1, 1, 0)


def test_deferral_depends_on_mode(spark):
    df = spark.createDataFrame([("repair", True, False), ("source_resume", True, True), ("source_resume", True, False), ("generation", True, False)],
                               "mode string, wait boolean, structured boolean")
    got = [tuple(r[0]) for r in df.select(J.deferral(F.col("mode"), F.col("wait"), F.col("structured"))).collect()]
    assert got == [(False, False), (False, True), (True, False), (True, False)]


def test_next_action(spark):
    jobs = spark.createDataFrame([("j", c) for c in "abcde"], "job string, category string")
    complete = jobs.where("category = 'a'")
    drafts = spark.createDataFrame([("j", "b", 1, "x", True), ("j", "c", 1, "x", True), ("j", "c", 2, "x", False), ("j", "d", 1, "x", False)],
                                   "job string, category string, at int, event_id string, has_receipt boolean")
    rows = [event(i, f"r{i}", "failed", i, stage="category_repair", category="d") for i in range(4)]
    got = {r.category: r.action for r in J.next_action(jobs, complete, drafts, spark.createDataFrame(rows, SCHEMA), KEYS).collect()}
    assert got == {"a": "reuse", "b": "resume", "c": "repair", "d": "regenerate", "e": "generate"}


def test_publication_is_terminal_and_conflicts_are_seen(spark):
    rows = [("a", 1, "1", "pending", None), ("a", 2, "2", "published", "c1"), ("b", 1, "1", "published", "c1"), ("b", 2, "2", "published", "c2"), ("c", 1, "1", "failed", None)]
    df = spark.createDataFrame(rows, "job string, at int, event_id string, status string, commit string")
    got = {r.job: (r.last_status, r.published_commit, r.conflicting) for r in A.publication_state(df, ["job"]).collect()}
    assert got == {"a": ("published", "c1", False), "b": ("published", "c2", True), "c": ("failed", None, False)}


def test_imports_are_idempotent_by_content(spark):
    records = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("c", "z"), ("d", "1"), ("d", "2"), ("e", "")], "k string, payload string")
    stored = spark.createDataFrame([("b", "y"), ("c", "other")], "k string, payload string").select("k", F.sha2("payload", 256).alias("sha256"))
    fresh, refused = J.import_records(records, stored, ["k"], [lambda df: F.length("payload") > 0])
    assert [r.k for r in fresh.collect()] == ["a"]
    assert {r.k: r.reason for r in refused.collect()} == {
        "c": "differs from the stored record", "d": "conflicting arrivals", "e": "failed validation"}


def test_open_jobs_keeps_the_stored_run(spark):
    schema = "k string, evaluationRunId string, createdAt int, snapshotSha256 string"
    stored = spark.createDataFrame([("a", "r1", 1, "s"), ("a", "r2", 2, "s")], schema)
    asked = spark.createDataFrame([("a", "r9", 9, "s"), ("b", "r5", 5, "t"), ("b", "r6", 6, "t"), ("a", "r8", 8, "different")], schema)
    jobs, refused = J.open_jobs(stored, asked, ["k"])
    assert {(r.k, r.evaluationRunId, r.opened) for r in jobs.collect()} == {("a", "r1", False), ("b", "r5", True)}
    assert [(r.k, r.evaluationRunId) for r in refused.collect()] == [("a", "r8")]


def test_receipts(spark):
    ids = [f"2502.{i:05d}" for i in range(15)]
    announced = spark.createDataFrame([("d", "s", i) for i in ids], "report_date string, slug string, id string")
    schema = "report_date string, slug string, arxivId string, failureClass string, provisionalCandidateIds array<string>"
    good = ("d", "s", ids[3], J.config.MODEL_FAILURE, ids[:12])
    assert J.check_receipt(spark.createDataFrame([good], schema), announced).isEmpty()
    bad = [("d", "s", ids[14], J.config.MODEL_FAILURE, ids[:12]), ("d", "s", ids[0], "nope", ids[:11]), ("d", "s", ids[0], J.config.MODEL_FAILURE, ids[:11] + ["2502.99999"])]
    assert J.check_receipt(spark.createDataFrame(bad, schema), announced).count() == 4
    made, refused = J.probe_failure(spark.createDataFrame([good], schema), spark.createDataFrame([("d", "s", ids[5]), ("d", "s", ids[14])], "report_date string, slug string, arxivId string"))
    assert [(r.arxivId, r.failureClass) for r in made.collect()] == [(ids[5], J.config.PROBE_FAILURE)]
    assert [r.arxivId for r in refused.collect()] == [ids[14]]


@pytest.fixture()
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark


def test_retry_stream_equals_batch(rocks, tmp_path):
    spark = rocks
    rows = [event(1, "a", "failed", 0), event(2, "b", "started", 1), event(3, "b", "failed", 2, structured=True, observed=1.5),
            event(4, "c", "completed", 3, category="hep-th"), event(5, "d", "failed", 4, category="hep-th"), event(6, "e", "started", 1, category="quant-ph"),
            event(7, "f", "failed", 2, job="k"), event(8, "g", "completed", 3, job="k"), event(9, "z", "deferred", 12, job="z")]
    late = [event(10, "a0", "failed", 0.5), event(11, "h", "failed", 2.5, job="k")]
    for i, part in enumerate((rows[:4], rows[4:], late + rows[:2])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/p{i}.parquet")
    events = ingest.table_stream(spark, f"{tmp_path}/in/*", "*.parquet", SCHEMA, 1)
    stream = state.retry_stream(events.withColumn("event_time", F.col("at").cast("timestamp")), KEYS, "10 days")
    ingest.run_changes(stream, f"{tmp_path}/out", f"{tmp_path}/cp", KEYS)
    got = {(r.job, r.category): r for r in ingest.latest_changes(spark, f"{tmp_path}/out", KEYS).where("active").collect()}
    batch = J.retry_state(spark.createDataFrame(rows + late, SCHEMA), KEYS, F.lit(T0 + timedelta(hours=4)).cast("timestamp_ntz")).collect()
    assert {k for k in got} == {(r.job, r.category) for r in batch}
    for r in batch:
        g = got[(r.job, r.category)]
        assert (g.kind, g.failure_count, g.source_failure_count, g.delay_hours, g.observed_at, g.retry_at, g.latest_attempt_id) == (
            r.kind, r.failure_count, r.source_failure_count, r.delay_hours, r.observed_at, r.retry_at, r.latest_attempt_id)


def test_late_events_count_and_are_reported(rocks, tmp_path):
    spark = rocks
    first = [event(1, "a", "failed", 0), event(2, "b", "started", 100), event(3, "n", "deferred", 200, job="other")]
    # Far behind the watermark: a success that ends the first failure, a better failure, and one before a success.
    late = [event(4, "x", "completed", 1), event(5, "c", "failed", 2, structured=True, observed=1.5), event(6, "c", "failed", 3), event(7, "d", "failed", 0.5)]
    parts = (first, [event(8, "m", "deferred", 300, job="other")], late, [event(9, "m", "deferred", 301, job="other"), event(10, "y", "completed", 2.5)])
    for i, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/p{i}.parquet")
    events = ingest.table_stream(spark, f"{tmp_path}/in/*", "*.parquet", SCHEMA, 1)
    stream = state.retry_stream(events.withColumn("event_time", F.col("at").cast("timestamp")), KEYS, "1 hour")
    ingest.run_changes(stream, f"{tmp_path}/out", f"{tmp_path}/cp", KEYS)
    changes = ingest.all_changes(spark, f"{tmp_path}/out")
    assert sorted(int(r.event_id, 16) for r in state.late_events(changes, KEYS).collect()) == [4, 5, 6, 7, 10]
    got = {r.job: r for r in ingest.latest_changes(spark, f"{tmp_path}/out", KEYS).where("active").collect()}
    want = J.retry_state(spark.createDataFrame([e for p in parts for e in p], SCHEMA), KEYS, F.lit(T0 + timedelta(hours=301)).cast("timestamp_ntz")).collect()
    assert len(want) == 1 and set(got) == {"j"}
    assert (got["j"].kind, got["j"].failure_count, got["j"].latest_attempt_id, got["j"].retry_at) == (want[0].kind, want[0].failure_count, want[0].latest_attempt_id, want[0].retry_at)


def test_attempt_state_forgets_what_cannot_matter():
    import itertools
    import random

    rng = random.Random(3)
    for _ in range(300):
        failures = [(rng.random() < 0.4, rng.randrange(6), rng.randrange(6), str(k), "s") for k in range(rng.randrange(1, 6))]
        own = state.Attempt()
        for f in failures:
            own.add(f)
        again = state.Attempt(own.value())
        for done in itertools.product(range(-1, 6), ["0", "9"]):
            left = [f for f in failures if f[2:4] > done]
            kept = state.Attempt(again.value())
            assert kept.since(done) == bool(left)
            if left:
                best = max(left, key=lambda f: f[:4])
                assert kept.outcome("a", 0)[:3] == best[1:4]
        assert len(own.failures) <= len(failures)
    many = state.Attempt()
    for k in range(1000):  # failures that only get newer leave one
        many.add((False, k, k, str(k), "s"))
    assert len(many.failures) == 1


def test_publication_stream_equals_batch(rocks, tmp_path):
    spark = rocks
    schema = "job string, at timestamp_ntz, event_id string, status string, commit string"
    rows = [("a", T0, "1", "pending", None), ("a", T0 + timedelta(hours=2), "2", "published", "c1"), ("b", T0, "3", "published", "c1"),
            ("b", T0, "4", "published", "c2"), ("a", T0 + timedelta(hours=1), "5", "publishing", None)]
    for i, part in enumerate((rows[:3], rows[3:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/in/p{i}.parquet")
    stream = state.publication_stream(ingest.table_stream(spark, f"{tmp_path}/in/*", "*.parquet", schema, 1), ["job"])
    ingest.run_changes(stream, f"{tmp_path}/out", f"{tmp_path}/cp", ["job"])
    got = {r.job: (r.last_status, r.published_commit, r.conflicting) for r in ingest.latest_changes(spark, f"{tmp_path}/out", ["job"]).collect()}
    want = {r.job: (r.last_status, r.published_commit, r.conflicting) for r in A.publication_state(spark.createDataFrame(rows, schema), ["job"]).collect()}
    assert got == want


def test_new_dates_and_imports_from_streams(spark, tmp_path):
    for i, days in enumerate((["2026-07-08", "2026-07-09"], ["2026-07-09", "2026-07-10"])):
        spark.createDataFrame([(d, d) for d in days], "date string, payload string").coalesce(1).write.parquet(f"{tmp_path}/in/p{i}.parquet")
    spark.createDataFrame([("2026-07-08",)], "date string").write.parquet(f"{tmp_path}/published")
    stream = ingest.table_stream(spark, f"{tmp_path}/in/*", "*.parquet", "date string, payload string", 1)
    ingest.new_dates_stream(stream, f"{tmp_path}/published", f"{tmp_path}/queue", f"{tmp_path}/c1").awaitTermination()
    queue = spark.read.parquet(f"{tmp_path}/queue")
    assert sorted(r.date for r in queue.collect()) == ["2026-07-09", "2026-07-10"]
    assert ingest.next_queued(spark, f"{tmp_path}/queue", f"{tmp_path}/published").first().date == "2026-07-09"
    ingest.import_stream(stream, f"{tmp_path}/store", f"{tmp_path}/refused", f"{tmp_path}/c2", ["date"]).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/store").count() == 3
    assert spark.read.parquet(f"{tmp_path}/refused").count() == 0


def test_streams_go_on_after_a_restart(rocks, tmp_path):
    spark = rocks
    schema = "date string, payload string"

    def land(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{name}.parquet")

    def run():
        stream = ingest.table_stream(spark, f"{tmp_path}/in/*", "*.parquet", schema, 1)
        ingest.new_dates_stream(stream, f"{tmp_path}/published", f"{tmp_path}/queue", f"{tmp_path}/c1").awaitTermination()
        ingest.import_stream(stream, f"{tmp_path}/store", f"{tmp_path}/refused", f"{tmp_path}/c2", ["date"], [lambda df: F.length("payload") > 0]).awaitTermination()

    land("a", [("1", "x"), ("1", "x"), ("2", "y"), ("3", "p"), ("3", "q"), ("4", "")])
    run()
    land("b", [("1", "x"), ("2", "other"), ("3", "p"), ("4", "z"), ("5", "w"), ("5", "w")])
    land("c", [("5", "v"), ("3", "p"), ("6", "u")])
    run()
    assert sorted((r.date, r.payload) for r in spark.read.parquet(f"{tmp_path}/store").collect()) == [("1", "x"), ("2", "y"), ("3", "p"), ("4", "z"), ("5", "w"), ("6", "u")]
    assert sorted((r.date, r.reason) for r in spark.read.parquet(f"{tmp_path}/refused").collect()) == [
        ("2", "differs from the stored record"), ("3", "conflicting arrivals"), ("4", "failed validation"), ("5", "differs from the stored record")]
    assert sorted(r.date for r in spark.read.parquet(f"{tmp_path}/queue").collect()) == ["1", "2", "3", "4", "5", "6"]


def test_attempt_rows_decode_receipts(spark):
    receipt = {"schemaVersion": "1.0", "status": "source_incomplete", "arxivId": "2502.00001", "failureClass": J.config.PROBE_FAILURE,
               "provisionalCandidateIds": ["2502.00001"]}
    good = R.BLOCKER_PREFIX + json.dumps({"schemaVersion": "1.0", "kind": "source_blocker", "observedAt": "2026-07-10T01:00:00.000Z", "receipt": receipt}, separators=(",", ":"))
    base = {"schemaVersion": "1.0", "kind": "attempt", "eventId": "0" * 32, "attemptId": "a", "reportDate": "2026-07-10", "snapshotFingerprint": "s",
            "runtimeFingerprint": "r", "evaluationRunId": "e", "at": "2026-07-10T02:00:00.000Z", "status": "failed", "stage": "category_generation", "category": "gr-qc"}
    from tests_support import frame
    from dayfolio import schemas
    rows = J.attempt_rows(frame(spark, [{**base, "message": m} for m in (good, "text", R.BLOCKER_PREFIX + "{}")], schemas.ATTEMPT)).collect()
    assert [(r.structured, r.malformed) for r in rows] == [(True, False), (False, False), (False, True)]
    assert rows[0].observed_at == datetime(2026, 7, 10, 1) and rows[1].observed_at == datetime(2026, 7, 10, 2)


def test_import_stream_brings_its_own_state_store(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.unset(provider)
    try:
        spark.createDataFrame([("a", "one"), ("b", "two"), ("a", "one")], "date string, payload string").write.parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("date string, payload string").parquet(f"{tmp_path}/in")
        ingest.import_stream(stream, f"{tmp_path}/store", f"{tmp_path}/refused", f"{tmp_path}/c", ["date"]).awaitTermination()
        assert sorted(r.date for r in spark.read.parquet(f"{tmp_path}/store").collect()) == ["a", "b"]
    finally:
        spark.conf.set(provider, before)


class Held:
    """State of one key in memory, which counts how often it is asked."""

    def __init__(self):
        self.values, self.calls, self.timers = {}, 0, []

    def _call(self, result=None):
        self.calls += 1
        return result

    getValueState = getMapState = lambda self, name, *schema: setattr(self, name, Cell(self)) or getattr(self, name)
    registerTimer = lambda self, at: self._call(self.timers.append(at))


class Cell:
    def __init__(self, held):
        self.held, self.value, self.map = held, None, {}

    exists = lambda self: self.held._call(self.value is not None)
    get = lambda self: self.held._call(self.value)
    update = lambda self, value: self.held._call(setattr(self, "value", value))
    containsKey = lambda self, key: self.held._call(key in self.map)
    getValue = lambda self, key: self.held._call(self.map.get(key))
    updateValue = lambda self, key, value: self.held._call(self.map.__setitem__(key, value))
    removeKey = lambda self, key: self.held._call(self.map.pop(key))
    iterator = lambda self: self.held._call(iter(dict(self.map).items()))


class Watermark:
    getCurrentWatermarkInMs = lambda self: 0


def _reply(processor, rows):
    from pyspark.sql import Row

    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return list(processor.handleInputRows(("j", "gr-qc"), iter([Row(**dict(zip(names, row))) for row in rows]), Watermark()))


def test_state_is_asked_once_for_what_a_success_ends():
    held, processor = Held(), state.RetryProcessor()
    processor.keys = list(KEYS)
    processor.init(held)
    ended = [event(i, f"a{i}", ("failed", "started")[i % 2], i) for i in range(40)]
    got = _reply(processor, [*ended, event(40, "s", "completed", 40), event(41, "n", "failed", 41), event(42, "m", "started", 42)])
    assert [(r.failure_count, r.latest_attempt_id) for r in got] == [(1, "n")] and sorted(held.attempts.map) == [("m",), ("n",)]
    assert held.calls <= 6 and len(held.timers) == 1  # success, attempts, success, two attempts, a timer
    held.calls = 0
    assert _reply(processor, ended)[0].failure_count == 1 and held.calls == 2  # nothing new is told


def test_state_in_batches_is_that_of_one_batch():
    import random

    rng = random.Random(8)
    for _ in range(200):
        rows = [event(i, rng.choice("abc"), rng.choice(["started", "failed", "failed", "deferred", "completed"]), rng.randrange(12), rng.choice(["category_generation", "category_repair", "publication"]),
                      structured=rng.random() < 0.3, observed=rng.randrange(12)) for i in range(rng.randrange(1, 9))]
        ends = []
        for parts in ([rows], [[row] for row in rng.sample(rows, len(rows))], [rows[:3], rows[2:]]):
            held, processor = Held(), state.RetryProcessor()
            processor.keys = list(KEYS)
            processor.init(held)
            for part in parts:
                _reply(processor, part)
            ends.append((held.done.value, {k: (sorted(v[0]), *v[1:]) for k, v in held.attempts.map.items()}))
        assert ends[0] == ends[1] == ends[2]
