"""Readers, page and archive extraction, immutable and published sinks."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

import pages_fixture as P
import tests_support as X
from dayfolio.sources import archives, pages as G, readers, writers as S

TEX = b"\\documentclass{article}\n\\begin{document}Result\\end{document}\n"


def test_listings(spark):
    rows = [("a", "hep-th", P.listing()), ("b", "gr-qc", P.listing(day="Monday, 4 February 2025")), ("c", "gr-qc", P.listing(declared={"New": 8})), ("d", "gr-qc", "x"), ("e", "gr-qc", P.listing(ids={"New": [], "Cross": []}))]
    got = {r.page: r for r in G.extract_listings(spark.createDataFrame(rows, "page string, slug string, html string")).collect()}
    assert (str(got["a"].announcement_date), got["a"].new_ids, got["a"].crosslist_count) == ("2025-02-04", P.SHOWN["New"], 1)
    assert [got[p].reject for p in "bcde"] == ["invalid date heading", "declared counts differ from the entries", "needs exactly one listing element", None]


def test_week(spark):
    good = P.week(P.day("Tue, 4 Feb 2025", ["2502.01234"], ["2502.03456"]), P.day("Mon, 3 Feb 2025", ["2502.00777"], total=9))
    partial = P.week(P.day("Tue, 4 Feb 2025", ["2502.01234"], total=6), P.day("Mon, 3 Feb 2025", ["2502.00777"]))
    df = G.extract_week(spark.createDataFrame([("a", "hep-th", good), ("b", "hep-th", partial)], "page string, slug string, html string"))
    groups = G.week_groups(df).orderBy("place").collect()
    assert [(str(g.announcement_date), g.complete, g.new_ids, g.crosslist_count) for g in groups] == [("2025-02-04", True, ["2502.01234"], 1), ("2025-02-03", False, ["2502.00777"], 0)]
    assert df.where("page = 'b'").first().reject == "a newer group is partial"


def test_abstracts(spark):
    rows = [("ok", P.abstract()), ("v2", P.abstract(version="v2")), ("rotated", P.abstract(cited=("šić, Ana Žar",), visible=("Ana Žaršić",), comments='Data at <a href="https://y.org/d?p=1">this https URL</a> &amp; below')),
            ("other", P.abstract(cited=("Someone, E", "Dal, Jan T.")))]
    df = spark.createDataFrame([(n, P.PAPER["id"], "quant-ph", h) for n, h in rows], "n string, arxivId string, slug string, html string")
    got = {r.n: r for r in G.extract_abstracts(df).collect()}
    assert got["ok"].authors == ["Mina Okoro", "Jan T. Dal"] and got["ok"].comments == "9 pages, one table"
    assert got["v2"].reject == "version marker differs"
    assert got["rotated"].authors == ["Ana Žaršić"] and got["rotated"].comments == "Data at https://y.org/d?p=1 & below"
    assert got["other"].authors == ["Someone, E", "Dal, Jan T."]


ARCHIVES = [
    (P.tar({"paper/main.tex": TEX, "refs.bib": b"@a{x}", "fig.png": b"\0\1"}), ["paper/main.tex", "refs.bib"], None), (gzip.compress(TEX), ["2502.00001.tex"], None),
    (P.tar({"../e.tex": TEX}), None, "traversal"), (P.tar({"main.tex": b"\x5c\xc3\x28"}), None, "UTF-8"), (P.tar({"main.tex": TEX, "r.bib": b"\xc3\x28"}), ["main.tex"], None),
    (b"%PDF-1.7\n", None, "neither"), (gzip.compress(TEX)[:30], None, "unexpected end"), (P.tar({"main.tex": TEX + b"\x1b"}), None, "control")]


def test_damaged_archives_are_rejected_whole(spark):
    whole = P.tar({"a.tex": TEX, "b.tex": TEX, "c.tex": TEX}, compress=False)
    checksum = bytearray(whole)
    checksum[1024 + 148] ^= 1  # in the header of the second member
    cases = {"2502.00001": bytes(checksum), "2502.00002": whole[:1024 + 100], "2502.00003": P.tar({"notes": b"x" * (13 << 20), "a.tex": TEX}, compress=True)}
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in cases.items()], "id string, content binary")
    got = [(r.id, r.path, r.reject is None) for r in archives.extract_sources(df).collect()]
    assert sorted(got, key=repr) == [("2502.00001", None, False), ("2502.00002", None, False), ("2502.00003", "a.tex", True)]


def test_landed_files_are_never_lost(spark, tmp_path):
    (tmp_path / "p").mkdir()
    for name, size in (("a.html", 10), ("b.html", 5000), ("c.html", 0), ("d.html", 4001)):
        (tmp_path / "p" / name).write_text("x" * size)
    good, bad = readers.read_pages(spark, f"{tmp_path}/p", maximum_bytes=4000)
    assert good.count() == 1 and sorted(r.reason for r in bad.collect()) == ["empty", "too large", "too large"]
    for name, size in (("2502.00001.gz", 9), ("2502.00002.gz", 0), ("2502.00003.gz", 99)):
        (tmp_path / name).write_bytes(b"x" * size)
    usable, refused = readers.read_archives(spark, f"{tmp_path}/*.gz", maximum_bytes=50)
    assert [r.id for r in usable.collect()] == ["2502.00001"] and sorted((r.id, r.reason) for r in refused.collect()) == [("2502.00002", "empty"), ("2502.00003", "too large")]


def test_a_table_of_many_files_streams_whole(spark, tmp_path):
    from dayfolio.streaming import ingest

    spark.range(100).repartition(3).write.parquet(f"{tmp_path}/in/events.parquet")
    stream = ingest.table_stream(spark, f"{tmp_path}/in", "events.parquet", "id bigint")
    ingest.run_to_table(ingest.unique_events(stream, ["id"]), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 100


def test_paths_of_any_depth(spark):
    from dayfolio.functions import records as R

    deep = "/".join(["n"] * 12 + [".."] * 12 + ["main.tex"])
    cases = {deep: "main.tex", "a/../../b": None, "./a//b/./c": "a/b/c", "..": None, "a/..": None, "a/": None, "/a": None, "../a": None, "a/b/../c": "a/c"}
    got = spark.createDataFrame([(c,) for c in cases], "p string").select("p", R.safe_path("p").alias("s")).collect()
    assert {r.p: r.s for r in got} == cases


def test_archives(spark):
    df = spark.createDataFrame([(f"2502.{i:05d}", bytearray(c)) for i, (c, _, _) in enumerate(ARCHIVES, 1)], "id string, content binary")
    got = archives.extract_sources(df).collect()
    for i, (_, paths, reject) in enumerate(ARCHIVES, 1):
        rows = [r for r in got if r.id == f"2502.{i:05d}"]
        if reject:
            assert len(rows) == 1 and reject in rows[0].reject
        else:
            assert [r.path.replace(rows[0].id, "2502.00001") for r in rows] == paths and all(r.reject is None for r in rows)


def test_reports_from_files(spark, tmp_path):
    for record in X.report_set()[:2]:
        (tmp_path / f"{X.DATE}-{record['slug']}.json").write_text(json.dumps(record, indent=2, ensure_ascii=False))
    (tmp_path / "stray.json").write_text(json.dumps(X.report("hep-th")))
    reports = readers.read_reports(spark, str(tmp_path))
    assert {(r.kind, r.path) for r in readers.report_file_issues(reports).collect()} == {("name", "file"), ("incomplete", "reports")}


def test_json_quarantine(spark, tmp_path):
    for name, text in {"a": '{"k": 1}', "b": '{"k": 1} {', "c": "{", "d": '{"k": 2, "x": "' + "y" * 500 + '"}'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    good, bad = readers.read_json_bounded(spark, str(tmp_path), "k INT", 200)
    assert [r.k for r in good.collect()] == [1]
    assert {(r.path[-6:], r.reason) for r in bad.collect()} == {("b.json", "invalid JSON"), ("c.json", "invalid JSON"), ("d.json", "exceeds 200 bytes")}


def test_events_from_files(spark, tmp_path):
    event = {"schemaVersion": "1.0", "kind": "attempt", "eventId": "ab" * 16, "attemptId": "a", "at": "2026-07-10T01:02:03.004Z", "status": "failed", "message": "", "stage": "s", "category": None}
    (tmp_path / f"20260710T010203.004Z-{'ab' * 16}.json").write_text(json.dumps(event))
    (tmp_path / f"20260710T010203.005Z-{'ab' * 16}.json").write_text(json.dumps(event))
    got = sorted(str(r.reason) for r in readers.read_events(spark, str(tmp_path)).collect())
    assert got == ["None", "time does not match the file name"]


def test_immutable_partitions(spark, tmp_path):
    df = spark.createDataFrame([("d1", 1), ("d1", 2), ("d2", 3)], "date string, v int")
    path = f"{tmp_path}/t"
    assert S.write_immutable(df.where("date = 'd1'"), path, ["date"]) == 1
    assert S.write_immutable(df, path, ["date"]) == 1
    assert S.write_immutable(df.repartition(3), path, ["date"]) == 0
    with pytest.raises(S.RefusedWrite):
        S.write_immutable(df.withColumn("v", F.col("v") + 1), path, ["date"])
    assert spark.read.parquet(path).count() == 3


def test_publications_are_all_or_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "v int")
    root = f"{tmp_path}/p"
    S.publish({"a": df, "b": df}, root, "r1", lambda t: t["a"].where("v > 1"))
    with pytest.raises(S.RefusedWrite):
        S.publish({"a": df, "b": df}, root, "r2", lambda t: t["a"])
    with pytest.raises(S.RefusedWrite):
        S.publish({"a": df}, root, "r1")
    assert S.read_published(spark, root, "a").select("run_id", "v").collect() == [("r1", 1)]


def test_source_text_paths(spark, tmp_path):
    schema = "id string, path string, text string"
    bad = spark.createDataFrame([("1", "a", "x"), ("1", "a-b", "x"), ("1", "a/c", "x")], schema)
    assert [(r.id, r.path) for r in S.path_conflicts(bad).collect()] == [("1", "a")]
    good = spark.createDataFrame([("1", "a/b", "x"), ("1", "a/c", "y"), ("2", "a", "z")], schema)
    S.write_source_text(good, f"{tmp_path}/s", "r1")
    with pytest.raises(S.RefusedWrite):
        S.write_source_text(good.where("id = '2'"), f"{tmp_path}/s", "r2")


def test_safety_scan(spark, tmp_path):
    from dayfolio.plans.audits import audit_safety
    for name, body in {"a.txt": b"fine", "id_rsa": b"x", "b.txt": b"AKIA" + b"A" * 16, "c.bin": b"%PDF-1.7", "d.txt": b"password = changeme-not-a-secret", "e.txt": b"q" * 3000}.items():
        (tmp_path / name).write_bytes(body)
    got = {(r.path.rsplit("/", 1)[1], r.rule) for r in audit_safety(readers.scan_files(spark, str(tmp_path), 2000), maximum_bytes=2000).collect()}
    assert got == {("id_rsa", "file name"), ("b.txt", "access key"), ("c.bin", "pdf content"), ("e.txt", "too large")}


def test_bundle(spark):
    dates = spark.createDataFrame([("2026-07-10",)], "date string")
    allowed = S.publication_allowlist(dates)
    assert allowed.count() == 6
    extra = allowed.select("path").limit(5).union(spark.createDataFrame([("private.txt",)], "path string"))
    assert {r.side for r in S.check_bundle(extra, allowed).collect()} == {"not allowed", "missing"}


def test_many_published_runs_are_pruned_by_the_manifest(spark, tmp_path):
    root, runs = f"{tmp_path}/published", 120
    rows = spark.range(runs * 2).select(F.concat(F.lit("0"), (F.col("id") % runs).cast("string")).alias("run_id"), F.col("id").alias("v"))
    rows.repartition("run_id").write.partitionBy("run_id").parquet(f"{root}/data/a")
    spark.range(runs).where("id % 4 = 0").select(F.concat(F.lit("0"), F.col("id").cast("string")).alias("run_id"), F.array(F.lit("a")).alias("targets")).write.json(f"{root}/manifest")
    S.publish({"a": spark.range(3).select(F.col("id").alias("v"))}, root, "007x")
    found = S.read_published(spark, root, "a")
    got = sorted((r.run_id, r.v) for r in found.collect())
    assert got == sorted([(f"0{i % runs}", i) for i in range(runs * 2) if i % runs % 4 == 0] + [("007x", i) for i in range(3)])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
