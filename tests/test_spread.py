"""Work that takes long per row runs on all cores, and each text is cut once."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dayfolio import schemas
from dayfolio.functions import text as X
from dayfolio.operators import lint as L, repetition as RP
from dayfolio.plans import backfill as B
from dayfolio.session import BATCH_BYTES
from dayfolio.workload import audits, pages, text
from dayfolio.workload.registry import table

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("rows", [audits.japanese, audits.paged, pages.abstract_pages])
def test_narrow_tables_are_dealt_over_the_cores(spark, rows):
    assert rows(spark, FOLDER).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_prose_is_cut_for_reuse_once(spark):
    rules = [r for r in L.sibling_rules() if r.name == "trigram"]
    assert len(rules) == 24 and not any("shared" in str(r.holds) for r in rules)  # no Python function a rule


def test_overlaps_of_lists_agree_with_those_of_pairs(spark):
    texts = ["aaaaabc", "aaab", "", None, "xyzxyz", "あいうえおあいう"]
    rows = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    got = rows.select(X.gram_overlap(F.col("a"), F.col("b"), 3).alias("one"), X.gram_overlaps(F.array("a", "b"), F.array("b", "a"), 3).alias("all")).collect()
    assert all(r.one == r.all[0] == r.all[3] for r in got) and any(r.one for r in got)


def test_signatures_leave_a_worker_in_small_parts(spark, monkeypatch):
    structure = {"sample": 1, "ratio": 0.0, "long": 6, "long_left": 3, "long_hiragana": 1, "short": 4, "short_left": 2, "short_hiragana": 1, "gap": 4}
    texts = ["ab, cd. ef; gh! ij? " * 9, None, "", "abcdefgh", "xy. zw, ab, cd."]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    monkeypatch.setattr(RP, "SIGNATURES", 7)
    got = RP.structure_rows(rows.select("i", "t"), structure, marks="[.,;!?]", letter="[a-z]")
    cut = X.structure_cutter(structure, "[.,;!?]", "[a-z]")
    assert sorted(map(tuple, got.collect())) == sorted((i, s) for i, t in enumerate(texts) for s in cut(t)) and got.count() > 7


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_group_rules_make_no_masks(spark):
    fields = L.diversity_fields(audits.japanese(spark, FOLDER), ["report_date", "slug"], "index")
    assert r"\$[^$]*\$" not in _plan(fields) and r"\$[^$]*\$" in _plan(L.prose_fields(audits.japanese(spark, FOLDER)))


def test_only_texts_with_marks_are_framed(spark):
    rows = spark.createDataFrame([(1, i, t) for i, t in enumerate(["ab, cd. ef gh ij"] * 9 + ["plain words only"] * 9 + [None])], "g int, i int, t string")
    found = RP.template_repeats(rows, F.col("t"), ["g"], "i", marks="[.,]", letter="a-z", content="[c-f]+", sample=2, short_matches=2,
                                template={"ratio": 0.1, "short_ratio": 0.1, "characters": 4, "hiragana": 2, "punctuation": 2, "slots": 1,
                                          "short_characters": 4, "short_hiragana": 2, "short_punctuation": 2, "short_slots": 1}, markers=())
    assert [(r.matches, r.papers, r.first_position) for r in found.collect()] == [(9, 19, 0)]
    assert "regexp_extract_all(t#" in _plan(found)  # the text itself, before its frame


def test_corrected_rows_are_joined_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(audits, "issue_rows", lambda issues, *columns: seen.append(issues) or issues)
    audits.correction_issues(spark, FOLDER)
    assert seen and "LeftOuter" not in _plan(seen[0])  # the audits read the written rows


@pytest.mark.parametrize("canonical", [True, False])
def test_papers_of_a_page_are_brought_together_once(spark, canonical):
    ranked = audits.ranked_as(audits.paged(spark, FOLDER), canonical)
    grouped = ranked.groupBy("report_date", "slug", "page").agg(F.max("rank"), F.max("title"))
    assert grouped._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_papers_of_a_date_move_once_into_its_document(spark, monkeypatch):
    monkeypatch.setattr(audits, "cut_lineage", lambda df: df)
    plan = _plan(audits.documents(spark, FOLDER, spark.createDataFrame([], schemas.REPORT)))
    lists = [line for line in plan.splitlines() if "Aggregate" in line and "eminentAuthors" in line and "collect_list" in line]
    assert lists and all("Aggregate [report_date#" in line and ", slug#" not in line.split("]")[0] for line in lists)


def test_texts_reach_python_in_small_batches(spark):
    table(spark, FOLDER, "documents")
    sizes = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("t")).mapInArrow(
        lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
    assert len(sizes) > 5 and max(r.n for r in sizes) < 2 * BATCH_BYTES


def test_ascii_stays_out_of_python(spark):
    rows = spark.createDataFrame([("abc",), ("aé",), ("",), (None,)], "t string")
    marked = X._beyond_ascii(lambda value: F.concat(value, F.lit("!")), lambda value: value)
    assert [r[0] for r in rows.select(marked("t")).collect()] == ["abc", "aé!", "", None]
    texts = ["ﬁ", "é", "plain", None]
    got = spark.createDataFrame([(texts,)], "t array<string>").select(X.nfkc_list("t"), X.nfkc(F.get("t", F.lit(0)))).first()
    assert tuple(got) == (["fi", "é", "plain", None], "fi")


def test_repeated_texts_are_read_once(spark):
    assert "normalise(" not in _plan(text.affected_rows(spark, FOLDER))


def test_windows_of_plans_are_compared_without_sorting_them(spark, tmp_path):
    schema = ("k long, position int, mode string, anchor date, target date, digest string, new_count int, evidence struct<schemaVersion: string, selectionMode: string, "
              "expectedLatestDate: date, targetDate: date, targetSnapshotFingerprint: string, officialHeadDate: date, officialHeadFingerprint: string, "
              "pastweekAnnouncementDates: array<date>, completeSnapshotDates: array<date>>")
    day = "date '2026-07-{:02d}'".format
    window = [f"array({', '.join(day(13 + d) for d in days)})" for days in ((3, 2, 1), (3, 1), (3, 2, 1))]

    def entry(k, position, dates, fingerprint="h"):
        mode = ("aged_checkpoint_recovery", "aged_window_continuation", "normal")[position]
        return (f"select {k}L, {position}, '{mode}', {day(12 + position)}, {day(13 + position)}, 'g', 1, struct('1.0', '{mode}', {day(12 + position)}, {day(13 + position)}, "
                f"'g', {day(16)}, '{fingerprint}', {dates}, {dates})")

    rows = [entry(1, i, window[0]) for i in range(3)] + [entry(2, i, window[i]) for i in range(3)] + [entry(3, i, window[0], "hi"[i]) for i in range(2)]
    entries = spark.sql(" union all ".join(rows))
    spark.createDataFrame(entries.rdd, schema).write.parquet(f"{tmp_path}/entries")
    found = B.check_plan(spark.read.parquet(f"{tmp_path}/entries"), ["k"])
    assert sorted(r.id for r in found.where("kind = 'window' and path = 'entries'").collect()) == ["2", "3"]
    assert found.where("kind = 'chain'").isEmpty()
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not [line for line in lines if "SortAggregate" in line and "StructsToJson" in line or "Scan ExistingRDD" in line and "evidence" in line]


def test_texts_of_a_paper_are_brought_to_normal_form_in_one_array(spark):
    plan = _plan(L.prose_fields(audits.japanese(spark, FOLDER)))
    assert 0 <= plan.index("posexplode") < plan.index("ArrowEvalPython")  # below the generator, so once per paper


def test_only_rows_that_may_match_are_matched(spark):
    patterns = [*L.LITERALS, *L.CLASSES]
    texts = ["(energy)", "（エネルギー energy）", "相 の", "を解析。", "総合点は80/100", "信頼性は20点", "公式概要", "全文で確認", "要旨だけ", "と追跡したが", "独立に再現していない",
             "Software", "ſoftware", "rank-1", "an echo", "the plain words", "waveの", "Quantum fields", "plain", "", None, "らりるれろ"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    value = F.col("t")
    got = rows.select(*[F.struct(L.may_match(value, p).alias("may"), value.rlike(p).alias("is")).alias(f"p{i}") for i, p in enumerate(patterns)]).collect()
    assert all(p["may"] or not p["is"] for r in got for p in r)
    for place in range(len(patterns)):
        assert any(r[place]["is"] for r in got) and any(r[place]["may"] is False for r in got)
    assert rows.select(L.may_match(value, "unknown")).distinct().collect() == [(True,)]


def test_folding_agrees_with_squeezing_any_text(spark):
    texts = ["Ab c", " a", "a ", "a  b", "a\tb", "a　b", " a", "a \n", "a \u0085", "\u0085", "", None, "ＡＢ　c", "あい"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(X.fold_prose(F.col("t")).alias("now"), X.squeeze_space(F.lower("t")).alias("all"),
                      X.is_blank("t").alias("blank"), F.coalesce(X.trim_space("t") == "", F.lit(True)).alias("empty"),
                      X.count_script("t", X.JAPANESE).alias("n"), F.regexp_count("t", F.lit(f"[{X.JAPANESE}]")).alias("m")).collect()
    assert all(r.now == r.all and r.blank == r.empty and r.n == r.m for r in got)


def test_reports_are_written_as_columns(spark):
    written = audits.reports(spark, FOLDER)
    assert written.inputFiles() and written.schema["papers"].dataType == audits.reports(spark, FOLDER, canonical=True).schema["papers"].dataType
    docs = audits.documents(spark, FOLDER, again=False)
    assert "collect_list" in _plan(docs) and "collect_list" not in _plan(audits.documents(spark, FOLDER))  # read once, so not written


def test_places_in_small_groups_write_nothing(spark):
    from dayfolio.operators.ordering import with_position, with_previous
    rows = spark.createDataFrame([(g, i, (i * 7) % 11) for g in ("a", "b", None) for i in range(9)], "g string, i int, v int")
    for ranges in (1, 3):
        plain = with_position(rows, ["g"], ["v", "i"], ranges=ranges)
        assert sorted(map(str, plain.collect())) == sorted(map(str, with_position(rows, ["g"], ["v", "i"], small_groups=True).collect()))
        before = with_previous(rows, ["g"], ["v", "i"], {"b": "v"}, ranges=ranges)
        assert sorted(map(str, before.collect())) == sorted(map(str, with_previous(rows, ["g"], ["v", "i"], {"b": "v"}, small_groups=True).collect()))
    assert with_position(rows, ["g"], ["v", "i"], small_groups=True).dtypes == plain.dtypes
    assert "RDD" not in _plan(with_position(spark.range(9), ["id"], ["id"], small_groups=True))
