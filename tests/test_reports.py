"""Reports, ranking, audits, lint and editions on reference-shaped fixtures."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

import tests_support as X
from dayfolio import config, schemas
from dayfolio.functions import display as D, text as T, times
from dayfolio.operators import aggregates as A, checks as C, lint as L, ordering as O, ranking as K, repetition as RP
from dayfolio.plans import audits as Y, editions as E
from dayfolio.session import cut_lineage


def reports(spark, edit=None):
    records = X.report_set()
    return X.frame(spark, X.changed(records, edit) if edit else records)


def exceptions(spark):
    return C.policy_exceptions(X.frame(spark, [X.POLICY], schemas.POLICY))


def structure(spark, edit=None):
    found = Y.audit_structure(reports(spark, edit), exceptions(spark), X.RUN["modelId"], X.RUN["modelDisplayName"], X.RUBRIC)
    return {(r.slug, r.path) for r in found.collect()}


def test_valid_reports_have_no_findings(spark):
    assert structure(spark) == set()
    assert Y.audit_report_set(reports(spark)).isEmpty()
    rows, groups = Y.audit_language(reports(spark))
    assert rows.isEmpty() and groups.isEmpty()


def test_all_structural_findings_at_once(spark):
    def edit(r):
        first = r[1]["papers"][0]
        first["url"] = "https://example.org"
        first["totalScore"] += 1
        first["authors"] = ["Ann Bee", "ANN  bée"]
        r[1]["papers"][3]["rank"] = 9
        r[1]["papers"][10]["scores"]["originality"] = 24
        r[1]["papers"][10]["totalScore"] += 4
        r[1]["audit"]["sourceCounts"]["newPrimary"] = 3
        r[1]["papers"][2]["fullTextEvaluated"] = False
    found = structure(spark, edit)
    assert {p for s, p in found if s == "gr-qc"} >= {
        "url", "totalScore", "authors", "rank", "scores.originality", "audit.sourceCounts.newPrimary", "fullTextEvaluated", "fullTextEvaluatedCount"}
    assert all(s == "gr-qc" for s, _ in found)


def test_report_set_findings(spark):
    def edit(r):
        r[0]["papers"][0]["arxivId"] = r[1]["papers"][0]["arxivId"]
        r[2]["evaluationRun"]["runId"] = "run-other-one"
        r[2]["audit"]["listingUrl"] = "https://arxiv.org/list/hep-th/pastweek"
    kinds = {r.kind for r in Y.audit_report_set(reports(spark, edit)).collect()}
    assert kinds == {"duplicate", "run", "listing"}
    assert {r.kind for r in Y.audit_report_set(reports(spark).where("slug <> 'gr-qc'")).collect()} == {"incomplete"}


def test_tie_break_order(spark):
    rows = [("d", "s", i, 50, (b, c, o, t), f"2502.0000{i}") for i, (b, c, o, t) in enumerate([(10, 20, 10, 10), (10, 10, 20, 10), (20, 10, 10, 10), (10, 10, 10, 20), (10, 10, 20, 10)])]
    schema = f"report_date string, slug string, index int, totalScore int, scores {schemas.SCORES}, arxivId string"
    ranked = K.rank_papers(spark.createDataFrame(rows, schema)).orderBy("rank").collect()
    assert [r["index"] for r in ranked] == [2, 1, 4, 3, 0]


@pytest.mark.parametrize("ranges", [1, 7])
def test_positions_do_not_depend_on_ranges(spark, ranges):
    df = spark.range(3000).select((F.col("id") % 10 == 0).cast("int").alias("g"), F.pmod(F.xxhash64("id"), F.lit(100)).alias("v"), "id").repartition(5)
    window = Window.partitionBy("g").orderBy("v", "id")
    want = df.withColumn("p", F.row_number().over(window).cast("bigint")).withColumn("q", F.lag("v").over(window))
    got = O.with_previous(O.with_position(df, ["g"], ["v", "id"], "p", ranges), ["g"], ["v", "id"], {"q": "v"}, ranges)
    assert got.select(*want.columns).exceptAll(want).isEmpty() and got.count() == 3000


def test_plateau_thresholds_are_strict(spark):
    def count(n, same):
        df = spark.createDataFrame([("d", "s", i, 50 if i < same else 1000 + i) for i in range(n)], "report_date string, slug string, index int, totalScore int")
        return A.score_plateau(df).count()
    assert [count(20, 7), count(20, 8), count(22, 8), count(24, 8), count(15, 15)] == [0, 1, 1, 0, 0]


def test_identical_text_needs_three_and_more_than_a_quarter(spark):
    def found(n, same):
        df = spark.createDataFrame([("g", i, "Ｓame  TEXT" if i < same else f"text {i}") for i in range(n)], "g string, i int, t string")
        return RP.prose_repeats(df, T.normalize_prose("t"), ["g"], "i").count()
    assert [found(12, 3), found(11, 3), found(4, 2), found(3, 3)] == [0, 1, 0, 1]


def test_trigram_reuse_is_a_multiset(spark):
    def coverage(a, b):
        return spark.range(1).select(RP.reuse_coverage(F.lit(a), F.lit(b))).first()[0]
    assert coverage("ab" * 15, "ab" * 15) == 1.0
    assert coverage("ab" * 15, "abab") == pytest.approx(2 / 28)
    assert coverage("short text", "short text") == 0.0


ROW_FAULTS = [
    ("curiosity", "未解決のsoftwareの問題を問う。", "english_terms"), ("concept", "新しい 方法を組み立てる。", "boundary_space"), ("conclusion", "限界と応答を解析。", "bare_sahen"),
    ("curiosity", "公式本文の未解決量を問う。", "review_provenance"), ("assessment", "総合80点という評価で証拠と限界を比べる。", "no_recap"), ("concept", "この解析法には点に価値がある。", "generic_phrases"),
    ("titleJa", "量子model検証の題名", "display_title"), ("concept", "一ループの計算法を組み立てる。", "phrase_list"), ("concept", "some lower words を含む方法である。", "latin_phrases"), ("paperType", "x", "min_script_chars"),
    ("conclusion", "あ" * 181, "max_chars")]


def test_row_rules(spark):
    """One fault per paper; each is found in its field and nowhere else."""
    record = X.report("quant-ph")
    for p, (field, value, _) in zip(record["papers"], ROW_FAULTS):
        p[field] = value
    found = L.validate_prose(C.explode_papers(X.frame(spark, [record]))).collect()
    for position, (field, _, rule) in enumerate(ROW_FAULTS):
        assert {r.path for r in found if r.position == position} == {field}
        assert rule in {r.rule for r in found if r.position == position}


def test_group_rules(spark):
    record = X.report("gr-qc", 20)
    for p in record["papers"]:
        p["assessment"] = "証拠と限界を比べた結果、中心的な主張は妥当である。"
    found = {(r.field, r.rule) for r in L.validate_diversity(C.explode_papers(X.frame(spark, [record]))).where("field = 'assessment'").collect()}
    assert found == {("assessment", "identical"), ("assessment", "skeleton"), ("assessment", "template")}


def test_display_forms(spark):
    title = r"Symmetry $\mathcal{PT}$ in $SU(2) \times U(1)$ with $\alpha_2^3$, phase-$\theta$ -- test"
    old = "総合95/100。物理全体22/25：隣接分野へ波及する。hep-th内25/25：中心課題を前進させる。"
    row = spark.range(1).select(D.display_title(F.lit(title)), D.display_title(F.lit(r"$\unknown{X} \mathbb{Q}_4 \left(2,3\right)$")), D.display_assessment(F.lit(old))).first()
    assert tuple(row) == ("Symmetry PT in SU(2) × U(1) with α₂³, phase-θ – test", "X Q₄ (2,3)", "隣接分野へ波及する。中心課題を前進させる。")


def test_dates_and_times(spark):
    row = spark.range(1).select(
        times.parse_date(F.lit("2026-02-30")), times.next_weekday(F.lit("2026-07-10").cast("date")).cast("string"), times.long_heading(F.lit("Showing new listings for Friday, 10 July 2026")).cast("string"),
        times.long_heading(F.lit("Showing new listings for Monday, 10 July 2026")), times.parse_jst(F.lit("2026-07-10T00:00:00+09:00")).cast("string"), times.parse_jst(F.lit("2026-07-10T00:00:00Z"))).first()
    assert tuple(row) == (None, "2026-07-13", "2026-07-10", None, "2026-07-09 15:00:00", None)


def registry(spark):
    entry = {"canonicalName": "Kim gr-qc 10", "aliases": ["Kím hep-th 0"], "fieldTags": ["gr-qc", "hep-th"], "distinction": "Prize", "identityEvidence": "Biography",
             "officialUrls": ["https://a.example"], "lastVerified": "2026-07-10"}
    from dayfolio.sources.readers import registry_rows
    return registry_rows(X.frame(spark, [{"schemaVersion": "1.0", "authors": [entry]}], schemas.REGISTRY))


def test_edition_and_its_audits(spark):
    r = cut_lineage(reports(spark))
    edition = E.build_edition(r, registry(spark))
    assert edition.issues.isEmpty()
    head = edition.headers.first()
    assert (head.total, head.full_text, head.badged, head.generated_at) == (39, 30, 2, f"{X.DATE}T06:42:10+09:00")
    dates = E.edition_dates(r.select(F.col("reportDate").alias("date")).limit(0), edition.headers)
    docs, large = E.edition_documents(edition, dates, "never", "{total}/{full_text}/{badged}", "scheduled")
    docs = cut_lineage(docs)
    one = docs.first()
    assert large.isEmpty() and one.statusMessage == "39/30/2" and one.availableDates == [X.DATE]
    assert [len(one.categories[s].topPapers) for s in config.CATEGORIES] == [10, 10, 10]
    assert Y.audit_editions(docs, X.RUBRIC).isEmpty()
    assert Y.verify_edition(docs, r).isEmpty()
    from dayfolio.sources.writers import current_edition, index_row
    assert Y.audit_archive(docs, index_row(docs), current_edition(docs), r).isEmpty()
    moved = r.withColumn("papers", F.transform("papers", lambda p: p.withField("concept", F.lit("別の方法である。"))))
    assert {x.path for x in Y.verify_edition(docs, moved).collect()} == {"topPapers"}


def test_audit_gate(spark):
    passes = spark.createDataFrame([("a", 1, 3), ("a", 2, 0), ("a", 3, 1), ("b", 2, 1), ("c", 5, 0)], "k string, pass int, count int")
    got = {(r.k, r["pass"]): r.problem for r in Y.audit_gate(passes, ["k"]).collect()}
    assert got == {("a", 1): None, ("a", 2): None, ("a", 3): "an earlier pass found nothing", ("b", 2): "an earlier pass is missing", ("c", 5): "pass number is out of range"}


def test_coverage_equals_brute_force(spark):
    import random
    rng = random.Random(1)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    sources = [(i, " ".join(rng.choice(words) for _ in range(12))) for i in range(12)]
    targets = [(i, " ".join(rng.choice(words) for _ in range(20)) + (" " + sources[i % 12][1][: 20 + i] if i % 3 == 0 else "")) for i in range(60)]

    def bag(t):
        t = t.replace(" ", "")
        out = {}
        for k in range(len(t) - 4):
            out[t[k:k + 5]] = out.get(t[k:k + 5], 0) + 1
        return out
    want = set()
    for s, a in sources:
        ga = bag(a)
        for t, b in targets:
            gb = bag(b)
            if sum(min(n, gb.get(g, 0)) for g, n in ga.items()) / sum(ga.values()) >= 0.5:
                want.add((s, t))
    left, right = spark.createDataFrame(sources, "s int, x string"), spark.createDataFrame(targets, "t int, y string")
    found = RP.shingle_coverage(left, right, "s", "t", T.compare_text("x"), T.compare_text("y"), 5, 24, 0.5)
    assert want and {(r.s, r.t) for r in found.collect()} == want


def test_badges_of_a_paper_listed_twice(spark):
    from dayfolio.operators.reconcile import match_authors

    papers = spark.createDataFrame([("d", "s", "1", 0, ["A B", "C D"]), ("d", "s", "1", 1, ["A B", "C D"]), ("d", "s", "2", 2, ["E F"])],
                                   "report_date string, slug string, arxivId string, index int, authors array<string>")
    known = spark.createDataFrame([("A B", [], ["s"], "prize", "page", ["https://x"], 1)],
                                  "canonicalName string, aliases array<string>, fieldTags array<string>, distinction string, identityEvidence string, officialUrls array<string>, entry int")
    got = match_authors(papers, known).orderBy("index").collect()
    assert [len(r.eminentAuthors) for r in got] == [1, 1, 0]


def test_papers_are_ranked_within_their_report(spark):
    from dayfolio.operators import ranking

    def shuffle(records):
        for record in records:
            for i, p in enumerate(record["papers"]):
                p["totalScore"] = None if i == 4 else p["totalScore"] // 20 * 20
                p["scores"]["originality"] = 10 + i * 7 % 5
            record["papers"] = record["papers"][5:] + record["papers"][:5] + record["papers"][:1]

    table = reports(spark, shuffle)
    near = ranking.ranked_reports(table)
    far = ranking.rank_papers(C.explode_papers(table).drop("rank"))
    columns = ["report_date", "slug", "arxivId", "rank"]
    assert sorted(map(tuple, near.select(columns).collect())) == sorted(map(tuple, far.select(columns).collect()))
    assert sorted((r["slug"], r["index"]) for r in near.collect()) == sorted((r["slug"], r["index"]) for r in far.collect())
