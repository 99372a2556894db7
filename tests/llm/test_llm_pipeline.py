"""The corpus pipeline, stage by stage, against brute force."""

from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
import duckdb  # noqa: E402
from llm_cases import WORDS, awkward, components, empty  # noqa: E402
from test_llm_documents import brute_quality, targets  # noqa: E402
from test_llm_models import similar_sets  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from dayfolio.llm import queries  # noqa: E402

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, docs, tmp_path):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        out.append(docs)
    return out


def check(given, found):
    quality, lines, near, mixed, packed = [x.collect() for x in found]
    assert all(x.columns == COLUMNS for x in found[:4])
    texts = {r.doc_id: r.text or "" for r in given}
    for r in quality:
        own = texts[r.doc_id].split("\n")
        assert not brute_quality(texts[r.doc_id])[5] and r.n_chars == len(r.text) and not Counter(r.text.split("\n")) - Counter(own)
    assert Counter(r.doc_id for r in lines) == Counter(r.doc_id for r in quality)
    rows = [(r.doc_id, r.text) for r in lines]
    sets, links = similar_sets(rows, 5)
    group = components([(rows[a][0], rows[b][0]) for a, b in links], [r[0] for r in rows])
    assert {r.doc_id for r in near} == {k for k, v in group.items() if k == v}
    sizes, times = Counter(), Counter(r.doc_id for r in mixed)
    for r in near:
        sizes[r.source] += len(WORDS.findall(r.text))
    want, taken, most = targets(sizes), Counter(), Counter()
    for r in near:
        n = len(WORDS.findall(r.text))
        assert times[r.doc_id] <= 2
        taken[r.source] += times[r.doc_id] * n
        most[r.source] = max(most[r.source], n)
    assert all(abs(taken[s] - want[s]) <= most[s] / 2 + 1e-6 for s in sizes)
    assert Counter(r.doc_id for r in packed if r.start == 0) == times


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = stages(spark, docs, tmp_path)
    check(docs.collect(), found)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/quality_rules/*.parquet'")
    want = {row[0]: row[1] for row in con.execute(f"SELECT doc_id, text FROM ({queries.SQL['op9_line_dedup']})").fetchall()}
    assert {r.doc_id: r.text for r in found[1].collect()} == want


def test_awkward_and_empty(spark, tmp_path):
    docs = awkward(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    check(docs.collect(), stages(spark, docs, tmp_path / "a"))
    assert [x.count() for x in stages(spark, empty(spark), tmp_path / "b")] == [0] * 5
    assert stages(spark, awkward(spark), tmp_path / "c")[-1].count() > 0


def test_near_duplicates_by_row(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(3, one), (None, one), (None, two), (None, two + " more"), (4, "x y z"), (5, one + " end"), (9, one), (9, "c " + two), (9, "another text " * 9), (6, None), (None, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()]
    assert Counter(left) == Counter([(3, one), (4, "x y z"), (9, "c " + two), (9, "another text " * 9), (6, None), (None, None), (6, "")])
    assert left == [] or Counter(left) == Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(7), SMALL).collect())


def test_run_and_registry(spark):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SMALL).filter("offset = 0").count() > 0
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in entry.queries()}
