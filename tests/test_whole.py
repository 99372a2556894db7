"""Queries that take the whole job where a query bound by its SQL takes a part."""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from dayfolio.functions import text as X  # noqa: E402
from dayfolio.operators import repetition as RP  # noqa: E402


def test_any_passage_is_found_in_any_document(spark, tmp_path):
    long = "The  quick brown fox jumps over the lazy dog"
    passages = [(0, long), (1, "no document holds this passage"), (2, "Straße"), (3, ""), (4, None), (5, "over the lazy cat and away")]
    docs = [(0, "nothing at all"), (1, f"It says: {long.upper()}, twice. {long}"), (2, "a straße in a town; over the lazy cat and  away"), (3, None), (4, "the quick brown fox jumps"),
            (5, "x the quick brown fox\njumps over the lazy dogs")]
    spark.createDataFrame(passages, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    fold = lambda t: " ".join((t or "").lower().split())
    want = {(i, d) for i, p in passages for d, t in docs if p and fold(p) in fold(t)}
    got = [tuple(r) for r in entry.queries()["j18_verbatim_reuse_whole"](spark, str(tmp_path)).select("item_id", "doc_id").collect()]
    assert sorted(got) == sorted(want) and {(0, 1), (0, 5), (2, 2), (5, 2)} == want
    long_only = spark.createDataFrame(passages[:2], "item_id long, text string")
    none = spark.createDataFrame(docs[:1], "doc_id long, text string")
    assert RP.contained_passages(long_only, none, "item_id", "doc_id", X.normalize_prose("text"), X.normalize_prose("text")).count() == 0


def masked_frame(text: str) -> str:
    text = unicodedata.normalize("NFKC", text)
    for pattern in (r"\$[^$]*\$", r"(?s)\\\(.*?\\\)", r"(?s)\\\[.*?\\\]", r"\\[A-Za-z]+", r"(?<![A-Za-zà-ÿ0-9])[A-Za-z][A-Za-z0-9]*(?:_[A-Za-z0-9]+)+(?![A-Za-zà-ÿ0-9])"):
        text = re.sub(pattern, " ", text)
    return re.sub("[a-zà-ÿ]{4,}", "◇", " ".join(text.lower().split()))


MATH = ["we see $x_{}$ and, so it is; a long tale to be told by us all.", "we see \\alpha and, so it is; a short walk to be seen by us all.",
        "we see some_name_{} and, so it is; a good word to be said by us all.", "we see \\(a+{}\\) and, so it is; a fine time to be had by us all."]


def test_skeleton_masks_math(spark, tmp_path):
    texts = [t.format(i) for i, t in enumerate(MATH)] + ["plain words of it, no more", "cost: 5$ and 7_ or \\[x\ny\\] end"]
    spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.turn: r.frame for r in entry.queries()["h9_skeleton"](spark, str(tmp_path)).collect()}
    assert got == {i: re.sub(r"\s+", "", masked_frame(t)) for i, t in enumerate(texts)}


def test_templates_count_texts_with_math(spark, tmp_path):
    docs = [(i, "s", MATH[i % 4].format(i)) for i in range(12)] + [(20 + i, "s", f"no{'abcd'[i]} it is") for i in range(4)]
    spark.createDataFrame(docs, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    signed = {d: re.sub(r"\s+", "", re.sub("◇+", "◇", masked_frame(t))) for d, _, t in docs[:12]}
    counts = Counter(signed.values())
    want = {(hashlib.sha256(s.encode()).hexdigest(), n, 16, min(d for d in signed if signed[d] == s)) for s, n in counts.items()}
    got = entry.queries()["a12_template_repeats"](spark, str(tmp_path)).collect()
    assert {(r.signature, r.matches, r.papers, r.first_position) for r in got} == want and max(counts.values()) > 1
