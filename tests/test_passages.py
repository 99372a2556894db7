"""Passages in texts against a scan of all pairs."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayfolio.operators import passages as PS
from dayfolio.operators.skew import small_or_plain


def units(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def test_run_hashes_depend_on_the_run_alone():
    rng = random.Random(1)
    text = "".join(rng.choice("abé ") for _ in range(300))
    data = text.encode()
    for size in (1, 2, 3, 7, 12, 16, 31):
        hashes = PS.run_hashes(units(text), size)
        runs = [data[i:i + size] for i in range(len(data) - size + 1)]
        assert len(hashes) == len(runs) and len(set(zip(hashes.tolist(), runs))) == len(set(runs)) == len(set(hashes.tolist()))
    assert not len(PS.run_hashes(units("ab"), 3)) and not len(PS.run_hashes(units(""), 0))


def test_a_text_has_all_hashes_of_its_parts():
    rng = random.Random(2)
    for _ in range(60):
        text = "".join(rng.choice("abc d") for _ in range(rng.randrange(40, 400)))
        a = rng.randrange(len(text) - PS.SHORTEST + 1)
        part = text[a:a + rng.randrange(PS.SHORTEST, len(text))]
        own, all_of = PS.winnowed(units(part)), PS.winnowed(units(text))
        assert np.isin(own, all_of).all() and len(own) == (0 if len(part) < PS.SHORTEST else len(own)) and (len(part) < PS.SHORTEST or len(own))
        hashes = PS.run_hashes(units(text), PS.GRAM)
        assert set(all_of.tolist()) == {int(hashes[i:i + PS.WINDOW].min()) for i in range(len(hashes) - PS.WINDOW + 1)}


def test_filter_loses_nothing(spark):
    rng = np.random.default_rng(3)
    given = rng.integers(-2**63, 2**63 - 1, 3000)
    table = spark.createDataFrame([(int(v),) for v in given], "fp long")
    for most in (1024, 1 << 20):
        words = PS.hash_filter(table, most)
        assert PS.may_hold(words, given.view(np.uint64)).all() and len(words) <= max(most, 1024)
    other = rng.integers(-2**63, 2**63 - 1, 20_000).view(np.uint64)
    assert PS.may_hold(words, other).mean() < 0.02
    assert not PS.may_hold(PS.hash_filter(table.limit(0)), other).any()


def texts(rng, n, long):
    words = ["the", "of", "and", "été", "naïve", "日本", "x"] + [f"w{i}" for i in range(30)]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(1, long))) for _ in range(n)]


@pytest.mark.parametrize("automaton_bytes", [1 << 20, 0])
def test_contained_passages(spark, automaton_bytes):
    rng = random.Random(5)
    documents = list(enumerate(texts(rng, 60, 120)))
    passages = [(i, documents[rng.randrange(60)][1][rng.randrange(30):][:rng.choice([1, 3, 12, 31, 32, 33, 60, 300])]) for i in range(80)]
    passages += [(100, ""), (101, None), (102, documents[3][1]), (103, documents[3][1]), (104, "nothing holds this one here, at all or ever")]
    documents += [(200 + i, documents[3][1]) for i in range(30)] + [(300, None), (301, "")]
    want = sorted((p, d) for p, s in passages for d, t in documents if s and t and s in t)
    left = spark.createDataFrame(passages, "p long, a string")
    right = spark.createDataFrame(documents, "d long, b string").repartition(5)
    found = PS.contained_passages(left, right, "p", "d", F.col("a"), F.col("b"), automaton_bytes)
    assert sorted(map(tuple, found.select("p", "d").collect())) == want and len(want) > 100
    assert PS.contained_passages(left.limit(0), right, "p", "d", F.col("a"), F.col("b")).count() == 0


def test_long_texts_are_hashed_in_parts(spark, monkeypatch):
    scans, hashed = [], PS._hashed
    monkeypatch.setattr(PS, "_hashed", lambda rows, key, of, columns: scans.append(of) or hashed(rows, key, of, columns))
    left = spark.createDataFrame([(1, "a passage that is long enough to have hashes of its own"), (2, "short")], "p long, a string")
    right = spark.createDataFrame([(1, "of"), (2, None)], "d long, b string")
    for of, most in ((PS.contained_passages, 0), (PS.shingle_coverage, 12)):
        of(left, right, "p", "d", F.col("a"), F.col("b"), most)
        text = "words of a text " * (1 << 16) + "a passage that is long enough to have hashes of its own short"
        tracemalloc.start()
        found = scans[-1](text)[0]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(found) and peak < 12 * len(text)


def test_parts_have_the_runs_of_the_whole(monkeypatch):
    rng = random.Random(7)
    for length in (0, 1, 5, 31, 32, 33, 63, 64, 65, 95, 96, 97, 500):
        monkeypatch.setattr(PS, "PART", rng.choice([1, 7, 32, 64]))
        text = units("".join(rng.choice("ab ") for _ in range(length)))
        for size in (1, 12, 31):
            assert [h for part in PS.in_parts(text, size) for h in PS.run_hashes(part, size)] == list(PS.run_hashes(text, size))
        assert {h for part in PS.in_parts(text, PS.SHORTEST) for h in PS.winnowed(part)} == set(PS.winnowed(text))


def test_only_candidates_are_folded_again(spark):
    left = spark.createDataFrame([(1, "a passage that is long enough to have hashes of its own")], "p long, a string")
    right = spark.createDataFrame([(1, "Here is A Passage that is long enough to have hashes of its own."), (2, "nothing"), (3, None)], "d long, b string").repartition(3)
    found = PS.contained_passages(left, right, "p", "d", F.lower("a"), F.lower("b"))
    assert "isnotnull(lower(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [(1, 1)]


def test_shingle_coverage(spark):
    rng = random.Random(6)
    documents = list(enumerate(texts(rng, 40, 60)))
    sources = []
    for i in range(50):
        own = list(documents[rng.randrange(40)][1])
        for _ in range(rng.randrange(12)):
            own[rng.randrange(len(own))] = rng.choice("qz")
        sources.append((i, "".join(own)))
    documents += [(100 + i, documents[1][1] + " more of it") for i in range(40)] + [(200, None), (201, "ab")]
    size, minimum, threshold = 4, 24, 0.6
    grams = lambda t: Counter(t[i:i + size] for i in range(len(t) - size + 1))
    want = {}
    for s, a in sources:
        if len(a) >= minimum:
            for d, b in documents:
                both = (grams(a) & grams(b or "")).total()
                if both / grams(a).total() >= threshold:
                    want[s, d] = (both, grams(a).total())
    left, right = spark.createDataFrame(sources, "s long, a string"), spark.createDataFrame(documents, "d long, b string")
    found = PS.shingle_coverage(left, right, "s", "d", F.col("a"), F.col("b"), size, minimum, threshold)
    assert {(r.s, r.d): (r.overlap, r.total) for r in found.collect()} == want and len(want) > 60


def test_broadcast_by_bytes(spark):
    few = spark.createDataFrame([(1, "x" * 100, ["a", None], {"k": b"v"}, (1, "y"))], "i long, s string, l array<string>, m map<string,binary>, t struct<a:int,b:string>")
    hinted = lambda df, most: "broadcast" in small_or_plain(df, most)._jdf.queryExecution().analyzed().toString().lower() or "hint" in small_or_plain(df, most)._jdf.queryExecution().logical().toString().lower()
    assert hinted(few, 1000) and not hinted(few, 100) and hinted(few.limit(0), 0)
