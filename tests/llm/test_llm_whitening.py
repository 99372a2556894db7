"""Whitening against covariances taken in fractions."""

from __future__ import annotations

import math
import random
import sys
from collections import defaultdict
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from dayfolio.llm import queries, whitening  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, id string, x int, _v string, n string, component string"


def usable(vector, width):
    return vector is not None and len(vector) == width and all(c is not None and math.isfinite(c) for c in vector)


def brute(rows, width, most=16):
    """{id: [(deviation, centred x in fractions)]}, n and the covariance in fractions."""
    kept = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in rows if usable(v, width)]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = [Fraction(s, n) for s in sums]
    centred = [[Fraction(c) - m for c, m in zip(x, mean, strict=True)] for x in fit]
    matrix = np.array([[float(sum((z[i] * z[j] for z in centred), Fraction(0)) / n) for j in range(width)] for i in range(width)])
    return kept, n, sums, matrix


def check(rows, got, width, most=16):
    kept, n, sums, matrix = brute(rows, width)
    values = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    k = min(most, int((values > values[0] * width * np.finfo(float).eps).sum()))
    by_id = defaultdict(list)
    for i, x in kept:
        by_id[i].append((sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)), x))
    found = defaultdict(list)
    for r in got:
        assert r.n == n and r.identity_error <= 1e-9 and r.explained == pytest.approx(values[r.component - 1] / matrix.trace(), rel=1e-9)
        found[r.vec_id].append((r.component, r.deviation, r.whitened))
    assert {i: sorted([d for d, _ in v] * k) for i, v in by_id.items()} == {i: sorted(d for _, d, _ in v) for i, v in found.items()}
    assert all(sorted(c for c, _, _ in v) == sorted(list(range(1, k + 1)) * len(by_id[i])) for i, v in found.items())
    # A row's squared whitened values, each with its component's variance, are its squared distance within the components.
    if k == width:
        for i, own in by_id.items():
            if len(own) == 1:
                distance = sum(values[c - 1] * w * w for c, _, w in found[i])
                assert distance == pytest.approx(own[0][0] / n**2, rel=1e-9, abs=1e-12)
    return found, matrix


def test_whitening_agrees_with_fractions(spark):
    rng = random.Random(4)
    turn = np.linalg.qr(np.random.default_rng(2).normal(size=(5, 5)))[0]
    rows = [(i, (turn @ [rng.gauss(0, s) for s in (3, 2, 1, 0.7, 0.4)]).tolist()) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(60)]  # a third of all rows
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0]), (303, [math.nan] * 5), (304, [math.inf, 0.0, 0.0, 0.0, 0.0]), (305, [1.0] * 4), (306, [1e300] * 5)]
    rows += [rows[7], (None, rows[8][1]), (307, [-0.0] * 5), (308, [1e-9, -1e-9, 0.0, 0.0, 0.0])]
    table = spark.createDataFrame([(*r, "a", 1, "b", "c", "d") for r in rows], SCHEMA).repartition(7)
    got = whitening.whiten_embeddings(table)
    assert set(got.columns) == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    good = [(i, v) for i, v in rows if i != 306]
    found, matrix = check(good, got.collect(), 5)
    # The components are eigenvectors: whitened values times the root of the variance are projections on orthogonal axes.
    n, sums, exact = whitening.covariance(whitening.quantised(table)[0].select("x").distinct(), 5)
    assert np.array_equal(exact, matrix)
    assert len(check(good, whitening.whiten_embeddings(table, most=2).collect(), 5, 2)[0]) == len(found)


def test_little_variance(spark):
    flat = [(i, [float(i % 3), 2.0 * (i % 3), 5.0]) for i in range(30)]  # a line: one component
    got = whitening.whiten_embeddings(spark.createDataFrame(flat, "vec_id long, embedding array<float>")).collect()
    check(flat, got, 3)
    assert {r.component for r in got} == {1}
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], "vec_id long, embedding array<float>")
    for table in (same, same.limit(0), same.limit(1), spark.createDataFrame([(1, None), (2, [])], "vec_id long, embedding array<float>")):
        assert whitening.whiten_embeddings(table).collect() == []


def test_large_entries_stay_exact(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([1e12, -3e13, 7e14]), rng.random()]) for i in range(40)]
    got = whitening.whiten_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    kept, n, sums, _ = brute(rows, 2)
    want = {i: sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for i, x in kept}
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 2**63 else None for i, d in want.items()}


def test_query_over_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = queries.QUERIES["op11_embedding_whitening"](spark, "/root/testdata/sf0.001").collect()
    check(rows, got, len(rows[0][1]))
