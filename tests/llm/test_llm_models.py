"""Language-model scores, language identification and near duplicates against brute force."""

from __future__ import annotations

import math
import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_cases import WORDS, awkward, components, empty, text_of  # noqa: E402

from dayfolio.llm import language, near_dedup, ppm  # noqa: E402
from dayfolio.llm.components import connected_components  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def ascii_words(text: str | None) -> list[bytes]:
    return [w.encode().lower() for w in WORDS.findall(text or "")]


def brute_ppm(texts: list[tuple[bool, str]], order: int):
    counts = defaultdict(Counter)
    symbols = [(held, [257] * order + [*(t or "").encode(), 256]) for held, t in texts]
    for held, s in symbols:
        if not held:
            for i in range(order, len(s)):
                for j in range(order + 1):
                    counts[tuple(s[i - j:i])][s[i]] += 1

    def chance(context: tuple, symbol: int) -> float:
        p, gone = 1.0, set()
        for j in range(order, -1, -1):
            seen = counts.get(context[order - j:])
            if not seen:
                continue
            left = {k: n for k, n in seen.items() if k not in gone}
            total = sum(left.values())
            if symbol in left:
                return p * (2 * left[symbol] - 1) / (2 * total)
            if total:
                p *= len(left) / (2 * total)
            gone |= set(seen)
        return p / (257 - len(gone))

    scores = [sum(math.log10(chance(tuple(s[i - order:i]), s[i])) for i in range(order, len(s))) for _, s in symbols]
    return scores, chance


@pytest.mark.parametrize(("order", "options"), [(5, {}), (3, {"batch_bytes": 3000, "fan_in": 2, "parts": 3}), (2, {"parts": 1})])
def test_scores(spark, order, options):
    docs = awkward(spark).filter("doc_id is null or doc_id not in (55, 56)")
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    scores, chance = brute_ppm([(h, t) for h, (_, t) in zip(held, rows, strict=True)], order)
    tokens = [[*ascii_words(t), b""] for _, t in rows]
    counts = Counter(w for h, own in zip(held, tokens, strict=True) if not h for w in own)
    n = sum(counts.values())
    want = sorted((repr((i, h, len(own), sum(counts[w] > 0 for w in own), n)), sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in own), s)
                  for (i, _), h, own, s in zip(rows, held, tokens, scores, strict=True))
    got = sorted((repr((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens)), r.base_score, r.score) for r in ppm.score_documents(docs, order=order, **options).collect())
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [x for g in got for x in g[1:]] == pytest.approx([x for w in want for x in w[1:]], rel=1e-9)
    assert sum(chance((119,) * order, s) for s in range(257)) == pytest.approx(1)


def test_scores_of_nothing_and_long_texts(spark):
    assert ppm.score_documents(empty(spark)).count() == 0
    assert {r.doc_id for r in ppm.score_documents(awkward(spark).filter("doc_id > 50")).collect()} >= {55, 56}


def test_gradients():
    rng = np.random.default_rng(2)
    network = language.Network.fresh(["a", "b", "c"], 5, 1)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    x, label, weight = rng.integers(97, 122, (6, 4)).astype(np.uint8), np.array([0, 1, 2, 1]), np.array([1.0, 2.0, 0.5, 1.0])

    def loss() -> float:
        p = network.positions(x)[:, np.arange(4), label]
        return float(-(np.log(p) * weight).sum() / (weight.sum() * len(x)))

    found = network.gradients(x, label, weight)
    for name, w in network.weights.items():
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in w.shape)
            if name.endswith("_in"):
                at = (int(x[rng.integers(6), rng.integers(4)]), at[1])
            keep, step = w[at], 1e-4
            w[at] = keep + step
            up = loss()
            w[at] = keep - step
            down = loss()
            w[at] = keep
            assert found[name][at] == pytest.approx((up - down) / (2 * step), abs=2e-4)


def test_languages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = language.identify_languages(docs, words_per_language=2500).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows) and len(rows) == docs.count()
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_awkward_rows(spark):
    docs = awkward(spark)
    got = language.identify_languages(docs, rounds=1).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id in (50, 51, 52, 54):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "de")
    assert language.identify_languages(empty(spark)).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in language.identify_languages(unlabelled).collect()} == {"und"}


def test_letters_and_long_words(spark):
    docs = spark.createDataFrame([(i, t, None if i else "en") for i, t in enumerate(["one word", "½ ①", "² Ⅷ", "١٢", "a½", "\U00020000", "ª"])], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify_languages(docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(3000).cast("long"))), rounds=1).collect()}
    assert [got[i] for i in range(1, 7)] == ["und", "und", "und", "en", "en", "en"]
    word = "aé日\U00020000" * 40
    pieces = language.words_of(word)
    assert b"".join(pieces) == word.encode() and max(map(len, pieces)) <= 30 and all(p.decode() for p in pieces) and len(language.words_of("b" * 100)) == 4


def similar_sets(rows, n, percent=80):
    sets = []
    for _, text in rows:
        w = ascii_words(text)
        k = min(n, len(w))
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset())
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return sets, links


def near_cases(rng):
    base = text_of(rng, 120).split()
    rows = []
    for i in range(150):  # edits away from one text, near and far
        words = list(base)
        for _ in range(rng.randrange(0, 16)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(words)))
    chain = list(base)
    for i in range(25):  # each next to the one before, the ends far apart
        chain[i * 3] = f"c{i}"
        rows.append((i, "  ".join(chain).upper() if i % 2 else "\n".join(chain)))
    rows += [(500 + i, text_of(rng, rng.randrange(1, 60))) for i in range(60)] + [(700, ""), (701, None), (702, " \n"), (703, "one"), (704, "ONE"), (705, "one two")]
    return rows + [rows[0], rows[3], rows[3]] + [(2000 + i, rows[7][1]) for i in range(9)]


@pytest.mark.parametrize(("words", "hubs"), [(2, 8), (5, 1)])
def test_near_duplicates(spark, words, hubs):
    rows = near_cases(random.Random(4))
    sets, links = similar_sets(rows, words)
    found = components([(rows[a][0], rows[b][0]) for a, b in links], [r[0] for r in rows])
    table = spark.createDataFrame([(*r, "k", 1, "l") for r in rows], "doc_id long, text string, key string, n int, label string")
    got = Counter(map(tuple, near_dedup.near_duplicates(table, words=words, hubs=hubs).collect()))
    assert got == Counter((i, len(s), found[i], found[i] == i) for (i, _), s in zip(rows, sets, strict=True))


def test_near_duplicates_of_awkward_rows(spark):
    docs = awkward(spark)
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[60].component_id == by_id[61].component_id == 3 and not by_id[60].kept and by_id[50].n_shingles == 0 and by_id[50].kept
    assert near_dedup.near_duplicates(empty(spark)).count() == 0


def test_sketch():
    rng = np.random.default_rng(0)
    for n in (1, 3, 200, 5000):
        items = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        sketch = near_dedup.similarity_sketch(items, 240)
        assert (sketch != near_dedup._EMPTY).all() and (sketch == near_dedup.similarity_sketch(items[::-1].copy(), 240)).all()
    shared, close = rng.integers(0, 2**63, 900).astype(np.uint64), []
    for k in range(20):
        other = [np.concatenate([shared, rng.integers(0, 2**63, 100).astype(np.uint64)]) for _ in range(2)]
        close.append((near_dedup.similarity_sketch(other[0], 240) == near_dedup.similarity_sketch(other[1], 240)).mean())
    assert np.mean(close) == pytest.approx(900 / 1100, abs=0.03)


def test_components(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = components(links, sorted({n for link in links if link[0] != link[1] for n in link}))
    assert got == want
