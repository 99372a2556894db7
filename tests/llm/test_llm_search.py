"""Block-Max MaxScore against scores of all documents."""

from __future__ import annotations

import math
import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_cases import awkward, empty  # noqa: E402

from dayfolio.llm import block_search  # noqa: E402

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(documents, items, size=10):
    """{(item, text): [(doc, score)]} over all documents."""
    cut = [(d, Counter(terms(t))) for d, t in documents]
    n_docs, n_words = sum(bool(c) for _, c in cut), sum(c.total() for _, c in cut)
    df = Counter(t for _, c in cut for t in c)
    out = {}
    for item, text in set(items):
        scored = []
        for doc, c in cut:
            m = 10 + (90 * c.total() * n_docs) // n_words if n_words else 10
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc, score))
        out[item, text] = [(d, s) for _, _, d, s in sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:size]]
    return out


def check(got, want):
    found = {}
    for r in sorted(got, key=lambda r: r.rank):
        found.setdefault(r.item_id, []).append((r.rank, r.doc_id, r.score))
    lists = {}
    for (item, _), rows in want.items():
        lists.setdefault(item, []).extend((i + 1, d, s) for i, (d, s) in enumerate(rows))
    order = lambda x: (x[0], -x[2], x[1] is None, x[1] or 0)
    assert {k: sorted(v, key=order) for k, v in found.items()} == {k: sorted(v, key=order) for k, v in lists.items() if v}


def corpus(rng, n):
    words = [f"w{i}" for i in range(300)] + ["été", "Ünder", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i * 3 - 50, " ".join(rng.choices(words, weights, k=rng.choice([1, 3, 20, 120])))) for i in range(n)]


@pytest.mark.parametrize("shard_docs", [3, 400, 5000])
def test_best_documents_are_those_of_a_full_scan(spark, shard_docs):
    rng = random.Random(shard_docs)
    documents = corpus(rng, 1500)
    documents += [(10_000 + i, documents[7][1]) for i in range(500)] + [(None, documents[7][1]), (10_001, documents[7][1]), (20_000, None), (20_001, ""), (20_002, "-- !!")]
    items = [(i, " ".join(rng.choices([f"W{j}" for j in range(300)] + ["été", "absent"], k=rng.choice([1, 4, 25])))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "nothing_here x/y"), items[0], (1, "w0 w1"), (103, documents[7][1])]
    docs = spark.createDataFrame([(d, t, "a", 1) for d, t in documents], "doc_id long, text string, item string, score int").repartition(3)
    asked = spark.createDataFrame([(i, t, "b", 2) for i, t in items], "item_id long, text string, term string, block int")
    index, n = block_search.build_index(docs, shard_docs=shard_docs)
    want = brute(documents, items)
    check(block_search.search_index(index, n, asked).collect(), want)
    if shard_docs == 400:
        check(block_search.search_index(index, n, asked, items_at_once=9, broadcast_bytes=0).collect(), want)
        check(block_search.search_index(index, n, asked, size=3).collect(), brute(documents, items, 3))


def test_blocks_are_rejected_before_decompression(monkeypatch):
    rng = np.random.default_rng(1)
    n = 40_000
    norm = np.full(n, 100, np.int64)

    def postings(weight, docs, tf):
        docs, tf = np.asarray(docs), np.asarray(tf, np.int64)
        gaps = np.diff(docs, prepend=-1)
        data, places = block_search.pack_numbers(np.stack([gaps, tf], axis=1).ravel())
        heads = np.arange(0, len(docs), block_search.BLOCK)
        tails = np.append(heads[1:], len(docs)) - 1
        tops = np.maximum.reduceat(block_search.impacts(tf, norm[docs]), heads)
        return block_search._Postings(weight, len(docs), int(tops.max()), docs[tails], tops, places[2 * heads], data.tobytes(), norm)

    rare = np.sort(rng.choice(n, 60, replace=False))
    lists = [postings(9000, rare, np.full(60, 3)), postings(50, np.arange(n), np.where(np.arange(n) % 997 == 0, 5, 1)), postings(20, np.arange(0, n, 2), np.ones(n // 2))]
    docs, scores = block_search.best_documents(lists, 10, n)
    total = np.zeros(n, np.int64)
    opened = [int(p.open.sum()) for p in lists]
    for p in lists:
        p.ensure(np.arange(len(p.lasts)))
        total[p.docs] += p.scores
    order = np.lexsort((np.arange(n), -total))[:10]
    assert docs.tolist() == order.tolist() and scores.tolist() == total[order].tolist()
    assert opened[1] < 100 and opened[2] < 100  # of 313 and 157 blocks


def test_packed_numbers_round_trip():
    values = np.concatenate([np.arange(1, 400), 2 ** np.arange(31), 2 ** np.arange(1, 32) - 1]).astype(np.int64)
    data, places = block_search.pack_numbers(values)
    assert block_search.unpack_numbers(data).tolist() == values.tolist() and places[-1] == len(data)


def test_awkward_tables(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(i, t) for i, t in enumerate(["w1 w2 the", "und", None, "été por", "word", "endoftext c"])]
    asked = spark.createDataFrame(items, "item_id long, text string")
    check(block_search.rank_documents(docs, asked).collect(), brute(rows, items))
    assert block_search.rank_documents(empty(spark), asked).count() == 0
    assert block_search.rank_documents(docs, asked.limit(0)).count() == 0
