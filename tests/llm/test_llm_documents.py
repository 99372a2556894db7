"""Exact dedup, quality rules, mixing, packing and line dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import public_tokenizers  # noqa: E402
from llm_cases import SCHEMA, WORDS, awkward, empty  # noqa: E402
from oracle import compare, connect  # noqa: E402

from dayfolio.llm import exact_dedup, line_quality, line_templates, mixing, packing, queries  # noqa: E402

SMALL = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def docs(spark):
    return awkward(spark).cache()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    assert compare(spark, connect(SMALL), queries.QUERIES[name], queries.SQL[name], SMALL)[1] is None


def test_exact_duplicates(docs):
    groups = defaultdict(list)
    for r in docs.collect():
        groups[r.text or ""].append(r.doc_id)
    want = Counter()
    for text, ids in groups.items():
        stays = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, stays, len(ids), i == stays, hashlib.sha256(text.encode()).hexdigest()] += 1
    for runs in (16, 7, 1):
        assert Counter(map(tuple, exact_dedup.exact_duplicates(docs, runs=runs).collect())) == want


def test_runs_merge_two_by_two(spark):
    rng = random.Random(11)
    entries = [(run, bytes([rng.randrange(3), rng.randrange(2)]) + b"x", 1, 2, rng.choice([None, 5, 6, 7]), rng.randrange(1, 4)) for run in range(5) for _ in range(6)]
    table = spark.createDataFrame(entries, "_run long, _digest binary, _length int, _check long, _keep long, _n long").selectExpr("*", "substring(_digest, 1, 2) as _part")
    got = exact_dedup.merge_runs(table)
    want = defaultdict(lambda: [None, 0])
    for run, digest, _, _, keep, n in entries:
        own = want[run // 2, digest]
        own[0], own[1] = max((k for k in (own[0], keep) if k is not None), default=None), own[1] + n
    assert {(r._run, bytes(r._digest)): [r._keep, r._n] for r in got.collect()} == want and got.count() == len(want)
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Sort ") == 1 and "HashAggregate" not in plan  # sorted runs stay sorted


def brute_quality(text: str | None):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


def test_quality_counts(spark, docs):
    rng = random.Random(3)
    more = [" ".join(rng.choice("abc") for _ in range(rng.randrange(3, 30))) for _ in range(60)] + ["a b c d e a b c d e", "\n".join(["p q", "p q", "", " ", "p q"])]
    rows = docs.select("doc_id", "text").collect() + spark.createDataFrame(list(enumerate(more)), "doc_id long, text string").collect()
    table = spark.createDataFrame([(r.doc_id, r.text, i) for i, r in enumerate(rows)], "doc_id long, text string, row int")
    got = {r.row: r for r in line_quality.assess_quality(table).collect()}
    for i, r in enumerate(rows):
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == brute_quality(r.text)
        assert not (g.base_failed and g.kept)


def test_quality_lines(spark, docs):
    good = "This line is a whole sentence with a good number of words in it."
    other = "Quite another one follows here, and that is where the short text ends now."
    bad = ["Home | News | About | Contact | Help", "We use cookies to improve this site.", "BUY!! NOW!! TODAY!! CHEAP!!", "Older posts", "### *** $$$ %%%"]
    table = spark.createDataFrame([(1, "\n".join([good, *bad, "", other])), (2, "\n".join([good, *bad * 9]) ), (3, good + " And so on it goes.")], "doc_id int, text string")
    got = {r.doc_id: r for r in line_quality.assess_quality(table).collect()}
    assert got[1].clean_text == "\n".join([good, "", other]) and got[1].n_failed_lines == 5 and got[1].kept
    assert not got[2].kept and got[3].kept and got[3].lost_chars == 0
    judged = line_quality.assess_quality(docs)  # its columns win over those of the same name
    assert dict(judged.dtypes)["kept"] == "boolean" and judged.count() == docs.count()
    assert line_quality.assess_quality(docs.limit(0)).count() == 0


def targets(sizes: dict, share=1.5, most=2.0, weights=(3, 1, 2)) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    full: set = set()
    while True:
        rest = [s for s in names if s not in full]
        level = (share * sum(sizes.values()) - sum(most * sizes[s] for s in full)) / max(1, sum(weight[s] for s in rest))
        above = {s for s in rest if weight[s] * level > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else weight[s] * level for s in names}
        full |= above


def check_mix(rows, texts):
    sizes = Counter()
    for text, source in texts:
        sizes[source] += len(WORDS.findall(text or ""))
    want, taken, largest = targets(sizes), Counter(), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6 for s in sizes)


def test_mixing(spark, docs):
    rows = mixing.mix_sources(docs, chunk=4).collect()
    assert len(rows) == docs.count()
    check_mix(rows, [(r.text, r.source) for r in docs.collect()])
    assert Counter(rows) == Counter(mixing.mix_sources(docs.repartition(3), chunk=4).collect())
    alike = docs.unionByName(docs.withColumn("text", F.reverse("text")))  # two texts of one id, source and size
    assert Counter(mixing.take_mix(alike, chunk=4).collect()) == Counter(mixing.take_mix(alike.repartition(5), chunk=4).collect())
    took = mixing.take_mix(docs, chunk=4)
    assert took.columns == docs.columns and took.count() == sum(r.copies for r in rows)
    assert mixing.mix_sources(empty(spark)).count() == 0 and mixing.take_mix(empty(spark)).count() == 0


def test_mixing_spreads_choice(spark):
    table = spark.createDataFrame([(i, "a b c d e", "s" if i % 3 else "t") for i in range(600)], "doc_id long, text string, source string")
    rows = mixing.mix_sources(table, share=0.5).collect()
    assert sum(r.taken for r in rows) == pytest.approx(1500, abs=6)
    low = sum(r.copies for r in rows if r.doc_id < 300)
    assert 90 < low < 210  # about half of 300 copies


def test_tokens_are_those_of_the_other_library(spark):
    from tokenizers import Tokenizer

    other, rng = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), random.Random(8)
    pick = [lambda: rng.randrange(1, 128), lambda: rng.randrange(128, 0xD800), lambda: rng.randrange(0xE000, 0x11000), lambda: 32, lambda: 10, lambda: 0xA0, lambda: 39]
    texts = ["".join(chr(rng.choice(pick)()) for _ in range(rng.randrange(30))) for _ in range(400)] + ["a<|endoftext|> b", "don't  x"]
    encode = packing.load_ranks(RANKS).encode
    assert [encode(t, allowed_special="all") for t in texts] == [e.ids for e in other.encode_batch(texts, add_special_tokens=False)]


def check_packed(rows, texts, size):
    encode = packing.load_ranks(RANKS).encode
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    found = Counter()
    for key, own in pieces.items():
        for r in own:
            if r.start == 0:
                found[key, r.doc_tokens] += 1
        assert all(len(r.ids) == r.length <= size for r in own)
    assert found == Counter((k, len(encode(t or "", allowed_special="all")) + 1) for k, t in texts)
    whole = Counter(i for r in rows for i in r.ids)
    assert whole == Counter(i for _, t in texts for i in [*encode(t or "", allowed_special="all"), 0])
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in own])
        assert [r.offset for r in own] == [0, *ends[:-1]] and ends[-1] <= size


def test_packing(spark, docs):
    rows = packing.pack_documents(docs, RANKS, size=64, with_ids=True).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()], 64)
    assert packing.pack_documents(empty(spark), RANKS).count() == 0


def test_pack_histogram_is_tight():
    rng = random.Random(1)
    counts = {n: rng.randrange(1, 10**6) for n in range(1, 1025)}
    patterns = packing.pack_histogram(counts, 1024)
    placed = Counter()
    for pattern, n in patterns:
        assert sum(pattern) <= 1024
        for length in pattern:
            placed[length] += n
    assert placed == counts and len(patterns) <= 2 * 1024
    assert sum(k * v for k, v in counts.items()) / (1024 * sum(n for _, n in patterns)) > 0.98


def test_line_templates(spark, docs):
    note = "Posted on 2024-{} by the web team of this site, see page {} for more of it."
    rows = [(1, note.format("01-02", 3) + "\nFirst own line here, with words."), (2, "Second own line, also with words.\n" + note.format("05-07", 44)),
            (3, note.format("11-30", 1)), (4, "short one.\nshort one."), (5, "short one."), (6, "said twice here by me alone\nsaid twice here by me alone")]
    rows += [(10 + i, f"the server {name} has gone away and will be back in a little while") for i, name in enumerate(["alpha", "beta", "alpha", "gamma"])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_templates.drop_recurring_lines(table, depth=2).collect()}
    assert got[1] == (rows[0][1], 0) and got[2] == ("Second own line, also with words.", 1) and got[3] == ("", 1)
    assert got[4][1] == got[5][1] == got[6][1] == 0
    assert got[10][1] == 0 and [got[i] for i in (11, 12, 13)] == [("", 1)] * 3
    kept = line_templates.drop_recurring_lines(docs)
    assert kept.count() == docs.count() and set(docs.columns) <= set(kept.columns)
    by_id = {(r.doc_id, r.source): r for r in kept.collect()}
    assert all(len(line.split()) < 5 for line in by_id[60, "a"].text.split("\n")) and by_id[50, None].text == "" and by_id[4, docs.filter("doc_id = 4").first().source].n_dropped == 0
    assert line_templates.drop_recurring_lines(empty(spark)).count() == 0


def brute_lines(docs: list[tuple[int | None, str | None]], depth: int, percent: int = 75, least: int = 5, short: int = 5) -> dict[int, str]:
    """The text that is left of each document, by comparing each line with those of all earlier documents."""
    lines = [(d, p, line) for d, text in docs for p, line in enumerate((text or "").split("\n"))]
    cut = [(d, p, ["<*>" if re.search("[0-9]", w) else w for w in WORDS.findall(line)]) for d, p, line in lines if d is not None]
    leaves = defaultdict(list)
    for d, p, words in cut:
        if words:
            leaves[len(words), *words[:depth]].append((d, p, words))
    gone = set()
    for (n, *_), own in leaves.items():
        for d, p, words in own:
            if n >= least:
                if any(e < d and 100 * sum(map(str.__eq__, words, other)) >= percent * n for e, _, other in own):
                    gone.add((d, p))
            elif len({e for e, _, other in own if other == words}) >= short and any(e < d for e, _, other in own if other == words):
                gone.add((d, p))
    left = defaultdict(list)
    for d, p, line in lines:
        if d is not None and (d, p) not in gone:
            left[d].append(line)
    return {d: "\n".join(left[d]) for d, _ in docs if d is not None}


FAMILY = [(1, "this page was written by somebody else entirely, in fact some years ago")]
FAMILY += [(10 + i, f"this page was written by {name} for all of our readers") for i, name in enumerate("ann bob cleo dan eve fay gus hal ida jon".split())]
WIDE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


def test_many_templates_in_a_leaf(spark):
    rows = [*FAMILY, (2, WIDE), (3, WIDE.replace("six", "6x").replace("ten", "x").replace("fourteen", "y")), (4, "one two three four " + " ".join("abcdefghijkl"))]
    rows += [(100 + i, "All rights reserved.") for i in range(10)] + [(200 + i, "Good morning to you.") for i in range(4)]
    rows += [(300, "this page was written by <b> ann </b> for all"), (301, "a b c d e"), (302, "a b c d f"), (303, "a b c g e")]
    got = {r.doc_id: r.text for r in line_templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(10, 20)] == [FAMILY[1][1]] + [""] * 9 and got[1] == FAMILY[0][1]
    assert got[2] == WIDE and got[3] == "" and got[4] != ""
    assert [got[100 + i] for i in range(10)] == ["All rights reserved."] + [""] * 9 and all(got[200 + i] for i in range(4))
    assert got[301] and not got[302] and got[303]
    assert got == brute_lines(rows, 4)


@pytest.mark.parametrize("hubs", [1, 4])
def test_lines_agree_with_all_pairs(spark, docs, hubs):
    rng = random.Random(hubs)
    words = "a b c d e f".split()
    rows = [(i, "\n".join(" ".join(rng.choice(words[:2 if k < 3 else 6]) for k in range(rng.randrange(1, 14))) for _ in range(rng.randrange(6)))) for i in range(250)]
    rows += [(i, "x y z w " + " ".join(rng.choice("pqrst") for _ in range(9))) for i in range(300, 420)]  # one leaf of unlike and alike lines
    rows += [(None, rows[3][1]), (7, rows[9][1]), (500, None), (501, "\t a  b\x0bc 1 2 \r")] + [(600 + i, "the very same line of text as in all of these") for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    drops = line_templates.recurring_lines(table, depth=2, hubs=hubs).collect()
    one_each = [(d, t) for d, t in rows if d not in (None, 7)]
    table = spark.createDataFrame(one_each, "doc_id long, text string").repartition(6)
    assert {r.doc_id: r.text for r in line_templates.drop_recurring_lines(table, depth=2).collect()} == brute_lines(one_each, 2)
    places = {(r.doc, r.pos) for r in line_templates.recurring_lines(table, depth=2, hubs=hubs).collect()}
    left = {d: "\n".join(x for p, x in enumerate((t or "").split("\n")) if (d, p) not in places) for d, t in one_each}
    assert left == brute_lines(one_each, 2) and drops


def test_schema_has_clashing_names():
    assert all(name in SCHEMA for name in ("kept", "batch", "label", "_id", "size"))
