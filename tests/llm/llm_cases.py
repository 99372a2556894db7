"""Small tables with nulls, empty and long texts, ties, repeated rows and columns whose names clash."""

from __future__ import annotations

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n string, batch string, label string, _id long, size string, _lines int"
CLASH = ("x", "y", "z", "w", 5, "u", 1)


def text_of(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    words = [f"w{rng.randrange(vocabulary):x}" if rng.random() < 0.7 else rng.choice(["the", "und", "été", "por"]) for _ in range(n)]
    return ". ".join(" ".join(words[i:i + 9]) for i in range(0, n, 9)) + "."


def awkward(spark, seed: int = 5):
    rng = random.Random(seed)
    rows = [(i, text_of(rng, rng.randrange(12, 90)).replace(". ", ".\n"), rng.choice(["en", "de"]), rng.choice(["a", "b", "é", None]), i) for i in range(40)]
    rows += [(50, None, None, None, None), (51, "", "en", "a", 0), (52, "  \n\t ", "de", "b", 5), (53, "word", None, "a", 4), (54, "123 456 %%%", "en", "b", 11)]
    rows += [(55, text_of(rng, 30_000), "en", "b", 1), (56, "x" * 50_000, None, "a", 50_000), (57, "a\x00b \U0001F600 é\u00a0ü <|endoftext|> c", "en", "b", 9)]
    rows += [(60, rows[3][1], "en", "a", 3), (61, rows[3][1], "en", None, 3), rows[4], rows[4], (None, rows[5][1], "en", "a", 1), (None, "no id at all here", None, None, 2)]
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA)


def empty(spark):
    return awkward(spark).limit(0)


def components(links: list[tuple[int, int]], nodes: list[int]) -> dict[int, int]:
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
