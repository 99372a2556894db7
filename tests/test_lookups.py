"""Author badges and secrets, found in place."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from dayfolio.functions import text as X
from dayfolio.operators import reconcile as RC
from dayfolio.plans import audits as Y

KNOWN = [(0, "Zoë Ångström", ["Z. Angstrom"], ["gr-qc", "hep-th"], "prize one"), (1, "ZOE ANGSTROM", None, ["gr-qc"], "prize two"), (2, "José-María López", [None, "J M Lopez"], ["quant-ph"], "prize three"), (3, None, None, None, "none")]


@pytest.mark.parametrize("registry_bytes", [1 << 20, 0])
def test_badges_of_papers_that_are_listed_twice(spark, registry_bytes):
    registry = spark.createDataFrame([(*k, "evidence", ["https://x.org"]) for k in KNOWN],
                                     "entry int, canonicalName string, aliases array<string>, fieldTags array<string>, distinction string, identityEvidence string, officialUrls array<string>")
    papers = [("d", "gr-qc", "1", ["Other One", "zoe  ångström", "Z Angstrom"]), ("d", "gr-qc", "1", ["Other One", "zoe  ångström", "Z Angstrom"]), ("d", "quant-ph", "2", ["Zoe Angstrom", "jose maria lopez"]),
              ("d", "quant-ph", "3", None), ("d", "hep-th", "4", []), ("d", "hep-th", "5", [None, "Z-Angstrom"])]
    table = spark.createDataFrame(papers, "report_date string, slug string, arxivId string, authors array<string>")
    got = RC.match_authors(table, registry, registry_bytes=registry_bytes)
    assert got.columns == [*table.columns, "eminentAuthors"] and [f.name for f in got.schema["eminentAuthors"].dataType.elementType] == ["authorName", "label", "reason", "identityEvidence", "evidenceUrls"]
    badges = sorted((r.arxivId, [(b.authorName, b.reason) for b in r.eminentAuthors]) for r in got.collect())
    twice = ("1", [("zoe  ångström", "prize one"), ("Z Angstrom", "prize one")])
    assert badges == [twice, twice, ("2", [("jose maria lopez", "prize three")]), ("3", []), ("4", []), ("5", [("Z-Angstrom", "prize one")])]


def test_keys_of_names_agree_with_the_column(spark):
    rng = random.Random(4)
    alphabet = "aZßİıÅéñŁøΣς中日 .-'’́ ½²Ⅷ_"
    names = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) for _ in range(300)]
    got = spark.createDataFrame(list(enumerate(names)), "i int, n string").select("i", X.author_key("n").alias("k")).collect()
    keys = X.AuthorKeys()
    assert [keys[names[r.i]] for r in got] == [r.k for r in got]


def test_fixed_text_is_only_a_shortcut(spark):
    rng = random.Random(5)
    parts = ["AKIA", "Q" * 16, "sk-", "ghp_", "gho_", "q" * 20, "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "Authorization", ": ", "Bearer ", "api_key", "API-KEY", "access_token", " = ", "'", "password", ":", "//u:p@h", "https", "changeme", " ", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(800)]
    texts += [None, "", "authorization : BEARER " + "q" * 20, "Authorization: Bearer short", "x GHP_" + "q" * 20, "akia" + "Q" * 16]
    table = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {(r.i, r.rule) for r in Y.scan_secrets(table, "text", ["i"]).collect()}
    content = [(name, pattern) for name, pattern in Y.SECRET_RULES if pattern in Y.SECRET_LITERALS]
    want = set()
    for name, pattern in content:
        want |= {(r.i, name) for r in table.where(F.col("text").rlike(pattern)).collect()}
    assert got == want and {name for _, name in want} == {name for name, _ in content} and len(content) == 7
