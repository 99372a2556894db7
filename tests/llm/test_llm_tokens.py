"""Byte-level BPE against the library on whole texts, and a round trip."""

from __future__ import annotations

import hashlib
import random
import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import public_tokenizers  # noqa: E402
from llm_cases import awkward, empty  # noqa: E402

from dayfolio.llm import byte_pairs, queries  # noqa: E402

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SMALL = "/root/testdata/sf0.001"


def whole(text: str | None) -> list[int]:
    return byte_pairs.load_codec(RANKS, PATTERN)[0].encode_ordinary(text or "")


def by_parts(text: str, size: int) -> list[int]:
    codec, single = byte_pairs.load_codec(RANKS, PATTERN)
    parts = list(byte_pairs.safe_parts(text, size))
    assert "".join(p for p, _ in parts) == text
    return [i for p, alone in parts for i in (single if alone else codec).encode_ordinary(p)]


def test_parts_have_the_ids_of_the_whole():
    rng = random.Random(3)
    alphabet = [*"abc XYZ019'\"-.,\n\t 　\x1c\x1f\x85 ", "'s", "'re", "é", "ß", "中", "文", "½", "\U0001F600", "́", "   ", "\n\n"]
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200)))
        for size in (1, 7, 40):
            assert by_parts(text, size) == whole(text)


def test_long_runs_of_white_space(monkeypatch):
    n = byte_pairs.LONG_RUN
    for run in (" " * n, " " * (n + 1), "\n" * (n + 5), " \n" * n):
        for text in (run, "a" + run, run + "b c", "a" + run + "b c", "a b" + run + "é", run + "x" + run):
            assert byte_pairs.encode_text(text, RANKS, PATTERN).tolist() == whole(text)
    text = "a" + " " * 1_000_000 + "b"  # the library's own regex gives up here
    ids = byte_pairs.encode_text(text, RANKS, PATTERN).tolist()
    assert byte_pairs.load_codec(RANKS, PATTERN)[0].decode_bytes(ids) == text.encode() and ids[-1] == whole(" b")[0]


def test_round_trip(spark):
    docs = awkward(spark)
    tokens = byte_pairs.encode_documents(docs, RANKS, PATTERN)
    rows = byte_pairs.decode_documents(tokens, RANKS, PATTERN).collect()
    key = lambda i: -1 if i is None else i
    assert sorted((key(r.doc_id), r.ids, bytes(r.bytes)) for r in rows) == sorted((key(r.doc_id), whole(r.text), (r.text or "").encode()) for r in docs.collect())
    assert byte_pairs.encode_documents(empty(spark), RANKS, PATTERN).count() == 0
    odd = spark.createDataFrame([(1, [50256]), (2, None), (3, []), (4, [-1]), (5, [None, 3])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.bytes for r in byte_pairs.decode_documents(odd, RANKS, PATTERN).collect()} == {1: None, 2: None, 3: b"", 4: None, 5: None}


def test_query(spark):
    got = Counter(map(tuple, queries.QUERIES["op12_byte_bpe"](spark, SMALL).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()))
    hexed = lambda b: hashlib.sha256(b).hexdigest()
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert got == Counter((r.doc_id, len(whole(r.text)), hexed(" ".join(map(str, whole(r.text))).encode()), hexed((r.text or "").encode())) for r in rows)
