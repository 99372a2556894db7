"""Byte-level BPE: texts to token ids and ids back to bytes, by the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The characters with the Unicode property White_Space.
WHITE_SPACE = "\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Texts are encoded in parts of about so many characters.
PART = 1 << 16
#: Rows whose ids a worker holds at a time.
ROWS = 256
#: From here on a run of white space is a piece that the library's regex does not get to see; it fails on some 400,000.
LONG_RUN = 1 << 14

_BOUNDARY = re.compile(f"(?<=[^{WHITE_SPACE}])[{WHITE_SPACE}]")
_RUN = re.compile(f"[{WHITE_SPACE}]{{{LONG_RUN},}}")


@functools.lru_cache(maxsize=4)
def load_codec(ranks_path: str, pattern: str):
    """The codec of a rank file (token in base 64 and id per line) and its pattern, and one that takes a text as a single match."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    build = functools.partial(tiktoken.Encoding, mergeable_ranks=ranks, special_tokens={})
    return build("texts", pat_str=pattern), build("matches", pat_str="(?s:.+)")


def safe_parts(text: str, size: int = PART) -> Iterator[tuple[str, bool]]:
    """The text in parts that can be encoded one by one; True marks a part that is a single match.

    No match of the pattern holds white space after another character, so a
    text may be cut where such a character is followed by white space, and a
    match there begins anew. A part goes on to the first such place after
    ``size`` characters. A very long run of white space is one match without
    its last character, which belongs to what follows, if anything does.
    """
    start = 0
    while start < len(text):
        run = _RUN.match(text, start)
        if run:
            end = run.end() if run.end() == len(text) else run.end() - 1
            yield text[start:end], True
        else:
            cut = _BOUNDARY.search(text, start + size)
            end = cut.start() if cut else len(text)
            run = _RUN.search(text, start + 1, min(len(text), end + LONG_RUN))
            if run and run.start() < end:
                end = run.start()
            yield text[start:end], False
        start = end


def encode_text(text: str, ranks_path: str, pattern: str) -> np.ndarray:
    codec, whole = load_codec(ranks_path, pattern)
    if len(text) < LONG_RUN:
        return codec.encode_to_numpy(text, disallowed_special=())
    return np.concatenate([(whole if single else codec).encode_to_numpy(part, disallowed_special=()) for part, single in safe_parts(text)])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of each text, one row per input row.

    Each match of ``pattern`` is merged by the ranks on its own; special tokens
    do not exist, so their strings are ordinary text. A null or empty text has
    no ids. A text of any length is encoded whole, in parts that meet where no
    match can lie across. Repeated rows and null ids are rows like any other; an
    empty table gives an empty result; other columns are ignored. The rank file
    is read from ``ranks_path`` on each executor, once per Python worker.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            ids = [encode_text(text.as_py() or "", ranks_path, pattern) for text in batch.column(1)]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).view(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[id_col, "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(encode, f"{id_col} long, ids array<int>")


def decode_documents(tokens: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, bytes): the ids and the bytes that they stand for, one row per input row.

    Bytes and not text, as ids cut anywhere need not end a character. No ids
    give no bytes; null ids, and ids with a null or one that the rank file does
    not have, give null. Other columns are ignored.
    """
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_codec(ranks_path, pattern)[0]

        def decoded(ids: list[int] | None) -> bytes | None:
            try:
                return None if ids is None else codec.decode_bytes(ids)
            except (KeyError, TypeError, OverflowError):  # an id without a token, a null, a negative id
                return None

        for batch in _slices(batches):
            found = pa.array([decoded(ids.as_py()) for ids in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=[id_col, "ids", "bytes"])

    rows = tokens.select(F.col(id_col).cast("long"), F.col(ids_col).cast("array<int>"))
    return rows.mapInArrow(decode, f"{id_col} long, ids array<int>, bytes binary")
