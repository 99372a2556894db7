"""Packing: token pieces into fixed-length sequences, shortest pack first over the length histogram."""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfolio.session import cut_lineage

#: Splits text before the merges of a byte-level rank file: the pattern such vocabularies are published with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Its one special token, which takes the first id after the ranks.
SPECIAL = "<|endoftext|>"


@functools.lru_cache(maxsize=4)
def load_ranks(path: str):
    """The encoding of a rank file (token in base 64 and id per line); one per Python worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)})


def token_pieces(docs: DataFrame, ranks_path: str, size: int = 1024, end_id: int = 0, with_ids: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of each document and its end id, cut every ``size`` ids.

    Returns doc_id, start, length, ids_crc32, doc_tokens (and ids): at least one
    piece per row, as a null or empty text still has its end id.
    """
    schema = f"{id_col} long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_ranks(ranks_path).encode
        for batch in batches:
            out: list[tuple] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or "", allowed_special="all"), end_id], dtype="<u4")
                for start in range(0, len(ids), size):
                    piece = ids[start:start + size]
                    out.append((key, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), *([piece.astype("i4")] if with_ids else [])))
            columns = list(zip(*out, strict=True)) or [[]] * (5 + with_ids)
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(cut, schema)


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is used.

    Lengths come longest first. Pieces of a length go to the pack that is
    shortest so far, that is, has the most room; packs with the same pattern are
    handled as one count, so the work depends on the number of lengths and not
    of pieces. A length that fits nowhere opens new packs.
    """
    room: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(size + 1)]
    for length in sorted(counts, reverse=True):
        left, most = counts[length], size
        while left:
            while most >= length and not room[most]:
                most -= 1
            if most < length:
                room[size - length].append(((length,), left))
                break
            pattern, n = room[most].pop()
            used = min(n, left)
            if n > used:
                room[most].append((pattern, n - used))
            room[most - length].append(((*pattern, length), used))
            left -= used
    return [entry for packs in room for entry in packs]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, offset): which pieces of a length lie where."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rank = taken.get(length, 0)
            out.append((length, rank, rank + n, sequence, offset))
            taken[length] = rank + n
            offset += length
        sequence += n
    return out


def assign_sequences(pieces: DataFrame, size: int = 1024, order: tuple[str, ...] = ("doc_id", "start", "ids_crc32"), buckets: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to pieces that have a length of 1 to ``size``.

    Only the histogram, at most ``size`` numbers, goes to the driver, and only
    the slots come back: patterns are at most two per length, so their number
    depends on ``size`` alone. A piece's rank among those of its length is the
    count of the buckets before its own plus its place in it, so a length that
    most pieces have is ranked by many tasks.
    """
    spark = pieces.sparkSession
    rows = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = cut_lineage(rows.groupBy("length", "_bucket").agg(F.count("*").alias("_n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = spark.createDataFrame(slots(pack_histogram(histogram, size)), "_length long, _from long, _until long, _first long, _offset long")
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("length", "_bucket").orderBy(*order)
    ranked = rows.join(starts, ["length", "_bucket"]).withColumn("_rank", F.col("_start") + F.row_number().over(inside) - 1)
    fits = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_until"))
    return ranked.join(F.broadcast(plan), fits).select(
        *pieces.columns, (F.col("_first") + F.col("_rank") - F.col("_from")).alias("sequence_id"), F.col("_offset").alias("offset"))


def pack_documents(docs: DataFrame, ranks_path: str, size: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Packs all documents into sequences of at most ``size`` tokens.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ids), one row per piece. A null or empty text is its end id alone. A
    document longer than ``size`` is cut every ``size`` ids. Repeated rows are
    packed each; an empty table gives an empty result; other columns are ignored.
    """
    return assign_sequences(cut_lineage(token_pieces(docs, ranks_path, size, end_id, with_ids)), size)
