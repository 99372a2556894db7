"""Ranked lexical search by Block-Max MaxScore over an inverted index in shards."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfolio.llm.common import small_enough, staged, text_of

#: A term: a run of ASCII letters, digits and any other than ASCII characters.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Postings in a block; bytes of text and documents in a shard, which one task builds and searches.
BLOCK, SHARD_BYTES, SHARD_DOCS = 128, 32 << 20, 1 << 16
#: Items that are searched together, and the most bytes of their terms that are broadcast.
ITEMS, BROADCAST_BYTES = 500, 16 << 20

#: For each byte: itself if it belongs to a term, A-Z lower-cased; else a space.
_FOLD = bytes(b + 32 * (65 <= b <= 90) if b > 127 or chr(b).isalnum() else 32 for b in range(256))

_INDEX = "shard long, term string, df int, best long, lasts array<int>, tops array<long>, offsets array<int>, postings binary, docs array<long>, norms array<long>"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, A-Z lower-cased."""
    return (text or "").encode().translate(_FOLD).split()


def impacts(tf: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * norms)


def pack_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive numbers in seven bits a byte, and where each begins (and the last ends)."""
    sizes = np.ones(len(values), np.int64)
    for k in range(1, 5):
        sizes += values >= 1 << 7 * k
    places = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(places[-1], np.uint8)
    for k in range(5):
        there = sizes > k
        out[places[:-1][there] + k] = (values[there] >> 7 * k) & 127 | np.where(sizes[there] > k + 1, 128, 0)
    return out, places


def unpack_numbers(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    out = (data[starts] & 127).astype(np.int64)
    for k in range(1, int((ends - starts).max(initial=0)) + 1):
        more = ends - starts >= k
        out[more] |= (data[starts[more] + k] & 127).astype(np.int64) << 7 * k
    return out


def index_shard(shard: int, documents: list[tuple[int | None, str]], n_docs: int, n_terms: int) -> pa.RecordBatch:
    """One row per term of the documents, and one without a term that holds their ids and lengths.

    Documents are numbered by their id, null last. A term's postings (distance
    to the document before, occurrences) lie in blocks; each block's last
    document, largest impact and first byte stay outside, uncompressed.
    """
    documents = sorted(documents, key=lambda d: (d[0] is None, d[0] or 0))
    vocabulary: dict[bytes, int] = {}
    norms, sizes, terms, counts = [], [], [], []
    for _, text in documents:
        found = terms_of(text)
        norms.append(10 + (90 * len(found) * n_docs) // n_terms if n_terms else 10)
        tf = Counter(found)
        sizes.append(len(tf))
        terms.append(np.fromiter((vocabulary.setdefault(t, len(vocabulary)) for t in tf), np.int64, len(tf)))
        counts.append(np.fromiter(tf.values(), np.int64, len(tf)))
    names = sorted(vocabulary)
    place = np.empty(len(names), np.int64)
    place[[vocabulary[t] for t in names]] = np.arange(len(names))
    norm = np.array(norms, np.int64)
    term = place[np.concatenate(terms)] if names else np.empty(0, np.int64)
    order = np.argsort(term, kind="stable")  # documents stay in their order
    term, doc, tf = term[order], np.repeat(np.arange(len(documents)), sizes)[order], np.concatenate([*counts, np.empty(0, np.int64)])[order]
    df = np.bincount(term, minlength=len(names))
    first = np.cumsum(df) - df
    inside = np.arange(len(term)) - first[term]
    gaps = doc - np.concatenate([[-1], doc[:-1]])
    gaps[inside == 0] = doc[inside == 0] + 1
    data, places = pack_numbers(np.stack([gaps, tf], axis=1).ravel())
    heads = np.flatnonzero(inside % BLOCK == 0)
    tails = np.concatenate([heads[1:], [len(term)]]) - 1 if len(heads) else heads
    tops = np.maximum.reduceat(impacts(tf, norm[doc]), heads) if len(heads) else heads
    blocks = np.concatenate([[0], np.cumsum(-(-df // BLOCK))])
    best = np.maximum.reduceat(tops, blocks[:-1]) if len(names) else tops
    bytes_from = np.concatenate([places[2 * first], [len(data)]]) if len(names) else np.zeros(1, np.int64)
    offsets = places[2 * heads] - np.repeat(bytes_from[:-1], np.diff(blocks))

    def listed(values: np.ndarray, kind: pa.DataType) -> pa.Array:  # one list per term, and an empty one
        return pa.ListArray.from_arrays(pa.array(np.append(blocks, blocks[-1]), pa.int32()), pa.array(values, kind))

    starts = np.append(bytes_from, len(data)).astype(np.int32)
    rest = [None] * len(names)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(names) + 1, shard)), pa.array([*names, None], pa.binary()).cast(pa.string()), pa.array(np.append(df, 0), pa.int32()), pa.array(np.append(best, 0), pa.int64()),
        listed(doc[tails], pa.int32()), listed(tops, pa.int64()), listed(offsets, pa.int32()),
        pa.Array.from_buffers(pa.binary(), len(names) + 1, [None, pa.py_buffer(starts.tobytes()), pa.py_buffer(data.tobytes())]),
        pa.array([*rest, [i for i, _ in documents]], pa.list_(pa.int64())), pa.array([*rest, norms], pa.list_(pa.int64()))],
        names=["shard", "term", "df", "best", "lasts", "tops", "offsets", "postings", "docs", "norms"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, shard_docs: int = SHARD_DOCS) -> tuple[DataFrame, int]:
    """The index of all documents, written to the shared folder, and the number of documents with a term.

    Documents stay in the partitions they are read in; a task closes a shard at
    so many bytes of text or documents, so its memory does not depend on the
    size of a partition. The counts that impacts need come from one earlier pass.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    words = F.regexp_count(text_of("text"), F.lit(TERM)).cast("long")
    counts = rows.select(words.alias("n")).agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = counts["docs"], counts["terms"]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str]] = []
        size, shard = 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                value = text.as_py()
                if value:
                    held.append((key.as_py(), value))
                    size += len(value)
                if size >= shard_bytes or len(held) >= shard_docs:
                    yield index_shard(shard, held, n_docs, n_terms)
                    held, size, shard = [], 0, shard + 1
        if held:
            yield index_shard(shard, held, n_docs, n_terms)

    return staged(rows.mapInArrow(shards, _INDEX))[0], n_docs


class _Postings:
    """A term's postings in a shard; blocks are decompressed when they are asked for, and once."""

    def __init__(self, weight: int, df: int, best: int, lasts: np.ndarray, tops: np.ndarray, offsets: np.ndarray, data: bytes, norms: np.ndarray):
        self.weight, self.df, self.best, self.lasts, self.tops, self.norms = weight, df, weight * best, lasts, weight * tops, norms
        self.offsets, self.data = np.append(offsets, len(data)), np.frombuffer(data, np.uint8)
        self.docs, self.scores = np.empty(df, np.int64), np.empty(df, np.int64)
        self.open = np.zeros(len(lasts), bool)

    def _decompress(self, start: int, end: int) -> None:
        """The blocks from start up to end."""
        gaps, tf = unpack_numbers(self.data[self.offsets[start]:self.offsets[end]]).reshape(-1, 2).T
        docs = np.cumsum(gaps) + (self.lasts[start - 1] if start else -1)
        own = slice(start * BLOCK, min(end * BLOCK, self.df))
        self.docs[own], self.scores[own] = docs, self.weight * impacts(tf, self.norms[docs])
        self.open[start:end] = True

    def ensure(self, blocks: np.ndarray) -> None:
        """Decompresses those of the ascending blocks that are not yet, neighbours at once."""
        closed = blocks[~self.open[blocks]]
        if len(closed):
            for run in np.split(closed, np.flatnonzero(np.diff(closed) > 1) + 1):
                self._decompress(int(run[0]), int(run[-1]) + 1)

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) from low up to high."""
        start, end = int(np.searchsorted(self.lasts, low)), min(int(np.searchsorted(self.lasts, high - 1)) + 1, len(self.lasts))
        if start >= end:
            return self.docs[:0], self.scores[:0]
        self.ensure(np.arange(start, end))
        docs = self.docs[start * BLOCK:end * BLOCK]
        cut = slice(int(np.searchsorted(docs, low)), int(np.searchsorted(docs, high)))
        return docs[cut], self.scores[start * BLOCK:end * BLOCK][cut]

    def bounds(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block that each document would lie in (the number of blocks: none), and that block's largest score."""
        block = np.searchsorted(self.lasts, docs)
        return block, np.append(self.tops, 0)[block]

    def scores_of(self, docs: np.ndarray, block: np.ndarray) -> np.ndarray:
        there = block < len(self.lasts)
        self.ensure(np.unique(block[there]))
        out = np.zeros(len(docs), np.int64)
        starts = block[there] * BLOCK
        for k in np.unique(block[there]):
            own = np.flatnonzero(there)[starts == k * BLOCK]
            part = slice(k * BLOCK, min((k + 1) * BLOCK, self.df))
            at = np.searchsorted(self.docs[part], docs[own])  # never past the end: the block's last is no smaller
            out[own] = np.where(self.docs[part][at] == docs[own], self.scores[part][at], 0)
        return out


def best_documents(lists: list[_Postings], size: int, n_docs: int, window: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the ``size`` highest sums above 0, equal ones by ascending document.

    Documents go by in windows that double. The lists whose largest scores
    together do not exceed the threshold, the lowest of the best sums so far,
    cannot lift a document by themselves: only the other, essential lists name
    candidates. A candidate's bound is its essential score and the largest
    score of its block in each other list; one that does not exceed the
    threshold is rejected before any such block is decompressed, and the bounds
    tighten list by list. A later document does not displace an equal one, so a
    bound equal to the threshold is enough to reject.
    """
    lists = sorted(lists, key=lambda p: p.best)
    prefix = np.cumsum([p.best for p in lists])
    docs, scores, threshold = np.empty(0, np.int64), np.empty(0, np.int64), 0
    low = 0
    while low < n_docs:
        high = min(low + window, n_docs)
        essential = int(np.searchsorted(prefix, threshold, side="right"))
        if essential == len(lists):
            break
        total = np.zeros(high - low, np.int64)
        for postings in lists[essential:]:
            found, own = postings.between(low, high)
            total[found - low] += own
        candidates = np.flatnonzero(total)
        bound = total[candidates]
        candidates = candidates + low
        others = []
        for postings in lists[:essential]:
            block, top = postings.bounds(candidates)
            bound = bound + top
            others.append((block, top))
        alive = np.flatnonzero(bound > threshold)
        for i in range(essential - 1, -1, -1):
            if not len(alive):
                break
            block, top = others[i]
            bound[alive] += lists[i].scores_of(candidates[alive], block[alive]) - top[alive]
            alive = alive[bound[alive] > threshold]
        if len(alive):
            docs, scores = np.append(docs, candidates[alive]), np.append(scores, bound[alive])
            order = np.lexsort((docs, -scores))[:size]
            docs, scores = docs[order], scores[order]
            threshold = int(scores[-1]) if len(scores) == size else 0
        low, window = high, window * 2
    return docs, scores


def _search_shard(table: pa.Table, size: int) -> pa.Table:
    """The best documents of one shard for each item of one block of items."""
    table = table.combine_chunks()
    rows = [table.column(c).chunk(0) if table.num_rows else None for c in ("w", "df", "best", "lasts", "tops", "offsets", "postings", "items", "docs", "norms")]
    w, df, best, lasts, tops, offsets, postings, items, docs, norms = rows
    head = next(i for i in range(table.num_rows) if docs[i].is_valid)
    ids, norm = docs[head].as_py(), norms[head].values.to_numpy()
    by_item: dict[str, list[_Postings]] = {}
    for i in range(table.num_rows):
        if i != head:
            own = _Postings(w[i].as_py(), df[i].as_py(), best[i].as_py(), *(c[i].values.to_numpy() for c in (lasts, tops, offsets)), postings[i].as_py(), norm)
            for item in items[i].as_py():
                by_item.setdefault(item, []).append(own)
    out: list[tuple[str, int | None, int]] = []
    for item, lists in by_item.items():
        found, scores = best_documents(lists, size, len(ids))
        out += [(item, ids[d], s) for d, s in zip(found.tolist(), scores.tolist(), strict=True)]
    columns = list(zip(*out, strict=True)) or [[], [], []]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["item", "doc", "score"])


def search_index(index: DataFrame, n_docs: int, items: DataFrame, size: int = 10, id_col: str = "item_id", text_col: str = "text",
                 doc_col: str = "doc_id", items_at_once: int = ITEMS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(item, rank, doc, score): the ``size`` best documents of each item.

    Items go in blocks, so a task holds one shard's postings of one block's
    terms; only those postings move. Heaps of shards, ``size`` rows for an
    item each, are merged at the end.
    """
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), F.md5(text_of(text_col)))
    queries = items.select(key.alias("item"), F.col(text_col).cast("string").alias("text")).distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(item, term) for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for term in set(terms_of(text.as_py()))]
            columns = list(zip(*pairs, strict=True)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()).cast(pa.string())], names=["item", "term"])

    blocks = -(-queries.count() // items_at_once) or 1
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block")
    wanted = staged(queries.mapInArrow(cut, "item string, term string").groupBy(block, "term").agg(F.collect_list("item").alias("items")))[0]
    names = wanted.select("term").distinct()
    held = index.select("term", "df").join(small_enough(names, F.octet_length("term") + 16, broadcast_bytes), "term", "left_semi")
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.sum("df") + 1))).cast("long")
    weights = held.groupBy("term").agg(weight.alias("w"))
    weighted = staged(wanted.join(weights, "term").filter("w > 0"))[0]
    lists = index.filter("term is not null").join(
        small_enough(weighted, F.octet_length("term") + 16 + F.aggregate("items", F.lit(0), lambda a, i: a + F.octet_length(i) + 16), broadcast_bytes), "term")
    columns = ["shard", "block", "w", "df", "best", "lasts", "tops", "offsets", "postings", "items", "docs", "norms"]
    heads = index.filter("docs is not null").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(None).cast("long").alias("w"), F.lit(None).cast("array<string>").alias("items"))
    found = lists.select(*columns).unionByName(heads.select(*columns)).groupBy("shard", "block").applyInArrow(
        lambda table: _search_shard(table, size), "item string, doc long, score long")
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= size)
    return ranked.select(F.substring_index("item", "|", 1).try_cast("long").alias(id_col), "rank", F.col("doc").alias(doc_col), "score")


def rank_documents(docs: DataFrame, items: DataFrame, size: int = 10, doc_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The ``size`` best documents of each item, among all documents.

    Returns item, rank from 1, doc, score; an item gets fewer rows if fewer
    documents score above 0, and none if it has no term. Equal scores go by
    ascending document id, null last. A document without a term, null or empty,
    is found by nothing; documents that repeat an id are documents of their
    own. Items that repeat id and text are one item; one id with two texts is
    two. Texts of any length count whole. Empty tables give an empty result;
    other columns are ignored.
    """
    index, n_docs = build_index(docs, doc_col, text_col)
    return search_index(index, n_docs, items, size, item_col, text_col, doc_col)
