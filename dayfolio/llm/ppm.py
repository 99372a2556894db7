"""Language-model scores by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from dayfolio.llm.common import staged
from dayfolio.session import cut_lineage

#: Symbols: the 256 bytes, the end of the text, and what stands before its first byte.
END, START, SYMBOLS = 256, 257, 257
BITS = 9
_MASK = np.uint64((1 << BITS) - 1)
#: Positions that are coded at once, so that a task holds a batch's texts and few arrays besides.
_SLICE = 1_000_000
#: The part that holds the pairs of symbols, at most 258 * 258 of them.
_PAIRS = -1


def is_held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 7 == 2


def _pack(a: np.ndarray) -> bytes:
    """An array's bytes by significance, compressed: sorted codes and small counts take little."""
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), -1).T.tobytes())


def _unpack(packed: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


class _Places(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def _word_places(texts: list[bytes], places: _Places) -> list[np.ndarray]:
    """Each text's tokens by place; the end of a text is the empty word."""
    return [np.fromiter(map(places.__getitem__, words), np.int32, len(words)) for words in ([*t.lower().split(), b""] for t in texts)]


def _codes(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code of each symbol with the ``order`` symbols before it, and how many each text has.

    The highest bits are the symbol just before, then those farther back, the
    lowest the symbol itself, so a node of the trie is a prefix of codes.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    symbols = np.full(int(sizes.sum()) + order * len(texts), START, np.uint64)
    starts = np.cumsum(sizes + order) - sizes
    inside = np.ones(len(symbols), bool)
    for start, text in zip(starts, texts, strict=True):
        symbols[start:start + len(text)] = np.frombuffer(text, np.uint8)
        symbols[start + len(text)] = END
        inside[start - order:start] = False
    codes = symbols[order:].copy()
    for k in range(1, order + 1):
        codes |= symbols[order - k:len(symbols) - k] << np.uint64(BITS * (order + 1 - k))
    return codes[inside[order:]], sizes


def _grams(codes: np.ndarray, j: int, order: int) -> np.ndarray:
    """The codes' last ``j`` symbols before it and the symbol."""
    return (codes >> np.uint64(BITS * (order + 1 - j)) << np.uint64(BITS)) | (codes & _MASK)


def _slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _SLICE:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and the sums of their counts."""
    codes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    by = np.argsort(codes, kind="stable")
    codes, counts = codes[by], counts[by]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def _packed(docs: DataFrame) -> DataFrame:
    """(batch, ids, held, sizes, texts): the documents of a batch that came together, as one row with compressed text."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            numbers = b.column("batch").to_numpy()
            by = np.argsort(numbers, kind="stable")
            cuts = np.flatnonzero(np.diff(numbers[by])) + 1
            rows = []
            for group in np.split(by, cuts) if len(by) else []:
                texts = [(b.column("text")[int(i)].as_py() or "").encode() for i in group]
                take = pa.array(group)
                rows.append((int(numbers[group[0]]), b.column("doc_id").take(take).to_pylist(), b.column("held_out").take(take).to_pylist(), [len(t) for t in texts], press(b"".join(texts))))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["batch", "ids", "held", "sizes", "texts"])

    return docs.mapInArrow(pack, "batch long, ids array<long>, held array<boolean>, sizes array<long>, texts binary")


def _documents(table: pa.Table) -> Iterator[tuple[list[int], np.ndarray, list[bytes]]]:
    """Ids, held-out flags and texts of a batch, a few million bytes at a time."""
    for row in range(table.num_rows):
        whole, at, texts = zstandard.ZstdDecompressor().decompress(table.column("texts")[row].as_py()), 0, []
        for size in table.column("sizes")[row].as_py():
            texts.append(whole[at:at + size])
            at += size
        ids, held = table.column("ids")[row].as_py(), np.array(table.column("held")[row].as_py(), bool)
        for a, b in _slices(texts):
            yield ids[a:b], held[a:b], texts[a:b]


def _gathered(packed: DataFrame, order: int, parts: int) -> DataFrame:
    """What each batch has: its words and its codes by part, with how often its training texts have them.

    Codes that share the last two symbols before them are in one part, in which
    all their nodes of order two and above are whole.
    """
    def gather(table: pa.Table) -> pa.Table:
        batch = table.column("batch")[0].as_py()
        places, found, words = _Places(), [], np.zeros(0, np.int64)
        for _, held, texts in _documents(table):
            at = _word_places(texts, places)
            learned = [x for x, out in zip(at, held, strict=True) if not out]
            now = np.bincount(np.concatenate(learned), minlength=len(places)) if learned else np.zeros(len(places), np.int64)
            now[:len(words)] += words
            words = now
            for out in (False, True):
                some = [x for x, h in zip(texts, held, strict=True) if h == out]
                if some:
                    codes, counts = np.unique(_codes(some, order)[0], return_counts=True)
                    found.append((codes, counts * 0 if out else counts))
            if sum(len(c) for c, _ in found[1:]) > 1_500_000:
                found = [_merged(found)]
        codes, counts = _merged(found)
        rows = []
        part = _part(codes, order, parts)
        by = np.argsort(part, kind="stable")  # codes stay in order within a part
        for group in np.split(by, np.flatnonzero(np.diff(part[by])) + 1):
            rows.append((int(part[group[0]]), _pack(codes[group]), _pack(counts[group])))
        learned = counts > 0
        if learned.any():
            pairs = _merged([(_grams(codes[learned], 1, order), counts[learned])])
            rows.append((_PAIRS, _pack(pairs[0]), _pack(pairs[1])))
        n, m = len(words), len(rows)
        return pa.table({
            "batch": pa.array(np.full(n + m, batch), pa.int64()),
            "word": pa.concat_arrays([pa.array(places, pa.binary()), pa.nulls(m, pa.binary())]),
            "n": pa.concat_arrays([pa.array(words, pa.int64()), pa.nulls(m, pa.int64())]),
            "part": pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array([r[0] for r in rows], pa.int32())]),
            "codes": pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array([r[1] for r in rows], pa.binary())]),
            "counts": pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array([r[2] for r in rows], pa.binary())])})

    return packed.groupBy("batch").applyInArrow(gather, "batch long, word binary, n long, part int, codes binary, counts binary")


def _part(codes: np.ndarray, order: int, parts: int) -> np.ndarray:
    node = codes >> np.uint64(BITS * (order - 1))
    return ((node * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(parts)


def _merge_up(level: DataFrame, fan_in: int) -> DataFrame:
    """One row for each part and ``fan_in`` nodes below, with the sums of their counts."""
    def merge(table: pa.Table) -> pa.Table:
        rows = [(_unpack(a.as_py(), np.uint64), _unpack(b.as_py(), np.int64)) for a, b in zip(table.column("codes"), table.column("counts"), strict=True)]
        codes, counts = _merged(rows)
        return pa.table({"part": table.column("part")[:1], "node": table.column("above")[:1], "codes": pa.array([_pack(codes)], pa.binary()), "counts": pa.array([_pack(counts)], pa.binary())})

    return level.withColumn("above", F.floor(F.col("node") / fan_in)).groupBy("part", "above").applyInArrow(merge, "part int, node long, codes binary, counts binary")


def _hand_down(level: DataFrame, above: DataFrame, fan_in: int) -> DataFrame:
    """To each row of a level the code lengths of its codes, from the row above it."""
    def hand(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if right.num_rows:
            codes, values = _unpack(right.column("codes")[0].as_py(), np.uint64), _unpack(right.column("values")[0].as_py(), np.float64)
            out = [_pack(values[np.searchsorted(codes, _unpack(x.as_py(), np.uint64))]) for x in left.column("codes")]
        return pa.table({"part": left.column("part"), "node": left.column("node"), "codes": left.column("codes"), "values": pa.array(out, pa.binary())})

    below = level.select("part", "node", "codes", F.floor(F.col("node") / fan_in).alias("above")).groupBy("part", "above")
    return below.cogroup(above.select("part", F.col("node").alias("above"), "codes", "values").groupBy("part", "above")).applyInArrow(
        hand, "part int, node long, codes binary, values binary")


def code_lengths(codes: np.ndarray, counts: np.ndarray, pairs: np.ndarray, order: int) -> np.ndarray:
    """log10 probability of each code's symbol after its context.

    ``codes`` are sorted and hold whole nodes of order two and above; ``pairs``
    counts, by code, each symbol after each symbol in the whole corpus.

    The longest context seen in training predicts. If it lacks the symbol, it
    escapes to the next shorter one, where the longer one's symbols are
    excluded. Of a node's counts each symbol gives half of one to the escape, so
    a symbol seen c times has (2 c - 1) / 2 t and the escape d / 2 t, with t and
    d the counts and the number of the symbols that are not excluded. Below the
    empty context the symbols never seen are equally likely. A longer node's
    symbols are among its suffix's, so what is excluded is one sum per node.
    """
    n = len(codes)
    symbol, learned = (codes & _MASK).astype(np.int64), counts > 0
    grams: list = [None] * (order + 1)  # sorted grams of an order and their counts
    for j in range(order, 1, -1):
        grams[j] = _merged([(_grams(codes[learned], j, order), counts[learned])])
    wide = np.zeros(1 << 2 * BITS, np.int64)
    wide[:len(pairs)] = pairs
    square = wide.reshape(1 << BITS, 1 << BITS)
    single = square.sum(axis=0)

    def count(j: int, wanted: np.ndarray) -> np.ndarray:
        if j == 0:
            return single[(wanted & _MASK).astype(np.int64)]
        if j == 1:
            return wide[wanted.astype(np.int64)]
        found, sums = grams[j]
        if not len(found):
            return np.zeros(len(wanted), np.int64)
        at = np.minimum(np.searchsorted(found, wanted), len(found) - 1)
        return np.where(found[at] == wanted, sums[at], 0)

    def node(j: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each code's node: all counts, the number of symbols, and these symbols' counts in the shorter node."""
        if j == 0:
            return np.full(n, single.sum()), np.full(n, (single > 0).sum()), np.zeros(n, np.int64)
        if j == 1:
            own = (wanted >> np.uint64(BITS)).astype(np.int64)
            return square.sum(axis=1)[own], (square > 0).sum(axis=1)[own], (square > 0).astype(np.int64).dot(single)[own]
        found, sums = grams[j]
        if not len(found):
            return (np.zeros(n, np.int64),) * 3
        low = count(j - 1, _lower(found, j))
        nodes = found >> np.uint64(BITS)
        first = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]]))
        at = np.minimum(np.searchsorted(nodes[first], wanted >> np.uint64(BITS)), len(first) - 1)
        there = nodes[first][at] == wanted >> np.uint64(BITS)
        sizes = np.diff(np.append(first, len(found)))
        return tuple(np.where(there, x[at], 0) for x in (np.add.reduceat(sums, first), sizes, np.add.reduceat(low, first)))

    value, open_ = np.zeros(n), np.ones(n, bool)
    kinds_above, low_above = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for j in range(order, -1, -1):
        wanted = _grams(codes, j, order) if j else symbol.astype(np.uint64)
        total, kinds, low = node(j, wanted)
        own = count(j, wanted)
        left, other = total - low_above, kinds - kinds_above
        hit = open_ & (own > 0)
        value[hit] += np.log10((2 * own[hit] - 1) / (2 * left[hit]))
        miss = open_ & (own == 0) & (left > 0)
        value[miss] += np.log10(other[miss] / (2 * left[miss]))
        open_ &= own == 0
        kinds_above, low_above = kinds, low
    value[open_] += np.log10(1 / (SYMBOLS - kinds_above[open_]))
    return value


def _lower(grams: np.ndarray, j: int) -> np.ndarray:
    """Grams of order j without the symbol farthest back."""
    return (grams >> np.uint64(2 * BITS) << np.uint64(BITS)) | (grams & _MASK)


class _Lookup:
    """Values by code: a table by hash, and a search for the few codes that lost their slot."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        by = np.argsort(codes)
        self.codes, self.values = codes[by], values[by]
        self.shift = np.uint64(64 - max(8, int(4 * len(codes)).bit_length()))
        self.table = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.table[self._slots(self.codes)] = np.arange(len(codes), dtype=np.int32)

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        at = self.table[self._slots(wanted)]
        lost = np.flatnonzero(self.codes[at] != wanted)
        at[lost] = np.searchsorted(self.codes, wanted[lost])
        return self.values[at]


def score_documents(docs: DataFrame, order: int = 5, batch_bytes: int = 16_000_000, parts: int = 256, fan_in: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores every whole text with a trie and a word count learned from all texts that are not held out.

    Documents are dealt by the hash of their id to batches of about
    ``batch_bytes``. A batch's task counts its distinct words and codes (a byte
    with the ``order`` bytes before it, 2 to 6). Words meet by word. Codes meet
    by part, ``fan_in`` batches at a time up a tree; its root computes the code
    lengths of the part's codes, which go down the tree again, each row taking
    those of its own codes. So a batch gets back what it needs, and neither the
    word list nor the trie goes whole to any task or to the driver, but for the
    counts of pairs of symbols, of which there are at most 258 * 258.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score (log10). The base is an add-one word model with lower-cased A-Z, one
    end per text; score sums the code lengths of the text's bytes and its end. A
    null text is empty. Texts of any length count whole: a batch is as long as its
    longest text at least. Repeated rows are scored and counted each; an empty
    table gives an empty result; other columns are ignored.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), is_held_out(id_col).alias("held_out"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = -(-size // batch_bytes) or 1
    packed = _packed(plain.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches))))
    gathered, _ = staged(_gathered(packed, order, parts))

    words = gathered.filter("word is not null").select("batch", "word", "n")
    same = Window.partitionBy("word")
    first = F.row_number().over(same.orderBy("batch")) == 1
    seen = Observation()
    counted = words.withColumns({"c": F.sum("n").over(same), "_first": first}).observe(
        seen, F.sum("n").alias("tokens"), F.sum((F.col("_first") & (F.col("c") > 0)).cast("long")).alias("distinct"))
    answers, _ = staged(counted.filter("c <> n").select("batch", "word", "c"))
    tokens, distinct = int(seen.get.get("tokens") or 0), int(seen.get.get("distinct") or 0)

    levels, nodes = [gathered.filter("part is not null").select("part", F.col("batch").alias("node"), "codes", "counts")], batches
    while len(levels) == 1 or nodes > 1:
        levels.append(cut_lineage(_merge_up(levels[-1], fan_in)))
        nodes = -(-nodes // fan_in)
    root = levels.pop()
    top = root.filter(F.col("part") == _PAIRS).select("codes", "counts").first()  # one row of at most 258 * 258 counts
    pairs = np.zeros(1 << 2 * BITS, np.int64)
    if top:
        pairs[_unpack(bytes(top["codes"]), np.uint64).astype(np.int64)] = _unpack(bytes(top["counts"]), np.int64)

    def lengths(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            found = [_pack(code_lengths(_unpack(x.as_py(), np.uint64), _unpack(y.as_py(), np.int64), pairs, order)) for x, y in zip(b.column("codes"), b.column("counts"), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("part"), b.column("node"), b.column("codes"), pa.array(found, pa.binary())], names=["part", "node", "codes", "values"])

    down = root.filter(F.col("part") != _PAIRS).mapInArrow(lengths, "part int, node long, codes binary, values binary")
    while levels:
        down = _hand_down(levels.pop().filter(F.col("part") != _PAIRS), down, fan_in)
    base_total = np.log10(tokens + distinct + 1.0)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        words = right.column("word").is_valid()
        blobs = right.filter(right.column("codes").is_valid())
        right = right.select(["word", "c"])
        lookup = _Lookup(np.concatenate([_unpack(x.as_py(), np.uint64) for x in blobs.column("codes")]), np.concatenate([_unpack(x.as_py(), np.float64) for x in blobs.column("values")]))
        places, found, ids, flags, scores = _Places(), [], [], [], []
        for own, out, texts in _documents(left):
            ids += own
            flags.append(out)
            found += _word_places(texts, places)
            some, sizes = _codes(texts, order)
            scores.append(np.add.reduceat(lookup(some), np.cumsum(sizes) - sizes))
        held, scores = np.concatenate(flags), np.concatenate(scores)
        learned = [x for x, out in zip(found, held, strict=True) if not out]
        counts = np.bincount(np.concatenate(learned), minlength=len(places)).astype(float) if learned else np.zeros(len(places))
        for some in right.filter(words).to_batches(max_chunksize=50_000):
            at = np.fromiter(map(places.__getitem__, some.column("word").to_pylist()), np.int64, some.num_rows)
            counts[at] = some.column("c").to_numpy()
        del right
        base, known = np.log10(counts + 1) - base_total, counts > 0
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(held, pa.bool_()),
            "n_tokens": pa.array([len(x) for x in found], pa.int64()), "n_known": pa.array([int(known[x].sum()) for x in found], pa.int64()),
            "train_tokens": pa.array([tokens] * len(ids), pa.int64()),
            "base_score": pa.array([float(base[x].sum()) for x in found], pa.float64()), "score": pa.array(scores, pa.float64())})

    right = answers.select("batch", "word", "c", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("binary").alias("values")).unionByName(
        down.select(F.col("node").alias("batch"), F.lit(None).cast("binary").alias("word"), F.lit(None).cast("long").alias("c"), "codes", "values"))
    return packed.groupBy("batch").cogroup(right.groupBy("batch")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
