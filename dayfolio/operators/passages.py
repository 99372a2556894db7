"""Passages of one table in the texts of another: word for word, and by the share of their n-grams.

Texts are read once and leave the scan as 64-bit hashes, of which a filter of
bounded size has taken those that no passage has. Whole texts are fetched for
candidates alone, and decide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from dayfolio import config
from dayfolio.functions import records as R, text as X
from dayfolio.operators.skew import salted_join, small_or_plain
from dayfolio.session import cut_lineage

#: Bytes of a hashed gram, and grams of which the smallest hash is kept: any run of GRAM + WINDOW - 1 bytes keeps one.
GRAM, WINDOW = 16, 17
SHORTEST = GRAM + WINDOW - 1
#: Most bytes of short passages in one automaton; beyond, they are looked up by hashes of their lengths.
AUTOMATON_BYTES = 1 << 20
#: Most 64-bit words of the filter that is sent to the scan.
FILTER_WORDS = 1 << 20
#: Rows that a worker hashes at a time, and units of a text whose runs it hashes at a time.
ROWS, PART = 256, 1 << 16

_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


def run_hashes(units: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of ``size`` units, such as bytes or code points.

    Runs double in length, or grow by one unit, until they have the size.
    """
    if len(units) < size or not size:
        return np.empty(0, np.uint64)
    units = units.astype(np.uint64) + np.uint64(1)
    rolled, length = units, 1
    for bit in bin(size)[3:]:
        rolled = rolled[:-length] * np.uint64(pow(int(_ODD[0]), length, 1 << 64)) + rolled[length:]
        length *= 2
        if bit == "1":
            rolled = rolled[:-1] * _ODD[0] + units[length:]
            length += 1
    return _scrambled(rolled + np.uint64(size))


def winnowed(units: np.ndarray, size: int = GRAM, window: int = WINDOW) -> np.ndarray:
    """Distinct smallest hashes of all windows of ``window`` neighbouring runs.

    Each window of a part of a text is a window of the text, so a text has all
    that any of its parts has, wherever the part begins.
    """
    hashes = run_hashes(units, size)
    if len(hashes) < window:
        return np.empty(0, np.uint64)
    step = 1
    while 2 * step < window:
        hashes = np.minimum(hashes[:-step], hashes[step:])
        step *= 2
    return np.unique(np.minimum(hashes[:len(hashes) - (window - step)], hashes[window - step:]) if window > step else hashes)


def in_parts(units: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Parts of a text that together have its runs of ``size`` units, each once, so that hashing takes no more memory for a longer text."""
    for start in range(0, max(len(units) - size + 1, 1), PART):
        yield units[start:start + PART + size - 1]


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _hashed(rows: DataFrame, key: str, of: Callable[[str], Sequence[np.ndarray]], columns: str) -> DataFrame:
    """(key, arrays) of the rows' texts ``_t``; rows whose first array is empty go."""
    schema = T.StructType([rows.schema[key], *T._parse_datatype_string(columns).fields])
    kinds = [pa.list_(pa.int64())] * (len(schema) - 1)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                found = [of(text.as_py()) if text.is_valid else None for text in part.column(1)]
                there = [i for i, arrays in enumerate(found) if arrays is not None and len(arrays[0])]
                lists = [pa.array([found[i][c].astype(np.int64) for i in there], kind) for c, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(there, pa.int64())), *lists], names=schema.names)

    return rows.select(key, "_t").mapInArrow(hashed, schema)


def hash_filter(hashes: DataFrame, most: int = FILTER_WORDS) -> np.ndarray:
    """A Bloom filter of the 64-bit column ``fp`` with two bits in one word for each.

    Words are made and merged by tasks; the driver gets the filter, at most
    ``most`` words. A fuller filter lets more through and loses nothing.
    """
    n = hashes.count()
    size = 1024
    while size < most and size * 4 < n:
        size *= 2
    bit = "shiftleft(1L, cast({} & 63 as int))"
    words = hashes.select(F.expr(f"cast(shiftrightunsigned(fp, 12) & {size - 1} as int)").alias("word"),
                          F.expr(f"{bit.format('fp')} | {bit.format('shiftrightunsigned(fp, 6)')}").alias("bits"))
    merged = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size, np.uint64)
    out[merged.column("word").to_numpy()] = merged.column("bits").to_numpy().view(np.uint64)
    return out


def may_hold(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes the filter lets through."""
    one, low = np.uint64(1), np.uint64(63)
    need = (one << (hashes & low)) | (one << ((hashes >> np.uint64(6)) & low))
    return words[((hashes >> np.uint64(12)) & np.uint64(len(words) - 1)).astype(np.intp)] & need == need


def _let_through(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return hashes[may_hold(words, hashes)]


def _whole_hash(text: str) -> np.ndarray:
    units = _bytes(text)
    return run_hashes(units, len(units))


def contained_passages(sources: DataFrame, targets: DataFrame, source_id: str, target_id: str, source_text: Column,
                       target_text: Column, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """All (source, target) pairs where the target holds the source's folded text word for word.

    A passage of ``SHORTEST`` bytes or more has winnowed hashes, and a target
    that holds it has all of them, so each passage meets only the targets that
    have its rarest one. Shorter passages are found by an automaton over all of
    them, if their bytes are few, else by the hashes of all runs of their
    lengths. Whole texts then decide, so nothing rests on hashes alone and no
    pair is lost. An empty or null source is no passage, and a null target holds
    none. Repeated rows give a pair each.
    """
    passages = cut_lineage(sources.select(source_id, source_text.alias("_t")).where("_t <> ''"))
    short = passages.where(F.octet_length("_t") < SHORTEST)
    size = short.agg(F.coalesce(F.sum(F.octet_length("_t")), F.lit(0))).first()[0]
    words, lengths = [], []
    if size <= automaton_bytes:
        words = [r[0] for r in short.select("_t").distinct().collect()]  # their bytes were summed above
    else:
        lengths = sorted(r[0] for r in short.select(F.octet_length("_t")).distinct().collect())  # at most SHORTEST - 1

    def own(text: str) -> list[np.ndarray]:
        units = _bytes(text)
        return [np.unique(np.concatenate([winnowed(part) for part in in_parts(units, SHORTEST)])) if len(units) >= SHORTEST else run_hashes(units, len(units))]

    prints = cut_lineage(_hashed(passages, source_id, own, "fps array<long>").select(source_id, F.explode("fps").alias("fp")))
    words_of = hash_filter(prints.select("fp"))
    kinds = [(SHORTEST, winnowed), *[(n, lambda part, n=n: run_hashes(part, n)) for n in lengths]]
    state: dict = {}

    def scan(text: str) -> list[np.ndarray]:
        units = _bytes(text)
        found = np.concatenate([_let_through(words_of, of(part)) for size, of in kinds for part in in_parts(units, size)])
        if words:
            if "automaton" not in state:
                import ahocorasick

                state["automaton"] = ahocorasick.Automaton()
                for word in words:
                    state["automaton"].add_word(word, int(_whole_hash(word)[0]))
                state["automaton"].make_automaton()
            hits = {value for _, value in state["automaton"].iter(text)}
            found = np.concatenate([found, np.fromiter(hits, np.uint64, len(hits))])
        return [np.unique(found)]

    texts = targets.select(target_id, target_text.alias("_t"))
    held = cut_lineage(_hashed(texts, target_id, scan, "fps array<long>").select(target_id, F.explode("fps").alias("fp")))
    frequency = held.groupBy("fp").agg(F.count(F.lit(1)).alias("held_by"))
    counted = prints.join(frequency, "fp", "left").select(source_id, F.struct(F.coalesce("held_by", F.lit(0)).alias("held_by"), "fp").alias("_f"))
    index = counted.groupBy(source_id).agg(F.min("_f").alias("_f")).where("_f.held_by > 0").select(source_id, F.col("_f.fp").alias("fp"))
    candidates = cut_lineage(held.join(small_or_plain(index), "fp").select(source_id, target_id).distinct())
    # A text that is never null is not folded before the join to see whether it is.
    wanted = targets.join(small_or_plain(candidates.select(target_id).distinct()), target_id, "left_semi").select(
        target_id, F.coalesce(target_text, F.lit("")).alias("_t"))
    pairs = candidates.join(passages.withColumnRenamed("_t", "_p"), source_id)
    return wanted.join(pairs, target_id).where(F.col("_t").contains(F.col("_p"))).select(source_id, target_id)


def _overlap(need: Column, need_n: Column, have: Column, have_n: Column) -> Column:
    """Sum over the hashes of both sides of the smaller of their two counts; hashes ascend."""
    @F.pandas_udf(T.LongType())
    def shared(a: pd.Series, a_n: pd.Series, b: pd.Series, b_n: pd.Series) -> pd.Series:
        def each(x, x_n, y, y_n):
            _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
            return int(np.minimum(x_n[i], y_n[j]).sum())

        return pd.Series([each(*row) for row in zip(a, a_n, b, b_n, strict=True)], dtype="int64")

    return shared(need, need_n, have, have_n)


def shingle_coverage(sources: DataFrame, targets: DataFrame, source_id: str, target_id: str, source_text: Column,
                     target_text: Column, size: int = config.REUSE["gram"], minimum: int = config.REUSE["characters"],
                     threshold: float = config.REUSE["coverage"]) -> DataFrame:
    """All (source, target) pairs with coverage >= threshold, exactly; ids are unique.

    A target that covers ``threshold`` of a source must hold one of the grams
    left when a smaller share is set aside. Setting aside the most frequent
    grams leaves the rarest: only those are joined, so common grams never pair
    anything, and no pair is lost. Candidates are counted by hashes, where
    grams that collide can only add to the count, and those that pass by text.
    """
    def grams(text: str) -> list[np.ndarray]:
        return list(np.unique(np.concatenate([run_hashes(part, size) for part in in_parts(_points(text), size)]), return_counts=True))

    texts = sources.select(source_id, source_text.alias("_t")).where(F.char_length("_t") >= max(minimum, size))
    texts = cut_lineage(texts)
    listed = cut_lineage(_hashed(texts, source_id, grams, "fps array<long>, ns array<long>"))
    each = listed.select(source_id, F.explode(F.arrays_zip("fps", "ns")).alias("_g")).select(source_id, F.col("_g.fps").alias("fp"), F.col("_g.ns").alias("n"))
    words_of = hash_filter(each.select("fp"))

    def scan(text: str) -> list[np.ndarray]:
        found = [_let_through(words_of, run_hashes(part, size)) for part in in_parts(_points(text), size)]
        return list(np.unique(np.concatenate(found), return_counts=True))

    held = cut_lineage(_hashed(targets.select(target_id, target_text.alias("_t")), target_id, scan, "fps array<long>, ns array<long>"))
    known = held.select(target_id, F.explode("fps").alias("fp"))
    frequency = known.groupBy("fp").agg(F.count(F.lit(1)).alias("held_by"))
    # One source's grams fit a task: a source is one stored text.
    per_source = Window.partitionBy(source_id)
    rarest = per_source.orderBy("_held", "fp").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (each.join(frequency, "fp", "left").withColumn("_held", F.coalesce("held_by", F.lit(0)))
              .withColumn("_all", F.sum("n").over(per_source)).withColumn("_before", F.coalesce(F.sum("n").over(rarest), F.lit(0))))
    # Grams from here on sum to less than threshold * total.
    index = ranked.where((R.ratio(F.col("_all") - F.col("_before"), F.col("_all")) >= threshold) & (F.col("_held") > 0)).select("fp", source_id)
    candidates = known.join(small_or_plain(index), "fp").select(source_id, target_id).distinct()
    total = F.aggregate("_need_n", F.lit(0).cast("long"), lambda a, n: a + n)
    needed = listed.select(source_id, F.col("fps").alias("_need"), F.col("ns").alias("_need_n")).withColumn("total", total)
    counted = salted_join(candidates, needed, [source_id], "inner").join(held, target_id)
    likely = counted.where(R.ratio(_overlap(F.col("_need"), F.col("_need_n"), F.col("fps"), F.col("ns")), F.col("total")) >= threshold)
    likely = cut_lineage(likely.select(source_id, target_id, "total"))
    wanted = targets.join(small_or_plain(likely.select(target_id).distinct()), target_id, "left_semi").select(target_id, target_text.alias("_to"))
    both = wanted.join(likely.join(texts, source_id), target_id)
    covered = both.select(source_id, target_id, X.gram_overlap(F.col("_t"), F.col("_to"), size).alias("overlap"), "total")
    return covered.withColumn("coverage", R.ratio(F.col("overlap"), F.col("total"))).where(F.col("coverage") >= threshold)
