"""Near duplicates: fast similarity sketches, banding, exact verification, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfolio.llm.common import small_enough, with_rank
from dayfolio.llm.components import connected_components
from dayfolio.session import cut_lineage

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: Words whose hash a worker remembers before it starts anew.
_REMEMBERED = 100_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str, n: int, hashes: _Hashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's n-word shingles, A-Z lower-cased.

    With fewer than n words the whole sequence is one shingle; without words
    the set is empty.
    """
    words = text.encode().lower().split()  # of bytes: A-Z alone, and the six ASCII white-space characters alone
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(n, len(words))
    mixed = h[:len(h) - n + 1].copy()
    for k in range(1, n):
        mixed = _mix(mixed * _MULTIPLIER + h[k:len(h) - n + 1 + k])
    return np.unique(mixed + np.uint64(n))


def similarity_sketch(items: np.ndarray, size: int) -> np.ndarray:
    """Fast similarity sketch of a non-empty set.

    In each of the first ``size`` rounds every item falls into one hashed
    coordinate with a hashed value; in the next ``size`` rounds every item falls
    into the round's own coordinate, so all are filled after at most 2 * size
    rounds. A coordinate keeps its smallest (round, value). For a set of n items
    about size * log(size) / n rounds are needed. Several rounds of a small set
    are done at once: later rounds never replace earlier ones.
    """
    sketch = np.full(size, _EMPTY)
    step, start = max(1, 2048 // len(items)), 0
    while start < 2 * size:
        rounds = np.arange(start, min(start + step, 2 * size), dtype=np.uint64)[:, None]
        hashed = _mix(items[None, :] ^ _mix((rounds + np.uint64(1)) * _MULTIPLIER))
        bins = ((hashed >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        if start + step > size:
            bins = np.where(rounds >= size, rounds - np.uint64(size), bins)
        np.minimum.at(sketch, bins.ravel().astype(np.intp), ((rounds << np.uint64(32)) | (hashed & np.uint64(0xFFFFFFFF))).ravel())
        if not (sketch == _EMPTY).any():
            break
        start += step
    return sketch


def band_keys(sketch: np.ndarray, bands: int) -> np.ndarray:
    """One key per band of the sketch."""
    parts = sketch.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(parts.shape[1]):
        key = _mix(key * _MULTIPLIER + parts[:, k])
    return key.view(np.int64)


def _sketched(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            sizes, keys, found = [], [], []
            for text in batch.column(1):
                items = shingle_set(text.as_py() or "", words, hashes)
                sizes.append(len(items))
                keys.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None)
                found.append(band_keys(similarity_sketch(items, bands * rows), bands) if len(items) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64()))], names=["id", "n", "key", "bands"])

    return docs.mapInArrow(sketch, "id long, n long, key binary, bands array<long>")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            found = [shingle_set(text.as_py() or "", words, hashes).view(np.int64) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["id", "items"])

    return docs.mapInArrow(sets, "id long, items array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have at least that percentage of their union in common."""
    one = sets.select(F.col("id").alias("a"), F.col("items").alias("_x"))
    two = sets.select(F.col("id").alias("b"), F.col("items").alias("_y"))
    common = F.size(F.array_intersect("_x", "_y"))
    counted = pairs.join(one, "a").join(two, "b").select("a", "b", common.alias("_c"), (F.size("_x") + F.size("_y")).alias("_s"))
    return counted.filter(100 * F.col("_c") >= percent * (F.col("_s") - F.col("_c"))).select("a", "b").distinct()


def _settled(labels: DataFrame, sets: DataFrame, percent: int, salts: int = 16) -> DataFrame:
    """Links of the members outside their bucket's largest component with all others of buckets that have the same one.

    Sets are compared inside the join, so that only links come out of it; the
    other side of a hot component is dealt over salts.
    """
    own = labels.select("rep", "n", "label", "_largest").distinct().join(sets.withColumnRenamed("id", "rep"), "rep")
    out = own.filter("label <> _largest").select(
        "_largest", F.col("rep").alias("a"), F.col("n").alias("_n"), F.col("label").alias("_label"), F.col("items").alias("_items"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    both = F.size(F.array_intersect("items", "_items"))
    fits = (100 * F.col("n") >= percent * F.col("_n")) & (100 * F.col("_n") >= percent * F.col("n")) & (F.col("label") != F.col("_label"))
    fits = fits & ((F.col("label") == F.col("_largest")) | (F.col("rep") < F.col("a")))  # of two outside, one comparison
    fits = fits & ((100 + percent) * both >= percent * (F.col("n") + F.col("_n")))
    dealt = own.withColumn("_salt", F.pmod(F.xxhash64("rep"), F.lit(salts)).cast("int"))
    o = out.withColumnRenamed("_largest", "_key").withColumnRenamed("_salt", "_key_salt")
    return dealt.join(o, (F.col("_largest") == F.col("_key")) & (F.col("_salt") == F.col("_key_salt")) & fits).select("a", F.col("rep").alias("b")).distinct()


def with_row_ids(docs: DataFrame, name: str, id_col: str = "doc_id") -> DataFrame:
    """Adds an id of the row: its own id where no other row has it, else a number above all ids.

    Rows without an id, and rows whose id comes twice or more, are numbered in
    the order of id (null last) and a hash of all columns.
    """
    repeated = docs.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__own")).agg(F.count("*").alias("__n")).filter("__n > 1").select("__own")
    repeated = cut_lineage(repeated)
    most = docs.agg(F.coalesce(F.max(F.col(id_col).cast("long")), F.lit(0))).first()[0]
    known, several = F.col(id_col) == F.col("__own"), small_enough(repeated, F.lit(16))
    odd = docs.filter(F.col(id_col).isNull()).unionByName(docs.join(several, known, "left_semi"))
    odd = with_rank(odd, F.col(id_col).asc_nulls_last(), F.xxhash64(*docs.columns), name=name).withColumn(name, F.col(name) + F.lit(most + 1))
    own = docs.filter(F.col(id_col).isNotNull()).join(several, known, "left_anti").withColumn(name, F.col(id_col).cast("long"))
    return own.unionByName(odd)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 40, rows: int = 6, hubs: int = 8,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The component of each document under links of similar shingle sets.

    1. A sketch of ``bands * rows`` coordinates per document. Documents with the
       same set are one group and its smallest id stands for it from here on, so
       copies cost one row each.
    2. Groups that agree in a whole band are candidates. At similarity 0.8 a
       pair agrees in none of 40 bands of 6 with probability 5e-6.
    3. In a band's bucket all members are compared on full sets with one hub;
       linked ones become a component. Then what lies outside the bucket's
       largest component is compared with ``hubs`` members of it drawn by hash,
       again and again while that settles most of what is left. What is still
       outside is compared with all members of the buckets that have the same
       largest component. Members of one component are not compared any more, so
       a bucket of thousands of near copies costs a few comparisons per member
       and the members without any link are compared once with the others; no
       link between different components of a bucket is left out.
    4. Components of all links.

    Returns id, n_shingles, component_id (the smallest id that links reach),
    kept, one row per input row. A null text or one without words has the empty
    set and is linked with nothing. Rows that repeat an id have the same answer
    if their sets agree; an id with several texts is linked by each of them. An
    empty table gives an empty result; other columns are ignored.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketched = cut_lineage(_sketched(plain, words, bands, rows))
    groups = cut_lineage(sketched.filter("n > 0").groupBy("key").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    in_bands = groups.select("rep", "n", F.explode("bands").alias("band"))
    shared = in_bands.groupBy("band").agg(F.count("*").alias("_m")).filter("_m > 1").drop("_m")
    members = cut_lineage(in_bands.join(shared, "band"))
    involved = cut_lineage(members.select(F.col("rep").alias("id")).distinct())
    sets = cut_lineage(_sets(plain.join(involved, "id", "left_semi"), words).distinct())

    def linked(near: DataFrame) -> DataFrame:
        fits = (100 * F.col("n") >= percent * F.col("_hub_n")) & (100 * F.col("_hub_n") >= percent * F.col("n")) & (F.col("label") != F.col("_hub_label"))
        pairs = near.filter(fits).select(F.least("rep", "_hub").alias("a"), F.greatest("rep", "_hub").alias("b")).distinct()
        return _confirmed(pairs, sets, percent)

    def relabelled(state: DataFrame, found: DataFrame) -> DataFrame:
        """Each member's component after more links: only the components that they join are looked at."""
        one, two = state.select(F.col("rep").alias("a"), F.col("label").alias("_a")), state.select(F.col("rep").alias("b"), F.col("label").alias("_b"))
        joined = connected_components(found.join(one, "a").join(two, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))
        joined = state.join(joined.withColumnRenamed("node", "label"), "label", "left")
        return cut_lineage(joined.select("rep", F.coalesce("component", "label").alias("label")))

    def open_labels(state: DataFrame) -> DataFrame:
        """Members of the buckets that still hold several components, with their bucket's largest component."""
        labels = members.join(state, "rep")
        largest = labels.groupBy("band", "label").agg(F.count("*").alias("_k")).groupBy("band").agg(
            F.count("*").alias("_labels"), F.max(F.struct("_k", "label")).alias("_l"), F.sum("_k").alias("_m"))
        largest = largest.filter("_labels > 1").select("band", "_m", F.col("_l.label").alias("_largest"))
        return cut_lineage(labels.join(largest, "band"))

    hub = F.struct("rep", "n")
    first = members.groupBy("band").agg(F.min(hub).alias("_h")).select("band", F.col("_h.rep").alias("_hub"), F.col("_h.n").alias("_hub_n"), F.col("_h.rep").alias("_hub_label"))
    state = involved.select(F.col("id").alias("rep"), F.col("id").alias("label"))
    state = relabelled(state, linked(members.withColumn("label", F.col("rep")).join(first, "band")))
    size, before, turn = members.count(), None, 0
    while True:
        labels = open_labels(state)
        inside, outside = labels.filter("label = _largest"), labels.filter("label <> _largest")
        left = outside.agg(F.sum("_m")).first()[0] or 0  # comparisons that would settle all buckets
        if not left:
            break
        last = left <= size // 4 or before is not None and 2 * left > before
        if last:
            found = _settled(labels, sets, percent)
        else:
            drawn = [F.min(F.struct(F.xxhash64(F.lit(turn * hubs + k), "rep"), hub.alias("hub")))["hub"] for k in range(hubs)]
            some = inside.groupBy("band").agg(F.array_distinct(F.array(*drawn)).alias("_h"), F.first("_largest").alias("_hub_label"))
            some = some.select("band", "_hub_label", F.explode("_h").alias("_h")).select("band", "_hub_label", F.col("_h.rep").alias("_hub"), F.col("_h.n").alias("_hub_n"))
            found = linked(outside.join(some, "band"))
        state = relabelled(state, found)
        if last:
            break
        before, turn = left, turn + 1
    answers = groups.select("key", "rep").join(state, "rep", "left").select("key", F.coalesce("label", "rep").alias("component_id"))
    return sketched.select("id", "n", "key").join(answers, "key", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component_id", "id")).alias("kept"))
