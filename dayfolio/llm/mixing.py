"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfolio.llm.common import WORD, text_of, with_rank
from dayfolio.session import cut_lineage

#: Weights by the source's place in code point order, repeating.
WEIGHTS = (3, 1, 2)
_SALTS = 64

#: One step: the entry in hand (a) meets the next (x). Words move between the two so that their expected
#: sum stays: either a rises or a falls, each as far as it can go, with odds that leave every expectation
#: as it was. One of the two becomes whole and is decided, the other is in hand.
_STEP = """
aggregate(
  slice(items, 2, size(items)),
  named_struct('done', cast(array() as array<struct<id: bigint, copy: bigint, size: bigint, up: boolean>>), 'hand', items[0]),
  (s, x) -> transform(array(named_struct(
      'rise', least(1 - s.hand.p, x.p * x.size / s.hand.size),
      'fall', least(s.hand.p, (1 - x.p) * x.size / s.hand.size),
      'u', shiftrightunsigned(xxhash64({seed}L, s.hand.id, s.hand.copy, x.id, x.copy), 11) / 9007199254740992D)),
    m -> CASE
      WHEN m.u * (m.rise + m.fall) < m.fall AND 1 - s.hand.p <= x.p * x.size / s.hand.size THEN
        named_struct('done', concat(s.done, array(named_struct('id', s.hand.id, 'copy', s.hand.copy, 'size', s.hand.size, 'up', true))),
          'hand', named_struct('size', x.size, 'order', x.order, 'id', x.id, 'copy', x.copy, 'p', greatest(0D, least(1D, x.p - (1 - s.hand.p) * s.hand.size / x.size))))
      WHEN m.u * (m.rise + m.fall) < m.fall THEN
        named_struct('done', concat(s.done, array(named_struct('id', x.id, 'copy', x.copy, 'size', x.size, 'up', false))),
          'hand', named_struct('size', s.hand.size, 'order', s.hand.order, 'id', s.hand.id, 'copy', s.hand.copy, 'p', greatest(0D, least(1D, s.hand.p + m.rise))))
      WHEN s.hand.p <= (1 - x.p) * x.size / s.hand.size THEN
        named_struct('done', concat(s.done, array(named_struct('id', s.hand.id, 'copy', s.hand.copy, 'size', s.hand.size, 'up', false))),
          'hand', named_struct('size', x.size, 'order', x.order, 'id', x.id, 'copy', x.copy, 'p', greatest(0D, least(1D, x.p + s.hand.p * s.hand.size / x.size))))
      ELSE
        named_struct('done', concat(s.done, array(named_struct('id', x.id, 'copy', x.copy, 'size', x.size, 'up', true))),
          'hand', named_struct('size', s.hand.size, 'order', s.hand.order, 'id', s.hand.id, 'copy', s.hand.copy, 'p', greatest(0D, least(1D, s.hand.p - m.fall))))
    END)[0])
"""


def _size() -> Column:
    return F.regexp_count(text_of(), F.lit(WORD)).cast("long")


def source_targets(sources: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds each source's target words to (source, source_size).

    The weights share ``share`` times all words; a target stops at ``most``
    times its source, and what is over is shared again by weight among the
    rest, until none is above. Each round is one sum over the sources.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = with_rank(sources, F.col("source").asc_nulls_last(), name="_place")
    ranked = cut_lineage(ranked.select("source", "source_size", F.get(cycle, (F.col("_place") % len(weights)).cast("int")).alias("_weight")))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    goal, level, capped = share * total, 0.0, -1
    while True:
        full = F.col("_weight") * F.lit(level) > most * F.col("source_size")
        n, held, weight = ranked.agg(
            F.sum(full.cast("long")), F.sum(F.when(full, most * F.col("source_size")).otherwise(0.0)),
            F.sum(F.when(full, 0).otherwise(F.col("_weight")))).first()
        if n is None or n == capped or not weight:
            break
        level, capped = (goal - held) / weight, n
    return ranked.select("source", "source_size", F.least(F.col("_weight") * F.lit(level), most * F.col("source_size")).alias("target"))


def mix_sources(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS,
                chunk: int = 64, seed: int = 20240) -> DataFrame:
    """How often the mix takes each document, so that sources meet their targets.

    A document's expected copies are its source's target over its source's
    size. The whole part is taken; the rest is rounded by pivotal rounding
    within the source: in a chunk of about ``chunk`` documents, long ones first,
    two at a time meet and words move between them until one has a whole number
    of copies; the one that is left of each chunk goes on to the next level,
    where ``chunk`` of them meet, and so on up a tree. The source's last one is
    rounded to the nearer number. So a source's words differ from its target by
    half of one document at most, and no task sees more than a chunk of any
    source. All choices hash ids, so reruns agree.

    Returns doc_id, source, size, source_size, target, copies, taken, place (the
    row's number among equal rows), one row per input row. Null texts have no words; a null source is a source of its
    own, last in order. Documents without words are taken 0 times (copies 0).
    Repeated rows are told apart by their count and each get a row. An empty
    table gives an empty result.
    """
    rows = cut_lineage(
        docs.select(F.col("doc_id").alias("_id"), F.col("source"), _size().alias("size"))
        .groupBy("_id", "source", "size").agg(F.count("*").alias("_copies")))
    sources = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("_copies")).alias("source_size"), F.sum("_copies").alias("_rows"))
    sources = cut_lineage(sources)
    targets = source_targets(sources.select("source", "source_size"), share, most, weights)
    targets = targets.join(sources.select(F.col("source").alias("_s"), "_rows"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    targets = targets.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    single = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1))).drop("_copies")
    single = single.withColumn("_order", F.xxhash64(F.lit(seed), "_id", "_copy")).withColumn("_salt", F.pmod("_order", F.lit(_SALTS)).cast("int"))
    joined = single.alias("d").join(targets.alias("t"), (F.col("d._salt") == F.col("t._salt")) & F.col("d.source").eqNullSafe(F.col("t.source")))
    expected = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.col("target") / F.col("source_size"))).otherwise(0.0)
    planned = cut_lineage(joined.select(
        "_id", "_copy", "_order", "d.source", "size", "source_size", "target", F.floor(expected).alias("_whole"),
        (expected - F.floor(expected)).alias("_p"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "_id", "_copy"), F.ceil(F.col("_rows") / chunk)).alias("_chunk")))
    open_ = (F.col("size") > 0) & (F.col("_p") > 0)
    facts = ["source", "source_size", "target", "_whole"]
    parts = [planned.filter(~open_).select("_id", "_copy", "size", *facts, F.lit(False).alias("_up"))]
    level = planned.filter(open_).select(
        *facts, "_chunk", F.struct("size", F.col("_order").alias("order"), F.col("_id").alias("id"), F.col("_copy").alias("copy"), F.col("_p").alias("p")).alias("_item"))
    chunks = (sources.agg(F.max("_rows")).first()[0] or 0) / chunk
    while True:
        met = level.groupBy(*facts, "_chunk").agg(F.sort_array(F.collect_list("_item"), asc=False).alias("items"))
        met = cut_lineage(met.withColumn("_met", F.expr(_STEP.format(seed=seed))).select(*facts, "_chunk", "_met"))
        done = met.select(*facts, F.explode("_met.done").alias("_d"))
        parts.append(done.select(F.col("_d.id").alias("_id"), F.col("_d.copy").alias("_copy"), F.col("_d.size").alias("size"), *facts, F.col("_d.up").alias("_up")))
        left = met.select(*facts, F.floor(F.col("_chunk") / chunk).alias("_chunk"), F.col("_met.hand").alias("_item"))
        if chunks <= 1:
            break
        level, chunks = left, chunks / chunk
    last = F.col("_item.p") >= 0.5
    parts.append(left.select(F.col("_item.id").alias("_id"), F.col("_item.copy").alias("_copy"), F.col("_item.size").alias("size"), *facts, last.alias("_up")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    copies = F.when(F.col("size") > 0, F.col("_whole") + F.col("_up").cast("long")).otherwise(0).cast("long")
    return out.select(F.col("_id").alias("doc_id"), "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), F.col("_copy").alias("place"))


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as many times as ``mix_sources`` takes it, with the columns given.

    Rows that share id, source and number of words are told apart by a hash of
    all their columns, so a rerun takes the same ones.
    """
    mix = mix_sources(docs, **options).select(F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"), F.col("size").alias("__mix_size"), F.col("place").alias("__mix_place"), F.col("copies").alias("__mix_times"))
    key = [F.col("doc_id"), F.col("source"), _size()]
    placed = docs.withColumn("__mix_words", _size()).withColumn("__mix_nth", F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64(*docs.columns))) - 1)
    same = F.col("doc_id").eqNullSafe(F.col("__mix_id")) & F.col("source").eqNullSafe(F.col("__mix_source")) & (F.col("__mix_words") == F.col("__mix_size")) & (F.col("__mix_nth") == F.col("__mix_place"))
    taken = placed.join(mix.filter("__mix_times > 0"), same)
    return taken.withColumn("__mix_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_times")))).select(*docs.columns)
