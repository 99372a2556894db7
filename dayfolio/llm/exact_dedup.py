"""Exact duplicates by a tree merge of sorted digest runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfolio.llm.common import text_of
from dayfolio.session import cut_lineage

#: What two entries must share to be the same text: SHA-256, length and a second hash.
KEY = ("_digest", "_length", "_check")


def merge_runs(entries: DataFrame) -> DataFrame:
    """One binomial round: run 2k and run 2k + 1 become run k, sorted by digest, with one entry for each digest.

    The two runs meet part by part, the part being the first two bytes of the
    digest, so a run is never a task of its own. Each task sorts what it gets
    and goes through it once: neighbours that agree in the whole key become
    one entry with the largest id and the sum of the counts.
    """
    order = ["_run", "_part", *KEY]
    dealt = entries.withColumn("_run", F.floor(F.col("_run") / 2)).repartition("_run", "_part").sortWithinPartitions(*order, F.desc_nulls_last("_keep"))
    same = Window.partitionBy(*order)
    largest = same.orderBy(F.desc_nulls_last("_keep"))
    both = largest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    merged = dealt.withColumns({"_place": F.row_number().over(largest), "_n": F.sum("_n").over(both)})
    return merged.filter("_place = 1").drop("_place")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = 16) -> DataFrame:
    """Marks, for each row, the row that stays among those with the same text.

    Each document belongs to one of ``runs`` runs. A run first keeps one entry
    per digest; then, round by round, two runs merge into one (``merge_runs``),
    until one is left. An entry is a digest, an id and a count, and a run has
    one for each digest, so a group of copies meets as two entries at a time.
    The answer goes back the same way: to the entries of the first runs, then
    to the documents by run and digest, so a group that holds a third of all
    rows is dealt to ``runs`` tasks.

    Returns id, keep_id, group_size, kept, text_sha256, one row per input row.
    A null text equals the empty text. Rows that repeat an id with the same
    text are one document shown more than once: each counts in group_size and
    has the same answer. A null id loses to any other. Texts of any length
    count whole. An empty table gives an empty result; other columns are
    ignored.
    """
    text = text_of(text_col)
    rows = cut_lineage(docs.select(
        F.col(id_col).alias("_id"),
        F.unhex(F.sha2(text, 256)).alias("_digest"), F.octet_length(text).alias("_length"), F.xxhash64(text).alias("_check"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(runs)).alias("_run"),
    ))
    leaves = rows.groupBy(*KEY, "_run").agg(F.max("_id").alias("_keep"), F.count("*").alias("_n"))
    merged, left = leaves.withColumn("_part", F.substring("_digest", 1, 2)), runs
    while left > 1:
        merged, left = merge_runs(merged), -(-left // 2)
    answers = leaves.select(*KEY, "_run").join(merged.select(*KEY, "_keep", "_n"), [*KEY])
    return rows.join(answers, [*KEY, "_run"]).select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )
