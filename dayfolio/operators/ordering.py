"""Positions and neighbours inside groups of any size.

A plain ``row_number`` sends each group to one task. Here the rows are dealt by
ranges of group and order and written once, so every later step sees the same
ranges and the input is read once. Each range numbers its own rows; the few
groups that go on from one range into the next, at most one per range, get what
lies before them from a table with a row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from dayfolio.session import cut_lineage


def sort_key(order: Sequence[Column | str]) -> Column:
    """One ascending struct; negate numeric columns for descending order.

    The last column must make the key unique within a group.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)])


def _same_group(group: Sequence[str], prefix: str) -> Column:
    condition = F.col("_range") == F.col(prefix + "range")
    for name in group:
        condition = condition & F.col(name).eqNullSafe(F.col(prefix + name))
    return condition


def with_range(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], ranges: int | None = None) -> DataFrame:
    """The rows dealt by ranges, with ``_key`` and ``_range``, written to the shared folder."""
    count = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("_key", sort_key(order)).repartitionByRange(count, *group, "_key")
    return cut_lineage(dealt.withColumn("_range", F.spark_partition_id()))


def _before(ranged: DataFrame, group: Sequence[str], last: Column, across) -> DataFrame:
    """For each group that goes on from an earlier range what ``across`` finds there.

    Only a range's first group can go on, so there are fewer rows than ranges.
    """
    window = Window.partitionBy(*["_g_" + name for name in group]).orderBy("_g_range")
    sizes = ranged.groupBy(*[F.col(name).alias("_g_" + name) for name in group], F.col("_range").alias("_g_range")).agg(last.alias("_ord_last"))
    return sizes.withColumn("_ord_before", across("_ord_last", window)).where("_ord_before is not null").drop("_ord_last")


def with_position(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                  name: str = "position", ranges: int | None = None, small_groups: bool = False) -> DataFrame:
    """Adds the 1-based place of each row in its group.

    With ``small_groups``, for groups that are known to fit a task, such as the
    papers of a document, nothing is written.
    """
    if group and small_groups:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(sort_key(order))).cast("bigint"))
    if not group:
        return with_position(df.withColumn("_all", F.lit(0)), ["_all"], order, name, ranges).drop("_all")
    ranged = with_range(df, group, order, ranges)
    earlier = _before(ranged, group, F.count(F.lit(1)), lambda c, w: F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    within = Window.partitionBy(*group, "_range").orderBy("_key")
    return (
        ranged.withColumn("_ord_local", F.row_number().over(within))
        .join(F.broadcast(earlier), _same_group(group, "_g_"), "left")
        .withColumn(name, F.col("_ord_local") + F.coalesce("_ord_before", F.lit(0)))
        .drop("_key", "_range", "_ord_local", "_ord_before", "_g_range", *["_g_" + c for c in group])
    )


def with_previous(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                  columns: dict[str, Column | str], ranges: int | None = None, small_groups: bool = False) -> DataFrame:
    """Adds, under each new name, the value the preceding row of the group has."""
    if group and small_groups:
        before = Window.partitionBy(*group).orderBy(sort_key(order))
        return df.withColumns({n: F.lag(c).over(before) for n, c in columns.items()})
    if not group:
        whole = df.withColumn("_all", F.lit(0))
        return with_previous(whole, ["_all"], order, columns, ranges).drop("_all")
    wanted = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])
    ranged = with_range(df.withColumn("_ord_row", wanted), group, order, ranges)
    earlier = _before(ranged, group, F.max_by("_ord_row", "_key"), lambda c, w: F.lag(c).over(w))
    within = Window.partitionBy(*group, "_range").orderBy("_key")
    joined = (
        ranged.withColumn("_ord_lag", F.lag("_ord_row").over(within))
        .join(F.broadcast(earlier), _same_group(group, "_g_"), "left")
        .withColumn("_ord_lag", F.coalesce("_ord_lag", "_ord_before"))
    )
    for name in columns:
        joined = joined.withColumn(name, F.col("_ord_lag")[name])
    return joined.drop("_key", "_range", "_ord_row", "_ord_lag", "_ord_before", "_g_range", *["_g_" + c for c in group])


def top_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], size: int,
             name: str = "position") -> DataFrame:
    """The first ``size`` rows of each group.

    Catalyst keeps only ``size`` rows per group and task before the shuffle.
    """
    window = Window.partitionBy(*group).orderBy(sort_key(order))
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= size)
