"""Deterministic ranking, stored-rank checks and top lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dayfolio import config
from dayfolio.operators.checks import PAPER_ISSUE_KEYS
from dayfolio.operators.issues import Rule, as_issue, find_issues, union_all
from dayfolio.operators.ordering import top_rows, with_position, with_previous

GROUP = ("report_date", "slug")


def paper_order(total: str = "totalScore", scores: str = "scores", paper_id: str = "arxivId") -> list[Column]:
    """Total, then the axes in tie-break order, all descending; then the id."""
    return [-F.col(total), *[-F.col(f"{scores}.{k}") for k in config.TIE_BREAK_KEYS], F.col(paper_id)]


def rank_papers(df: DataFrame, group: Sequence[str] = GROUP, order: Sequence[Column] | None = None,
                name: str = "rank", **options) -> DataFrame:
    """1..n per group, without ties, however large a group is."""
    return with_position(df, group, order or paper_order(), name, **options)


def placed(paper: Column, index: Column) -> Column:
    """A paper of a report's array behind its place in the canonical order, so that sorted entries are ranked papers."""
    order = [-paper["totalScore"], *[-paper["scores"][k] for k in config.TIE_BREAK_KEYS], paper["arxivId"]]
    return F.struct(*[c.alias(f"k{n}") for n, c in enumerate(order)], index.alias("index"), paper.alias("paper"))


def ranked_reports(reports: DataFrame, name: str = "rank") -> DataFrame:
    """``explode_papers`` with the papers' canonical ranks in place of the stored ones.

    A report is one stored document, so its papers are ordered where they lie:
    nothing moves. Rows of many documents are ranked by ``rank_papers``.
    """
    entries = F.array_sort(F.transform("papers", placed))
    rows = reports.select(F.col("reportDate").alias("report_date"), "slug", F.posexplode(entries).alias("_at", "_k"))
    return rows.select("report_date", "slug", F.col("_k.index").alias("index"), "_k.paper.*", "_at").withColumn(name, F.col("_at") + 1).drop("_at")


def order_papers(df: DataFrame, group: Sequence[str] = GROUP, order: Sequence[Column] | None = None) -> DataFrame:
    """Total order over all groups: a range-partitioned sort."""
    return df.orderBy(*group, *(order or paper_order()))


def check_rank(df: DataFrame, group: Sequence[str] = GROUP, order: Sequence[Column] | None = None,
               stored: str = "rank", keys: Mapping[str, str] = PAPER_ISSUE_KEYS, **options) -> DataFrame:
    """Stored rank against the canonical one; range; repeated ranks."""
    ranked = rank_papers(df, group, order, "_canonical", **options)
    rows = find_issues(ranked, [
        Rule(stored, "value", "must be a positive integer", F.col(stored) >= 1, name="rank"),
        Rule(stored, "invariant", F.concat(F.lit("must be deterministic rank "), F.col("_canonical").cast("string")),
             F.col(stored) == F.col("_canonical"), name="rank"),
    ], keys)
    used = df.where(F.col(stored).isNotNull()).groupBy(*group, stored).agg(F.count(F.lit(1)).alias("_n"))
    shared = {k: keys[k] for k in ("date", "slug") if k in keys}
    repeated = as_issue(used.where("_n > 1"), "invariant",
                        F.concat(F.lit("rank "), F.col(stored).cast("string"), F.lit(" is used "), F.col("_n").cast("string"), F.lit(" times")),
                        stored, shared)
    extent = used.groupBy(*group).agg(F.max(stored).alias("_highest"), F.sum("_n").alias("_size"))
    beyond = as_issue(extent.where("_highest > _size"), "value",
                      F.concat(F.lit("rank "), F.col("_highest").cast("string"), F.lit(" exceeds the paper count "), F.col("_size").cast("string")),
                      stored, shared)
    return union_all([rows, repeated, beyond])


def check_monotone(df: DataFrame, group: Sequence[str] = GROUP, along: Sequence[Column | str] = ("rank", "arxivId"),
                   total: str = "totalScore", keys: Mapping[str, str] = PAPER_ISSUE_KEYS, **options) -> DataFrame:
    """Totals must not rise along the rank."""
    stepped = with_previous(df, group, along, {"_previous": total}, **options)
    return find_issues(stepped, [Rule(total, "order", "total scores must be non-increasing by rank",
                                      F.col("_previous") >= F.col(total), applies=F.col("_previous").isNotNull(), name="monotone")], keys)


def check_order(df: DataFrame, group: Sequence[str], along: Sequence[Column | str], value: str,
                newest_first: bool = True, keys: Mapping[str, str] | None = None, **options) -> DataFrame:
    """Dates strictly newest to oldest, or oldest to newest, along a position."""
    stepped = with_previous(df, group, along, {"_previous": value}, **options)
    good = F.col("_previous") > F.col(value) if newest_first else F.col("_previous") < F.col(value)
    message = "must be in strict newest-to-oldest order" if newest_first else "must be in strict oldest-to-newest order"
    return find_issues(stepped, [Rule(value, "order", message, good, applies=F.col("_previous").isNotNull(), name="order")], keys or {})


def split_top(df: DataFrame, size: int = config.TOP_SIZE, group: Sequence[str] = GROUP,
              order: Sequence[Column] | None = None, name: str = "rank", **options) -> tuple[DataFrame, DataFrame]:
    """The top list and the remainder; sizes min(k, n) and n - min(k, n)."""
    order = order or paper_order()
    rest = rank_papers(df, group, order, name, **options).where(F.col(name) > size)
    return top_rows(df, group, order, size, name), rest


def shortlist(df: DataFrame, size: int = config.SHORTLIST_SIZE, group: Sequence[str] = GROUP,
              order: Sequence[Column] | None = None, name: str = "rank") -> DataFrame:
    return top_rows(df, group, order or paper_order(), size, name)


def projected_budget(df: DataFrame, limits: DataFrame, flag: str = "fullTextEvaluated", size: int = config.TOP_SIZE,
                     group: Sequence[str] = GROUP, order: Sequence[Column] | None = None) -> DataFrame:
    """Flagged rows united with the top list, against ``full_text_limit``.

    Counting the unflagged members of the top list is enough, so only ``size``
    rows per group are ordered.
    """
    flagged = df.groupBy(*group).agg(F.count_if(F.col(flag)).alias("flagged"), F.count(F.lit(1)).alias("papers"))
    added = (top_rows(df, group, order or paper_order(), size, "_rank").where(~F.coalesce(F.col(flag), F.lit(False)))
             .groupBy(*group).agg(F.count(F.lit(1)).alias("added")))
    joined = flagged.join(added, list(group), "left").join(limits.select(*group, "full_text_limit"), list(group), "left")
    return (joined.withColumn("projected", F.col("flagged") + F.coalesce("added", F.lit(0)))
            .withColumn("over_budget", F.col("projected") > F.col("full_text_limit")).drop("added"))


def top_and_rest(ranked: DataFrame, full: Sequence[str], summary: Sequence[str], size: int = config.TOP_SIZE,
                 name: str = "rank") -> DataFrame:
    """Full record up to ``size``, summary columns beyond it."""
    inside = F.col(name) <= size
    return ranked.select(
        *[c for c in ranked.columns if c in GROUP], name, inside.alias("is_top"),
        F.when(inside, F.struct(*full)).alias("full"), F.when(~inside, F.struct(*summary)).alias("summary"))
