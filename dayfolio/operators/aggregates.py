"""Counts, consistency checks and score distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dayfolio import config
from dayfolio.functions import records as R
from dayfolio.operators.ordering import with_position

GROUP = ("report_date", "slug")


def category_counts(df: DataFrame, group: Sequence[str] = GROUP, flag: str = "fullTextEvaluated",
                    crosslist: str | None = None) -> DataFrame:
    """New, evaluated, full-text and cross-list counts per date and category."""
    cross = F.coalesce(F.col(crosslist), F.lit(False)) if crosslist else F.lit(False)
    return df.groupBy(*group).agg(
        F.count_if(~cross).alias("total_new"), F.count_if(~cross).alias("evaluated"),
        F.count_if(~cross & F.col(flag)).alias("full_text"), F.count_if(cross).alias("crosslists"))


def edition_totals(counts: DataFrame, date: str = "report_date", slug: str = "slug") -> DataFrame:
    """Per category and per date; the date's own row has a null category.

    Dates without any paper are dropped: they may not be published.
    """
    summed = counts.rollup(date, slug).agg(
        F.sum("total_new").alias("total_new"), F.sum("evaluated").alias("evaluated"), F.sum("full_text").alias("full_text"))
    return summed.where(F.col(date).isNotNull()).where(F.col(slug).isNotNull() | (F.col("total_new") > 0))


def edition_time(df: DataFrame, date: str = "report_date", time: str = "generated_at") -> DataFrame:
    return df.groupBy(date).agg(F.max(time).alias(time))


def duplicate_ids(df: DataFrame, date: str = "report_date", slug: str = "slug", paper_id: str = "arxivId") -> DataFrame:
    """Ids used more than once on a date, within or across categories."""
    per_slug = df.groupBy(date, paper_id, slug).agg(F.count(F.lit(1)).alias("_n"))
    return (per_slug.groupBy(date, paper_id)
            .agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("categories"),
                 F.array_join(F.sort_array(F.collect_list(slug)), ",").alias("category_list"))
            .where("rows > 1"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def run_consistency(df: DataFrame, date: str = "report_date", run: str = "run_id", kind: str = "listing_kind") -> DataFrame:
    """One row per broken rule: a date with several runs or listing kinds, a run on several dates."""
    triples = df.groupBy(date, run, kind).agg(F.count(F.lit(1)).alias("_n"))
    per_date = triples.groupBy(date).agg(F.count_distinct(run).alias("runs"), F.count_distinct(kind).alias("kinds"))
    per_run = triples.groupBy(run).agg(F.count_distinct(date).alias("dates"))
    broken_date = per_date.where("runs > 1 or kinds > 1").select(
        F.lit("date").alias("scope"), F.col(date).cast("string").alias("value"), "runs", "kinds", F.lit(None).cast("bigint").alias("dates"))
    broken_run = per_run.where("dates > 1").select(
        F.lit("run").alias("scope"), F.col(run).cast("string").alias("value"),
        F.lit(None).cast("bigint").alias("runs"), F.lit(None).cast("bigint").alias("kinds"), "dates")
    return broken_date.unionByName(broken_run)


def repeated_groups(df: DataFrame, value: Column | str, position: str, group: Sequence[str] = (), **options) -> DataFrame:
    """Each value with its size and first position, largest first, then earliest."""
    column = F.col(value) if isinstance(value, str) else value
    sizes = df.groupBy(*group, column.alias("value")).agg(
        F.count(F.lit(1)).alias("size"), F.min(position).alias("first_position"))
    return with_position(sizes, group, [-F.col("size"), F.col("first_position")], "place", **options)


def plateau(df: DataFrame, value: Column, position: str, group: Sequence[str] = GROUP, ratio: float = 0.35,
            sample: int = config.PLATEAU["sample"], matches: int = config.PLATEAU["matches"]) -> DataFrame:
    """Values that one group uses too often.

    The values are counted before anything moves; totals come from the counts.
    """
    sizes = df.groupBy(*group, value.alias("value")).agg(F.count(F.lit(1)).alias("size"), F.min(position).alias("first_position"))
    totals = sizes.groupBy(*group).agg(F.sum("size").alias("papers")).where(F.col("papers") >= sample)
    return (sizes.where(F.col("size") >= matches).join(totals, list(group))
            .where(R.ratio(F.col("size"), F.col("papers")) > ratio))


def score_plateau(df: DataFrame, group: Sequence[str] = GROUP, total: str = "totalScore", position: str = "index") -> DataFrame:
    return plateau(df, F.col(total), position, group, config.PLATEAU["total_ratio"])


def score_vector(scores: str = "scores") -> Column:
    return F.concat_ws("/", *[F.col(f"{scores}.{k}").cast("string") for k in config.SCORE_KEYS])


def vector_plateau(df: DataFrame, group: Sequence[str] = GROUP, position: str = "index", scores: str = "scores") -> DataFrame:
    return plateau(df, score_vector(scores), position, group, config.PLATEAU["vector_ratio"])


def latest_id(df: DataFrame, paper_id: str = "arxivId", group: Sequence[str] = ()) -> DataFrame:
    """The numerically largest id."""
    return df.groupBy(*group).agg(F.max_by(paper_id, R.id_sort_key(paper_id)).alias("latest_id"))


def failure_counts(events: DataFrame, keys: Sequence[str], attempt: str = "attempt_id", failed: str = "failed",
                   structured: str = "structured") -> DataFrame:
    """Distinct failed attempts: all, structured and ordinary."""
    per_attempt = events.where(F.col(failed)).groupBy(*keys, attempt).agg(F.max(F.col(structured).cast("int")).alias("_s"))
    return per_attempt.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("failures"), F.sum("_s").alias("structured_failures"),
        F.sum(1 - F.col("_s")).alias("ordinary_failures"))


def complete_jobs(records: DataFrame, keys: Sequence[str], slug: str = "slug", receipted: str = "has_receipt",
                  categories: Sequence[str] = config.CATEGORIES) -> DataFrame:
    """Adds whether every category is present with a receipt."""
    present = [F.coalesce(F.max(F.when(F.col(slug) == c, F.col(receipted))), F.lit(False)).alias(f"_c{i}")
               for i, c in enumerate(categories)]
    counted = records.groupBy(*keys).agg(*present)
    count = sum((F.col(f"_c{i}").cast("int") for i in range(len(categories))), F.lit(0))
    return counted.select(*keys, count.alias("complete_categories"), (count == len(categories)).alias("is_complete"))


def badge_counts(df: DataFrame, date: str = "report_date", slug: str = "slug", badges: str = "eminentAuthors") -> DataFrame:
    """Papers with a badge per category and, in the null-category row, per date."""
    return (df.rollup(date, slug).agg(F.count_if(F.size(badges) > 0).alias("badge_papers"))
            .where(F.col(date).isNotNull()))


def publication_state(events: DataFrame, keys: Sequence[str], order: Sequence[str] = ("at", "event_id"),
                      status: str = "status", commit: str = "commit") -> DataFrame:
    """Last status, published commit and whether published commits conflict."""
    published = F.when(F.col(status) == "published", F.col(commit))
    return events.groupBy(*keys).agg(
        F.max_by(status, F.struct(*order)).alias("last_status"),
        F.max_by(published, F.when(published.isNotNull(), F.struct(*order))).alias("published_commit"),
        (F.min(published) != F.max(published)).alias("_conflict"),
    ).withColumn("conflicting", F.coalesce("_conflict", F.lit(False))).drop("_conflict")


def pending_summary(dates: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """Number of pending dates and the oldest and newest of them."""
    return dates.groupBy(*keys).agg(F.count(F.lit(1)).alias("pending"), F.min(date).alias("oldest"), F.max(date).alias("newest"))


def latest_date(df: DataFrame, date: str = "date") -> DataFrame:
    return df.agg(F.max(date).alias("latest_date"))


def eligible_dates(counts: DataFrame, date: str = "date", new: str = "new_count", group: Sequence[str] = ()) -> DataFrame:
    """Dates with at least one primary item in any category."""
    return counts.groupBy(*group, date).agg(F.sum(new).alias(new)).where(F.col(new) > 0)


def sorted_ids(df: DataFrame, group: Sequence[str] = GROUP, paper_id: str = "arxivId", **options) -> DataFrame:
    """Distinct ids of each group with their place in sorted order, one row each."""
    return with_position(df.select(*group, paper_id).distinct(), group, [paper_id], "position", **options)
