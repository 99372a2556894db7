"""Findings as rows.

A rule states what must hold. All rules of a table are evaluated in one pass:
each row builds the array of its rules' findings, without the null ones of
rules that hold, and what is left is exploded. Adding a rule adds no scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

ISSUE_COLUMNS = ("date", "slug", "scope", "id", "position", "path", "kind", "rule", "message", "fragment")
ISSUE_SCHEMA = ("date STRING, slug STRING, scope STRING, id STRING, position BIGINT, path STRING, kind STRING, "
                "rule STRING, message STRING, fragment STRING")


@dataclass(frozen=True)
class Rule:
    """One requirement. A null outcome counts as broken."""

    path: str | Column
    kind: str
    message: str | Column
    holds: Column
    applies: Column | None = None
    fragment: Column | None = None
    name: str | None = None


def _text(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def find_issues(df: DataFrame, rules: Sequence[Rule], keys: Mapping[str, str | Column],
                scope: str = "paper") -> DataFrame:
    """One row per broken rule. ``keys`` maps date, slug, id, position to columns."""
    found = []
    for rule in rules:
        broken = ~F.coalesce(rule.holds, F.lit(False))
        if rule.applies is not None:
            broken = F.coalesce(rule.applies, F.lit(False)) & broken
        found.append(F.when(broken, F.struct(
            _text(rule.path).alias("path"), F.lit(rule.kind).alias("kind"),
            F.lit(rule.name or rule.kind).alias("rule"), _text(rule.message).alias("message"),
            (rule.fragment if rule.fragment is not None else F.lit(None)).cast("string").alias("fragment"),
        )))
    listed = df.select(
        *[(F.col(keys[k]) if isinstance(keys.get(k), str) else keys.get(k, F.lit(None))).cast(t).alias(k)
          for k, t in (("date", "string"), ("slug", "string"), ("id", "string"), ("position", "bigint"))],
        # The filter also keeps many rules out of one generated method, which the JVM would not compile.
        F.explode(F.filter(F.array(*found), lambda i: i.isNotNull())).alias("issue"),
    )
    return listed.select("date", "slug", F.lit(scope).alias("scope"), "id", "position", "issue.*")


def as_issue(df: DataFrame, kind: str, message: str | Column, path: str | Column,
             keys: Mapping[str, str | Column], scope: str = "category") -> DataFrame:
    """Every row of ``df`` becomes one finding."""
    return find_issues(df, [Rule(path, kind, message, F.lit(False))], keys, scope)


def collect_issues(*tables: DataFrame) -> DataFrame:
    """Union of findings, each (place, kind, message, affected row) once.

    Affected rows stay rows: a finding that touches a third of a table would
    not fit an array.
    """
    union = tables[0]
    for table in tables[1:]:
        union = union.unionByName(table)
    return union.dropDuplicates(["date", "slug", "id", "position", "path", "kind", "message"])


def summarize_issues(issues: DataFrame) -> DataFrame:
    """One row per finding with the number of rows it affects and the first."""
    return issues.groupBy("date", "slug", "path", "kind", "message").agg(
        F.count(F.lit(1)).alias("affected"), F.min("position").alias("first_position"))


def order_issues(issues: DataFrame) -> DataFrame:
    return issues.orderBy("path", "kind", "message", "position", "id")


def passes(issues: DataFrame) -> bool:
    """The gate form of an audit: true when nothing was found."""
    return issues.isEmpty()


def union_all(tables: Iterable[DataFrame]) -> DataFrame:
    tables = list(tables)
    union = tables[0]
    for table in tables[1:]:
        union = union.unionByName(table, allowMissingColumns=True)
    return union
