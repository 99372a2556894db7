"""URL filters: rules by host and path, and trust carried along links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfolio.llm.common import lower_ascii
from dayfolio.session import cut_lineage

#: (verdict, host, path start)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_SALTS = 64
#: Host of each link that names one.
LINK_HOST = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: what follows the first ``://`` up to ``/ ? #``, A-Z lower-cased.
    Path: what follows up to ``? #``. Both empty without ``://`` or url."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as ``host + path``, and its verdict; null if none."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts, counted before they move."""
    links = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(LINK_HOST), 1)
    found = pages.select(F.col("_host").alias("src"), F.explode(links).alias("_to"))
    found = found.select("src", lower_ascii(F.col("_to")).alias("dst"))
    return found.filter((F.col("src") != "") & (F.col("src") != F.col("dst"))).groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-4) -> DataFrame:
    """Personalised PageRank of several walks at once: (walk, node, score).

    ``edges`` has walk, src, dst, n; ``seeds`` has walk, node and a mass that
    sums to 1 for each walk. Each round carries the mass that still moves one
    step along the edges; a node's score sums what passed through it. Rounds
    end when, for every node of every walk, what the round brought and what may
    follow from it at the damping's pace is at most ``tolerance`` of what the
    node has, so neither the number of seeds nor the distance from them counts:
    a node reached for the first time always asks for another round. Rounds are
    as many as the longest way from a seed, or as long as mass circles. Edges
    of a node are dealt over salts by their target, so a host that links to
    very many is not one task.
    """
    out = edges.groupBy("walk", "src").agg(F.sum("n").alias("_out"))
    steps = edges.join(out, ["walk", "src"]).select(
        "walk", "src", "dst", (damping * F.col("n") / F.col("_out")).alias("_share"), F.pmod(F.xxhash64("dst"), F.lit(_SALTS)).cast("int").alias("_salt"))
    steps = cut_lineage(steps)
    passed = cut_lineage(seeds.select("walk", "node", F.col("mass").cast("double").alias("mass"), F.col("mass").cast("double").alias("moved")))
    while True:
        spread = passed.filter("moved > 0").select("walk", F.col("node").alias("src"), "moved", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt"))
        moving = steps.join(spread, ["walk", "src", "_salt"]).select("walk", F.col("dst").alias("node"), (F.col("moved") * F.col("_share")).alias("moved"))
        both = passed.select("walk", "node", "mass", F.lit(0.0).alias("moved")).unionByName(moving.withColumn("mass", F.col("moved")))
        passed = cut_lineage(both.groupBy("walk", "node").agg(F.sum("mass").alias("mass"), F.sum("moved").alias("moved")))
        if passed.filter(F.col("moved") * damping > tolerance * (1 - damping) * F.col("mass")).isEmpty():
            return passed.select("walk", "node", ((1 - damping) * F.col("mass")).alias("score"))


def judge_urls(pages: DataFrame, rules=RULES, damping: float = 0.85, ratio: float = 1.0) -> DataFrame:
    """Allows or blocks each page: by the longest rule, else by its host's links.

    Hosts are trusted seeds when rules allow more than half of their pages, and
    blocked seeds when rules block more than half. Trust walks along links from
    the trusted seeds; distrust walks against them from the blocked seeds, so a
    host that links to blocked ones is tainted. A host is blocked if its
    distrust is above ``ratio`` times its trust; a host that neither reaches is
    allowed.

    Returns page_id, host, path, rule, verdict, trust and distrust of blocked
    hosts (else null). Null urls and urls without ``://`` have an empty host,
    no rule and are allowed; null html has no links. Repeated rows each get a
    row; an empty table gives an empty result; other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    named = pages.select(F.col("page_id"), F.col("html"), host.alias("_host"), path.alias("_path"))
    name, verdict = matching_rule(F.col("_host"), F.col("_path"), rules)
    ruled = named.withColumns({"_rule": name, "_verdict": verdict})
    hosts = ruled.filter(F.col("_host") != "").groupBy("_host").agg(
        F.count("*").alias("_n"), F.sum((F.col("_verdict") == "allow").cast("int")).alias("_allow"), F.sum((F.col("_verdict") == "block").cast("int")).alias("_block"))
    hosts = cut_lineage(hosts)
    both = F.when(2 * F.col("_allow") > F.col("_n"), "trust").when(2 * F.col("_block") > F.col("_n"), "distrust")
    seeds = hosts.select(both.alias("walk"), F.col("_host").alias("node")).filter(F.col("walk").isNotNull())
    counts = {r["walk"]: r["n"] for r in seeds.groupBy("walk").agg(F.count("*").alias("n")).collect()}  # two rows
    seeds = seeds.withColumn("mass", F.when(F.col("walk") == "trust", 1.0 / counts.get("trust", 1)).otherwise(1.0 / counts.get("distrust", 1)))
    edges = cut_lineage(host_edges(named))
    walks = edges.select(F.lit("trust").alias("walk"), "src", "dst", "n").unionByName(
        edges.select(F.lit("distrust").alias("walk"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    scores = propagate(walks, seeds, damping).groupBy("node").agg(
        F.sum(F.when(F.col("walk") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("walk") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"))
    blocked = scores.filter(F.col("distrust") > ratio * F.col("trust")).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    judged = ruled.drop("html").withColumn("_salt", F.pmod(F.xxhash64("page_id", "_path"), F.lit(_SALTS)).cast("int"))
    judged = judged.join(blocked.withColumnRenamed("node", "_host"), ["_host", "_salt"], "left")
    return judged.select(
        "page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"),
        F.coalesce("_verdict", F.when(F.col("distrust").isNotNull(), "block").otherwise("allow")).alias("verdict"), "trust", "distrust")
