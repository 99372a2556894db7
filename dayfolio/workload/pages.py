"""Landed pages, listings and archives, all built by Spark from the tables."""

from __future__ import annotations

import gzip
import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from dayfolio.functions import text as X
from dayfolio.sources import archives, pages as G, readers
from dayfolio.workload.derive import issue_rows, padded
from dayfolio.workload.registry import query, spread, table


@query("s6_read_pages", "SELECT page_id, CASE WHEN octet_length(encode(html)) > 4000 THEN 'too large' END AS reason FROM pages")
def read_pages(spark, folder):
    good, bad = readers.read_pages(table(spark, folder, "pages"), maximum_bytes=4000)
    return good.select("page_id", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("page_id", "reason"))


@query("x3_page_titles", r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS title,
  len(regexp_extract_all(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'), '(?i)<a\s[^>]*>'))::BIGINT AS links FROM pages""")
def page_titles(spark, folder):
    p = table(spark, folder, "pages").withColumn("m", G.markup("html"))
    title = G.element_text(F.regexp_extract("m", "(?s)<h1>(.*?)</h1>", 1))
    links = F.size(F.regexp_extract_all("m", F.lit("(?i)<a\\s[^>]*>"), F.lit(0)))
    return p.select("page_id", title.alias("title"), links.cast("bigint").alias("links"))


@query("h11_page_link_targets", r"""SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)) AS href FROM pages""")
def page_links(spark, folder):
    p = table(spark, folder, "pages").withColumn("m", G.markup("html"))
    tags = F.regexp_extract_all("m", F.lit("<li>(<a [^>]*>)"), F.lit(1))
    return p.select("page_id", F.explode(F.transform(tags, lambda t: G.attribute(t, "href"))).alias("href"))


PAGE = 40


def listing_pages(spark, folder):
    """One listing page per 40 consecutive orders and category, so a page stays small."""
    o = table(spark, folder, "orders")
    page = F.floor(F.col("o_orderkey") / PAGE)
    slug = F.when(F.col("o_orderstatus") == "F", "quant-ph").when(F.col("o_orderstatus") == "O", "gr-qc").otherwise("hep-th")
    number = F.concat(F.lit("2607."), padded(F.col("o_orderkey") % 100000))
    cross = F.substring("o_orderpriority", 1, 1) == "5"
    link = F.concat(F.lit('<dt><a href="/abs/'), number, F.lit('" title="Abstract">arXiv:'), number, F.lit("</a>"), F.when(cross, " (cross-list from math-ph)").otherwise(""),
                    F.lit('</dt><dd>Text <a href="/abs/9999.99999" title="Abstract">x</a></dd>'))
    grouped = o.select(page.alias("page"), slug.alias("slug"), "o_orderkey", "o_orderdate", cross.alias("cross"), link.alias("link")).groupBy("page", "slug").agg(
        F.min("o_orderdate").alias("day"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(~F.col("cross"), F.struct("o_orderkey", "link")))), lambda s: s["link"]), "").alias("new"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("cross"), F.struct("o_orderkey", "link")))), lambda s: s["link"]), "").alias("crossed"),
        F.count_if(~F.col("cross")).alias("n"), F.count_if("cross").alias("c"))
    return grouped


LISTED = f"""l AS (SELECT o_orderkey // {PAGE} AS page, CASE o_orderstatus WHEN 'F' THEN 'quant-ph' WHEN 'O' THEN 'gr-qc' ELSE 'hep-th' END AS slug, o_orderkey, o_orderdate,
  '2607.' || lpad((o_orderkey % 100000)::VARCHAR, 5, '0') AS id, substr(o_orderpriority, 1, 1) = '5' AS crossed FROM orders)"""


@query("x1_extract_listings", f"""WITH {LISTED} SELECT page, slug, CASE WHEN page % 9 <> 4 AND page % 11 <> 3 THEN min(o_orderdate)::DATE::VARCHAR END AS date, CASE WHEN page % 9 <> 4 AND page % 11 <> 3 THEN count(*) FILTER (crossed) END AS crosslist_count,
  CASE WHEN page % 9 <> 4 AND page % 11 <> 3 THEN coalesce(string_agg(id, ',' ORDER BY id) FILTER (NOT crossed), '') END AS ids,
  CASE WHEN page % 9 = 4 THEN 'invalid date heading' WHEN page % 11 = 3 THEN 'declared counts differ from the entries' END AS reject FROM l GROUP BY 1, 2""")
def extract_listings(spark, folder):
    g = listing_pages(spark, folder)
    heading = F.when(F.col("page") % 9 == 4, "Someday, 1 July 2026").otherwise(F.date_format("day", "EEEE, d MMMM yyyy"))
    n = (F.col("n") + F.when(F.col("page") % 11 == 3, 1).otherwise(0)).cast("string")
    c = F.col("c").cast("string")
    html = F.concat(F.lit("<!doctype html><html><head><script>'<h3>New submissions (showing 9 of 9 entries)</h3>'</script></head><body><div id=\"dlpage\"><h3>Showing new listings for "), heading,
                    F.lit("</h3><dl><h3>New submissions (showing "), n, F.lit(" of "), n, F.lit(" entries)</h3>"), F.col("new"), F.lit("</dl><dl><h3>Cross submissions (showing "), c, F.lit(" of "), c,
                    F.lit(" entries)</h3>"), F.col("crossed"), F.lit("</dl></div></body></html>"))
    found = G.extract_listings(g.select("page", "slug", html.alias("html")))
    return found.select("page", "slug", F.col("announcement_date").cast("string").alias("date"), "crosslist_count", F.array_join("new_ids", ",").alias("ids"), "reject")


@query("x2_extract_week", f"""WITH {LISTED} SELECT page, slug, min(o_orderdate)::DATE::VARCHAR AS date, count(*) AS shown_count, count(*) + page % 3 AS total_count, page % 3 = 0 AS complete,
  count(*) FILTER (crossed) AS crosslist_count, count(*) FILTER (NOT crossed) AS new_count FROM l GROUP BY 1, 2""")
def extract_week(spark, folder):
    g = listing_pages(spark, folder)
    shown = (F.col("n") + F.col("c"))
    html = F.concat(F.lit('<div id="dlpage"><h1>Past week</h1><h3>'), F.date_format("day", "EEE, d MMM yyyy"), F.lit(" (showing "), shown.cast("string"), F.lit(" of "),
                    (shown + F.col("page") % 3).cast("string"), F.lit(" entries )</h3><dl>"), F.col("new"), F.col("crossed"), F.lit("</dl></div>"))
    found = G.week_groups(G.extract_week(g.select("page", "slug", html.alias("html"))))
    return found.select("page", "slug", F.col("announcement_date").cast("string").alias("date"), "shown_count", "total_count", "complete", "crosslist_count", "new_count")


def abstract_pages(spark, folder):
    """An abstract page per customer; some name another paper, some link their comments."""
    c = spread(table(spark, folder, "customer"), "c_custkey")
    k = F.col("c_custkey")
    number = F.concat(F.lit("2607."), padded(k % 100000))
    meta = lambda name, value: F.concat(F.lit(f'<meta name="{name}" content="'), value, F.lit('" />'))
    title = F.concat(F.lit("Result &amp; proof "), F.col("c_name"))
    html = F.concat(
        F.lit('<html><head><link rel="canonical" href="https://arxiv.org/abs/'), number, F.lit('" />'), meta("citation_title", title),
        meta("citation_author", F.concat(F.lit("No"), k.cast("string"), F.lit(", Ann"))), meta("citation_author", F.lit("Gee, Bee")),
        meta("citation_pdf_url", F.concat(F.lit("https://arxiv.org/pdf/"), number)), meta("citation_arxiv_id", F.when(k % 13 == 0, "1111.11111").otherwise(number)),
        meta("citation_abstract", F.concat(F.lit("We study "), F.col("c_mktsegment"))), F.lit("</head><body><strong>arXiv:"), number, F.when(k % 17 == 0, "v2").otherwise("v1"),
        F.lit('</strong><h1 class="title mathjax"><span class="descriptor">Title:</span>'), title, F.lit('</h1><div class="authors"><span class="descriptor">Authors:</span><a href="u">Ann No'),
        k.cast("string"), F.lit("</a>, "), F.when(k % 3 == 0, '<a href="u">Other Person</a>').otherwise('<a href="u">Bee Gee</a>'),
        F.lit('</div><blockquote class="abstract"><span class="descriptor">Abstract:</span>We study</blockquote><table><tr><td class="tablecell label">Comments:</td><td class="tablecell comments">See <a href="https://x.example/'),
        k.cast("string"), F.lit('">this https URL</a></td></tr></table><span class="primary-subject">Quantum Physics (quant-ph)</span></body></html>'))
    return c.select("c_custkey", "c_mktsegment", number.alias("arxivId"), F.when(k % 19 == 0, "gr-qc").otherwise("quant-ph").alias("slug"), html.alias("html"))


@query("x3_extract_abstracts", """SELECT c_custkey, reject, CASE WHEN reject IS NULL THEN 'Result & proof ' || c_name END AS title, CASE WHEN reject IS NULL THEN
    CASE WHEN c_custkey % 3 = 0 THEN 'No' || c_custkey || ', Ann;Gee, Bee' ELSE 'Ann No' || c_custkey || ';Bee Gee' END END AS authors, CASE WHEN reject IS NULL THEN 'See https://x.example/' || c_custkey END AS comments
  FROM (SELECT *, CASE WHEN c_custkey % 13 = 0 THEN 'citation id differs' WHEN c_custkey % 17 = 0 THEN 'version marker differs' WHEN c_custkey % 19 = 0 THEN 'primary category differs' END AS reject FROM customer)""")
def extract_abstracts(spark, folder):
    found = G.extract_abstracts(abstract_pages(spark, folder))
    return found.select("c_custkey", "reject", "title", F.array_join("authors", ";").alias("authors"), "comments")


@query("x5_classify_rejects", """SELECT 'incomplete' AS kind, reason, count(*) AS rows FROM (SELECT CASE WHEN c_custkey % 13 = 0 THEN 'citation id differs' WHEN c_custkey % 17 = 0 THEN 'version marker differs'
  WHEN c_custkey % 19 = 0 THEN 'primary category differs' END AS reason FROM customer) WHERE reason IS NOT NULL GROUP BY ALL""")
def classify_rejects(spark, folder):
    return G.classify_rejects(G.extract_abstracts(abstract_pages(spark, folder)))


@query("x6_build_metadata", """WITH g AS (SELECT *, '2607.' || lpad((c_custkey % 100000)::VARCHAR, 5, '0') AS id FROM customer WHERE c_custkey % 13 <> 0 AND c_custkey % 17 <> 0 AND c_custkey % 19 <> 0)
  SELECT id AS arxiv_id, c_mktsegment AS report_date, row_number() OVER (PARTITION BY c_mktsegment ORDER BY id) AS position, sha256(c_mktsegment) AS digest FROM g WHERE c_custkey % 5 <> 0""")
def build_metadata(spark, folder):
    p = abstract_pages(spark, folder).withColumnRenamed("c_mktsegment", "report_date")
    announced = p.where("c_custkey % 5 <> 0").select("report_date", F.lit("quant-ph").alias("slug"), "arxivId")
    digests = p.select("report_date").distinct().withColumn("digest", F.sha2("report_date", 256))
    found, _ = G.build_metadata(G.extract_abstracts(p), announced, digests)
    return found.select(F.col("arxivId").alias("arxiv_id"), "report_date", F.col("position").cast("bigint").alias("position"), "digest")


def packed(spark, folder):
    """A source archive per document: a tar, a single gzip TeX file, or something broken."""
    d = table(spark, folder, "documents").select("doc_id", "text")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for number, text in zip(batch["doc_id"], batch["text"]):
                body = ("\\documentclass{article}\n" + text).encode("utf-8")
                if number % 4 == 0:
                    content = gzip.compress(body, 1)
                elif number % 4 == 3 and number % 3 == 0:
                    content = b"%PDF-1.7"
                else:
                    raw = io.BytesIO()
                    with tarfile.open(fileobj=raw, mode="w") as tar:
                        name = "../escape.tex" if number % 4 == 2 and number % 5 == 0 else "paper/main.tex"
                        for path, content in ((name, body), ("fig.png", b"\x00\x01"), ("refs.bib", b"\xc3\x28")):
                            info = tarfile.TarInfo(path)
                            info.size = len(content)
                            tar.addfile(info, io.BytesIO(content))
                    content = gzip.compress(raw.getvalue(), 1)
                out.append((str(number), content))
            yield pd.DataFrame(out, columns=["id", "content"])

    return d.mapInPandas(pack, "id string, content binary")


@query("x4_extract_sources", """SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 4 = 0 THEN doc_id || '.tex' WHEN doc_id % 4 = 3 AND doc_id % 3 = 0 THEN NULL WHEN doc_id % 4 = 2 AND doc_id % 5 = 0 THEN NULL ELSE 'paper/main.tex' END AS path,
  CASE WHEN doc_id % 4 = 3 AND doc_id % 3 = 0 THEN NULL WHEN doc_id % 4 = 2 AND doc_id % 5 = 0 THEN NULL ELSE sha256('\\documentclass{article}' || chr(10) || text) END AS digest FROM documents""")
def extract_sources(spark, folder):
    found = archives.extract_sources(packed(spark, folder))
    return found.select("id", "path", F.sha2("text", 256).alias("digest"))


@query("s3_parse_json", """SELECT event_id, event_id % 10 <> 3 AND event_id % 10 <> 7 AS parsed, CASE WHEN event_id % 10 <> 3 AND event_id % 10 <> 7 THEN json_extract_string(props, '$.k')::BIGINT END AS k FROM events""")
def parse_json(spark, folder):
    e = table(spark, folder, "events")
    n = F.col("event_id") % 10
    text = F.when(n == 3, F.concat("props", F.lit("}"), F.lit(" {"))).when(n == 7, F.expr("substring(props, 1, 3)")).otherwise(F.col("props"))
    good, bad = readers.parse_json(e.select("event_id", text.alias("raw")), "raw", "k BIGINT")
    return good.select("event_id", F.lit(True).alias("parsed"), "k").unionByName(bad.select("event_id", F.lit(False).alias("parsed"), F.lit(None).cast("bigint").alias("k")))
