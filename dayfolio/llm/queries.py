"""The operators over the supplied tables, one query each, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfolio.llm import block_search, byte_pairs, exact_dedup, html_cut, language, line_quality, line_templates, mixing, near_dedup, packing, ppm, url_graph, whitening
from dayfolio.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


@query("op1_html_extraction")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return html_cut.extract_main_text(read_table(spark, folder, "pages"))


@query("op2_packing")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op3_lm_scoring")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.score_documents(read_table(spark, folder, "documents"))


@query("op4_near_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, folder, "documents"), words=2)


@query("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify_languages(read_table(spark, folder, "documents"))


@query("op6_source_mixing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(read_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query("op7_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
""")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, folder, "documents"))


@query("op8_quality_rules", r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
counts AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols FROM docs),
starts AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM docs WHERE len(words) > 4),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(list_slice(words, i, i + 4), ' ')) AS c FROM starts),
covered AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS place FROM windows WHERE c > 1) GROUP BY 1),
cut AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
lines AS (SELECT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
  length(line) - length(regexp_replace(line, '[#*$%&|<>»›•·]', '', 'g')) AS marks, length(line) - length(replace(line, '!!', '')) AS shouts FROM cut),
judged AS (SELECT *, n > 0 AND ((n >= 2 AND 3 * marks >= n) OR (n >= 2 AND shouts >= n) OR regexp_matches(line, '%BOILERPLATE%')
  OR (n < 5 AND NOT regexp_matches(line, '%END%'))) AS bad FROM lines),
per AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (bad) AS n_failed_lines, coalesce(sum(chars) FILTER (bad), 0)::BIGINT AS lost_chars,
  count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines FROM judged GROUP BY 1),
whole AS (SELECT counts.*, coalesce(covered.n, 0) AS n_repeat_words, n_lines, n_failed_lines, lost_chars, n_dup_lines FROM counts JOIN per USING (doc_id) LEFT JOIN covered USING (doc_id)),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM whole)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND 100 * lost_chars <= 50 * word_chars AS kept, n_lines, n_failed_lines, lost_chars FROM base
""".replace("%BOILERPLATE%", line_quality.BOILERPLATE).replace("%END%", line_quality.SENTENCE_END.replace("'", "''")))
def op8(spark: SparkSession, folder: str) -> DataFrame:
    judged = line_quality.assess_quality(read_table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_failed_lines", "lost_chars")


@query("op9_line_dedup", """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos
  FROM documents),
cut AS (
  SELECT doc_id, pos, list_transform(
    list_filter(string_split(regexp_replace(line, '[ \t\v\f\r]+', ' ', 'g'), ' '), lambda t: t <> ''),
    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS t
  FROM lines WHERE doc_id IS NOT NULL),
leaves AS (SELECT doc_id, pos, t, len(t) AS n, array_to_string(list_slice(t, 1, 4), ' ') AS lead, array_to_string(t, ' ') AS whole FROM cut WHERE len(t) > 0),
fulls AS (SELECT n, lead, whole, any_value(t) AS t, min(doc_id) AS lo, count(DISTINCT doc_id) AS k FROM leaves GROUP BY n, lead, whole),
variants AS (
  SELECT DISTINCT f.n, f.lead, f.whole FROM fulls f JOIN fulls g ON f.n = g.n AND f.lead = g.lead AND g.lo < f.lo
  WHERE f.n >= 5 AND f.whole <> g.whole AND 100 * len(list_filter(list_zip(f.t, g.t), lambda p: p[1] = p[2])) >= 75 * f.n),
gone AS (
  SELECT DISTINCT doc_id, pos FROM leaves JOIN fulls USING (n, lead, whole) LEFT JOIN variants ON variants.n = leaves.n AND variants.lead = leaves.lead AND variants.whole = leaves.whole
  WHERE variants.n IS NOT NULL OR doc_id > lo AND (leaves.n >= 5 OR k >= 5))
SELECT lines.doc_id, coalesce(string_agg(line, chr(10) ORDER BY lines.pos) FILTER (WHERE gone.pos IS NULL), '') AS text,
       count(*) AS n_lines, count(gone.pos) AS n_dropped
FROM lines LEFT JOIN gone ON lines.doc_id = gone.doc_id AND lines.pos = gone.pos GROUP BY lines.doc_id
""")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return line_templates.drop_recurring_lines(read_table(spark, folder, "documents").select("doc_id", "text"))


@query("op10_url_filters")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return url_graph.judge_urls(read_table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op11_embedding_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten_embeddings(read_table(spark, folder, "embeddings"))


@query("op12_byte_bpe")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    codec = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    tokens = byte_pairs.encode_documents(read_table(spark, folder, "documents"), *codec)
    return byte_pairs.decode_documents(tokens, *codec).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


FOLDED_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@query("op13_lexical_search", f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {FOLDED_TERMS} AS terms FROM documents),
size AS (SELECT count(*) FILTER (len(terms) > 0) AS docs, sum(len(terms))::BIGINT AS words FROM docs),
asked AS (SELECT DISTINCT item_id, unnest({FOLDED_TERMS}) AS term FROM benchmark),
counted AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM counted, size GROUP BY term, docs),
scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term), size GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return block_search.rank_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
