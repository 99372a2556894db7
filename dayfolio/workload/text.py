"""Normalisation, repetition, reuse and lint over documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfolio.functions import display as D, records as R, text as X
from dayfolio.operators import lint as L, repetition as RP
from dayfolio.operators.issues import Rule
from dayfolio.plans.audits import scan_secrets
from dayfolio.session import cut_lineage
from dayfolio.workload.derive import issue_rows
from dayfolio.workload.registry import query, spread, table

FOLD_SQL = r"trim(regexp_replace(lower(nfc_normalize({c})), '\s+', ' ', 'g'))"


@query("h1_normalize_prose", f"SELECT doc_id, sha256({FOLD_SQL.format(c='text')}) AS digest FROM documents")
def normalize_prose(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2(X.normalize_prose("text"), 256).alias("digest"))


@query("h2_author_key", r"SELECT c_custkey, 'customer ' || substr(c_name, 10) || ' uber' AS key FROM customer")
def author_key(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", X.author_key(F.concat("c_name", F.lit(" — Über!"))).alias("key"))


@query("h3_author_signature", "SELECT c_custkey, substr(c_name, 10) || '/ann/customer' AS signature, 'annécustomer' || substr(c_name, 10) AS compact FROM customer")
def author_signature(spark, folder):
    c = table(spark, folder, "customer")
    name = F.concat(F.lit("Ann, "), "c_name")
    return c.select("c_custkey", F.replace(X.author_signature(name), F.lit("\x00"), F.lit("/")).alias("signature"),
                    X.author_compact(F.concat(F.lit("Anné "), "c_name")).alias("compact"))


@query("h4_canonical_text", r"SELECT doc_id, CASE WHEN length(t) <= 3000 AND t <> '' THEN sha256(t) END AS digest FROM (SELECT doc_id, trim(regexp_replace(nfc_normalize(text), '\s+', ' ', 'g')) AS t FROM documents)")
def canonical_text(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2(X.canonical_text("text", 3000), 256).alias("digest"))


@query("h5_mask_math", r"""SELECT p_partkey, 'see   and   and   with   end ' || p_brand AS masked FROM part""")
def mask_math(spark, folder):
    text = F.concat(F.lit("see $x_"), F.col("p_size").cast("string"), F.lit("$ and \\(a+b\\) and \\alpha with some_name_1 end "), F.col("p_brand"))
    return table(spark, folder, "part").select("p_partkey", X.mask_math(text).alias("masked"))


@query("h6_compare_text", r"SELECT doc_id, sha256(regexp_replace(lower(nfc_normalize(text)), '[^\p{L}\p{N}]+', '', 'g')) AS digest FROM documents")
def compare_text(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2(X.compare_text("text"), 256).alias("digest"))


@query("h7_char_ngrams", """SELECT item_id, gram, count(*) AS n FROM (SELECT item_id, unnest(list_transform(generate_series(1, length(text) - 2), lambda i: text[i:i + 2])) AS gram FROM benchmark) GROUP BY ALL""")
def char_ngrams(spark, folder):
    return RP.gram_counts(table(spark, folder, "benchmark"), "item_id", F.col("text"), 3)


@query("h8_count_script", r"SELECT doc_id, len(regexp_extract_all(text, '\p{Latin}'))::BIGINT AS latin, len(regexp_extract_all(text, '[.,;!?]'))::BIGINT AS marks, len(regexp_extract_all(text, '\p{Han}'))::BIGINT AS han FROM documents")
def count_script(spark, folder):
    d = table(spark, folder, "documents")
    return d.select("doc_id", *[X.count_script("text", c).cast("bigint").alias(n) for n, c in (("latin", "\\p{IsLatin}"), ("marks", "[.,;!?]"), ("han", "\\p{IsHan}"))])


SHORT_WORD = "[a-zà-ÿ]{4,}"
# Formulas, commands and snake_case names become spaces. SQL has no look-around, so a name is found with its two neighbours, and
# twice over, as neighbouring names share one.
NAME_PATTERN = r"(^|[^\p{Latin}\p{N}])[A-Za-z][A-Za-z0-9]*(?:_[A-Za-z0-9]+)+($|[^\p{Latin}\p{N}])"


def mask_sql(text: str) -> str:
    for pattern in (r"\$[^$]*\$", r"(?s)\\\(.*?\\\)", r"(?s)\\\[.*?\\\]", r"\\[A-Za-z]+"):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    for _ in range(2):
        text = rf"regexp_replace({text}, '{NAME_PATTERN}', '\1 \2', 'g')"
    return text


@query("h9_skeleton", rf"""SELECT conv_id, turn, regexp_replace(regexp_replace(trim(regexp_replace(lower({mask_sql('nfc_normalize(text)')}), '\s+', ' ', 'g')), '[a-zà-ÿ]{{4,}}', '◇', 'g'), '\s+', '', 'g') AS frame FROM conversations""")
def skeleton(spark, folder):
    c = table(spark, folder, "conversations")
    frame = F.regexp_replace(F.regexp_replace(X.squeeze_space(F.lower(X.mask_math(X.nfkc(F.col("text"))))), SHORT_WORD, X.SLOT), f"{X.SPACE}+", "")
    return c.select("conv_id", "turn", frame.alias("frame"))


@query("h23_display_title", "SELECT p_partkey, 'On ' || p_name || ' with α₂³ and SU(' || p_size || ') × U(1) – test' AS title FROM part")
def display_title(spark, folder):
    raw = F.concat(F.lit("On "), "p_name", F.lit(" with $\\alpha_2^3$ and $SU("), F.col("p_size").cast("string"), F.lit(") \\times U(1)$ -- test"))
    return spread(table(spark, folder, "part"), "p_partkey").select("p_partkey", D.display_title(raw).alias("title"))


@query("h24_display_assessment", "SELECT p_partkey, p_name || 'に波及する。' || p_type || 'を前進させる。' AS shown FROM part")
def display_assessment(spark, folder):
    raw = F.concat(F.lit("総合"), F.col("p_size").cast("string"), F.lit("/100。物理全体22/25："), "p_name", F.lit("に波及する。gr-qc内24点："), "p_type", F.lit("を前進させる。"))
    return table(spark, folder, "part").select("p_partkey", D.display_assessment(raw).alias("shown"))


@query("h29_paths", """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_brand || '/main.tex' WHEN 1 THEN NULL WHEN 2 THEN 'a/' || p_brand || '.bib' WHEN 3 THEN NULL ELSE p_brand || '/README' END AS path,
  CASE p_partkey % 5 WHEN 0 THEN 'text' WHEN 2 THEN 'optional' WHEN 4 THEN 'bare' WHEN 1 THEN 'text' ELSE 'other' END AS kind FROM part""")
def paths(spark, folder):
    k = F.col("p_partkey") % 5
    raw = (F.when(k == 0, F.concat(F.lit("./"), "p_brand", F.lit("/x/../main.tex"))).when(k == 1, F.concat(F.lit("../"), "p_brand", F.lit(".tex")))
           .when(k == 2, F.concat(F.lit("a//"), "p_brand", F.lit(".bib"))).when(k == 3, F.concat(F.lit("/"), "p_brand", F.lit(".png"))).otherwise(F.concat("p_brand", F.lit("/README"))))
    return table(spark, folder, "part").select("p_partkey", R.safe_path(raw).alias("path"), R.text_kind(raw).alias("kind"))


@query("h30_source_text", r"SELECT doc_id, doc_id % 3 = 0 AS tex, CASE WHEN doc_id % 4 = 1 THEN NULL ELSE sha256('“' || text || '”') END AS digest FROM documents")
def source_text(spark, folder):
    d = table(spark, folder, "documents")
    raw = F.concat(F.lit("\u0093"), "text", F.lit("\u0094"), F.when(F.col("doc_id") % 4 == 1, F.lit("\u009b")).otherwise(""))
    tex = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("\\documentclass{a} "), "text")).otherwise(F.col("text"))
    return d.select("doc_id", R.is_tex(tex).alias("tex"), F.sha2(R.clean_source(raw), 256).alias("digest"))


# Repetition ---------------------------------------------------------------------------------------------

FOLDED = FOLD_SQL.format(c="text")
EXACT_SQL = f"""f AS (SELECT doc_id, source, sha256({FOLDED}) AS signature FROM documents), s AS (SELECT source, count(*) AS papers FROM documents GROUP BY 1),
  g AS (SELECT source, signature, count(*) AS matches, min(doc_id) AS first_position FROM f GROUP BY 1, 2)"""


@query("a10_prose_repeats", f"WITH {EXACT_SQL} SELECT source, signature, matches, papers, first_position FROM g JOIN s USING (source) WHERE matches >= 2 AND matches / papers::DOUBLE > 0.01")
def prose_repeats(spark, folder):
    d = table(spark, folder, "documents")
    found = RP.prose_repeats(d, X.normalize_prose("text"), ["source"], "doc_id", matches=2, ratio=0.01)
    return found.select("source", "signature", "matches", "papers", "first_position")


@query("a10_affected_rows", f"WITH {EXACT_SQL} SELECT doc_id, source FROM f JOIN (SELECT source, signature FROM g JOIN s USING (source) WHERE matches >= 2 AND matches / papers::DOUBLE > 0.01) USING (source, signature)")
def affected_rows(spark, folder):
    d = table(spark, folder, "documents")
    # Counted, measured and joined: the texts are read for it once.
    signed = cut_lineage(RP.prose_signatures(d, X.normalize_prose("text"), ["source"], "doc_id"))
    found = RP.repeated_signatures(signed, ["source"], "doc_id", matches=2, ratio=0.01)
    return RP.affected_rows(signed, found, ["source"]).select("doc_id", "source")


LATIN_STRUCTURE = {"sample": 16, "ratio": 0.02, "long": 20, "long_left": 10, "long_hiragana": 6, "short": 12, "short_left": 6, "short_hiragana": 4, "gap": 4}


@query("a11_skeleton_repeats", r"""WITH t AS (SELECT doc_id, source, string_split(regexp_replace(trim(regexp_replace(lower(nfc_normalize(text)), '\s+', ' ', 'g')), '\s+', '', 'g'), '') AS c FROM documents),
  m AS (SELECT doc_id, source, c, len(c) AS n, i FROM t, unnest(generate_series(1, len(c))) AS u(i) WHERE c[i] IN ('.', ',', ';', '!', '?', ':')),
  w AS (SELECT doc_id, source, i, n, array_to_string(c[greatest(0, least(i - 1 - 10, n - 20)) + 1 : greatest(0, least(i - 1 - 10, n - 20)) + 20], '') AS l,
        array_to_string(c[greatest(0, least(i - 1 - 6, n - 12)) + 1 : greatest(0, least(i - 1 - 6, n - 12)) + 12], '') AS s FROM m),
  k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM w WHERE n >= 12 AND len(regexp_extract_all(s, '\p{Latin}')) >= 4),
  sig AS (SELECT DISTINCT doc_id, source, 'long' || chr(1) || l AS signature FROM w WHERE n >= 20 AND len(regexp_extract_all(l, '\p{Latin}')) >= 6
    UNION SELECT DISTINCT a.doc_id, a.source, 'pair' || chr(1) || a.s || chr(1) || b.s FROM k a JOIN k b ON a.doc_id = b.doc_id AND b.p BETWEEN a.p + 1 AND a.p + 4),
  z AS (SELECT source, count(*) AS papers FROM documents GROUP BY 1), g AS (SELECT source, signature, count(*) AS matches, min(doc_id) AS first_position FROM sig GROUP BY 1, 2)
  SELECT source, signature, matches, papers, first_position FROM g JOIN z USING (source) WHERE papers >= 16 AND matches / papers::DOUBLE > 0.02""")
def skeleton_repeats(spark, folder):
    d = table(spark, folder, "documents")
    found = RP.skeleton_repeats(d, X.normalize_prose("text"), ["source"], "doc_id", structure=LATIN_STRUCTURE, marks="[.,;!?:]", letter="[A-Za-zªºÀ-ÖØ-öø-ʸ]")
    return found.select("source", F.translate("signature", "\x00", "\x01").alias("signature"), "matches", "papers", "first_position")


LATIN_TEMPLATE = {"sample": 8, "reviewed_sample": 8, "ratio": 0.005, "characters": 16, "hiragana": 8, "slots": 3, "punctuation": 2,
                  "short_characters": 7, "short_hiragana": 3, "short_slots": 2, "short_punctuation": 2, "short_matches": 2, "short_ratio": 0.004}


@query("a12_template_repeats", rf"""WITH n AS (SELECT doc_id, source, nfc_normalize(text) AS t FROM documents),
  f AS (SELECT doc_id, source, t, regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(lower({mask_sql('t')}), '\s+', ' ', 'g')), '[a-zà-ÿ]{{4,}}', '◇', 'g'), '◇+', '◇', 'g'), '\s+', '', 'g') AS s FROM n),
  m AS (SELECT *, length(s) AS size, len(regexp_extract_all(s, '\p{{Latin}}')) AS letters, len(regexp_extract_all(s, '[.,;!?:]')) AS stops, len(regexp_extract_all(s, '◇')) AS slots FROM f),
  j AS (SELECT *, size >= 16 AND letters >= 8 AND stops >= 2 AND slots >= 3 AS l, size >= 7 AND letters >= 3 AND stops >= 2 AND slots >= 2 AS h FROM m),
  g0 AS (SELECT doc_id, source, CASE WHEN contains(t, 'the the') THEN 'marker|the the' WHEN contains(t, ' of ') AND (l OR h) THEN 'marker-skeleton| of |' || regexp_replace(s, '\p{{N}}+([.,]\p{{N}}+)?', '#', 'g') WHEN NOT contains(t, ' of ') AND (l OR h) THEN s END AS signature,
    CASE WHEN contains(t, 'the the') THEN true WHEN contains(t, ' of ') THEN false ELSE l END AS is_long FROM j),
  z AS (SELECT source, count(*) AS papers FROM n GROUP BY 1),
  g AS (SELECT source, signature, count(*) AS matches, min(doc_id) AS first_position, bool_or(is_long) AS is_long FROM g0 WHERE signature IS NOT NULL GROUP BY 1, 2)
  SELECT source, sha256(signature) AS signature, matches, papers, first_position, is_long FROM g JOIN z USING (source)
  WHERE papers >= 8 AND CASE WHEN is_long THEN matches / papers::DOUBLE > 0.005 ELSE matches >= 2 AND matches / papers::DOUBLE > 0.004 END""")
def template_repeats(spark, folder):
    return _template_repeats(table(spark, folder, "documents"))


def _template_repeats(d):
    found = RP.template_repeats(d, X.nfkc(F.col("text")), ["source"], "doc_id", sample=8, short_matches=2, template=LATIN_TEMPLATE,
                                markers=(("the the", True), (" of ", False)), letter="\\p{IsLatin}", marks="[.,;!?:]", content=SHORT_WORD)
    return found.select("source", F.sha2(F.translate("signature", "\x00", "|"), 256).alias("signature"), "matches", "papers", "first_position", "is_long")


CONTAINED_SQL = f"""b AS (SELECT item_id, {FOLD_SQL.format(c='text')} AS p FROM benchmark), d AS (SELECT doc_id, {FOLDED} AS t FROM documents),
  held AS (SELECT item_id, doc_id FROM d JOIN b ON p <> '' AND contains(t, p))"""


@query("j18_verbatim_reuse_whole", f"WITH {CONTAINED_SQL} SELECT item_id, doc_id FROM held")
def verbatim_reuse_whole(spark, folder):
    """Every document against every passage."""
    return RP.contained_passages(table(spark, folder, "benchmark"), table(spark, folder, "documents"), "item_id", "doc_id",
                                 X.normalize_prose("text"), X.normalize_prose("text"))


@query("j18_verbatim_reuse", f"""WITH {CONTAINED_SQL}, k AS (SELECT doc_id, count(*) AS passages FROM held GROUP BY 1)
  SELECT doc_id AS position, coalesce(passages, 0) AS passages FROM documents LEFT JOIN k USING (doc_id)""")
def verbatim_reuse(spark, folder):
    """How many of all passages each document holds word for word."""
    counts = verbatim_reuse_whole(spark, folder).groupBy("doc_id").agg(F.count(F.lit(1)).alias("passages"))
    return table(spark, folder, "documents").select("doc_id").join(counts, "doc_id", "left").select(
        F.col("doc_id").alias("position"), F.coalesce("passages", F.lit(0)).cast("bigint").alias("passages"))


@query("j18_row_verbatim_reuse", f"""WITH n AS (SELECT conv_id, turn, {FOLDED} AS t, {FOLD_SQL.format(c="lag(text) OVER (PARTITION BY conv_id ORDER BY turn)")} AS p,
    {FOLD_SQL.format(c="substr(text, 11, 60)")} AS s FROM conversations)
  SELECT conv_id || '/' || turn AS id, 't' AS path FROM n WHERE contains(t, p) UNION ALL SELECT conv_id || '/' || turn, 's' FROM n WHERE contains(t, s)""")
def row_verbatim_reuse(spark, folder):
    """Turns that repeat the turn before them, and the middle of a turn, which each turn holds unless folding parts it."""
    from pyspark.sql import Window

    c = table(spark, folder, "conversations")
    # A conversation's turns are few; the window only looks one turn back.
    c = c.withColumn("before", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn")))
    folded = c.select("conv_id", "turn", X.nfkc_list(F.array("text", "before", F.substring("text", 11, 60))).alias("n"))
    texts = folded.select(F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("key"), *[X.fold_prose(F.get("n", F.lit(i))).alias(k) for i, k in enumerate("tps")])
    found = RP.verbatim_reuse(texts, [("t", F.col("t"), "p", F.col("p")), ("s", F.col("t"), "s", F.col("s"))], {"id": "key"})
    return issue_rows(found, "id", "path")


COMPARE_SQL = r"regexp_replace(lower(nfc_normalize({c})), '[^\p{{L}}\p{{N}}]+', '', 'g')"
GRAMS_SQL = "unnest(list_transform(generate_series(1, length(t) - {k}), lambda i: t[i:i + {k}]))"


@query("j19_shingle_coverage", f"""WITH b AS (SELECT item_id, {COMPARE_SQL.format(c='text')} AS t FROM benchmark), d AS (SELECT doc_id, {COMPARE_SQL.format(c='text')} AS t FROM documents),
  bg AS (SELECT item_id, gram, count(*) AS n FROM (SELECT item_id, {GRAMS_SQL.format(k=11)} AS gram FROM b WHERE length(t) >= 24) GROUP BY ALL),
  dg AS (SELECT doc_id, gram, count(*) AS n FROM (SELECT doc_id, {GRAMS_SQL.format(k=11)} AS gram FROM d) WHERE gram IN (SELECT gram FROM bg) GROUP BY ALL),
  s AS (SELECT item_id, sum(n)::BIGINT AS total FROM bg GROUP BY 1), o AS (SELECT item_id, doc_id, sum(least(bg.n, dg.n))::BIGINT AS overlap FROM bg JOIN dg USING (gram) GROUP BY 1, 2)
  SELECT item_id, doc_id, overlap, total FROM o JOIN s USING (item_id) WHERE overlap / total::DOUBLE >= 0.6""")
def shingle_coverage(spark, folder):
    found = RP.shingle_coverage(table(spark, folder, "benchmark"), table(spark, folder, "documents"), "item_id", "doc_id",
                                X.compare_text("text"), X.compare_text("text"), size=12, threshold=0.6)
    return found.select("item_id", "doc_id", F.col("overlap").cast("bigint").alias("overlap"), F.col("total").cast("bigint").alias("total"))


@query("j19_row_trigram_reuse", f"""WITH c AS (SELECT conv_id, turn, {COMPARE_SQL.format(c='text')} AS a, {COMPARE_SQL.format(c='substr(text, 31)')} AS b FROM conversations),
  ag AS (SELECT conv_id, turn, gram, count(*) AS n FROM (SELECT conv_id, turn, unnest(list_transform(generate_series(1, length(a) - 2), lambda i: a[i:i + 2])) AS gram FROM c WHERE length(a) >= 24) GROUP BY ALL),
  bg AS (SELECT conv_id, turn, gram, count(*) AS n FROM (SELECT conv_id, turn, unnest(list_transform(generate_series(1, length(b) - 2), lambda i: b[i:i + 2])) AS gram FROM c) GROUP BY ALL),
  s AS (SELECT conv_id, turn, sum(n)::BIGINT AS total FROM ag GROUP BY 1, 2), o AS (SELECT conv_id, turn, sum(least(ag.n, bg.n))::BIGINT AS overlap FROM ag JOIN bg USING (conv_id, turn, gram) GROUP BY 1, 2)
  SELECT conv_id, turn, round(CASE WHEN total IS NULL THEN 0 ELSE coalesce(overlap, 0) / total::DOUBLE END, 6) AS coverage FROM c LEFT JOIN s USING (conv_id, turn) LEFT JOIN o USING (conv_id, turn)""")
def row_trigram_reuse(spark, folder):
    c = table(spark, folder, "conversations")
    n = c.select("conv_id", "turn", X.nfkc_list(F.array("text", F.expr("substring(text, 31)"))).alias("n"))
    side = lambda i: X.fold_compare(F.get("n", F.lit(i)))
    return n.select("conv_id", "turn", F.round(RP.reuse_coverage(side(0), side(1)), 6).alias("coverage"))


# Lint with Latin settings -----------------------------------------------------------------------------------

KEYS = {"position": "doc_id"}
TEXT = F.col


def lint(spark, folder, *rules, documents=None):
    return issue_rows(L.lint_table(table(spark, folder, "documents") if documents is None else documents, "text", rules, KEYS), "position", "fragment")


#: What every sixteenth document ends with, by the remainder of its id; the table itself has next to none of it.
PLANTED = (
    ' See "alpha" and (beta), not "the".', " with two  spaces , and so on", " for a total : 95 / 100", " AKIA" + "Q" * 16, " sk-" + "q" * 20, " ghp_" + "q" * 20, " -----BEGIN RSA PRIVATE KEY-----",
    " Authorization: Bearer " + "q" * 20, " api_key = '" + "q" * 16, " https://me:word@host/", " AKIA" + "q" * 16, " sk-short", " password: changeme-or-do-not", " the key of a token")
PLANTED_SQL = "(SELECT doc_id, text || CASE doc_id % 16 " + " ".join(f"WHEN {i} THEN '{p.replace(chr(39), chr(39) * 2)}'" for i, p in enumerate(PLANTED)) + " ELSE '' END AS text FROM documents)"


def planted(spark, folder):
    parts = F.get(F.array(*[F.lit(p) for p in PLANTED]), (F.col("doc_id") % 16).cast("int"))
    return table(spark, folder, "documents").withColumn("text", F.concat("text", F.coalesce(parts, F.lit(""))))


@query("q1_min_script_chars", r"SELECT doc_id AS position, len(regexp_extract_all(text, '\p{Latin}'))::VARCHAR AS fragment FROM documents WHERE len(regexp_extract_all(text, '\p{Latin}')) < 400")
def min_script_chars(spark, folder):
    return lint(spark, folder, L.minimum_rule("text", TEXT("text"), "\\p{IsLatin}", F.lit(400)))


@query("q2_term_list", r"SELECT doc_id AS position, regexp_extract(text, '(?i)\b(?:token|password|license|copyright)\b') AS fragment FROM documents WHERE regexp_matches(text, '(?i)\b(?:token|password|license|copyright)\b')")
def term_list(spark, folder):
    return lint(spark, folder, L.pattern_rule("text", "terms", TEXT("text"), "(?i)\\b(?:token|password|license|copyright)\\b", "must not use the term"))


@query("q3_allowed_tokens", r"""SELECT doc_id AS position, list_filter(regexp_extract_all(text, '\(([a-z]{2,})\)|"([a-z]{3,})"'), lambda x: x NOT IN ('"the"', '"and"'))[1] AS fragment FROM %PLANTED% WHERE len(list_filter(regexp_extract_all(text, '\(([a-z]{2,})\)|"([a-z]{3,})"'), lambda x: x NOT IN ('"the"', '"and"'))) > 0""".replace("%PLANTED%", PLANTED_SQL))
def allowed_tokens(spark, folder):
    return lint(spark, folder, L.allowed_rule("text", "tokens", TEXT("text"), "(\\([a-z]{2,}\\)|\"[a-z]{3,}\")", ('"the"', '"and"'), "must not quote the token"), documents=planted(spark, folder))


@query("q4_boundary_space", r"SELECT doc_id AS position, regexp_extract(text, '[a-z]  +[a-z]| [,.;]') AS fragment FROM %PLANTED% WHERE regexp_matches(text, '[a-z]  +[a-z]| [,.;]')".replace("%PLANTED%", PLANTED_SQL))
def boundary_space(spark, folder):
    return lint(spark, folder, L.pattern_rule("text", "space", TEXT("text"), "[a-z]  +[a-z]| [,.;]", "must not insert spaces"), documents=planted(spark, folder))


PHRASES = ("that the", "of the", "der die", "que la")


@query("q5_phrase_list", "SELECT doc_id AS position, CASE WHEN contains(text, 'that the') THEN 'that the' WHEN contains(text, 'of the') THEN 'of the' WHEN contains(text, 'der die') THEN 'der die' WHEN contains(text, 'que la') THEN 'que la' END AS fragment FROM documents WHERE contains(text, 'that the') OR contains(text, 'of the') OR contains(text, 'der die') OR contains(text, 'que la')")
def phrase_list(spark, folder):
    return lint(spark, folder, L.phrase_rule("text", "phrases", TEXT("text"), PHRASES, "must replace the phrase"))


@query("q6_clause_end", r"SELECT doc_id AS position, regexp_extract(text, '\b(?:the|of|and|to)[.;!?]') AS fragment FROM documents WHERE regexp_matches(text, '\b(?:the|of|and|to)[.;!?]')")
def clause_end(spark, folder):
    return lint(spark, folder, L.pattern_rule("text", "clause", TEXT("text"), "\\b(?:the|of|and|to)[.;!?]", "must complete the clause"))


@query("q8_no_recap", r"SELECT doc_id AS position, regexp_extract(text, '(?i)total\s*:?\s*\d{1,3}\s*/\s*100') AS fragment FROM %PLANTED% WHERE regexp_matches(text, '(?i)total\s*:?\s*\d{1,3}\s*/\s*100')".replace("%PLANTED%", PLANTED_SQL))
def no_recap(spark, folder):
    return lint(spark, folder, L.pattern_rule("text", "recap", TEXT("text"), "(?i)total\\s*:?\\s*\\d{1,3}\\s*/\\s*100", "must not repeat the total"), documents=planted(spark, folder))


@query("q9_generic_phrases", f"SELECT doc_id AS position, CASE WHEN contains({FOLDED}, 'all rights reserved') THEN 'all rights reserved' ELSE 'the the' END AS fragment FROM documents WHERE contains({FOLDED}, 'all rights reserved') OR contains({FOLDED}, 'the the')")
def generic_phrases(spark, folder):
    d = table(spark, folder, "documents").withColumn("folded", X.normalize_prose("text"))
    rule = L.phrase_rule("text", "generic", F.col("folded"), ("all rights reserved", "the the"), "must not use the generic phrase")
    return issue_rows(L.lint_table(d, "text", [rule], KEYS), "position", "fragment")


@query("q11_distinct_reasons", f"SELECT conv_id::VARCHAR AS id FROM (SELECT conv_id, count(*) AS n, count(DISTINCT {FOLD_SQL.format(c='text')}) AS d FROM conversations GROUP BY 1) WHERE d < n OR conv_id % 4 = 0")
def distinct_reasons(spark, folder):
    c = table(spark, folder, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.col("text").alias("t")))).alias("r"))
    c = c.withColumn("r", F.when(F.col("conv_id") % 4 == 0, F.concat("r", F.slice("r", 1, 1))).otherwise(F.col("r")))  # some say their first text again
    listed = c.select("conv_id", X.nfkc_list(F.transform("r", lambda t: t["t"])).alias("n"))
    folded = F.transform("n", X.fold_prose)
    rule = Rule("text", "language", "must be distinct", F.size(F.array_distinct(folded)) == F.size(folded))
    return issue_rows(L.lint_table(listed, "text", [rule], {"id": "conv_id"}), "id")


SECRETS = (("private key", r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----"), ("access key", r"\bAKIA[0-9A-Z]{16}\b"),
           ("token", r"(?i)\b(?:token|secret)\s*[=:]\s*[\"']?[A-Za-z0-9._~+/-]{16,}"), ("url credentials", r"(?i)https?://[^\s/:]+:[^\s/@]+@"))


@query("a20_scan_secrets", "SELECT doc_id, rule FROM (" + " UNION ALL ".join(
    f"SELECT doc_id, '{n}' AS rule FROM documents WHERE regexp_matches(text, '{p.replace(chr(39), chr(39) * 2)}')" for n, p in SECRETS) + ")")
def secrets(spark, folder):
    return scan_secrets(table(spark, folder, "documents"), "text", ["doc_id"], SECRETS)


@query("a20_default_rules", r"""WITH planted AS %PLANTED% SELECT doc_id, 'url credentials' AS rule FROM planted WHERE regexp_matches(text, '(?i)https?://[^\s/:]+:[^\s/@]+@') UNION ALL SELECT doc_id, 'access key' FROM planted WHERE regexp_matches(text, '\bAKIA[0-9A-Z]{16}\b')
  UNION ALL SELECT doc_id, 'private key' FROM planted WHERE regexp_matches(text, '-----BEGIN (RSA |EC |OPENSSH )?PRIVATE KEY-----') UNION ALL SELECT doc_id, 'sk token' FROM planted WHERE regexp_matches(text, '\bsk-[A-Za-z0-9_-]{20,}\b')
  UNION ALL SELECT doc_id, 'gh token' FROM planted WHERE regexp_matches(text, '\bgh[pousr]_[A-Za-z0-9]{20,}\b') UNION ALL SELECT doc_id, 'bearer' FROM planted WHERE regexp_matches(text, '(?i)\bAuthorization\s*:\s*Bearer\s+[A-Za-z0-9._~+/-]{20,}')
  UNION ALL SELECT doc_id, 'assignment' FROM planted WHERE regexp_matches(text, '(?i)\b(api[_-]?key|access[_-]?token|client[_-]?secret|password)\s*[=:]\s*["'']?[A-Za-z0-9._~+/-]{16,}') AND NOT regexp_matches(text, '(?i)password: changeme')""".replace("%PLANTED%", PLANTED_SQL))
def default_secret_rules(spark, folder):
    return scan_secrets(planted(spark, folder), "text", ["doc_id"])
