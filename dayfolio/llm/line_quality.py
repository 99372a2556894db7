"""Line-first cleaning: rules judge lines, then the loss judges the document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfolio.llm.common import WHITE, WORD, let, text_of

SYMBOLS = "#*$%&|<>"
#: Ends of a sentence, also before a closing quote or bracket.
SENTENCE_END = r"[.!?…:;。！？][\"'”’»)\]]*\s*$"
SEPARATORS = "|»›•·"
BOILERPLATE = (
    r"(?i)\b(cookies?|javascript|lorem ipsum|privacy policy|terms of (use|service)|all rights reserved|"
    r"click here|sign (in|up)|log in|subscribe|newsletter|skip to content|read more)\b"
)


def _chars_without(text: Column, dropped: str) -> Column:
    return F.length(F.translate(text, dropped, ""))


def repeated_words(hashes: Column, window: int = 5) -> Column:
    """How many words lie in windows of five words that the text has twice or more.

    Windows are compared by 64-bit hash. A text whose windows all differ, the
    usual case, is done after one pass over a hash set; else positions are
    sorted by window. Work and memory grow with the text's length, not its square.
    """
    def covered(positions: Column) -> Column:
        gaps = F.transform(positions, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(positions, i + 1) - p, F.lit(window))))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    def repeats(entries: Column) -> Column:
        same = F.transform(entries, lambda e, i: F.when(
            (F.get(entries, i + 1)["h"] == e["h"]) | (F.when(i > 0, F.get(entries, i - 1)["h"]) == e["h"]), e["p"]))
        return let(F.sort_array(F.filter(same, lambda p: p.isNotNull())), covered)

    def judged(found: Column) -> Column:
        entries = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(let(entries, repeats))

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - window)
        return let(F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])), judged)

    return let(hashes, lambda h: F.when(F.size(h) > window, windows(h)).otherwise(F.lit(0))).cast("long")


def line_fails(line: Column, short_words: int = 5) -> Column:
    """Whether a line is navigation, boilerplate, symbols, shouting or a loose scrap.

    - symbols or navigation: a symbol or separator for every third word;
    - shouting: a double exclamation mark for every second word;
    - boilerplate: a phrase of web pages that belongs to no article;
    - punctuation: fewer than ``short_words`` words without an end of sentence.

    A line without words never fails.
    """
    def judged(n: Column) -> Column:
        marks = F.length(line) - _chars_without(line, SYMBOLS + SEPARATORS)
        shouts = (F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
        return F.when(n == 0, F.lit(False)).otherwise(
            ((n >= 2) & (3 * marks >= n)) | ((n >= 2) & (2 * shouts >= n)) | line.rlike(BOILERPLATE)
            | ((n < short_words) & ~line.rlike(SENTENCE_END)))

    return let(F.regexp_count(line, F.lit(WORD)), judged)


def assess_quality(docs: DataFrame, text_col: str = "text", min_words: int = 10, max_repeat_percent: int = 20,
                   max_lost_percent: int = 50, short_words: int = 5, prefix: str = "") -> DataFrame:
    """Adds counts, the cleaned text and the verdict to each document.

    New columns, each named with ``prefix`` before it and replacing a column of
    that name: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_lines, n_failed_lines, clean_text, kept. Lines are parts
    between line feeds; those that fail a rule go from clean_text. A document
    is kept if the base rules hold (enough words, few repeated windows) and
    failing lines hold at most ``max_lost_percent`` of its word characters.

    A null or empty text has no words, zero counts, an empty clean text and is
    not kept. Row-wise: repeated rows, long texts and empty tables need nothing
    special.
    """
    text = text_of(text_col)
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    lines = F.split(text, "\n", -1)
    counted = let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        repeated_words(F.transform(w, lambda x: F.xxhash64(x))).alias("n_repeat_words")))
    with_words = F.filter(lines, lambda x: _chars_without(x, WHITE) > 0)
    weight = lambda some: F.aggregate(some, F.lit(0), lambda a, x: a + _chars_without(x, WHITE))
    judged = let(lines, lambda all_lines: let(F.filter(all_lines, lambda x: line_fails(x, short_words)), lambda bad: F.struct(
        F.size(all_lines).cast("long").alias("n_lines"), F.size(bad).cast("long").alias("n_failed_lines"), weight(bad).cast("long").alias("lost_chars"))))
    temp = "__quality_counts", "__quality_lines"
    p = lambda name: prefix + name
    out = docs.withColumns({
        temp[0]: counted, temp[1]: judged,
        p("word_chars"): _chars_without(text, WHITE).cast("long"),
        p("n_symbols"): (F.length(text) - _chars_without(text, SYMBOLS)).cast("long"),
        p("n_dup_lines"): let(with_words, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        p("clean_text"): F.array_join(F.filter(lines, lambda x: ~line_fails(x, short_words)), "\n"),
    })
    out = out.withColumns({
        p("n_words"): F.col(f"{temp[0]}.n_words"), p("n_repeat_words"): F.col(f"{temp[0]}.n_repeat_words"),
        p("n_lines"): F.col(f"{temp[1]}.n_lines"), p("n_failed_lines"): F.col(f"{temp[1]}.n_failed_lines"),
        p("lost_chars"): F.col(f"{temp[1]}.lost_chars"),
    }).drop(*temp)
    failed = (F.col(p("n_words")) < min_words) | (100 * F.col(p("n_repeat_words")) > max_repeat_percent * F.col(p("n_words")))
    return out.withColumn(p("base_failed"), failed).withColumn(
        p("kept"), ~F.col(p("base_failed")) & (100 * F.col(p("lost_chars")) <= max_lost_percent * F.col(p("word_chars"))))
