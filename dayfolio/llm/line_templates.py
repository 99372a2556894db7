"""Line dedup by a tree of log templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfolio.llm.common import let, small_enough, staged, text_of

_NOT_WHITE = r"[^\x20\x09-\x0D]"
#: A token with a digit. It is only tried at a token's start and never backtracks, so long tokens cost their length.
VARIABLE = rf"(?<!{_NOT_WHITE})[^\x20\x09-\x0D0-9]*+[0-9]{_NOT_WHITE}*+"
MASK = "<*>"
#: Lines that make up more than one part in so many of all are joined by broadcast; there can't be more of them than that.
HOT_PARTS = 1000


def line_rows(docs: DataFrame, depth: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, pos, n, leaf, full, line) of each line with a token, of documents with an id.

    Runs of white space become one space and tokens with a digit one mask; n is
    the number of tokens. The leaf is n and the leading tokens, full is the
    whole line, both hashed.
    """
    text = text_of(text_col)
    masked = F.when(text.rlike("[0-9]"), F.regexp_replace(text, VARIABLE, MASK)).otherwise(text)
    whole = F.col("_masked")
    odd = whole.startswith(" ") | whole.endswith(" ")
    for white in ("  ", " \n", "\n ", "\t", "\x0b", "\x0c", "\r"):
        odd = odd | whole.contains(white)
    spaced = F.regexp_replace(whole, r"[\x20\x09\x0B-\x0D]+", " ")
    plain = F.when(odd, F.trim(F.replace(F.replace(spaced, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n")))).otherwise(whole)
    known = docs.filter(F.col(id_col).isNotNull())
    rows = known.select(F.col(id_col).alias("doc"), masked.alias("_masked")).select("doc", F.posexplode(F.split(plain, "\n", -1)).alias("pos", "line"))
    rows = rows.filter("line <> ''").withColumn("n", F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1)
    return rows.select("doc", "pos", "n", F.xxhash64("n", F.substring_index("line", " ", depth)).alias("leaf"), F.xxhash64("line").alias("full"), "line")


def _alike(a: Column, b: Column, n: Column, percent: int) -> Column:
    """At least ``percent`` of the tokens of two lines with n tokens agree, place by place."""
    same = F.filter(F.zip_with(F.split(a, " "), F.split(b, " "), lambda x, y: x == y), lambda agrees: agrees)
    return 100 * F.size(same) >= percent * n


def _segments(line: Column, n: Column, depth: int, percent: int) -> Column:
    """Hashes of parts of the tokens behind the leading ones, one more than there may be tokens that differ.

    Of two alike lines of a leaf at least one part agrees in full.
    """
    differ = F.floor(n * (100 - percent) / 100).cast("int")
    cut = lambda j: F.floor((n - depth) * j / (differ + 1)).cast("int")
    return let(F.split(line, " "), lambda tokens: F.transform(F.sequence(F.lit(0), differ), lambda j: F.xxhash64(
        "leaf", j, F.array_join(F.slice(tokens, cut(j) + depth + 1, cut(j + 1) - cut(j)), " "))))


def variants(docs: DataFrame, fulls: DataFrame, depth: int, percent: int, min_words: int, hubs: int, id_col: str, text_col: str) -> DataFrame:
    """(leaf, full) of the lines for which an earlier document has another line of the same template.

    Only leaves that hold several lines of several documents are looked at; of
    these the tokens are read again. Each line is compared with the leaf's
    earliest one first: in a leaf with one template that settles all. What is
    left is compared with those lines of the leaf that share a segment: with
    the ``hubs`` earliest ones of the segment, then, where a segment has more,
    with its other lines inside one join, which stops at the first alike.
    """
    wide = fulls.filter((F.col("n") >= min_words) & (F.col("n") > depth))
    families = wide.groupBy("leaf").agg(F.min("full").alias("_a"), F.max("full").alias("_b"), F.min("lo").alias("_lo"), F.max("lo").alias("_hi"))
    families = families.filter("_a <> _b and _lo < _hi").select("leaf")
    asked = wide.join(families, "leaf").select("leaf", "full", F.col("lo").alias("doc"), "lo")
    read = line_rows(docs, depth, id_col, text_col).join(small_enough(asked, F.lit(24)), ["leaf", "full", "doc"])
    members, _ = staged(read.groupBy("leaf", "full").agg(F.first("lo").alias("lo"), F.first("n").alias("n"), F.first("line").alias("line")))
    like = lambda own, other: _alike(F.col(own), F.col(other), F.col("n"), percent)

    earliest = members.groupBy("leaf").agg(F.min(F.struct("lo", "full", "line")).alias("_first"))
    beside = members.join(earliest, "leaf").filter(F.col("full") != F.col("_first.full"))
    judged = beside.select("leaf", "full", ((F.col("_first.lo") < F.col("lo")) & like("line", "_first.line")).alias("_found"))
    judged, _ = staged(judged)
    open_ = judged.filter(~F.col("_found")).select("leaf", "full")
    members = members.join(open_.select("leaf").distinct(), "leaf", "left_semi").join(open_.withColumn("_open", F.lit(True)), ["leaf", "full"], "left")

    keys = members.select("leaf", "full", "lo", F.coalesce("_open", F.lit(False)).alias("open"), F.explode(F.array_distinct(_segments(F.col("line"), F.col("n"), depth, percent))).alias("key"))
    several = keys.groupBy("key").agg(F.min("lo").alias("_lo"), F.max("lo").alias("_hi"), F.count("*").alias("size"), F.max("open").alias("_any")).filter("_lo < _hi and _any").select("key", "size")
    keys, _ = staged(keys.join(several, "key"))
    text = members.select("leaf", "full", "n", "line")
    place = Window.partitionBy("key").orderBy("lo", "full")
    first = keys.withColumn("_place", F.row_number().over(place)).filter(F.col("_place") <= hubs).select("key", F.col("full").alias("_full"), F.col("lo").alias("_lo"))
    pairs = keys.filter("open").join(first, "key").filter("_lo < lo").select("leaf", "full", "_full").distinct()
    other = text.select("leaf", F.col("full").alias("_full"), F.col("line").alias("_line"))
    found, _ = staged(pairs.join(text, ["leaf", "full"]).join(other, ["leaf", "_full"]).filter(like("line", "_line")).select("leaf", "full").distinct())

    large = keys.filter(F.col("size") > hubs)
    left, _ = staged(large.filter("open").join(found, ["leaf", "full"], "left_anti"))
    rest = large.join(left.select("key").distinct(), "key", "left_semi").join(text, ["leaf", "full"])  # lines go with their text only where some line is left
    rest = rest.select(F.col("key").alias("_key"), F.col("lo").alias("_lo"), F.col("line").alias("_line"))
    alike = (F.col("key") == F.col("_key")) & (F.col("_lo") < F.col("lo")) & like("line", "_line")
    late = left.join(text, ["leaf", "full"]).join(rest, alike, "left_semi").select("leaf", "full")
    return judged.filter("_found").select("leaf", "full").unionByName(found).unionByName(late).distinct()


def recurring_lines(docs: DataFrame, depth: int = 4, percent: int = 75, min_words: int = 5, short_documents: int = 5, hubs: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, pos) of the lines to drop.

    A line goes down the tree by its token count and its ``depth`` leading
    tokens to a leaf. Lines of a leaf belong to one template if ``percent`` of
    their tokens agree, place by place; the others are its variable fields. A
    leaf holds as many templates as its lines make. A line goes if a document
    with a smaller id has a line of its template, so each template stays where
    it is first. A line of fewer than ``min_words`` words is a template by
    itself, and recurs if ``short_documents`` documents have it: ordinary short
    sentences come twice.

    Counts are combined before they move, and lines move as 64-bit keys, not as
    text; a line that makes up a thousandth of all or more is looked up without
    a shuffle, in a table of at most a thousand.
    """
    lines, _ = staged(line_rows(docs, depth, id_col, text_col).drop("line"))
    fulls, _ = staged(lines.groupBy("leaf", "full").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.first("n").alias("n"), F.count("*").alias("times")))
    short = lines.filter(F.col("n") < min_words).select("leaf", "full", "doc").distinct().groupBy("leaf", "full").agg(F.count("*").alias("_k"))
    often = short.filter(F.col("_k") >= short_documents).select("leaf", "full", F.lit(True).alias("_often"))
    alike = variants(docs, fulls, depth, percent, min_words, hubs, id_col, text_col).withColumn("_variant", F.lit(True))
    judged = fulls.join(often, ["leaf", "full"], "left").join(alike, ["leaf", "full"], "left")
    judged = judged.filter(F.col("_variant") | ((F.col("lo") < F.col("hi")) & (F.col("_often") | (F.col("n") >= min_words))))
    answers, _ = staged(judged.select("leaf", "full", "times", F.when(F.col("_variant"), None).otherwise(F.col("lo")).alias("owner")))
    total = fulls.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    hot = answers.filter(F.col("times") * HOT_PARTS >= max(total, 1)).drop("times")
    goes = F.col("owner").isNull() | (F.col("doc") != F.col("owner"))
    common = lines.join(F.broadcast(hot), ["leaf", "full"]).filter(goes)
    other = lines.join(F.broadcast(hot.select("leaf", "full")), ["leaf", "full"], "left_anti").join(
        answers.filter(F.col("times") * HOT_PARTS < max(total, 1)).drop("times"), ["leaf", "full"]).filter(goes)
    return common.select("doc", "pos").unionByName(other.select("doc", "pos"))


def drop_recurring_lines(docs: DataFrame, depth: int = 4, percent: int = 75, min_words: int = 5, short_documents: int = 5,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without lines whose template recurs across documents.

    Same rows and columns as given, with the text replaced and two columns more
    (in place of any of that name): n_lines, n_dropped. Lines are parts between
    line feeds; lines without a word, and lines that only recur within one
    document, stay. A document may end up with an empty text. Texts and lines
    of any length count whole. A null text becomes empty. Of lines that tie,
    being of one template, those of the smallest id stay. Rows that repeat an id
    are one document, and a null id is no document: its lines neither count nor
    go. An empty table gives an empty result.
    """
    drops = recurring_lines(docs, depth, percent, min_words, short_documents, id_col=id_col, text_col=text_col)
    drops = drops.distinct().groupBy("doc").agg(F.collect_list("pos").alias("__line_drops")).withColumnRenamed("doc", "__line_doc")
    joined = docs.join(drops, F.col(id_col) == F.col("__line_doc"), "left").drop("__line_doc")

    def rebuilt(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__line_drops"))
        return F.struct(
            F.when(F.col("__line_drops").isNull(), text_of(text_col)).otherwise(F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")).alias("text"),
            F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size("__line_drops"), F.lit(0)).cast("long").alias("n_dropped"))

    joined = joined.withColumn("__line_lines", let(F.split(text_of(text_col), "\n", -1), rebuilt))
    return joined.withColumns({text_col: F.col("__line_lines.text"), "n_lines": F.col("__line_lines.n_lines"), "n_dropped": F.col("__line_lines.n_dropped")}).drop("__line_lines", "__line_drops")
