"""Text normalisation, masking, n-grams and script counts.

Unicode normal forms are the one thing Spark SQL lacks, so only those run in
Arrow UDFs; case, space and pattern work stays in the JVM.
"""

from __future__ import annotations

import re
from collections import Counter
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from dayfolio import config

# The characters a script engine's \s and trim cover.
SPACE = "[\\t\\n\\x0b\\f\\r \\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]"
# Script classes and sentence marks in Java regex syntax.
_PLAIN_JAPANESE = "ぁ-ゖァ-ヺ一-龥"  # the common part of the three scripts, which is found faster
JAPANESE = _PLAIN_JAPANESE + "\\p{IsHiragana}\\p{IsKatakana}\\p{IsHan}"
LATIN = "\\p{IsLatin}"
MARKS = "[、。；：！？]"
SLOT = "◇"
CONTENT_RUN = "[ァ-ヺ一-龥\\p{IsHan}\\p{IsKatakana}\\p{IsLatin}$\\\\_{}^+*/=<>~・ー‐‑‒–—-]+"


def _beyond_ascii(function, text):
    """The function for values that have more than ASCII, which every normal form keeps; those stay in the JVM."""
    def normalise(c: Column | str) -> Column:
        value = _column(c)
        return F.coalesce(function(F.when(F.octet_length(text(value)) > F.char_length(text(value)), value)), value)
    return normalise


def _normal_form(form: str):
    @F.pandas_udf(T.StringType())
    def normalise(values: pd.Series) -> pd.Series:
        return values.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize(form, v))
    return normalise


def _normal_form_list(form: str):
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def normalise(values: pd.Series) -> pd.Series:
        def each(items):
            if items is None:
                return None
            return [v if v is None or v.isascii() else unicodedata.normalize(form, v) for v in items]
        return values.map(each)
    return normalise


_FORMS = {form: _normal_form(form) for form in ("NFKC", "NFKD", "NFC")}
nfkc, nfkd, nfc = (_beyond_ascii(function, lambda value: value) for function in _FORMS.values())
nfkc_list, nfkd_list, nfc_list = (_beyond_ascii(_normal_form_list(form), lambda value: F.array_join(value, "")) for form in _FORMS)


def register(spark: SparkSession) -> None:
    """Makes the Unicode functions callable from SQL."""
    for form, function in _FORMS.items():
        spark.udf.register(form.lower(), function)


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_space(c: Column | str) -> Column:
    return F.regexp_replace(_column(c), f"^{SPACE}+|{SPACE}+$", "")


def squeeze_space(c: Column | str) -> Column:
    return trim_space(F.regexp_replace(_column(c), f"{SPACE}+", " "))


def is_blank(c: Column | str) -> Column:
    """Null or nothing but white space."""
    return F.coalesce(~_column(c).rlike(f"[^{SPACE[1:]}"), F.lit(True))


def fold_prose(normalised: Column) -> Column:
    """Case and space folding for text that is already in normal form. Only text with more than single spaces between words is squeezed."""
    text = F.lower(normalised)
    return F.when(text.rlike(f"[{SPACE[1:-1].replace(' ', '')}]|  |^ | $"), squeeze_space(text)).otherwise(text)


def normalize_prose(c: Column | str) -> Column:
    """Compatibility form, lower case, single spaces."""
    return fold_prose(nfkc(_column(c)))


def fold_author(decomposed: Column) -> Column:
    bare = F.lower(F.regexp_replace(decomposed, "[\\u0300-\\u036f]", ""))
    return F.trim(F.regexp_replace(bare, "[^\\p{L}\\p{N}]+", " "))


def author_key(c: Column | str) -> Column:
    """Name without accents, case and punctuation."""
    return fold_author(nfkd(_column(c)))


_ACCENTS = re.compile("[\u0300-\u036f]")


class AuthorKeys(dict):
    """The key of each name that was asked for, worked out once; starts anew when it holds very many."""

    def __missing__(self, name: str) -> str:
        import regex

        if len(self) >= 500_000:
            self.clear()
        bare = _ACCENTS.sub("", unicodedata.normalize("NFKD", name)).lower()
        self[name] = key = regex.sub(r"[^\p{L}\p{N}]+", " ", bare).strip(" ")
        return key


def author_keys(c: Column | str) -> Column:
    """The same for every element of an array of names."""
    return F.transform(nfkd_list(_column(c)), fold_author)


def author_signature(c: Column | str) -> Column:
    """Sorted name tokens, so that "Family, Given" equals "Given Family"."""
    return _signature(nfc(_column(c)))


def _signature(name: Column) -> Column:
    spaced = squeeze_space(F.regexp_replace(F.lower(name), "[\\p{P}\\p{S}]+", " "))
    return F.array_join(F.sort_array(F.split(spaced, " ")), "\x00")


def _compact(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), f"(?:{SPACE}|[\\p{{P}}\\p{{S}}])+", "")


def author_compact(c: Column | str) -> Column:
    """Name letters in order, without spaces, punctuation and symbols."""
    return _compact(nfc(_column(c)))


def canonical_text(c: Column | str, maximum: int) -> Column:
    """Composed form with single spaces; null when empty, unsafe or too long."""
    text = squeeze_space(nfc(_column(c)))
    unsafe = text.rlike("[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]")
    return F.when((text != "") & ~unsafe & (F.char_length(text) <= maximum), text)


def mask_math(c: Column | str) -> Column:
    """Replaces formulas, commands and snake_case names by a space; each has one of three characters."""
    whole = _column(c)
    text = F.regexp_replace(whole, "\\$[^$]*\\$", " ")
    text = F.regexp_replace(text, "(?s)\\\\\\(.*?\\\\\\)", " ")
    text = F.regexp_replace(text, "(?s)\\\\\\[.*?\\\\\\]", " ")
    text = F.regexp_replace(text, "\\\\[A-Za-z]+", " ")
    text = F.regexp_replace(
        text,
        "(?<![\\p{IsLatin}\\p{N}])[A-Za-z][A-Za-z0-9]*(?:_[A-Za-z0-9]+)+(?![\\p{IsLatin}\\p{N}])",
        " ",
    )
    return F.when(whole.contains("$") | whole.contains("\\") | whole.contains("_"), text).otherwise(whole)


def fold_compare(normalised: Column) -> Column:
    return F.regexp_replace(F.lower(normalised), "[^\\p{L}\\p{N}]+", "")


def compare_text(c: Column | str) -> Column:
    """Letters and digits only, in compatibility form and lower case."""
    return fold_compare(nfkc(_column(c)))


def let(value: Column, body) -> Column:
    """Evaluates ``value`` once and hands it to ``body``.

    A lambda body that mentions an outer expression evaluates it again for
    every element; a bound variable is evaluated once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def characters(c: Column | str) -> Column:
    """The code points of a text; an empty array for an empty text."""
    text = _column(c)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))


def char_ngrams(c: Column | str, size: int) -> Column:
    """Every run of ``size`` code points, repeats included, in linear time."""
    grams = let(characters(c), lambda chars: F.when(
        F.size(chars) >= size,
        F.transform(F.sequence(F.lit(1), F.size(chars) - (size - 1)),
                    lambda i: F.array_join(F.slice(chars, i, F.lit(size)), ""))))
    return F.coalesce(grams, F.array().cast("array<string>"))


def gram_overlap(source: Column, target: Column, size: int) -> Column:
    """How many n-grams two texts share, repeats counted, in Arrow batches and linear time."""
    @F.pandas_udf(T.LongType())
    def shared(ours: pd.Series, theirs: pd.Series) -> pd.Series:
        grams = lambda text: Counter(text[i:i + size] for i in range(len(text or "") - size + 1))
        return pd.Series([(grams(a) & grams(b)).total() for a, b in zip(ours, theirs)], dtype="int64")

    return shared(source, target)


def gram_overlaps(sources: Column, targets: Column, size: int) -> Column:
    """``gram_overlap`` of every source with every target, sources first; each text is cut once."""
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def shared(ours: pd.Series, theirs: pd.Series) -> pd.Series:
        def grams(text):
            cut = [text[i:i + size] for i in range(len(text or "") - size + 1)]
            return cut, set(cut)

        def common(a, b):
            (ours, distinct), (theirs, others) = a, b
            both = distinct & others
            if not both or len(ours) == len(distinct) or len(theirs) == len(others):  # the lesser count of a gram is 1
                return len(both)
            return (Counter(ours) & Counter(theirs)).total()

        def each(a, b):
            b = [grams(t) for t in b]
            return [common(one, other) for one in map(grams, a) for other in b]
        return pd.Series([each(a, b) for a, b in zip(ours, theirs)], dtype=object)

    return shared(sources, targets)


def count_script(c: Column | str, character_class: str) -> Column:
    """Number of characters in a regex character class, such as ``\\p{IsHan}``."""
    if not any(part in character_class for part in ("[", "^", "&&")):
        return F.char_length(F.regexp_replace(_column(c), f"[^{character_class}]+", ""))
    return F.regexp_count(_column(c), F.lit(character_class if character_class.startswith("[") else f"[{character_class}]"))


def japanese_characters(c: Column | str) -> Column:
    return count_script(c, JAPANESE)


def skeleton(normalised: Column, content: str = CONTENT_RUN) -> Column:
    """Sentence frame: every run of content characters becomes one slot."""
    text = squeeze_space(F.lower(mask_math(normalised)))
    text = F.regexp_replace(text, content, SLOT)
    return F.regexp_replace(F.regexp_replace(text, f"{SLOT}+", SLOT), f"{SPACE}+", "")


def number_free(text: Column) -> Column:
    return F.regexp_replace(text, "\\p{N}+(?:[.,]\\p{N}+)?", "#")


# The Hiragana script as a character class.
HIRAGANA = "[\u3041-\u3096\u309d-\u309f\U0001b001-\U0001b11f\U0001b132\U0001b150-\U0001b152\U0001f200]"


def gram_list(c: Column, size: int, distinct: bool = False) -> Column:
    """``char_ngrams`` for whole documents, in Arrow batches.

    A long text has as many grams as characters; slicing them in one batch is
    several times faster than evaluating a lambda per gram.
    """
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def cut(values: pd.Series) -> pd.Series:
        def grams(text):
            found = [] if text is None else [text[i:i + size] for i in range(len(text) - size + 1)]
            return list(dict.fromkeys(found)) if distinct else found
        return values.map(grams)

    return cut(c)


def structure_cutter(structure: dict = config.STRUCTURE, marks: str = MARKS, letter: str = HIRAGANA):
    """A function from normalised prose to its distinct long anchors and ordered pairs of nearby short anchors.

    An anchor is the window of characters around a sentence mark, shifted
    inwards at the ends; it needs enough characters of the letter class.
    """
    mark, wanted, gap = re.compile(marks), re.compile(letter), structure["gap"]
    kinds = [(structure[k], structure[f"{k}_left"], structure[f"{k}_hiragana"]) for k in ("long", "short")]

    def windows(text, places, size, left, letters):
        if len(text) < size:
            return []
        cuts = (max(0, min(i - left, len(text) - size)) for i in places)
        return [w for w in (text[i:i + size] for i in cuts) if len(wanted.findall(w)) >= letters]

    def cut(value):
        if value is None:
            return []
        text = value.replace(" ", "")
        places = [m.start() for m in mark.finditer(text)]
        long, short = (windows(text, places, *kind) for kind in kinds)
        pairs = (f"pair\0{first}\0{second}" for i, first in enumerate(short) for second in short[i + 1:i + 1 + gap])
        return list(dict.fromkeys([f"long\0{w}" for w in long] + list(pairs)))

    return cut


# Entities a landed page may use besides numeric ones.
NAMED_ENTITIES = {"amp": "&", "apos": "'", "gt": ">", "lt": "<", "nbsp": " ", "quot": '"'}
_ENTITY = "&(?:#\\d+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def _one_entity(entity: Column) -> Column:
    named = F.create_map(*[F.lit(v) for pair in NAMED_ENTITIES.items() for v in pair])

    def decoded(body: Column) -> Column:
        code = (F.when(body.startswith("#x"), F.conv(F.substr(body, F.lit(3)), 16, 10).cast("long"))
                .when(body.startswith("#"), F.substr(body, F.lit(2)).try_cast("long")))
        return let(code, lambda n: F.coalesce(
            F.try_element_at(named, body),
            F.when((n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))))

    return let(F.lower(F.regexp_extract(entity, "&(.*);", 1)), decoded)


def decode_entities(c: Column | str) -> Column:
    """Replaces six named and all numeric entities; null when one is unknown."""
    def replaced(text: Column) -> Column:
        return let(F.transform(F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0)), _one_entity), lambda found: F.when(
            ~F.exists(found, lambda d: d.isNull()),
            F.array_join(F.zip_with(F.split(text, _ENTITY, -1), found,
                                    lambda p, d: F.concat(F.coalesce(p, F.lit("")), F.coalesce(d, F.lit("")))), "")))

    return let(_column(c), lambda text: F.when(text.contains("&"), replaced(text)).otherwise(text))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that later expressions read many times.

    A generator stands between the plan's projections, so Catalyst does not
    copy the expression into every place that reads it.
    """
    packed = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(packed)))
