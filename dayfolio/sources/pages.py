"""Landed pages to typed rows, as Spark expressions over the HTML column.

A page is one row and at most 8 MiB, so its sections and entries are handled as
arrays inside the row: no shuffle, and no Python beyond Unicode composition.
Rows that cannot be read keep a ``reject`` reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dayfolio import config
from dayfolio.functions import records as R, text as X, times
from dayfolio.operators.checks import CROSS_MARKER
from dayfolio.operators.ordering import with_position
from dayfolio.operators.reconcile import reconcile_authors
from dayfolio.sources.readers import page_reason

# Elements whose content is not markup.
_RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes"
_ENTRY = "(?is)<dt\\b[^>]*>.*?</dt\\s*>"


def markup(html: Column | str) -> Column:
    """The page without comments and without the content of raw elements."""
    text = F.regexp_replace(F.col(html) if isinstance(html, str) else html, "(?s)<!--.*?-->", "")
    return F.regexp_replace(text, f"(?is)<({_RAW})\\b[^>]*>.*?</\\1\\s*>", "")


def element_text(fragment: Column) -> Column:
    """Visible text: tags dropped, entities decoded, spaces collapsed."""
    return X.squeeze_space(X.decode_entities(F.regexp_replace(fragment, "(?s)<[^>]*>", "")))


def attribute(tag: Column, name: str) -> Column:
    """Decoded value of a quoted attribute; null when absent."""
    pattern = f"(?is)^<[^>]*?\\s{name}\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)')"
    return X.let(tag, lambda t: F.when(t.rlike(pattern), X.decode_entities(
        F.concat(F.regexp_extract(t, pattern, 1), F.regexp_extract(t, pattern, 2)))))


def sections(html: Column, opening: str = "(?i)(?=<h3\\b)") -> Column:
    """Parts of a page that begin with a heading: ``array<struct<heading, body>>``."""
    parts = F.filter(F.split(html, opening, -1), lambda s: s.rlike("(?i)^<h3\\b"))
    return F.transform(parts, lambda s: F.struct(
        element_text(F.regexp_extract(s, "(?is)^(<h3\\b[^>]*>.*?</h3\\s*>)", 1)).alias("heading"), s.alias("body")))


def entries(body: Column) -> Column:
    return F.regexp_extract_all(body, F.lit(_ENTRY), F.lit(0))


def entry_id(entry: Column) -> Column:
    """The only unversioned abstract link of an entry; null when it has none or several."""
    links = F.filter(F.regexp_extract_all(entry, F.lit("(?is)<a\\b[^>]*>"), F.lit(0)),
                     lambda a: F.coalesce(attribute(a, "href").rlike(r"^/abs/\d{4}\.\d{4,5}$"), F.lit(False)))
    return X.let(links, lambda held: F.when(
        (F.size(held) == 1) & (attribute(F.get(held, F.lit(0)), "title") == "Abstract"),
        F.substring(attribute(F.get(held, F.lit(0)), "href"), 6, 12)))


def _listing_area(df: DataFrame, html: str, maximum: int) -> DataFrame:
    """Adds ``reject`` and ``_area``, the markup from the listing element on."""
    opened = "(?is)<div\\b[^>]*\\sid\\s*=\\s*[\"']dlpage[\"'][^>]*>"
    judged = X.once(df, reject=page_reason(html, maximum), _m=F.when(page_reason(html, maximum).isNull(), markup(html)))
    count = F.regexp_count(F.col("_m"), F.lit(opened))
    return (judged.withColumn("reject", F.coalesce("reject", F.when(count != 1, "needs exactly one listing element")))
            .withColumn("_area", F.regexp_extract("_m", f"(?s){opened}(.*)$", 1)).drop("_m"))


def _reject(df: DataFrame, *reasons: tuple[Column, str]) -> DataFrame:
    """The first broken requirement becomes the reject reason."""
    broken = [F.when(~F.coalesce(holds, F.lit(False)), F.lit(text)) for holds, text in reasons]
    return X.once(df, reject=F.coalesce(F.col("reject"), *broken))


def extract_listings(pages: DataFrame, html: str = "html", slug: str = "slug", maximum: int = config.MAX_LISTING_BYTES) -> DataFrame:
    """Daily listing pages: date, new ids, new and cross counts, or a reject."""
    found = X.once(_listing_area(pages, html, maximum), _s=sections(F.col("_area"))).drop("_area")
    starting = lambda prefix: F.filter("_s", lambda s: s["heading"].startswith(prefix))
    place = lambda prefix: F.array_position(F.transform("_s", lambda s: s["heading"].startswith(prefix)), F.lit(True))
    found = X.once(found, _d=starting("Showing new listings for "), _n=starting("New submissions"), _c=starting("Cross submissions"),
                   _at=place("New submissions"), _to=place("Cross submissions"))
    between = F.when(F.col("_to") > F.col("_at"), F.flatten(F.transform(
        F.slice("_s", F.greatest(F.col("_at"), F.lit(1)).cast("int"), F.greatest(F.col("_to") - F.col("_at"), F.lit(0)).cast("int")),
        lambda s: entries(s["body"]))))
    head = lambda c: times.section_heading(F.get(c, F.lit(0))["heading"])
    found = X.once(found, announcement_date=times.long_heading(F.get("_d", F.lit(0))["heading"]), new_count=head("_n")["total"],
                   crosslist_count=head("_c")["total"], _e=between, _x=entries(F.get("_c", F.lit(0))["body"]))
    found = X.once(found, new_ids=F.sort_array(F.transform("_e", entry_id)))
    judged = _reject(
        found,
        (F.size("_d") == 1, "needs exactly one date heading"), (F.col("announcement_date").isNotNull(), "invalid date heading"),
        ((F.size("_n") == 1) & (F.size("_c") == 1), "needs one new and one cross heading"), (F.col("_at") < F.col("_to"), "sections are out of order"),
        (F.col("new_count").isNotNull() & F.col("crosslist_count").isNotNull(), "a section does not show every entry"),
        ((F.size("_e") == F.col("new_count")) & (F.size("_x") == F.col("crosslist_count")), "declared counts differ from the entries"),
        (~F.exists("new_ids", lambda i: i.isNull()), "an entry lacks its abstract link"),
        (F.size(F.array_distinct("new_ids")) == F.size("new_ids"), "ids are repeated"))
    keep = [c for c in pages.columns if c != html]
    ok = F.col("reject").isNull()
    return judged.select(*keep, R.listing_url(slug, "new").alias("source_url"),
                         *[F.when(ok, F.col(c)).alias(c) for c in ("announcement_date", "new_count", "crosslist_count", "new_ids")], "reject")


def extract_week(pages: DataFrame, html: str = "html", slug: str = "slug", maximum: int = config.MAX_LISTING_BYTES) -> DataFrame:
    """Past-week pages: ``groups`` of (date, shown, total, complete, ids, cross count), newest first."""
    found = X.once(_listing_area(pages, html, maximum), _s=sections(F.col("_area"))).drop("_area")

    def group(s: Column) -> Column:
        rows = F.transform(entries(s["body"]), lambda e: X.let(element_text(e), lambda t: F.struct(
            (F.regexp_count(t, F.lit(CROSS_MARKER)) == 1).alias("cross"),
            ((F.regexp_count(t, F.lit(CROSS_MARKER)) > 1) | F.lower(F.regexp_replace(t, CROSS_MARKER, "")).contains("cross-list")).alias("bad"),
            entry_id(e).alias("id"))))
        return X.let(times.short_heading(s["heading"]), lambda head: X.let(rows, lambda listed: F.struct(
            head["date"].alias("announcement_date"), head["shown"].alias("shown_count"), head["total"].alias("total_count"),
            (head["shown"] == head["total"]).alias("complete"), F.size(listed).cast("bigint").alias("entries"),
            F.size(F.filter(listed, lambda r: r["cross"])).cast("bigint").alias("crosslist_count"),
            F.exists(listed, lambda r: r["bad"] | (~r["cross"] & r["id"].isNull())).alias("bad"),
            F.sort_array(F.transform(F.filter(listed, lambda r: ~r["cross"]), lambda r: r["id"])).alias("new_ids"))))

    found = X.once(found, groups=F.transform("_s", group))
    dates = F.transform("groups", lambda g: g["announcement_date"])
    ids = F.flatten(F.transform("groups", lambda g: g["new_ids"]))
    judged = _reject(
        found,
        (F.size("groups") > 0, "has no date headings"),
        (F.forall(dates, lambda d: d.isNotNull()), "malformed date heading"),
        (F.size(F.array_distinct(dates)) == F.size(dates), "a date is repeated"),
        (F.sort_array(dates, asc=False) == dates, "dates are not newest first"),
        (F.forall(F.slice("groups", F.lit(1), F.greatest(F.size("groups") - 1, F.lit(0))), lambda g: g["complete"]), "a newer group is partial"),
        (F.forall("groups", lambda g: g["entries"] == g["shown_count"]), "declared counts differ from the entries"),
        (~F.exists("groups", lambda g: g["bad"]), "an entry has a broken marker or link"),
        (F.size(F.array_distinct(ids)) == F.size(ids), "ids are repeated"))
    keep = [c for c in pages.columns if c != html]
    return judged.select(*keep, R.listing_url(slug, "pastweek").alias("source_url"), F.when(F.col("reject").isNull(), F.col("groups")).alias("groups"), "reject")


def week_groups(weeks: DataFrame) -> DataFrame:
    """One row per page and date, with ``place`` from newest (0) to oldest."""
    keep = [c for c in weeks.columns if c not in ("groups", "reject")]
    rows = weeks.where("reject is null").select(*keep, F.posexplode("groups").alias("place", "g"))
    return rows.select(*keep, "place", "g.*").withColumn("new_count", F.size("new_ids").cast("bigint")).drop("entries", "bad")


def announced_ids(listings: DataFrame, date: str = "announcement_date") -> DataFrame:
    """One row per announced id."""
    return listings.select(date, "slug", F.explode("new_ids").alias("id"))


def _meta(metas: Column, name: str) -> Column:
    return F.transform(F.filter(metas, lambda m: m["name"] == name), lambda m: m["content"])


def _by_class(page: Column, tag: str, name: str) -> Column:
    pattern = f"(?is)<{tag}\\b[^>]*\\sclass\\s*=\\s*[\"'](?:[^\"']*\\s)?{name}(?:\\s[^\"']*)?[\"'][^>]*>.*?</{tag}\\s*>"
    return F.regexp_extract_all(page, F.lit(pattern), F.lit(0))


def _described(blocks: Column, descriptor: str) -> Column:
    """The visible field holds exactly its descriptor and some text."""
    block = F.get(blocks, F.lit(0))
    named = X.let(F.transform(_by_class(block, "span", "descriptor"), element_text),
                  lambda marks: (F.size(marks) == 1) & (F.get(marks, F.lit(0)) == descriptor + ":"))
    filled = X.let(element_text(block), lambda text: text.startswith(descriptor + ":") & ~X.is_blank(F.substr(text, F.lit(len(descriptor) + 2))))
    return (F.size(blocks) == 1) & named & filled


def _linked(fragment: Column) -> Column:
    """Text in which an automatic link shows its address instead of a placeholder."""
    restored = F.regexp_replace(fragment, "(?is)<a\\b[^>]*?\\shref\\s*=\\s*[\"'](https?)(://[^\"'\\s]+)[\"'][^>]*>\\s*this \\1 URL\\s*</a\\s*>", "$1$2")
    return element_text(restored)


def extract_abstracts(pages: DataFrame, html: str = "html", paper_id: str = "arxivId", slug: str = "slug",
                      maximum: int = config.MAX_ABSTRACT_BYTES) -> DataFrame:
    """Abstract pages to bibliographic rows, or a reject.

    Title, abstract and author order come from the citation metadata; the
    visible author list replaces it when both name the same people.
    """
    limits = config.METADATA_LIMITS
    judged = X.once(pages, reject=page_reason(html, maximum), _m=F.when(page_reason(html, maximum).isNull(), markup(html)))
    tags = lambda name: F.regexp_extract_all(F.col("_m"), F.lit(f"(?is)<{name}\\b[^>]*>"), F.lit(0))
    judged = X.once(judged, _metas=F.transform(tags("meta"), lambda t: F.struct(
        F.lower(attribute(t, "name")).alias("name"), attribute(t, "content").alias("content"))))
    one = lambda name: X.let(_meta(F.col("_metas"), name), lambda held: F.when(F.size(held) == 1, F.get(held, F.lit(0))))
    canonical = F.transform(F.filter(tags("link"), lambda t: F.array_contains(F.split(F.lower(attribute(t, "rel")), "\\s+"), "canonical")),
                            lambda t: attribute(t, "href"))
    strong = F.transform(F.regexp_extract_all(F.col("_m"), F.lit("(?is)<strong\\b[^>]*>.*?</strong\\s*>"), F.lit(0)), element_text)
    marker = F.filter(strong, lambda t: t.rlike(r"^arXiv:\d{4}\.\d{4,5}v[1-9]\d*$"))
    labels = F.filter(F.transform(_by_class(F.col("_m"), "td", "label"), element_text), lambda t: t == "Comments:")
    comment_cells = _by_class(F.col("_m"), "td", "comments")
    subject = element_text(F.get(_by_class(F.col("_m"), "span", "primary-subject"), F.lit(0)))
    block = F.regexp_extract("_m", "(?is)<div\\b[^>]*\\sclass\\s*=\\s*[\"'](?:[^\"']*\\s)?authors(?:\\s[^\"']*)?[\"'][^>]*>(.*?)(?=<blockquote\\b|<table\\b|$)", 1)
    anchor = "(?is)(?:\\b(?:The|the)\\s*)?<a\\b[^>]*>.*?</a\\s*>"
    named = F.filter(F.regexp_extract_all("_b", F.lit(anchor), F.lit(0)), lambda a: ~a.rlike("(?is)<a\\b[^>]*\\sid\\s*=\\s*[\"']toggle[\"']"))
    hidden = F.regexp_extract("_b", "(?is)<div\\b[^>]*\\sid\\s*=\\s*[\"']long-author-list[\"'][^>]*>(.*?)</div\\s*>", 1)
    toggled = F.regexp_extract("_b", r"et al\. \(([1-9]\d*) additional authors not shown\)\s*</a", 1).try_cast("int")
    people = F.transform(named, lambda a: F.when(element_text(a).rlike("\\bCollaboration$"), element_text(a)).otherwise(
        element_text(F.regexp_replace(a, "(?is)^(?:The|the)\\s*(?=<a)", ""))))
    whole = F.coalesce(toggled, F.lit(0)) == F.size(F.regexp_extract_all(hidden, F.lit("(?is)<a\\b[^>]*>"), F.lit(0)))

    rows = X.once(judged, _b=block, _canonical=canonical, _marker=marker, _labels=labels, _cells=comment_cells, _subject=subject,
                  _h1=_by_class(F.col("_m"), "h1", "title"), _quote=_by_class(F.col("_m"), "blockquote", "abstract"),
                  _id=one("citation_arxiv_id"), _pdf=one("citation_pdf_url"))
    canonical, marker, labels, comment_cells, subject = (F.col(c) for c in ("_canonical", "_marker", "_labels", "_cells", "_subject"))
    rows = X.once(rows, _raw=F.array(one("citation_title"), one("citation_abstract"), F.when(F.size(comment_cells) > 0, _linked(F.get(comment_cells, F.lit(0))))),
                  _cited=F.transform(_meta(F.col("_metas"), "citation_author"), X.squeeze_space),
                  _visible=F.when(whole, F.transform(people, X.squeeze_space))).withColumn("_text", X.nfc_list("_raw"))
    rows = reconcile_authors(rows, "_cited", "_visible", "authors")
    field = lambda i: X.squeeze_space(F.get("_text", F.lit(i)))
    rows = X.once(rows, title=field(0), abstract=field(1), comments=field(2), authors=F.col("authors"), _cited=F.col("_cited"))
    expected = F.col(paper_id)
    bounded = lambda c, n: ~X.is_blank(c) & (F.char_length(c) <= n) & ~F.col(c).rlike("[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]")
    result = _reject(
        rows,
        (R.is_paper_id(expected), "invalid id"),
        (F.col("_id") == expected, "citation id differs"),
        ((F.size(marker) == 1) & (F.get(marker, F.lit(0)) == F.concat(F.lit("arXiv:"), expected, F.lit("v1"))), "version marker differs"),
        ((F.size(canonical) == 1) & (F.get(canonical, F.lit(0)) == R.abs_url(expected)), "canonical address differs"),
        (F.col("_pdf").isin(F.concat(F.lit(config.SITE + "/pdf/"), expected), R.pdf_url_v1(expected)), "PDF address differs"),
        (_described(F.col("_h1"), "Title"), "visible title is malformed"),
        (bounded("title", limits["title"]), "citation title is missing or too long"),
        (F.size("_cited").between(1, limits["authors"]) & ~F.exists("_cited", lambda a: X.is_blank(a) | (F.char_length(a) > limits["author"])),
         "citation authors are missing or too long"),
        (bounded("abstract", limits["abstract"]), "citation abstract is missing or too long"),
        (_described(F.col("_quote"), "Abstract"), "visible abstract is malformed"),
        (F.regexp_extract(subject, r"\(([a-z][a-z0-9-]*(?:\.[A-Za-z0-9-]+)*)\)$", 1) == F.col(slug), "primary category differs"),
        ((F.size(labels) == F.size(comment_cells)) & (F.size(labels) <= 1), "comments are malformed or repeated"),
        (F.col("comments").isNull() | bounded("comments", limits["comments"]), "comments are unsafe or too long"))
    keep = [c for c in pages.columns if c not in (html, paper_id)]
    ok = F.col("reject").isNull()
    return result.select(
        *keep, expected.alias("arxivId"), F.when(ok, "v1").alias("arxivVersion"), F.when(ok, "new").alias("submissionType"),
        F.when(ok, R.abs_url(expected)).alias("url"), F.when(ok, R.abs_url_v1(expected)).alias("sourceUrl"),
        *[F.when(ok, F.col(c)).alias(c) for c in ("title", "authors", "abstract", "comments")],
        F.when(ok, F.col(slug)).alias("primaryCategory"), "reject")


def build_metadata(abstracts: DataFrame, announced: DataFrame, digests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metadata for every announced id, ordered and bound to its snapshot digest.

    Announced ids without a page, and pages nobody announced, are returned too.
    """
    from dayfolio.operators.reconcile import reconcile_ids

    keys = ["report_date", "slug", "arxivId"]
    good = abstracts.where("reject is null").drop("reject")
    matched = good.join(announced.select(*keys).distinct(), keys, "left_semi")
    placed = with_position(matched, ["report_date", "slug"], ["arxivId"], "position")
    return placed.join(digests, ["report_date"], "left"), reconcile_ids(good, announced, keys)


def classify_rejects(rejects: DataFrame, reason: str = "reject", group: tuple[str, ...] = ()) -> DataFrame:
    """Counts of rejected rows by class and reason."""
    text = F.col(reason)
    kind = (F.when(text.rlike("(?i)too (?:large|long|many|much)|exceeds"), "too large")
            .when(text.rlike("(?i)traversal|unsafe|repeat|entry type|override"), "unsafe")
            .when(text.rlike("(?i)not found|status|unavailable|redirect"), "unavailable")
            .when(text.rlike("(?i)utf-8|control|neither|no readable"), "unsupported format")
            .otherwise("incomplete"))
    return rejects.where(text.isNotNull()).groupBy(*group, kind.alias("kind"), text.alias("reason")).agg(F.count(F.lit(1)).alias("rows"))
