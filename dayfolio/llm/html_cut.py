"""Main text of web pages by a minimum cut between content and boilerplate."""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
SKIPPED = frozenset("script style template iframe svg canvas audio video textarea select head title datalist".split())
#: Of these only their own end tag ends the content.
RAW = frozenset("script style iframe textarea title".split())
#: What can stand in a head; anything else, or text, ends an open head.
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big button cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var "
    "math annotation menclose mfrac mi mn mo mover mpadded mphantom mroot mrow ms msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element that ends when one of these begins.
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
#: Hints of boilerplate: elements, roles, and words of class and id.
OUTSIDE_TAGS = frozenset("nav footer aside form menu dialog".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
OUTSIDE_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus "
    "footer gdpr login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo related replies respond share sharing sidebar "
    "signup social sponsor sponsored subscribe toolbar widget".split())
#: Beginnings of longer words with the same meaning, such as a cookie bar's.
OUTSIDE_STARTS = ("advert", "breadcrumb", "cookie", "disqus", "footer", "masthead", "navbar", "newsletter", "popup", "sidebar", "sponsor")
#: These only say what else the page has: a body "with-sidebar" is no sidebar.
OTHERWISE = frozenset("has no with".split())
WHOLE_TAGS = frozenset("html body main".split())
#: Words that say so whatever follows them in a name; the others only by themselves or before a word of a part of a page.
ALWAYS = frozenset("adsense advertisement advertising breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr masthead navbar navigation "
                   "newsletter pagination popup replies respond sidebar signup sponsored".split())
READERS = frozenset("comment comments disqus replies respond".split())
PARTS = frozenset(
    "area articles bar block body bottom box button buttons card column container content cta element form group header holder icon icons image images inner inside item items "
    "label layer layout left link links list main media message outer overlay panel popup position posts primary right row secondary section slot space stories text this title "
    "top unit wrap wrapper zone".split())
INSIDE_TAGS = frozenset("article main".split())
INSIDE_WORDS = frozenset("article body content entry main post story text".split())
PHRASES = re.compile(
    r"all rights reserved|\bcookies?\b.*\b(use|accept|consent|policy)\b|privacy policy|terms of (use|service)|^(©|copyright)|subscribe (to|now)|sign up|log ?in\b|"
    r"share (this|on)|follow us|related (articles|posts)|read (more|next)|leave a (comment|reply)|skip to|enable javascript", re.I)
SENTENCE_END = (".", "!", "?", "…", ":", ";", "。", "！", "？", '."', '!"', '?"', ".”", "!”", "?”", ".)", ".»")

_OUTSIDE, _INSIDE, _HEADER, _HEADING, _HIDDEN, _PERHAPS, _ARTICLE, _READERS = 1, 2, 4, 8, 16, 32, 64, 128
#: Flags of an element that count for its blocks as long as it is not found to hold the article itself.
_HINTS = _OUTSIDE | _HIDDEN | _PERHAPS
#: Weights of the classifier that gives a block's log-odds of being content.
WEIGHTS = {"bias": -1.5, "words": 0.9, "links": -5.0, "sentence": 0.8, "heading": 1.0, "inside": 3.0, "outside": -14.0, "perhaps": -5.0, "header": -6.0, "phrase": -4.0}
#: Strength of the edge between neighbours in page order, halved as their distance in the tree doubles, and between neighbours under one parent.
NEXT, SIBLING = 1.0, 0.7
#: A block of so many words is prose. An element holds the article itself if the text outside of all hints is less than such a share
#: of its prose, and no content is named there; or less than the other share, if it holds the page's only article or main element.
PROSE, LITTLE, LESS = 8, 0.02, 0.3
#: Hints of a page that are found to be void at most.
TURNS = 20


class Block:
    __slots__ = ("text", "flags", "links", "parent")

    def __init__(self, text: str, flags: int, links: float, parent: int):
        self.text, self.flags, self.links, self.parent = text, flags, links, parent


def _name_hints(name: str, tag: str) -> int:
    """Hints in one name of a class or id, such as a sidebar-left; a share-price is only perhaps about sharing."""
    words = WORDS.findall(name)
    flags = (not INSIDE_WORDS.isdisjoint(words)) * _INSIDE
    if tag in WHOLE_TAGS or not OTHERWISE.isdisjoint(words):
        return flags
    hints = [w in OUTSIDE_WORDS or w.startswith(OUTSIDE_STARTS) for w in words]
    if any(hints):
        sure = any(w in ALWAYS or w.startswith(OUTSIDE_STARTS) for w in words)
        last = max(i for i, h in enumerate(hints) if h)
        flags |= _OUTSIDE if sure or PARTS.issuperset(words[last + 1:]) else _PERHAPS
        flags |= (not READERS.isdisjoint(words)) * _READERS
    return flags | ("header" in words) * _HEADER


def _hints(tag: str, attributes: str) -> int:
    flags = (tag in OUTSIDE_TAGS) * _OUTSIDE | (tag in INSIDE_TAGS) * _INSIDE | (tag == "header") * _HEADER | (tag in HEADINGS) * _HEADING
    if attributes and ("class" in (low := attributes.lower()) or "id" in low or "role" in low or "style" in low):
        for name, a, b, c in ATTRIBUTE.findall(low):
            value = a or b or c
            if name in ("class", "id"):
                for token in value.split():
                    flags |= _name_hints(token, tag)
            elif name == "role":
                flags |= (value in OUTSIDE_ROLES) * _OUTSIDE | (value in INSIDE_TAGS) * _INSIDE
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                flags |= _HIDDEN
    return flags


def blocks_of(page: str) -> tuple[list[Block], list[int], list[int], list[int]]:
    """The page's text blocks in order, and each tree node's parent, depth and own hints.

    A block is text between two ends of block elements, with character
    references decoded and white space turned into single spaces.
    """
    found: list[Block] = []
    parents, depths, hints = [0], [0], [0]
    stack: list[tuple[str, int, int]] = [("", 0, 0)]  # tag, node, flags of it and of all around it
    texts: list[str] = []
    linked: list[str] = []
    links = skipped = 0

    def flush() -> None:
        nonlocal texts, linked
        if texts:
            text = " ".join(html.unescape("".join(texts)).split())
            if text:
                _, node, flags = stack[-1]
                inside = sum(len(x) for x in linked)
                found.append(Block(text, flags, min(1.0, inside / len(text)), node))
            texts, linked = [], []

    def close(depth: int) -> None:
        nonlocal links, skipped
        for tag, *_ in stack[depth:]:
            links -= tag == "a"
            skipped -= tag in SKIPPED
        del stack[depth:]

    place, end = 0, len(page)
    while place < end:
        match = TAG.search(page, place)
        if stack[-1][0] == "head":
            begins = match and not match[1] and (match[2] or "").lower()
            if begins and begins not in IN_HEAD or page[place:match.start() if match else end].strip():
                close(len(stack) - 1)
        if not skipped and (text := page[place:match.start() if match else end]):
            texts.append(text)
            if links:
                linked.append(text)
        if not match:
            break
        place = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:  # an end tag
            inline = tag in INLINE
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    if not inline:
                        flush()
                    close(depth)
                    break
                if inline and stack[depth][0] not in INLINE:
                    break
            else:
                if not inline:
                    flush()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br" and not skipped:
                texts.append(" ")
            continue
        inline = tag in INLINE
        if not inline:
            flush()
            closed = CLOSED_BY.get(tag)
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = stack[depth][0]
                if open_tag == "p" or closed and open_tag in closed:
                    close(depth)
                    if open_tag != "p" or not closed:
                        break
                elif open_tag not in INLINE:
                    break
        if tag == "a" and links:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "a":
                    del stack[depth]
                    links -= 1
                    break
        if tag in RAW:
            ending = re.compile(f"</{tag}[^>]*>", re.I).search(page, place)
            place = ending.end() if ending else end
            continue
        if match[3].endswith("/") and tag in SKIPPED:
            continue
        _, node, flags = stack[-1]
        if not inline:
            parents.append(node)
            depths.append(depths[node] + 1)
            node = len(parents) - 1
            own = _hints(tag, match[3])
            hints.append(own | (tag in INSIDE_TAGS and not own & _OUTSIDE) * _ARTICLE)
            stack.append((tag, node, flags & ~_HEADING | own & ~(_HINTS | _READERS)))
        else:
            stack.append((tag, node, flags | _hints(tag, match[3])))
        links += tag == "a"
        skipped += tag in SKIPPED
    flush()
    return found, parents, depths, hints


def place_hints(found: list[Block], parents: list[int], hints: list[int]) -> None:
    """Gives each block the hints of the elements around it.

    An element is not what its hint says if the page has next to no text
    outside of all hinted elements beside what it holds: a form around the
    whole page, a layout named for its sidebar. Then the hint is void, of the
    largest such element first, and its parts are judged again by their own.
    Readers' comments are never the article.
    """
    n = len(parents)
    prose, formal, free, named = [0] * n, [0] * n, [0] * n, [0] * n  # by node: prose, that of an article or main element, text, prose where content is named
    articles, content = [False] * n, [False] * n
    for i in range(1, n):
        articles[i] = articles[parents[i]] or bool(hints[i] & _ARTICLE)
        content[i] = content[parents[i]] or bool(hints[i] & _INSIDE)
    written = [b.parent for b in found if articles[b.parent]]
    for b in found:
        if b.links < 0.5:
            words, size = b.text.count(" ") + 1, len(b.text)
            free[b.parent] += size * (words >= 3)
            prose[b.parent] += size * (words >= PROSE)
            formal[b.parent] += size * (words >= PROSE) * articles[b.parent]
            named[b.parent] += size * (words >= PROSE) * content[b.parent]
    for i in range(n - 1, 0, -1):
        prose[parents[i]] += prose[i]
        formal[parents[i]] += formal[i]
    around, outer = [0] * n, [0] * n
    for turn in range(TURNS + 1):
        for i in range(1, n):
            around[i] = around[parents[i]] | hints[i] & _HINTS
            outer[i] = outer[parents[i]] or (i if hints[i] & _HINTS else 0)  # the outermost hinted element
        if turn == TURNS or not all(outer[i] for i in written):  # an article outside of all hints is the article
            break
        left, left_named = (sum(x for x, o in zip(v, outer, strict=True) if not o) for v in (free, named))
        void = max((i for i in range(1, n) if outer[i] == i and prose[i] and not hints[i] & _READERS and (
            not left_named and left < LITTLE * prose[i] or formal[i] and left < LESS * prose[i])), key=lambda i: prose[i], default=0)
        if not void:
            break
        hints[void] &= ~_HINTS
    for b in found:
        b.flags |= around[b.parent]


def log_odds(block: Block) -> float:
    """The classifier: how much more likely the block is content than not."""
    w, n = WEIGHTS, block.text.count(" ") + 1
    inside = block.flags & _INSIDE
    score = w["bias"] + w["words"] * min(6.0, math.log2(1 + n)) + w["links"] * block.links
    score += w["sentence"] * block.text.endswith(SENTENCE_END) + w["heading"] * bool(block.flags & _HEADING) + w["inside"] * bool(inside)
    if block.flags & (_OUTSIDE | _HIDDEN) or block.flags & _HEADER and not inside:
        score += w["outside"]
    else:
        score += w["perhaps"] * bool(block.flags & _PERHAPS) + w["header"] * bool(block.flags & _HEADER and not block.flags & _HEADING)
    if n <= 40 and PHRASES.search(block.text):
        score += w["phrase"]
    return score


def _distance(a: int, b: int, parents: list[int], depths: list[int]) -> int:
    steps = 0
    while a != b:
        if depths[a] < depths[b]:
            a, b = b, a
        a = parents[a]
        steps += 1
    return steps


def minimum_cut(content: list[float], other: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each node whether it is on the source side of a minimum cut.

    ``content`` holds what it costs to call a node boilerplate, ``other`` what it
    costs to call it content, and an edge what it costs to part its two ends.
    Maximum flow by level graphs and blocking flows.
    """
    n = len(content)
    source, sink = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, there: float, back: float) -> None:
        head[a].append(len(to))
        to.append(b)
        room.append(there)
        head[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, (c, o) in enumerate(zip(content, other, strict=True)):
        if c > o:  # what flows straight through a node needs no search
            join(source, i, c - o, 0.0)
        elif o > c:
            join(i, sink, o - c, 0.0)
    for a, b, weight in edges:
        join(a, b, weight, weight)
    least = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in head[a]:
                if room[e] > least and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                cut = 0
                for k, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                    if room[e] <= least and not cut:
                        cut = k + 1
                del path[cut - 1:]
                a = to[path[-1]] if path else source
                continue
            while turn[a] < len(head[a]):
                e = head[a][turn[a]]
                if room[e] > least and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            else:
                if a == source:
                    break
                level[a] = -1
                a = to[path.pop() ^ 1]
                continue
            path.append(e)
            a = to[e]


def label_blocks(page: str) -> tuple[list[Block], list[bool]]:
    """The page's blocks and which of them are content."""
    found, parents, depths, hints = blocks_of(page)
    if not found:
        return [], []
    place_hints(found, parents, hints)
    scores = [log_odds(b) for b in found]
    soft = lambda x: x if x > 30 else math.log1p(math.exp(x)) if x > -30 else 0.0
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, NEXT / max(1, _distance(found[i - 1].parent, b.parent, parents, depths) / 2)))
        under = parents[b.parent]
        if under in last and last[under] != i - 1:
            edges.append((last[under], i, SIBLING))
        last[under] = i
    return found, minimum_cut([soft(s) for s in scores], [soft(-s) for s in scores], edges)


def main_text(page: str | None) -> tuple[str, int, int]:
    """Main text, number of blocks, number of content blocks."""
    found, content = label_blocks(page or "")
    kept = [b.text for b, c in zip(found, content, strict=True) if c]
    return "\n".join(kept), len(found), len(kept)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of each page: (page_id, url, text, n_chars, n_blocks, n_content).

    Each page is cut on its own: a classifier's costs are the capacities to the
    two terminals, neighbours in page order and under one parent are tied by
    smoothness edges, and the blocks on the source side of a minimum cut are the
    text, in page order, one per line. Pages of any length are read whole. Null,
    empty and broken html give the empty text or what can be read. Repeated rows each get a row; an empty table gives
    an empty result; other columns are ignored.
    """
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(x.as_py()) for x in batch.column(2)]
            texts = [x[0] for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64()),
                 pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64())],
                names=[id_col, url_col, "text", "n_chars", "n_blocks", "n_content"])

    wanted = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    return wanted.mapInArrow(extract, f"{id_col} long, {url_col} string, text string, n_chars long, n_blocks long, n_content long")
