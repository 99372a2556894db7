"""Main text and url verdicts against brute force."""

from __future__ import annotations

import itertools
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from dayfolio.llm import html_cut, url_graph  # noqa: E402

SENTENCE = "This is a sentence of the article, and it has words enough to be one."
PAGE = f"""<!DOCTYPE html><html><head><title>No title</title><style>p{{x:"</p>"}}</style><script>var a = "<p>{SENTENCE}</p>";</script></head><body>
<header><a href="/">Home</a> Our paper</header><nav><ul><li><a href=/a>News</a><li><a href=/b>Sport</a></ul></nav>
<!-- <p>{SENTENCE}</p> --><div class="side-bar sidebar"><p>{SENTENCE}</p></div><div class="cookie notice">{SENTENCE}</div>
<article><h1>The &lt;title&gt; &amp; more</h1><p>{SENTENCE}<p><b>Bold</b> &eacute;t&#233;<br>and  more&nbsp;of
it.</p><div id="ad-1" class="advert">{SENTENCE}</div><ul><li>One item of a list<li>Another item</ul>
<form><p>{SENTENCE}</p><input><button>Send it</button></form><blockquote>{SENTENCE}</blockquote></article>
<section id="comments"><p>{SENTENCE}</p></section><aside>{SENTENCE}</aside><footer>&copy; all of us</footer></body></html>"""
TEXT = "\n".join(["The <title> & more", SENTENCE, "Bold été and more of it.", "One item of a list", "Another item", SENTENCE])


def test_main_text():
    assert html_cut.main_text(PAGE)[0] == TEXT
    assert html_cut.main_text(None) == html_cut.main_text("") == ("", 0, 0)
    assert html_cut.main_text(SENTENCE)[0] == SENTENCE
    for broken in ("<", "<p", "</", "<a href='", "<!--", "<script>", "<p>" * 2000, "</div>" * 50, "<article><p>" + SENTENCE):
        text = html_cut.main_text(broken)[0]
        assert text in ("", SENTENCE, broken)
    assert html_cut.main_text("<div>" * 3000 + f"<p>{SENTENCE}" * 3000)[0].count("\n") == 2999


def test_open_head():
    for start in ("<body>", "", "<article>", "<body><div>"):
        page = f"<html><head><meta charset=utf-8><title>No title</title><style>p{{}}</style><noscript><p>none</p></noscript><template><p>{SENTENCE}</p></template>{start}<p>{SENTENCE}</p></html>"
        assert html_cut.main_text(page)[0] == SENTENCE
    assert html_cut.main_text(f"<head><title>x</title>\n{SENTENCE}")[0] == SENTENCE
    assert html_cut.main_text(f"<head><title>x</title></head>{SENTENCE}")[0] == SENTENCE


def test_only_what_is_listed_goes():
    page = f"""<article><p>{SENTENCE}</p><p>So <math><mi>a</mi><mo>+</mo><mi>b</mi></math> is <button>a button</button> here, as all of us can see.</p>
<object data="x"><p>What the object says, in words that stand for it.</p></object><noscript><p>What stands here without any script to run.</p></noscript><svg><text>drawn</text></svg></article>"""
    assert html_cut.main_text(page)[0].split("\n") == [
        SENTENCE, "So a+b is a button here, as all of us can see.", "What the object says, in words that stand for it.", "What stands here without any script to run."]


def test_hints():
    page = f'<body class="post with-sidebar"><div id="cookiebar">{SENTENCE}</div><div class="layout has-comments"><p>{SENTENCE}</p></div><div class="post-comments"><p>{SENTENCE}</p></div></body>'
    assert html_cut.main_text(page)[0] == SENTENCE


def test_hints_do_not_outvote_the_whole_page():
    more = [f"{SENTENCE} It is number {i}." for i in range(8)]
    long = "".join(f"<p>{x}</p>" for x in more)
    sidebar = f'<div class="sidebar"><p>{SENTENCE}</p></div>'
    around = {
        f'<form id="page" action="/"><div class="top"><a href="/">Home</a></div>{long}</form>': more,
        f'<div class="layout sidebar-left">{sidebar}<article>{long}</article></div>': more,
        f'<nav><a href="/">Home</a></nav><div class="reading ad-free">{long}</div>': more,
        f'<div class="entry-content share-price">{long}</div>{sidebar}': more,
        f'<div style="display: none">{SENTENCE}</div><div>{long}</div>': more,
        f'<article>{long}<p id="notice-of-law">{SENTENCE}</p><div class="notice">{SENTENCE}</div></article>': [*more, SENTENCE],
        # What is hinted stays out however much it holds, if there is something else, and readers' comments always do.
        f'<div><p>{SENTENCE}</p></div><div id="comments">{long}<article class="comment">{long}</article></div>': [SENTENCE],
        f'<article><p>Yes.</p></article><div class="sidebar">{long}</div>': ["Yes."],
        f'<div id="comments">{long}</div>': [],
    }
    for body, want in around.items():
        assert html_cut.main_text(f"<html><body>{body}</body></html>")[0].split("\n") == (want or [""])
    nested = '<div class="sidebar">' * 400 + f"<p>{SENTENCE}</p>"
    assert html_cut.main_text(nested)[0] in ("", SENTENCE)


def test_minimum_cut_is_minimal():
    rng = random.Random(9)
    for _ in range(150):
        n = rng.randrange(1, 9)
        content, other = [rng.random() * 4 for _ in range(n)], [rng.random() * 4 for _ in range(n)]
        edges = [(i, j, rng.random() * 2) for i in range(n) for j in range(i) if rng.random() < 0.5]
        cost = lambda c: sum(o if x else b for x, b, o in zip(c, content, other, strict=True)) + sum(w for i, j, w in edges if c[i] != c[j])
        assert cost(html_cut.minimum_cut(content, other, edges)) == pytest.approx(min(map(cost, itertools.product([False, True], repeat=n))))


def test_neighbours_decide_short_blocks():
    page = f"<div><p>{SENTENCE}</p><p>Yes</p><p>{SENTENCE}</p></div><table><tr><td>Yes</td></tr></table>"
    assert html_cut.main_text(page)[0] == f"{SENTENCE}\nYes\n{SENTENCE}"


def test_extract(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "x", ""), (3, "y", "<p>" + "word " * 60000 + "end.")]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = [tuple(r)[:4] for r in html_cut.extract_main_text(pages).collect()]
    long = "word " * 60000 + "end."
    assert sorted(got, key=repr) == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(2, None, "", 0), (None, "x", "", 0), (3, "y", long, len(long))], key=repr)
    assert html_cut.extract_main_text(pages.limit(0)).count() == 0


URLS = {
    "http://a.com/x?y": ("a.com", "/x", "com/", "allow"), "HTTPS://A.Example.COM/en/1#t": ("a.example.com", "/en/1", "example.com/en/", "block"),
    "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"), "http://x.www.example.com/en/a": ("x.www.example.com", "/en/a", "www.example.com/en/", "allow"),
    "http://b.net/es/1": ("b.net", "/es/1", "net/es/", "block"), "http://b.net/en/1": ("b.net", "/en/1", None, "block"), "http://com": ("com", "", None, "allow"),
    "http://examplexcom/en/": ("examplexcom", "/en/", None, "allow"), "http://telecom/": ("telecom", "/", None, "allow"), "http://c.com?/en/": ("c.com", "", None, "allow"),
    "no url": ("", "", None, "allow"), None: ("", "", None, "allow"), "x://": ("", "", None, "allow"), "http://a.com/p://b.net/es/?": ("a.com", "/p://b.net/es/", "com/", "allow"),
}


def test_rules(spark):
    rows = [(i, url, None, "h", "v") for i, url in enumerate(URLS)] + [(None, "http://b.net/es/1", "", "h", "v")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_graph.judge_urls(pages).collect() if r.page_id is not None}
    assert [got[i] for i in range(len(URLS))] == list(URLS.values())
    assert url_graph.judge_urls(pages).count() == len(rows) and url_graph.judge_urls(pages.limit(0)).count() == 0


def test_propagation(spark):
    rng = random.Random(2)
    edges = sorted({(a, b) for a, b in ((f"h{rng.randrange(12)}", f"h{rng.randrange(12)}") for _ in range(40)) if a != b})
    counted = [("trust", a, b, rng.randrange(1, 5)) for a, b in edges]
    out: dict = {}
    for _, a, _b, n in counted:
        out[a] = out.get(a, 0) + n
    mass = {"h0": 0.5, "h1": 0.5}
    want: dict = {}
    for _ in range(200):
        for k, v in mass.items():
            want[k] = want.get(k, 0) + 0.15 * v
        now: dict = {}
        for _, a, b, n in counted:
            now[b] = now.get(b, 0) + 0.85 * mass.get(a, 0) * n / out[a]
        mass = now
    seeds = spark.createDataFrame([("trust", "h0", 0.5), ("trust", "h1", 0.5)], "walk string, node string, mass double")
    got = {r.node: r.score for r in url_graph.propagate(spark.createDataFrame(counted, "walk string, src string, dst string, n int"), seeds, tolerance=1e-4).collect()}
    assert {k: got.get(k, 0) for k in want} == pytest.approx(want, abs=2e-4)


def test_links_decide(spark):
    link = lambda *hosts: "".join(f'<a class="x" href="https://{h}/p">t</a><A HREF=//{h}>' for h in hosts)
    rows = [("http://good.com/", link("friend.org")), ("http://friend.org/", link("good.com")), ("http://bad.net/es/", link("bad2.net")), ("http://farm.org/", link("bad.net")),
            ("http://farm2.org/", link("farm.org") * 3), ("http://alone.org/", '<a href="/x">t</a>'), ("http://bad2.net/fr/", "")]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    got = [r.verdict for r in sorted(url_graph.judge_urls(pages).collect())]
    assert got == ["allow", "allow", "block", "block", "block", "allow", "block"]


def test_many_seeds_and_far_hosts(spark):
    link = lambda host: f'<a href="http://{host}/">t</a>'
    rows = [(f"http://bad{i}.net/es/", "") for i in range(150)] + [(f"http://good{i}.com/", "") for i in range(148)] + [(f"http://good{i}.com/", link("both.org")) for i in (148, 149)]
    far = [f"far{i}.org" for i in range(64)]  # each links to the one before
    rows += [("http://both.org/", link("bad0.net")), (f"http://{far[0]}/", link("bad1.net"))]
    rows += [(f"http://{b}/", link(a)) for a, b in zip(far, far[1:])]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    got = {r.host: r.verdict for r in url_graph.judge_urls(pages).collect()}
    assert {h: got[h] for h in far} == dict.fromkeys(far, "block")
    assert got["both.org"] == "allow"  # twice as much trust as distrust
