import re
import time
from collections import Counter
from html import unescape
from itertools import product

import numpy as np
import pytest

from viewrecon.llm import html_extract as h
from viewrecon.llm.boosting import Boosted
from viewrecon.llm.dom import _TAG_GROUP, NAMES, Page


@pytest.fixture(scope="module")
def extractor():
    return h.Extractor(*h.trained())


def f1(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    return 2 * sum((a & b).values()) / max(1, sum(a.values()) + sum(b.values()))


def test_held_out_layouts(extractor):
    rng = np.random.default_rng(12345)
    pages = [h.synthetic_page(rng) for _ in range(150)]
    got = extractor.texts([h.unmarked(p) for p in pages])
    want = [h.marked_text(p) for p in pages]
    assert np.mean([a == b for a, b in zip(got, want, strict=True)]) > 0.85
    assert np.mean([f1(a, b) for a, b in zip(got, want, strict=True)]) > 0.94


def test_whole_table(spark, sf_dir):
    rows = h.op1_html_extraction(spark, sf_dir).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(html)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", html[r.page_id], re.S)[1]
        want = " ".join(unescape(re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|br)>", " ", article))).split())
        assert r.text == want and r.n_chars == len(want)


@pytest.mark.parametrize("html", ["", "   ", "<", "<p", "a < b > c", "<div><p>x", "</p></div>", "<!-- never ends", "<script>if (a</b) {}", "<a href='", "<td><tr></table><li>", "<p>" * 2000, "<div>" * 3000 + "x", "\x00<b>퟿", "<p>İ<script>x</script>y</p>"])
def test_broken_markup(extractor, html):
    assert isinstance(extractor.texts([html])[0], str)


def test_text_rules(extractor):
    body = "".join(f"<p>Para {i} with <b>bold</b>word, enough &amp; more&nbsp;text\n  to be  kept here.<br>Line two of it.</p>" for i in range(4))
    got = extractor.texts([f"<html><head><title>t</title><style>x</style></head><body><nav><a href=/>Home</a></nav><article><h1>Title &lt;1&gt;</h1>{body}</article><footer>&copy; me</footer></body></html>"])[0]
    assert got == "Title <1> " + " ".join(f"Para {i} with boldword, enough & more text to be kept here. Line two of it." for i in range(4))


def test_long_page(extractor):
    """Position and counts by tag mean the same beside several hundred siblings as beside a few."""
    paragraphs = [f"<p>Paragraph {i} says a few things, at some length, about number {i}.</p>" for i in range(400)]
    advert, foot = '<div class="ad"><a href="/buy">Buy this now</a></div>', "<footer>&copy; the owner of this page</footer>"
    page = Page(f"<body>{''.join(paragraphs[:300])}{advert}{''.join(paragraphs[300:])}{advert}{foot}</body>")
    x = page.features({})
    body = page.tag.index("body")
    kids = page.order[body]
    place, alike, beside, last = (x[[k - 1 for k in kids], NAMES.index(name)] for name in ("place", "alike", "beside", "last"))
    tags = [page.tag[k] for k in kids]
    assert len(kids) == 403 and place.tolist() == [i / 403 for i in range(403)] and last.tolist() == [0] * 402 + [1]
    assert alike.tolist() == [tags.count(t) / 403 for t in tags]
    for i in (0, 1, 300, 301, 401, 402):
        near = [page.chars[s] for s in kids[max(0, i - 3) : i + 4] if s != kids[i]]
        assert beside[i] == pytest.approx(np.log1p(np.mean(near)))
    got = extractor.texts([f"<body>{''.join(paragraphs[:300])}{advert}{''.join(paragraphs[300:])}{advert}{foot}</body>"])[0]
    assert got == " ".join(p[3:-4] for p in paragraphs)


def labellings(page, logp, k=0):
    """(log probability, nodes whose text is taken) of every labelling of the nodes with text below k, without contradictions."""
    kids = [c for c in page.order[k] if page.chars[c]]
    own = lambda label: logp[k - 1, label] if k else 0.0
    whole = lambda c, label: [c] + [d for x in page.order[c] if page.chars[x] for d in whole(x, label)]
    below = lambda label: sum(logp[d - 1, label] for c in kids for d in whole(c, label))
    out = [(own(h.LEAVE) + below(h.LEAVE), frozenset()), (own(h.TAKE) + below(h.TAKE), frozenset(whole(k, 0)))] if k or not kids else []
    if kids:
        for parts in product(*(labellings(page, logp, c) for c in kids)):
            out.append((own(h.MIXED) + sum(p for p, _ in parts), frozenset().union(*(t for _, t in parts))))
    return out


def test_decoding_is_the_most_likely_labelling():
    rng = np.random.default_rng(8)
    small = ["<p>a", "<div><p>a</p>b<p>c</div>", "<div><ul><li>a<li>b</ul></div>x", "a<div>b<p>c</p></div><div><div>d</div></div>", "<article><h1>t</h1><p>x</p></article><footer>y</footer>"]
    for html in small:
        page = Page(html)
        x = page.features({})
        for _ in range(200):
            logp = np.log(rng.dirichlet([1, 1, 1], len(x)))
            main = h._decode(page, logp)
            best = max(labellings(page, logp))[1]
            for k in range(1, len(page.tag)):
                if page.chars[k] and not any(page.chars[c] for c in page.order[k]):
                    assert main[k] == (k in best)


def test_subtree_sums_against_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(20):
        page = Page(h.unmarked(h.synthetic_page(rng)))
        x = page.features({"<p>": -1.0, "nav": 2.0})
        under = {k: [k] for k in range(len(page.tag))}
        for k in range(len(page.tag) - 1, 0, -1):
            under[page.parent[k]] += under[k]
        for k in range(1, len(page.tag)):
            size = sum(len(t.strip()) for node, t, _ in page.pieces if node in under[k])
            row = dict(zip(NAMES, x[k - 1], strict=True))
            siblings = [page.tag[s] for s in page.order[page.parent[k]]]
            i = page.order[page.parent[k]].index(k)
            assert page.chars[k] == size and row["chars"] == pytest.approx(np.log1p(size)) and row["nodes"] == pytest.approx(np.log1p(len(under[k])))
            group = lambda t: _TAG_GROUP.get(t, "other")
            assert row["alike"] == pytest.approx([group(t) for t in siblings].count(group(page.tag[k])) / len(siblings))
            assert row["like_before"] == float(i > 0 and group(siblings[i - 1]) == group(page.tag[k])) and row["place"] == pytest.approx(i / len(siblings))


HOSTILE = {"quote": '<a "x ', "value": '<a x="', "div": "<div>", "end": "<b></i>", "p": "<div><p></span>", "cell": "<table><tr><td></i>", "item": "<ul><li></b>", "less": "<", "comment": "<!--"}


@pytest.mark.parametrize("name", HOSTILE)
def test_steps_are_linear(name):
    """Ten times the markup takes about ten times as long, and a megabyte some seconds at most."""
    took = []
    for size in (100_000, 1_000_000):
        html = HOSTILE[name] * (size // len(HOSTILE[name])) + "x"
        began = time.process_time()
        Page(html).features({})
        took.append(time.process_time() - began)
    assert took[1] < 12 and took[1] < 30 * took[0] + 0.5


def paragraphs(n):
    return [f"Paragraph {i} says a few things, at some length, about the number {i} and what it means." for i in range(n)]


BOXES = {
    "meaningless notice": '<div class="css-9z">We use cookies to improve your visit. Accept all cookies.</div>', "notice with button": '<div class="css-9z"><p>We use cookies.</p><button>Accept</button></div>', "linked advert": '<div><a href="/buy">Buy cheap shoes now</a></div>',
    "aside": "<aside><p>Something else here to read.</p></aside>", "named advert": '<div class="ad">Buy this now.</div>', "newsletter": '<div class="newsletter"><p>Sign up for our newsletter.</p><form><input><button>Go</button></form></div>',
    "links": '<section class="x1"><h3>Read more</h3><ul><li><a href=a>One thing</a></li><li><a href=b>Two thing</a></li></ul></section>',
    "comments": '<div id="c9"><h3>Comments</h3><div class=u1><b>Joe</b><p>Nice one indeed, I liked it.</p></div><div class=u1><b>Ann</b><p>Not me at all.</p></div></div>',
}


@pytest.mark.parametrize("name", BOXES)
def test_boxes_whose_names_say_nothing(extractor, name):
    ps = paragraphs(6)
    page = "<html><body><nav><a href=/>Home</a> <a href=/b>B</a></nav><article><h1>Title of it</h1>%s</article>%s<footer>&copy; me</footer></body></html>"
    as_html = [f"<p>{p}</p>" for p in ps]
    inside = page % ("".join(as_html[:3]) + BOXES[name] + "".join(as_html[3:]), "")
    assert extractor.texts([inside if name != "comments" else page % ("".join(as_html), BOXES[name])])[0] == "Title of it " + " ".join(ps)


def test_newsletter_box_of_a_long_page(extractor):
    ps = paragraphs(170)
    as_html = [f"<p>{p}</p>" for p in ps]
    for box in ("<div class=newsletter><p>Sign up for our newsletter.</p></div>", "<div class=box3><p>Sign up for our newsletter.</p><form><input type=email><button>Subscribe</button></form></div>"):
        assert extractor.texts([f"<body><main>{''.join(as_html[:160])}{box}{''.join(as_html[160:])}</main></body>"])[0] == " ".join(ps)


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "u", "<p>" + "long " * 100_000), (3, "u", "<p>x</p>"), (None, "u", "plain")], "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS __text")
    out = h.extract(pages)
    assert out.columns == ["page_id", "url", "__text", "text"] and out.count() == 5
    assert {r.text for r in out.filter("url IS NULL OR page_id = 1").collect()} == {""}
    assert h.extract(pages.limit(0)).count() == 0


def test_boosting_learns_a_rule():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 5))
    y = np.where(x[:, 0] > 0.3, 2, np.where(x[:, 1] * x[:, 0] > 0, 1, 0))
    found = Boosted(3, rounds=12).fit(x[:1500], y[:1500]).log_probabilities(x[1500:]).argmax(axis=1)
    assert (found == y[1500:]).mean() > 0.9
