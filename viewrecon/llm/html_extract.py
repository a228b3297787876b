"""Main text of web pages: boosted trees over DOM nodes, decoded so that no node contradicts its ancestors.

For each node the trees give the odds that all of its text is main text, none is, or its children differ.
They see how dense a subtree is in text, links, marks and paragraphs, its depth, its place among its siblings
and how alike and how long those are, and what the words of its class, id and role and its tag, and those of
its ancestors, said for being left out in other pages. Decoding takes the most likely labelling of the whole
tree in which below a node taken whole everything is taken and below a node left out nothing is. The trees and
the weights of names are trained here on pages that ``synthetic_page`` makes by rule, with known main text: many
layouts, telling, misleading, meaningless or no names, and markup as careless as that of the web. Training
depends on no input and is done once for each driver process.

The text: character references decoded, white space within a block one space, blocks in page order joined by
one space. Defined results: null or empty html, and html without text, give the empty text; repeated rows
are extracted alike; an empty table gives an empty result; unclosed, misnested and cut-off markup is read as
far as it goes, in time that grows with its length; columns beside the html pass through, whatever their
names, except that ``text`` takes the place of a column of that name.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from functools import lru_cache
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewrecon.llm.boosting import Boosted
from viewrecon.llm.dom import Page, features
from viewrecon.llm.names import spare, without

LEAVE, TAKE, MIXED = range(3)
PAGES, SEED = 1600, 3
#: Marks that synthetic pages carry in their text; from the private use area.
_MAIN, _REST = "\ue001", "\ue002"


def _decode(page: Page, logp: np.ndarray) -> list[bool]:
    """For each node whether its own text is main text. logp: a row for each node but the root."""
    n = len(page.tag)
    take, leave, best, mixed = [0.0] * n, [0.0] * n, [0.0] * n, [False] * n
    line = [0]
    for k in line:
        line.extend(page.order[k])
    for k in reversed(line):
        kids = [c for c in page.order[k] if page.chars[c]]
        if k:
            take[k], leave[k] = logp[k - 1, TAKE], logp[k - 1, LEAVE]
        for c in kids:
            take[k] += take[c]
            leave[k] += leave[c]
        best[k] = max(take[k], leave[k])
        if kids:
            split = (logp[k - 1, MIXED] if k else 0.0) + sum(best[c] for c in kids)
            if split > best[k] or not k:
                best[k], mixed[k] = split, True
    out = [False] * n
    todo = [(0, None)]
    while todo:
        k, given = todo.pop()
        if given is None and not mixed[k]:
            given = take[k] > leave[k]
        out[k] = bool(given)
        todo.extend((c, given) for c in page.order[k])
    return out


def text_of(page: Page, main: list[bool]) -> str:
    parts = [" " if node < 0 else text for node, text, _ in page.pieces if node < 0 or main[node]]
    return " ".join("".join(parts).split())


class Extractor:
    def __init__(self, trees: Boosted, weights: dict[str, float]):
        self.trees, self.weights = trees, weights

    def texts(self, pages: list[str]) -> list[str]:
        """The main text of each page; the trees run over the nodes of all pages together."""
        parsed = [Page(h) for h in pages]
        rows = features(parsed, self.weights)
        full = [r for r in rows if len(r)]
        logp = self.trees.log_probabilities(np.vstack(full)) if full else np.zeros((0, 3))
        out, at = [], 0
        for p, r in zip(parsed, rows, strict=True):
            out.append(text_of(p, _decode(p, logp[at : at + len(r)])))
            at += len(r)
        return out


# Synthetic pages


class _Maker:
    SYLLABLES = "an er in on re ti th ou es la de un ge sch lo mi ka ra vo tu pe si no ba al or en to me fi".split()

    def __init__(self, rng: np.random.Generator):
        self.rng = rng = random.Random(int(rng.integers(1 << 62)))
        self.named = rng.random()  # how telling names are on this page
        self.plain = rng.choice(["p", "p", "p", "p", "p", "p", "p", "p", "p", "div", "li"])  # what holds the article's paragraphs
        self.loose = rng.random() < 0.3  # careless markup
        self.gap = ["", "\n", "\n  ", " "][rng.randrange(4)]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def pick(self, options):
        return self.rng.choice(options)

    def words(self, low: int, high: int, stops: bool = True) -> str:
        out = []
        for _ in range(self.rng.randrange(low, high + 1)):
            word = "".join(self.pick(self.SYLLABLES) for _ in range(self.rng.randrange(1, 5)))
            if stops and self.chance(0.12):
                word += self.pick([".", ",", ".", "?", ":", ";"])
            out.append(word)
        text = " ".join(out)
        return escape(text.capitalize() + ("." if stops and self.chance(0.8) else ""), quote=False) + self.pick(["", "", "", " &amp; x", "&nbsp;y"])

    def mark(self, text: str, main: bool) -> str:
        return (_MAIN if main else _REST) + text

    def name(self, *options: str) -> str:
        """Attributes: a telling name, a meaningless one, or none."""
        r = self.rng.random()
        if r < 0.25 + 0.6 * self.named:
            word = self.pick(options)
            word = self.pick([word, word, f"{word}-{self.pick(['box', 'wrap', 'inner', 'area', 'block', '1'])}", f"site-{word}", f"{word}_{self.rng.randrange(99)}"])
        elif r < 0.9:
            word = self.blank()
        else:
            return ""
        return f' {self.pick(["class", "class", "id"])}="{word}"'

    def blank(self) -> str:
        """A name that says nothing."""
        letters = "".join(self.pick("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(self.rng.randrange(1, 7)))
        return self.pick([letters, f"css-{letters}", f"c{self.rng.randrange(1000)}", f"{letters}_{letters[:2]}", "wrap", "row", "box", "inner", "x", "block", "item", "col-md-4", "module"])

    def called(self, *options: str) -> str:
        """Attributes of a part that is not main text: mostly a telling name; else one that says nothing, or none."""
        r = self.rng.random()
        if r < 0.25 + 0.6 * self.named:
            return f' {self.pick(["class", "class", "id"])}="{self.pick(options)}"'
        return f' {self.pick(["class", "class", "id"])}="{self.blank()}"' if r < 0.8 else ""

    def inline(self, text: str) -> str:
        if not self.chance(0.35):
            return text
        words = text.split(" ")
        k = self.rng.randrange(len(words))
        tag = self.pick(["b", "i", "em", "strong", "a", "span", "code", "small"])
        extra = ' href="/x"' if tag == "a" else ""
        if self.chance(0.5):
            extra += f' class="{self.blank()}"'
        words[k] = f"<{tag}{extra}>{words[k]}" + ("" if self.loose and tag == "b" and self.chance(0.3) else f"</{tag}>")
        return " ".join(words)

    def p(self, main: bool, low: int = 8, high: int = 70) -> str:
        body = self.mark(self.inline(self.words(low, high)), main)
        if self.chance(0.12):
            body += "<br>" + self.mark(self.words(3, 20), main)
        attributes = self.pick(["", "", "", f' class="{self.pick(["p", "lead", "text", "c1"])}"'])
        tag = self.plain if main and self.plain == "div" else "p"
        if tag == "p" and self.loose and self.chance(0.4):
            return f"<p{attributes}>{body}{self.gap}"
        return f"<{tag}{attributes}>{body}</{tag}>{self.gap}"

    def links(self, low: int = 2, high: int = 9) -> str:
        items = [f'<a href="/{i}">{self.mark(self.words(1, 3, False), False)}</a>' for i in range(self.rng.randrange(low, high + 1))]
        kind = self.rng.randrange(4)
        if kind < 2:
            return "<ul>" + "".join(f"<li>{x}" + ("" if self.loose else "</li>") for x in items) + "</ul>"
        return (" | " if kind == 2 else " ").join(items) if kind == 2 else "".join(f"<div>{x}</div>" for x in items)

    # parts that are not main text

    def menu(self) -> str:
        tag = self.pick(["nav", "nav", "div", "ul-div"])
        attributes = self.name("nav", "menu", "navbar", "navigation", "main-menu", "breadcrumb")
        return f"<nav{attributes}>{self.links(3, 9)}</nav>" if tag == "nav" else f"<div{attributes}>{self.links(3, 9)}</div>"

    def head(self) -> str:
        tag = self.pick(["header", "header", "div"])
        inner = self.pick([f"<h1>{self.mark(self.words(1, 4, False), False)}</h1>", f'<a href="/">{self.mark(self.words(1, 3, False), False)}</a>', f"<div>{self.mark(self.words(1, 5, False), False)}</div>"])
        if self.chance(0.5):
            inner += f"<p>{self.mark(self.words(2, 9), False)}</p>"
        if self.chance(0.5):
            inner += self.menu()
        return f"<{tag}{self.name('header', 'masthead', 'site-header', 'top', 'logo', 'branding')}>{inner}</{tag}>"

    def foot(self) -> str:
        tag = self.pick(["footer", "footer", "footer", "div"])
        inner = self.pick([self.mark("&copy; " + self.words(2, 14), False), f"<p>{self.mark('&copy; ' + self.words(2, 16), False)}</p>", self.links(2, 7) + f"<p>{self.mark(self.words(3, 25), False)}</p>"])
        return f"<{tag}{self.name('footer', 'site-footer', 'copyright', 'bottom', 'colophon')}>{inner}</{tag}>"

    def advert(self) -> str:
        tag = self.pick(["div", "div", "aside", "section", "ins", "p"])
        text = self.mark(self.words(2, 28), False)
        inner = self.pick([text, text, f"<p>{text}</p>", f'<a href="/buy">{text}</a>', f"<h3>{text}</h3><p>{self.mark(self.words(3, 20), False)}</p>"])
        if tag == "p":
            inner = text
        names = self.called("ad", "ads", "advert", "banner", "sponsored", "promo", "ad-box", "advertisement") if tag != "p" else f' class="{self.pick(["ad", "ads", "advert", "sponsored", "promo"])}"'
        return f"{self.pick(['<!-- ad -->', ''])}<{tag}{names}>{inner}</{tag}>"

    def notice(self) -> str:
        tag = self.pick(["div", "section", "aside", "p"])
        text = self.mark(self.words(4, 35), False)
        inner = text if tag == "p" else self.pick([text, f"<p>{text}</p>", f"<p>{text}</p><button>{self.mark('Ok', False)}</button>", f"<h4>{self.mark(self.words(1, 4), False)}</h4><p>{text}</p>"])
        options = ("cookie", "cookie-notice", "notice", "newsletter", "consent", "subscribe", "alert", "popup", "gdpr-banner", "paywall", "disclaimer")
        names = self.called(*options) if tag != "p" else f' class="{self.pick(options)}"'
        return f"<{tag}{names}>{inner}</{tag}>"

    def form(self) -> str:
        fields = "".join(f"<label>{self.mark(self.words(1, 4, False), False)}</label><input name=\"x\">" for _ in range(self.rng.randrange(1, 4)))
        more = self.pick(["", f"<p>{self.mark(self.words(3, 20), False)}</p>", f"<select><option>{self.mark(self.words(1, 2, False), False)}<option>b</select>"])
        return f"<form{self.name('form', 'search', 'login', 'contact')}>{more}{fields}<button>{self.mark(self.words(1, 2, False), False)}</button></form>"

    def side(self) -> str:
        tag = self.pick(["aside", "aside", "div", "td-div"])
        tag = "div" if tag == "td-div" else tag
        blocks = [self.pick([lambda: f"<h3>{self.mark(self.words(1, 4, False), False)}</h3>{self.links()}", lambda: f"<div><h4>{self.mark(self.words(1, 3), False)}</h4><p>{self.mark(self.words(5, 40), False)}</p></div>", lambda: f"<p>{self.mark(self.words(5, 40), False)}</p>", self.advert])() for _ in range(self.rng.randrange(1, 4))]
        return f"<{tag}{self.name('sidebar', 'widget', 'aside', 'secondary', 'related', 'rail')}>{''.join(blocks)}</{tag}>"

    def comments(self) -> str:
        item, who = self.pick(["div", "div", "li", "li", "p", "p", "article"]), self.pick(["div", "span", "b"])
        rows = []
        for _ in range(self.rng.randrange(1, 7)):
            text = self.mark(self.words(4, 60), False)
            author = f"<{who} class=\"{self.pick(['author', 'user', 'by'])}\">{self.mark(self.words(1, 2, False), False)}</{who}>" if self.chance(0.6) else ""
            body = f"{author}{text}" if item == "p" else f"{author}<p>{text}</p>"
            rows.append(f"<{item}{self.called('comment', 'comment', 'reply', 'comment-body')}>{body}</{item}>")
        title = f"<h{2 + self.rng.randrange(2)}>{self.mark(self.pick(['Comments', 'Reader comments', 'Kommentare', '3 responses', 'Replies']), False)}</h3>".replace("<h2", "<h3") if self.chance(0.6) else ""
        inside = "".join(rows)
        inside = f"<ul>{inside}</ul>" if item == "li" else inside
        more = self.form() if self.chance(0.3) else ""
        tag = self.pick(["section", "div", "div", "aside"])
        return f"<{tag}{self.called('comments', 'comments', 'comment-list', 'responses', 'discussion', 'replies', 'reader-comments')}>{title}{inside}{more}</{tag}>"

    def share(self) -> str:
        return f"<div{self.called('share', 'social', 'share-buttons', 'follow')}>{self.links(2, 5)}</div>"

    def related(self) -> str:
        tag = self.pick(["div", "section", "aside"])
        return f"<{tag}{self.called('related', 'related-posts', 'recommended', 'more-stories', 'popular')}><h3>{self.mark(self.words(1, 4, False), False)}</h3>{self.links()}</{tag}>"

    def hidden(self) -> str:
        return self.pick(['<script>var t="</p>";track(1);</script>', "<style>p{margin:0}</style>", "<script>if (a < b) { c('<div>x</div>'); }</script>", "<noscript>Enable it</noscript>", "<!-- <p>no</p> -->"])

    # main text

    def article(self) -> str:
        blocks = []
        if self.chance(0.9):
            blocks.append(f"<h1>{self.mark(self.words(2, 14), True)}</h1>")
        for _ in range(self.pick([0, 1, 1, 2, 3, 4, 5, 6, 8, 10, 14, 20]) if self.chance(0.985) else self.rng.randrange(60, 400)):
            r = self.rng.random()
            if r < 0.72:
                blocks.append(self.p(True, *self.pick([(1, 6), (3, 20), (10, 60), (40, 160)])))
            elif r < 0.80:
                blocks.append(f"<h{2 + self.rng.randrange(3)}>{self.mark(self.words(1, 8), True)}</h2>".replace("<h3", "<h2").replace("<h4", "<h2"))
            elif r < 0.86:
                blocks.append("<ul>" + "".join(f"<li>{self.mark(self.inline(self.words(2, 18)), True)}" + ("" if self.loose else "</li>") for _ in range(self.rng.randrange(1, 6))) + "</ul>")
            elif r < 0.89:
                blocks.append(f"<blockquote>{self.pick([self.p(True), self.mark(self.words(5, 40), True)])}</blockquote>")
            elif r < 0.91:
                blocks.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.mark(self.words(1, 5, False), True)}</td>" for _ in range(3)) + "</tr>" for _ in range(self.rng.randrange(1, 4))) + "</table>")
            elif r < 0.93:
                blocks.append(f"<figure><img src=x><figcaption>{self.mark(self.words(3, 15), True)}</figcaption></figure>")
            elif r < 0.95:
                blocks.append(f"<pre>{self.mark(self.words(5, 30), True)}</pre>")
            elif r < 0.98:
                blocks.append(self.p(True))
            else:
                blocks.append(self.mark(self.words(8, 50), True) + "<br><br>")
        if not blocks:
            blocks.append(self.p(True))
        for part, p in ((self.advert, 0.3), (self.share, 0.12), (self.related, 0.12), (self.notice, 0.15), (self.side, 0.05), (self.form, 0.05), (self.hidden, 0.2)):
            if self.chance(p):
                blocks.insert(self.rng.randrange(1, len(blocks) + 1), part())
        if self.chance(0.1):
            blocks.append(self.comments())
        if self.chance(0.2):
            cut = self.rng.randrange(1, len(blocks) + 1)
            blocks = [*blocks[:cut], f"<section{self.name('section', 'text', 'body')}>", *blocks[cut:], "</section>"]
        return self.gap.join(blocks)

    def page(self) -> str:
        main = self.article()
        tag = self.pick(["article", "article", "article", "main", "div", "div", "section", "td", ""])
        if tag == "td":
            main = f"<table><tr><td{self.name('nav', 'side', 'left')}>{self.links()}</td><td{self.name('content', 'main', 'text')}>{main}</td></tr></table>"
        elif tag:
            attributes = self.name("content", "article", "post", "entry", "story", "post-body", "main") if tag not in ("article", "main") or self.chance(0.5) else ""
            main = f"<{tag}{attributes}>{main}</{tag}>"
        if self.chance(0.3):
            main = f"<div{self.name('content', 'main', 'container')}>{main}</div>"
        if self.chance(0.15):
            main = f"<main>{main}</main>"
        before = [f() for f, p in ((self.head, 0.5), (self.menu, 0.7), (self.notice, 0.25), (self.advert, 0.4), (self.form, 0.15), (self.side, 0.15), (self.hidden, 0.3)) if self.chance(p)]
        after = [f() for f, p in ((self.share, 0.2), (self.comments, 0.4), (self.related, 0.25), (self.advert, 0.3), (self.side, 0.3), (self.form, 0.2), (self.notice, 0.2), (self.foot, 0.8), (self.hidden, 0.2)) if self.chance(p)]
        if self.chance(0.3):
            self.rng.shuffle(before)
        body = self.gap.join([*before, main, *after])
        if self.chance(0.2):
            body = f"<div{self.name('wrapper', 'page', 'container')}>{body}</div>"
        head = f"<title>{self.words(2, 8)}</title>" + self.pick(["", "<meta charset=utf-8>", self.hidden()])
        html = f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"
        if self.loose and self.chance(0.4):
            html = html.replace("</body></html>", "")
        return html


def synthetic_page(rng: np.random.Generator) -> str:
    """A page whose text is marked, run by run, as main text or not."""
    return _Maker(rng).page()


def unmarked(html: str) -> str:
    return html.replace(_MAIN, "").replace(_REST, "")


def marked_text(html: str) -> str:
    """The main text that the marks of a synthetic page give."""
    page = Page(html)
    main = [False] * len(page.tag)
    for node, text, _ in page.pieces:
        if _MAIN in text:
            main[node] = True
    return unmarked(text_of(page, main))


def _labelled(html: str) -> tuple[Page, np.ndarray]:
    """A synthetic page without its marks, and its nodes' labels, -1 for those without text."""
    page = Page(html)
    n = len(page.tag)
    main, rest = [False] * n, [False] * n
    pieces = []
    for node, text, link in page.pieces:
        if node >= 0:
            main[node] |= _MAIN in text
            rest[node] |= _REST in text
        pieces.append((node, unmarked(text), link))
    page.pieces = pieces
    for k in range(n - 1, 0, -1):
        main[page.parent[k]] |= main[k]
        rest[page.parent[k]] |= rest[k]
    return page, np.array([-1 if not (main[k] or rest[k]) else MIXED if main[k] and rest[k] else TAKE if main[k] else LEAVE for k in range(1, n)])


def learned_names(pages: list[tuple[Page, np.ndarray]]) -> dict[str, float]:
    """For each name or tag that a few pages have at least the log odds of being left out, against those of all. A page counts once for each."""
    counts: dict[str, list[float]] = {}
    total = [1.0, 1.0]
    for page, labels in pages:
        once = {(w, int(y == LEAVE)) for k, y in enumerate(labels, 1) if y >= 0 for w in (*page.names[k], f"<{page.tag[k]}>")}
        for w, left in once:
            total[left] += 1
            counts.setdefault(w, [0.0, 0.0])[left] += 1
    prior = total[1] / sum(total)
    odds = lambda kept, left: math.log((left + 2 * prior) / (kept + 2 * (1 - prior))) - math.log(prior / (1 - prior))
    return {w: odds(*c) for w, c in sorted(counts.items()) if sum(c) >= 4}


@lru_cache(1)
def trained() -> tuple[Boosted, dict[str, float]]:
    """The trees, and the weights of names. Trees learn from weights that other pages gave, as unseen pages have them."""
    rng = np.random.default_rng(SEED)
    pages = [_labelled(synthetic_page(rng)) for _ in range(PAGES)]
    x, y = [], []
    for half in (0, 1):
        weights = learned_names(pages[1 - half :: 2])
        for rows, (_, labels) in zip(features([p for p, _ in pages[half::2]], weights), pages[half::2], strict=True):
            x.append(rows[labels >= 0])
            y.append(labels[labels >= 0])
    return Boosted(3).fit(np.vstack(x), np.concatenate(y)), learned_names(pages)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without ``html`` and with ``text``, which replaces a column of its name; all others pass through."""
    rest = without(pages.columns, (html, "text"))
    src = pages.select(*(F.col(f"`{c}`") for c in rest), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias(spare(rest, "whole")))
    model = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(*model)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = extractor.texts([h.as_py() for h in part.column(len(rest))])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.string())], [*rest, "text"])

    return src.mapInArrow(run, T.StructType([*src.schema.fields[:-1], T.StructField("text", T.StringType())]))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.char_length("text").cast("long"))
