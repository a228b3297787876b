"""A tolerant parser from HTML to the nodes that extraction decides on, and their features."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import lru_cache
from html import unescape

import numpy as np

#: A tag, a value's quotes respected, or not; nothing is tried twice, so a failure costs one pass.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)>""", re.S)
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_OPENS = re.compile(r"<(?=/?[a-zA-Z]|[!?])")
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|aria-label|hidden|style)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKEN = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。]")

#: Fixed values of HTML: elements without content, with raw content, and those within a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea svg math iframe object select canvas audio video title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var button".split())
#: What an opening tag ends if it is open within the same container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
_SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
#: Cells, out of which only the closing tags of what holds tables reach; opening tags that end all cells and rows that are open.
_CELLS, _OUTER, _ROWS = ("td", "th", "table"), frozenset("table tr tbody body html div article main section".split()), frozenset("tr tbody tfoot thead".split())

TAGS = ("p", "heading", "list", "item", "link", "nav", "header", "footer", "aside", "article", "main", "section", "div", "form", "table", "cell", "figure", "quote", "text", "body", "other")
_TAG_GROUP = {t: g for g, names in {"p": "p", "heading": "h1 h2 h3 h4 h5 h6 hgroup", "list": "ul ol dl menu", "item": "li dt dd", "link": "a", "nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "article": "article", "main": "main", "section": "section", "div": "div center", "form": "form fieldset button input label legend", "table": "table tbody thead tfoot tr", "cell": "td th", "figure": "figure figcaption caption", "quote": "blockquote pre", "text": "#text", "body": "body html"}.items() for t in names.split()}
_INDEX = {t: TAGS.index(g) for t, g in _TAG_GROUP.items()}
_OTHER = TAGS.index("other")
_CONTROLS = frozenset("button label fieldset input option".split())


@lru_cache(50_000)
def names(attributes: str) -> tuple[str, ...]:
    """The words, lower-cased, of an element's class, id, role, itemprop and label."""
    found = []
    for m in _ATTRIBUTE.finditer(attributes):
        if m[1].lower() not in ("hidden", "style"):
            found += (w.lower() for w in _TOKEN.findall(m[2] or m[3] or m[4] or ""))
    return tuple(dict.fromkeys(found))


class Page:
    """Nodes in page order: elements that hold lines, and runs of text beside other nodes.

    ``pieces``: (node, text, whether in a link) in page order, and (-1, "", False) where a line ends; ``names``: the
    words of each node's attributes.
    """

    def __init__(self, html: str):
        self.tag, self.parent, self.names = ["#root"], [-1], [()]
        self.pieces: list[tuple[int, str, bool]] = []
        stack: list[tuple[str, int]] = [("#root", 0)]
        places: dict[str, list[int]] = {}  # where in the stack a name is, lowest first
        links, at, n, fold, tag = 0, 0, len(html), None, _TAG

        def text(raw: str) -> None:
            if raw:
                self.pieces.append((stack[-1][1], unescape(raw) if "&" in raw else raw, links > 0))

        def top(names: Iterable[str]) -> int:
            """The highest place in the stack that one of the names has, 0 if none."""
            return max((places[x][-1] for x in names if places.get(x)), default=0)

        def pop_to(k: int) -> None:
            nonlocal links
            for name, _ in stack[k:]:
                links -= name == "a"
                places[name].pop()
                if name not in INLINE:
                    self.pieces.append((-1, "", False))
            del stack[k:]

        while at < n:
            o = _OPENS.search(html, at)
            if o is None:
                text(html[at:])
                break
            text(html[at : o.start()])
            at = o.start()
            if html[at + 1] in "!?":
                comment = html.startswith("<!--", at)
                end = html.find("-->" if comment else ">", at + 4 * comment)
                at = n if end < 0 else end + (3 if comment else 1)
                continue
            m = tag.match(html, at)
            if m is None and tag is _TAG:  # a quote is never closed: from here on quotes don't count
                tag = _LOOSE_TAG
                m = tag.match(html, at)
            if m is None:  # cut off within a tag
                break
            at = m.end()
            name = m[2].lower()
            if m[1]:
                if name == "p" and not places.get("p"):
                    self.pieces.append((-1, "", False))
                if at_name := places.get(name):
                    if stack[-1][0] == name or name in _OUTER or at_name[-1] >= top(_CELLS):
                        pop_to(at_name[-1])
                continue
            if name in RAW:
                if not m[3].endswith("/"):
                    if fold is None:
                        fold = html.lower()
                    if len(fold) != n:  # a letter whose lower case is longer: look in the text itself
                        end = re.compile(rf"</{name}", re.I).search(html, at)
                        end = end.start() if end else -1
                    else:
                        end = fold.find(f"</{name}", at)
                    at = n if end < 0 else (html.find(">", end) + 1 or n)
                continue
            if name in VOID:
                if name in ("br", "hr"):
                    self.pieces.append((-1, "", False))
                continue
            if name not in INLINE:
                if at_name := places.get("p"):
                    pop_to(at_name[-1])
                if name in CLOSES:
                    while (k := top(CLOSES[name])) > top(_SCOPE[name]):
                        pop_to(k)
                        if name not in _ROWS:
                            break
                self.pieces.append((-1, "", False))
            node = stack[-1][1]
            if name not in INLINE or name == "button":
                node = len(self.tag)
                self.tag.append(name)
                self.parent.append(stack[-1][1])
                self.names.append(names(m[3]) if m[3].strip() else ())
            links += name == "a"
            places.setdefault(name, []).append(len(stack))
            stack.append((name, node))
        self._split()

    def _split(self) -> None:
        """Text beside child nodes becomes a node of its own, one for each run."""
        has_child = [False] * len(self.tag)
        for p in self.parent[1:]:
            has_child[p] = True
        last, out = None, []
        for node, text, link in self.pieces:
            if node >= 0 and has_child[node]:
                if text.strip():
                    if last is None or self.parent[last] != node:
                        last = len(self.tag)
                        self.tag.append("#text")
                        self.parent.append(node)
                        self.names.append(())
                    out.append((last, text, link))
                else:
                    out.append((last if last is not None and self.parent[last] == node else node, text, link))
                continue
            if node >= 0:
                last = None
            out.append((node, text, link))
        self.pieces = out

    def features(self, weights: Mapping[str, float]) -> np.ndarray:
        """One row for each node but the root; see NAMES."""
        return features([self], weights)[0]


def features(pages: Sequence[Page], weights: Mapping[str, float]) -> list[np.ndarray]:
    """For each page a row for each of its nodes but the root; see NAMES. Whole arrays hold the nodes of all pages together.

    weights: what a name, or a tag in angle brackets, says for being left out. Sets ``chars`` and ``order`` of the pages.
    """
    if not pages:
        return []
    begins = np.cumsum([0, *(len(p.tag) for p in pages)]).tolist()
    n = begins[-1]
    own, linked, marks, words, before = [0] * n, [0] * n, [0] * n, [0] * n, [-1] * n
    below, depth, place, kids = [1] * n, [0] * n, [0] * n, [0] * n
    at, free, parent = list(range(n)), list(range(1, n + 1)), [-1] * n
    known: dict[tuple[str, tuple[str, ...]], tuple[float, ...]] = {}
    name, path = [(0.0,) * 6] * n, [(0.0, 0.0, 0.0)] * n
    for page, begin in zip(pages, begins, strict=False):
        seen = 0
        for node, text, link in page.pieces:
            if node < 0 or not (size := len(text.strip())):
                continue
            k = node + begin
            if before[k] < 0:
                before[k] = seen
            own[k] += size
            if link:
                linked[k] += size
            marks[k] += len(_PUNCTUATION.findall(text))
            words[k] += text.count(" ") + 1
            seen += size
        page.order = order = [[] for _ in page.tag]
        for i in range(1, len(page.tag)):
            up, k = page.parent[i], begin + i
            p = parent[k] = begin + up
            depth[k] = depth[p] + 1
            place[k] = len(order[up])
            order[up].append(i)
            look = (page.tag[i], page.names[i])
            if (says := known.get(look)) is None:
                some = [weights[w] for w in look[1] if w in weights]
                by_tag = weights.get(f"<{look[0]}>", 0.0)
                says = known[look] = (sum(some), max(some, default=0.0), min(some, default=0.0), 2.0 if some else 1.0 if look[1] else 0.0, max([by_tag, *some]), min([by_tag, *some]))
            name[k] = says
            most, least, _ = path[p]
            high, low = says[4], says[5]
            path[k] = (high if high > most else most, low if low < least else least, high if abs(high) > abs(low) else low)
    for k in range(n - 1, 0, -1):  # a node comes after its parent
        p = parent[k]
        if p >= 0:
            below[p] += below[k]
            kids[p] += 1
            if before[k] >= 0 and (before[p] < 0 or before[k] < before[p]):
                before[p] = before[k]
    for k in range(n):  # places in preorder, so that a subtree is a stretch
        p = parent[k]
        if p >= 0:
            at[k] = free[p]
            free[p] += below[k]
            free[k] = at[k] + 1
    at, below, kids, depth, place, before, up, name, path = (np.array(x) for x in (at, below, kids, depth, place, before, parent, name, path))
    tags = [t for page in pages for t in page.tag]
    tag = np.array([_INDEX.get(t, _OTHER) for t in tags])

    def whole(values: Sequence[int] | np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        dealt = np.zeros(n + 1, np.int64)
        dealt[at + 1] = values
        total = np.cumsum(dealt)
        return total[at + below] - total[at]

    own = np.array(own)
    chars, linked, marks, words = (whole(x) for x in (own, linked, marks, words))
    paragraphs, controls = whole(tag == TAGS.index("p")), whole([t in _CONTROLS for t in tags])
    page_of = np.repeat(np.arange(len(pages)), np.diff(begins))
    root = np.array(begins[:-1])[page_of]
    some = np.bincount(page_of, (name[:, 2] < -1) | np.isin(tag, (TAGS.index("article"), TAGS.index("main"))))[page_of] > 0
    c, k = chars.astype(float), np.flatnonzero(up >= 0)
    for page, a, b in zip(pages, begins, begins[1:], strict=False):
        page.chars = chars[a:b].tolist()
    x = np.zeros((len(k), len(NAMES)))
    if len(k):
        p, here = up[k], np.arange(len(k))
        looks: dict[tuple, int] = {}
        look = np.array([looks.setdefault((t, w), len(looks)) for page in pages for t, w in zip(page.tag, page.names, strict=True)])
        share = [_like(p, kind[k], kids[p]) for kind in (tag, look)]
        row = np.argsort(p * n + place[k], kind="stable")  # siblings beside each other
        line, siblings, spot = c[k][row], kids[p][row], place[k][row]
        total = np.concatenate([[0.0], np.cumsum(line)])
        low, high = here - np.minimum(spot, 3), here + np.minimum(siblings - 1 - spot, 3) + 1
        beside, same = np.empty(len(k)), np.zeros((len(k), 2))
        beside[row] = (total[high] - total[low] - line) / np.maximum(1, high - low - 1)
        ordered = tag[k][row]
        alike = (ordered[1:] == ordered[:-1]) & (spot[1:] > 0)
        same[row[1:], 0], same[row[:-1], 1] = alike, alike
        at_least, log = np.maximum(1, c), np.log1p
        whole_page = np.maximum(1, c[root[k]])
        x[here, tag[k]] = 1
        numbers = (
            *name[k].T, *path[p].T, same[:, 0], same[:, 1], share[1], log(controls[k]),
            depth[k], log(below[k]), log(kids[k]), log(own[k]), log(c[k]), c[k] / below[k] / 100, linked[k] / at_least[k], c[k] / whole_page,
            np.maximum(0, before[k]) / whole_page, log(paragraphs[k]), paragraphs[k] / np.maximum(1, paragraphs[root[k]]), 100 * marks[k] / at_least[k], c[k] / np.maximum(1, words[k]),
            log(kids[p]), place[k] / kids[p], share[0], log(beside),
            linked[p] / at_least[p], c[p] / whole_page, some[k], place[k] == kids[p] - 1, linked[k] == chars[k], log(words[k]),
        )
        for i, values in enumerate(numbers, len(TAGS)):
            x[:, i] = values
    return [x[a - i : b - i - 1] for i, (a, b) in enumerate(zip(begins, begins[1:], strict=False))]


def _like(parent: np.ndarray, kind: np.ndarray, siblings: np.ndarray) -> np.ndarray:
    """Of each node's parent the share of children of the node's kind."""
    _, which, counts = np.unique(parent * (int(kind.max()) + 1) + kind, return_inverse=True, return_counts=True)
    return counts[which] / siblings


NUMBERS = (
    "name_sum", "name_most", "name_least", "named", "says_most", "says_least", "path_most", "path_least", "parent_says", "like_before", "like_after", "same_look", "controls",
    "depth", "nodes", "children", "own", "chars", "density", "links", "share", "before", "paragraphs", "paragraph_share", "marks", "word_length", "siblings", "place", "alike", "beside",
    "parent_links", "parent_share", "named_content", "last", "all_links", "words",
)
NAMES = (*TAGS, *NUMBERS)
