"""Main text of web pages by tree scoring.

Each paragraph gives points for its length and its commas to its ancestors,
less the farther they are; a container's points are discounted by the share of
its text that stands in links.  The best container and the siblings that look
like it are kept, without what is marked as something other than the article:
menus, page headers, footers, sidebars, notices, adverts, forms and comments.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NAMES = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")

#: Elements of the HTML standard by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template svg math xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
CLOSES_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: An element that begins closes one of these that is open, up to the element that bounds it.
SAME = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
DROPPED = frozenset("nav footer aside button select option menu dialog object audio video canvas input head".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Words of a class or id that mark what isn't the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar aside footer foot "
    "comment comments commentlist respond replies discussion disqus cookie cookies consent gdpr notice notices notification alert popup modal overlay lightbox newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations outbrain taboola widget widgets pagination pager toolbar skip rss copyright disclaimer form search hidden".split()
)
#: Those of them that also name pages and parts of pages in which an article may stand.
LOOSE = frozenset(
    "banner promo promotion foot notice notices notification alert popup modal overlay lightbox sidebar share sharing social related recommended recommendations widget widgets "
    "subscription signup login toolbar copyright disclaimer form search hidden".split()
)
#: Words that say where or in what shape something stands; what else stands beside a mark in a name is a subject, and the name may be the article's.
PLACES = frozenset(
    "site main page left right top bottom upper lower first last list lists item items area areas slot box bar block wrap wrapper container section inner outer row col column grid layout panel group button buttons "
    "link links icon icons post posts entry unit units primary secondary global local mobile desktop sticky fixed js the ul li div nofollow inline small large wide".split()
)
#: Words that say that what follows them is absent or elsewhere, and a last word that does so for what comes before.
NEGATIONS, FREE = frozenset("no not non without has have with hide hides is".split()), "free"
#: A marked element holds the page's article if what else there is has less than this share of its points.
ELSE = 0.25
#: Points that a paragraph of fifty characters has; less than that beside a surely marked element is no article.
NOTHING = 1.5
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEADS = frozenset("header masthead topbar".split())
PARAGRAPHS = frozenset("p pre td blockquote dd li h1 h2 h3 h4 h5 h6 div section article main body figcaption".split())
KEPT_SIBLINGS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 ul ol dl table figure".split())
LINKED = frozenset("ul ol dl table div section".split())


class _Page:
    """Elements in page order, as parallel lists; a parent comes before its children."""

    def __init__(self, text: str):
        self.tag, self.parent, self.attributes, self.runs = ["#root"], [0], [{}], []
        stack, at, end = [0], 0, len(text)
        while at < end:
            m = _TOKEN.search(text, at)
            self._text(stack[-1], text[at : m.start() if m else end])
            if not m:
                break
            at = m.end()
            close, name, rest = m[1] or m[4], (m[2] or m[5] or "").lower(), m[3] or m[6] or ""
            if not name:
                continue
            if close:
                self._close(stack, name)
                continue
            self._open(stack, name, rest)
            if name in RAW and not rest.endswith("/"):
                stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(text, at)
                at = stop.end() if stop else end
                stack.pop()
            elif name in VOID:
                stack.pop()
                if name in ("br", "hr"):
                    self.runs.append((stack[-1], " "))

    def _text(self, node: int, text: str) -> None:
        if text:
            self.runs.append((node, html.unescape(text)))

    def _open(self, stack: list[int], name: str, rest: str) -> None:
        if name in CLOSES_P:
            self._leave(stack, {"p"}, {"td", "th", "button", "table", "object", "article", "section", "div", "main", "body"})
        if name in SAME:
            self._leave(stack, *SAME[name])
        self.tag.append(name)
        self.parent.append(stack[-1])
        self.attributes.append({k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(rest)} if rest.strip() else {})
        stack.append(len(self.tag) - 1)
        if name not in INLINE:
            self.runs.append((stack[-1], None))

    def _leave(self, stack: list[int], names: set[str], bounds: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if self.tag[stack[i]] in names:
                self._cut(stack, i)
                return
            if self.tag[stack[i]] in bounds:
                return

    def _cut(self, stack: list[int], i: int) -> None:
        del stack[i:]
        self.runs.append((stack[-1], None))

    def _close(self, stack: list[int], name: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            own = self.tag[stack[i]]
            if own == name:
                if name in INLINE:
                    del stack[i:]
                else:
                    self._cut(stack, i)
                return
            if name in INLINE and own not in INLINE:
                return  # a formatting end tag doesn't end a block


NONE, LOOSELY, SURELY, GONE = range(4)


def _names(value: str) -> list[list[str]]:
    """The words of each class name in ``value``, without those that are said to be absent."""
    out = []
    for name in value.split():
        words = [w for w in _NAMES.split(name) if w]
        if FREE not in words[-1:]:
            out.append(words[: next((i for i, w in enumerate(words) if w in NEGATIONS), None)])
    return out


def _mark(tag: str, attributes: dict[str, str], inside: bool) -> int:
    """How an element is marked as something other than the article; ``inside``: it is within an article.

    A name marks surely only if nothing in it is a subject: "menu" and
    "left-menu" do, "menu-food" may be an article about food.
    """
    if tag in DROPPED or tag in RAW:
        return GONE
    loose = tag == "form" or (tag == "header" and not inside)
    if attributes and tag not in ("html", "body", "main"):
        if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", ""):
            return GONE
        loose = loose or attributes.get("role") in ROLES
        for words in _names(attributes.get("class", "")) + _names(attributes.get("id", "")):
            marks = [w for w in words if w in MARKS]
            subject = any(w not in MARKS and w not in PLACES and not w.isdigit() for w in words)
            if marks and not subject and any(w not in LOOSE for w in marks):
                return SURELY
            if marks and not (subject and inside) or (not inside and not HEADS.isdisjoint(words)):
                loose = True
    return LOOSELY if loose else NONE


def _total(parent: list[int], values: list[float], out: list[bool]) -> list[float]:
    """Sums of ``values`` over subtrees, without the subtrees that are ``out``."""
    whole = list(values)
    for i in range(len(parent) - 1, 0, -1):
        if not out[i]:
            whole[parent[i]] += whole[i]
    return whole


def _drop(page: _Page, mark: list[int], inside: list[bool], points: list[float]) -> list[bool]:
    """Which elements go: those marked, but for those that the points say hold the article or a part of it."""
    n, tag, parent = len(page.tag), page.tag, page.parent
    gone = [m == GONE for m in mark]
    dropped = [m != NONE for m in mark]
    if any(NONE < m < GONE for m in mark):
        whole = _total(parent, points, gone)
        # Only an element with half of all points may hold the article in spite of its name, or one with the only article.
        small = [dropped[i] and whole[i] < 0.5 * whole[0] for i in range(n)]
        rest = _total(parent, points, small)
        told = _total(parent, [0.0 if tag[i] in HEADINGS else p for i, p in enumerate(points)], small)
        articles = [float(tag[i] in ("article", "main") and not dropped[i]) for i in range(n)]
        held = _total(parent, articles, gone)
        for i in range(1, n):
            if LOOSELY <= mark[i] <= SURELY:
                alone = held[i] > 0 and held[i] == held[0]
                most = not small[i] and rest[i] > 0
                kept = most and told[0] - told[i] < NOTHING and held[i] == held[0]  # no other paragraph could be the article
                if mark[i] == LOOSELY:
                    kept = kept or most and rest[0] - rest[i] < ELSE * rest[i] or inside[parent[i]] and whole[i] >= 1
                dropped[i] = not (alone or kept)
    for i in range(1, n):
        dropped[i] = dropped[i] or dropped[parent[i]]
    return dropped


def extract(text: str | None) -> str:
    """The main text of one page: its blocks, trimmed, one space between any two words."""
    if not text:
        return ""
    page = _Page(text)
    n = len(page.tag)
    tag, parent = page.tag, page.parent
    inside, gone, linked, mark = [False] * n, [False] * n, [False] * n, [NONE] * n
    for i in range(1, n):
        up = parent[i]
        mark[i] = _mark(tag[i], page.attributes[i], inside[up])
        gone[i] = gone[up] or mark[i] == GONE
        inside[i] = inside[up] or tag[i] in ("article", "main")
        linked[i] = linked[up] or tag[i] == "a"
    # Own text of each block: a run belongs to the nearest element that isn't inline.
    block = [0] * n
    for i in range(1, n):
        block[i] = block[parent[i]] if tag[i] in INLINE else i
    length, links, commas = [0] * n, [0] * n, [0] * n
    for i, run in page.runs:
        if run and not gone[i]:
            size = len(run.strip())
            length[block[i]] += size
            commas[block[i]] += run.count(",")
            if linked[i]:
                links[block[i]] += size
    points = [0.0] * n
    for i in range(1, n):
        if length[i] and tag[i] in PARAGRAPHS:
            points[i] = (length[i] >= 25) + commas[i] + min(length[i] / 100, 3) + 0.01
    dropped = _drop(page, mark, inside, [p * (1 - links[i] / length[i]) if p else 0.0 for i, p in enumerate(points)])
    score = [0.0] * n
    for i in range(1, n):
        if dropped[i]:
            length[i] = links[i] = 0
        elif points[i]:
            up = i if tag[i] in ("div", "section", "article", "main", "body", "td") else parent[i]
            far = 1
            while up and far < 6:
                score[up] += points[i] / (far if far < 3 else 3 * (far - 1))
                up, far = parent[up], far + 1
    whole, linkage = length[:], links[:]
    for i in range(n - 1, 0, -1):
        whole[parent[i]] += whole[i]
        linkage[parent[i]] += linkage[i]
    share = [linkage[i] / whole[i] if whole[i] else 0.0 for i in range(n)]
    for i in range(1, n):
        score[i] *= 1 - share[i]
        if tag[i] in ("article", "main"):
            score[i] = 1.5 * score[i]
    best = max(range(n), key=lambda i: (score[i], -i))
    if score[best] <= 0:
        best = next((i for i in range(n) if tag[i] == "body"), 0)
    up = best
    while up:  # the article around the best part of it
        if tag[up] in ("article", "main"):
            best = up
        up = parent[up]
    keep = [False] * n
    keep[best] = True
    for i in range(1, n):
        if best and parent[i] == parent[best] and tag[best] not in ("body", "html", "main"):
            # A part of a split article may be short: it looks like the best part, or it counts by itself.
            alike = share[i] < 0.5 and score[i] >= max(1.0, 0.2 * score[best]) or share[i] < 0.25 and tag[i] == tag[best] and page.attributes[i].get("class") == page.attributes[best].get("class") and mark[i] == NONE
            keep[i] = keep[i] or alike or (tag[i] in KEPT_SIBLINGS and tag[best] != "article" and share[i] < 0.25)
    for i in range(1, n):
        keep[i] = (keep[i] or keep[parent[i]]) and not dropped[i]
        if keep[i] and i != best and tag[i] in LINKED and share[i] > 0.6 and not inside[i]:
            keep[i] = False
            dropped[i] = True
        elif dropped[parent[i]]:
            dropped[i], keep[i] = True, False
    out = [" " if run is None else run for i, run in page.runs if run is None or keep[i]]
    return " ".join("".join(out).split())


def main_text(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` -> page_id, url, text, n_chars.

    Null and empty html, and pages without an article, give an empty text; a
    page of any length is read whole, in one task.  Repeated rows and null
    page_ids give rows of their own; no rows give none; other columns are
    ignored, whatever their names.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            text = [extract(h) for h in f["html"]]
            yield pd.DataFrame({"page_id": f["page_id"], "url": f["url"], "text": text, "n_chars": [len(t) for t in text]})

    slim = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html")
    return slim.mapInPandas(read, "page_id string, url string, text string, n_chars long").withColumn("page_id", F.col("page_id").cast("long"))
