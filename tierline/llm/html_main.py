"""Main text of HTML pages by minimum-cut labelling.

A page is read into blocks: runs of text between block-level tags, each with
its chain of enclosing elements.  A linear classifier over element kinds,
class and id words, link density and length gives every block a score; its
positive part is the capacity from the content terminal, its negative part the
capacity to the boilerplate terminal.  A word that names boilerplate counts
against the text below it only if the page's own text is elsewhere: an element
that outweighs all text outside it is a wrapper (see release).  Neighbours in page order, and blocks
that follow each other under one parent, are tied by smoothness edges that weaken
with their distance in the document tree and with a contrast of their elements.  The minimum cut (Dinic's
maximum flow) separates content from boilerplate.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[/a-zA-Z][^>]*\Z""", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

_RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes"}
_SKIP = {"head", "template", "svg", "math", "object", "canvas", "audio", "video"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd",
          "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
          "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend",
          "li", "main", "menu", "nav", "noscript", "ol", "optgroup", "option", "p", "pre", "search",
          "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
_SCOPE = {"ul", "ol", "dl", "table", "div", "article", "section", "body", "main", "aside", "nav",
          "form", "footer", "header", "blockquote", "td", "th", "button", "fieldset", "details"}

#: Classifier weights, in log-odds of content.
_PENALTY_TAG = {"nav": 9.0, "footer": 9.0, "aside": 9.0, "menu": 9.0, "dialog": 9.0,
                "button": 9.0, "select": 9.0, "search": 9.0}
#: Elements that some servers wrap whole pages in: judged by their share of the
#: text, like those whose class is a penalty word.
_JUDGED_TAG = {"form", "fieldset", "noscript"}
_PENALTY_WORDS = {
    "ad", "ads", "adv", "advert", "advertisement", "advertising", "sponsor", "sponsored", "promo",
    "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "sidebar",
    "comment", "comments", "reply", "replies", "disqus", "share", "sharing", "social", "related",
    "recommended", "breadcrumb", "breadcrumbs", "menu", "nav", "navbar", "navigation", "footer",
    "login", "signin", "signup", "subscribe", "subscription", "newsletter", "popup", "modal",
    "overlay", "widget", "pagination", "pager", "toolbar", "masthead", "complementary",
    "contentinfo", "skip"}
_CONTENT_WORDS = {"article", "content", "post", "entry", "story", "main", "maintext"}
_W = {"words": 8.0, "hidden": 9.0, "region": 2.5, "named": 1.5, "outside": 2.0,
      "links": 4.0, "heading": 0.5, "length": 0.5, "length_bias": 0.3, "length_top": 2.0}
_NEXT, _SIBLING = 0.6, 1.0
#: How many times the text outside an element with a penalty word must be
#: outweighed to make it a wrapper: if a class is just that word ("sidebar"),
#: if a class mentions it ("has-sidebar"); by what these change if only one
#: side has an article, main or h1.
_PURE, _MENTION, _MARKED_IN, _MARKED_OUT = 10.0, 2.0, 1 / 8, 4.0


class _Frame:
    __slots__ = ("tag", "up", "depth", "penalty", "region", "skip", "link", "word", "pure")

    def __init__(self, tag: str, attrs: str, up: "_Frame | None"):
        self.tag, self.up = tag, up
        self.depth = up.depth + 1 if up else 0
        self.penalty = up.penalty if up else 0.0
        self.region = up.region if up else 0.0
        self.skip = (up.skip if up else False) or tag in _SKIP
        self.link = (up.link if up else False) or tag == "a"
        # The innermost element with a penalty word, itself included.
        self.word = up.word if up else None
        self.pure = tag in _JUDGED_TAG
        if self.pure:
            self.word = self
        self.penalty = max(self.penalty, _PENALTY_TAG.get(tag, 0.0))
        if tag == "header":
            # An article's own header holds its title; a page header does not.
            self.penalty = max(self.penalty, 0.0 if self.region >= _W["region"] else 9.0)
        if tag in ("article", "main"):
            self.region = max(self.region, _W["region"])
        if attrs and not attrs.isspace():
            self._attributes(attrs)

    def _attributes(self, attrs: str) -> None:
        named, tokens = set(), []
        for name, value in _ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id", "role", "itemprop"):
                tokens += [{w.lower() for w in _PART.findall(t)} for t in value.split()]
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or \
                    name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                self.penalty = max(self.penalty, _W["hidden"])
        if self.tag in ("body", "html"):
            return
        named.update(*tokens)
        bad = _PENALTY_WORDS if self.region else _PENALTY_WORDS | {"header"}
        if named & bad:
            self.pure = self.pure or any(t and t <= bad for t in tokens)
            # <article class="post comments-open"> is a post with a state.
            if self.pure or self.tag not in ("article", "main") or \
                    not any(t and t <= _CONTENT_WORDS for t in tokens):
                self.word = self
        if named & _CONTENT_WORDS:
            self.region = max(self.region, _W["named"])


class _Block:
    __slots__ = ("text", "link", "frame", "heading")

    def __init__(self, text: str, link: float, frame: _Frame, heading: bool):
        self.text, self.link, self.frame, self.heading = text, link, frame, heading


def blocks_of(page: str) -> list[_Block]:
    """Text blocks in page order; references decoded, white space single."""
    out: list[_Block] = []
    top = _Frame("html", "", None)
    here, parts, linked = top, [], 0

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                frame, heading = here, False
                while frame.up and frame.tag not in _BLOCK:
                    frame = frame.up
                heading = len(frame.tag) == 2 and frame.tag[0] == "h" and frame.tag[1] in "123456"
                out.append(_Block(text, min(1.0, linked / len(text)), frame, heading))
        parts, linked = [], 0

    def add(raw: str):
        nonlocal linked
        if raw and not here.skip:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if here.link:
                linked += len(text.strip())

    def close(tags, scope=()):
        """Leave the innermost open element of ``tags``, not beyond scope."""
        nonlocal here
        f = here
        while f.up and f.tag not in tags:
            if f.tag in scope:
                return
            f = f.up
        if f.up:
            here = f.up

    at = 0
    while (m := _TAG.search(page, at)) is not None:
        add(page[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, closing, attrs = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if tag in _BLOCK:
            flush()
        elif tag == "br":
            parts.append(" ")
        if closing:
            close({tag})
        elif tag in _RAW:
            # Raw text: nothing but its own end tag is a tag.
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            if end is None:
                at = len(page)
                break
            at = _TAG.match(page, end.start()).end()
        elif tag not in _VOID:
            if tag in _BLOCK:
                close({"p"}, _SCOPE)
            if tag in _CLOSES:
                close(_CLOSES[tag], _SCOPE - {"td", "th"} if tag == "tr" else _SCOPE - _CLOSES[tag])
            if tag not in ("html", "body") or attrs:
                here = _Frame(tag, "" if attrs.endswith("/") and not attrs[:-1].strip() else attrs, here)
    add(page[at:])
    flush()
    return out


def release(blocks: list[_Block]) -> None:
    """Apply the penalty words and judged tags, except those of wrappers.

    The element with such a word or tag that outweighs the free text most is a
    wrapper if it outweighs it at all; its own text is free from then on, and
    the elements with such words inside it are judged in turn.
    """
    size: dict[_Frame | None, list[float]] = {None: [0.0, False]}  # own text, marked
    for b in blocks:
        f = b.frame.word
        while f is not None and f not in size:
            size[f] = [0.0, False]
            f = f.up.word
        if b.frame.penalty < _W["words"]:
            own = size[b.frame.word]
            own[0] += len(b.text) * (1 - b.link)
            own[1] = own[1] or b.frame.region >= _W["region"] or b.heading and b.frame.tag == "h1"
    inside: dict[_Frame, list[_Frame]] = {}
    whole = {f: list(v) for f, v in size.items()}
    for f in sorted((f for f in size if f is not None), key=lambda f: -f.depth):
        up = f.up.word
        inside.setdefault(up, []).append(f)
        if up is not None:
            whole[up][0] += whole[f][0]
            whole[up][1] = whole[up][1] or whole[f][1]
    free, marked = size[None]
    wrappers, waiting = {None}, inside.get(None, [])

    def weight(f: _Frame) -> float:
        k = _PURE if f.pure else _MENTION
        if whole[f][1] != marked:
            k *= _MARKED_IN if whole[f][1] else _MARKED_OUT
        return whole[f][0] / k

    while waiting:
        best = max(waiting, key=weight)
        if weight(best) <= free:
            break
        wrappers.add(best)
        free, marked = free + size[best][0], marked or size[best][1]
        waiting = [f for f in waiting if f is not best] + inside.get(best, [])
    for b in blocks:
        if b.frame.word not in wrappers:
            b.frame.penalty = max(b.frame.penalty, _W["words"])


def score(b: _Block, has_region: bool) -> float:
    f = b.frame
    s = f.region - f.penalty - _W["links"] * b.link
    if has_region and not f.region:
        s -= _W["outside"]
    s += min(_W["length_top"], _W["length"] * math.log1p(len(b.text.split())) - _W["length_bias"])
    return s + (_W["heading"] if b.heading else 0.0)


def _apart(a: _Frame, b: _Frame) -> int:
    """Steps between two elements of the tree."""
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.up
        else:
            b = b.up
        n += 1
    return n


def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) of a minimum cut; ties go to boilerplate."""
    n = len(scores)
    src, snk = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to, cap = [], []

    def edge(a, b, c, back):
        graph[a].append(len(to))
        to.append(b), cap.append(c)
        graph[b].append(len(to))
        to.append(a), cap.append(back)

    for i, s in enumerate(scores):
        if s > 0:
            edge(src, i, s, 0.0)
        elif s < 0:
            edge(i, snk, -s, 0.0)
    for a, b, w in edges:
        edge(a, b, w, w)
    eps = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[src] = 0
        queue = deque([src])
        while queue:
            u = queue.popleft()
            for e in graph[u]:
                if cap[e] > eps and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[snk] < 0:
            return [level[i] >= 0 for i in range(n)]
        it = [0] * (n + 2)
        path: list[int] = []
        u = src
        while True:  # blocking flow, depth first without recursion
            if u == snk:
                push = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= push
                    cap[e ^ 1] += push
                path, u = [], src
                continue
            while it[u] < len(graph[u]):
                e = graph[u][it[u]]
                if cap[e] > eps and level[to[e]] == level[u] + 1:
                    break
                it[u] += 1
            if it[u] < len(graph[u]):
                path.append(graph[u][it[u]])
                u = to[path[-1]]
            elif path:
                level[u] = -1
                u = to[path.pop() ^ 1]
            else:
                break


def main_text(page: str | None) -> str:
    """The main text of one page (null: empty); blocks joined by blank lines."""
    blocks = blocks_of(page or "")
    release(blocks)
    # A teaser's article tag does not make text elsewhere an outsider.
    has_region = any(b.frame.region >= _W["region"] and b.frame.penalty < _W["words"] for b in blocks)
    scores = [score(b, has_region) for b in blocks]
    edges, last = [], {}

    def tie(i: int, j: int, weight: float):
        # Weaker across a contrast: an advert does not pull its neighbours down.
        contrast = abs(blocks[i].frame.penalty - blocks[j].frame.penalty)
        edges.append((i, j, weight / (1 + contrast)))

    for i, b in enumerate(blocks):
        if i:
            tie(i - 1, i, _NEXT / (1 + _apart(blocks[i - 1].frame, b.frame) / 2))
        parent = id(b.frame.up)
        if parent in last:
            tie(last[parent], i, _SIBLING / (i - last[parent]))
        last[parent] = i
    keep = min_cut(scores, edges)
    return "\n\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``.

    Null or empty html gives empty text; repeated rows each get theirs; other
    columns are never read.
    """
    out = T.StructType([pages.schema["page_id"], pages.schema["url"],
                        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column("html")]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    return pages.select("page_id", "url", "html").mapInArrow(run, out)


def op7_html_main(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return extract(pages)
