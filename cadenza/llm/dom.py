"""HTML to a tree of block elements, with features per element.

A small tree builder for main-text extraction: raw-text elements, drawings and
comments are skipped (an unclosed drawing ends where browsers leave it), formulas
are inline text, paragraphs and list items close as browsers close them, stray end
tags are ignored, an unfinished tag at the end is dropped. Inline markup belongs
to the block around it; a run of text between block boundaries is one piece.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|textarea|title)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<unquoted>svg|math|annotation(?:-xml)?)(?=[\s/>])[^>]*>"
    r"|<(?:[!?/][^>]*>|[a-zA-Z/!?][^>]*\Z)|[^<]+|<", re.S | re.I)
_FOREIGN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
BLOCKS = frozenset((
    "html body main article section div p ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre "
    "figure figcaption nav header footer aside form fieldset address details summary button select option label "
    "center dialog menu hgroup search").split()) | frozenset(HEADINGS)
#: A start tag of the key's group closes open elements of the value's, up to a list or table around them.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table select menu".split())
#: Elements without text of the page: drawings, and the sources of formulas.
SKIPPED = frozenset(("svg", "annotation", "annotation-xml"))
#: Start tags that end a drawing (HTML's list, and blocks), but not inside its HTML parts.
BREAKS = BLOCKS | frozenset("b big body br code em embed hr i img nobr ruby s small span strong strike sub sup tt u var".split())
HTML_PARTS = ("foreignobject", "desc", "title")
NO_PARAGRAPH = BLOCKS - {"html", "body", "label", "button", "option"}

#: Tag groups, one feature each.
TAGS = (("article",), ("main",), ("section",), ("div", "center"), ("p",), HEADINGS, ("ul", "ol", "dl", "menu"),
        ("li", "dt", "dd"), ("nav", "search"), ("header", "hgroup"), ("footer",), ("aside",),
        ("form", "fieldset", "button", "select", "option", "label"), ("table", "thead", "tbody", "tfoot", "tr"),
        ("td", "th", "caption"), ("blockquote", "pre"), ("figure", "figcaption"), ("address", "details", "summary", "dialog"))
#: Groups of attribute tokens, one feature each for an element and one for its ancestors.
TOKENS = (
    "article content post entry story body text main page-content prose markdown hentry".split(),
    "nav menu navbar navigation breadcrumb breadcrumbs pagination pager tabs toc toolbar".split(),
    "header masthead topbar top hero logo branding".split(),
    "footer bottom copyright legal colophon".split(),
    "sidebar side aside rail widget widgets complementary".split(),
    "ad ads advert advertisement banner sponsor sponsored promo promotion adsbygoogle dfp".split(),
    "cookie cookies consent notice notification alert popup modal overlay gdpr paywall dialog".split(),
    "comment comments reply replies respond disqus discussion thread reader responses".split(),
    "newsletter subscribe subscription signup login form search contact register".split(),
    "share sharing social follow related recommended recommendations more popular trending tags".split(),
)
_TAG_AT = {t: i for i, group in enumerate(TAGS) for t in group}
_TOKEN_AT = {t: i for i, group in enumerate(TOKENS) for t in group}


class Node:
    __slots__ = ("tag", "parent", "children", "tokens", "depth", "pieces", "links", "tags", "order")

    def __init__(self, tag, parent, tokens, order):
        self.tag, self.parent, self.tokens, self.order = tag, parent, tokens, order
        self.children: list[Node] = []
        self.depth = parent.depth + 1 if parent else 0
        self.pieces: list[tuple[int, str]] = []  # (place, text) of the element's own runs of text
        self.links = 0  # characters of own text inside links
        self.tags = 0  # inline tags among it


def attribute_tokens(attrs: str) -> frozenset[int]:
    found = set()
    for groups in _ATTRIBUTE.findall(attrs):
        for part in re.split(r"[^a-z0-9]+", "".join(groups).lower()):
            at = _TOKEN_AT.get(part, _TOKEN_AT.get(part.rstrip("s")))
            if at is not None:
                found.add(at)
    return frozenset(found)


def skipped(source: str, at: int, name: str, outside) -> int:
    """Where an element of ``SKIPPED`` ends whose start tag ends at ``at``: behind
    its end tag, or before a tag that browsers take out of it. ``outside`` tells
    whether a tag is open around it."""
    stack, held = [name], Counter([name])
    for m in _FOREIGN.finditer(source, at):
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["close"]:
            if held[tag] > 0:
                while True:
                    last = stack.pop()
                    held[last] -= 1
                    if last == tag:
                        break
                if not stack:
                    return m.end()
            elif tag in ("p", "br") or outside(tag):
                return m.start()
        elif tag in BREAKS and not any(held[x] > 0 for x in HTML_PARTS):
            return m.start()
        elif tag not in VOID and not m["attrs"].endswith("/"):
            stack.append(tag)
            held[tag] += 1
    return len(source)


def parse(source: str) -> list[Node]:
    """The block elements of a page in document order, the root first."""
    root = Node("body", None, frozenset(), 0)
    nodes, stack, inline = [root], [root], []
    opened = Counter()  # tags on the stack
    run: list[str] = []
    place = 0

    def flush():
        nonlocal place
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            stack[-1].pieces.append((place, text))
            place += 1

    def leave(depth):
        flush()
        opened.subtract(x.tag for x in stack[depth:])
        del stack[depth:]
        inline.clear()

    at = 0
    while at < len(source):
        m = _TOKEN.match(source, at)
        at = m.end()
        tag = m["tag"] or m["unquoted"]
        if tag is None:
            token = m[0]
            if token[0] != "<" or token == "<":
                run.append(token)
                if "a" in inline:
                    stack[-1].links += len(token)
            continue
        tag = tag.lower()
        if tag in ("html", "body", "head"):
            continue
        if m["close"]:
            if tag in BLOCKS:
                if opened[tag] > 0:
                    leave(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            elif tag in inline:
                del inline[len(inline) - 1 - inline[::-1].index(tag):]
            continue
        closed = (m["attrs"] or "").endswith("/")
        if tag in SKIPPED:
            if not closed:
                at = skipped(source, at, tag, lambda t: opened[t] > 0 or t in inline)
            continue
        if tag not in BLOCKS:
            stack[-1].tags += "math" not in inline  # a formula is one tag
            if tag == "br" or tag == "hr":
                run.append(" ")
            elif tag not in VOID and not closed:
                inline.append(tag)
            continue
        flush()
        inline.clear()
        if tag in NO_PARAGRAPH and stack[-1].tag == "p":
            leave(len(stack) - 1)
        elif tag in HEADINGS and stack[-1].tag in HEADINGS:
            leave(len(stack) - 1)
        if tag in CLOSES and any(opened[t] > 0 for t in CLOSES[tag]):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in CLOSES[tag]:
                    leave(i)
                    break
                if stack[i].tag in SCOPES:
                    break
        node = Node(tag, stack[-1], attribute_tokens(m["attrs"]), len(nodes))
        stack[-1].children.append(node)
        nodes.append(node)
        stack.append(node)
        opened[tag] += 1
    flush()
    return nodes


def features(nodes: list[Node]) -> np.ndarray:
    """One row per element: tags and attribute tokens of it and above it, subtree
    text, link and tag density, depth, and how it stands among its siblings."""
    n = len(nodes)
    own = np.array([sum(len(t) for _, t in x.pieces) for x in nodes], float)
    words = np.array([sum(t.count(" ") + 1 for _, t in x.pieces) for x in nodes], float)
    stops = np.array([sum(t.count(". ") + t.count(", ") + t.endswith((".", "!", "?")) for _, t in x.pieces)
                      for x in nodes], float)
    upper = np.array([sum(sum(map(str.isupper, t)) for _, t in x.pieces) for x in nodes], float)
    links = np.array([min(x.links, o) for x, o in zip(nodes, own, strict=True)], float)
    tags = np.array([1 + x.tags for x in nodes], float)
    pieces = np.array([len(x.pieces) for x in nodes], float)
    heading = np.array([x.tag == "h1" for x in nodes], float)
    blocks = np.ones(n)
    total = np.stack([own, words, stops, upper, links, tags, pieces, heading, blocks], 1)
    parent = np.array([x.parent.order if x.parent else -1 for x in nodes])
    for i in range(n - 1, 0, -1):
        total[parent[i]] += total[i]
    text, word, stop, up, link, tag, piece, h1, block = total.T
    width = len(TAGS) + len(TOKENS)  # of an element's kind; the same again for what is above it
    out = np.zeros((n, 2 * width + 24))
    above = [frozenset()] * n
    before = np.cumsum(own) - own
    whole = max(text[0], 1.0)
    base = 2 * width
    kind = []
    for i, x in enumerate(nodes):
        at = _TAG_AT.get(x.tag)
        kind.append([k + len(TAGS) for k in x.tokens] + ([] if at is None else [at]))
        out[i, kind[i]] = 1
        if i:
            above[i] = above[parent[i]].union(kind[parent[i]])
            out[i, [width + k for k in above[i]]] = 1
        tags_here = Counter(child.tag for child in x.children)
        for k, child in enumerate(x.children):
            c = child.order
            row = out[c, base:]
            row[0], row[1], row[2] = k, len(x.children), tags_here[child.tag]
            row[3] = k / len(x.children)
            row[4] = text[x.children[k - 1].order] if k else 0
            row[5] = text[x.children[k + 1].order] if k + 1 < len(x.children) else 0
            row[6] = (text[i] - text[c]) / max(1, len(x.children) - 1)
            row[7] = text[c] / max(text[i], 1)
            row[8] = h1[i] - h1[c]
    chars = np.maximum(text, 1)
    rest = np.stack([np.log1p(text), np.log1p(own), text / np.maximum(piece, 1), link / chars, tag / chars * 100,
                     stop / np.maximum(word, 1), up / chars, text / whole, before / whole, h1,
                     np.array([x.depth for x in nodes], float), block, np.log1p(word / np.maximum(block, 1)),
                     np.array([len(x.children) for x in nodes], float),
                     np.array([x.parent is not None and x.parent.tag == "body" for x in nodes], float)], 1)
    out[:, base + 9:] = rest
    return out


def chosen(nodes: list[Node], p: np.ndarray) -> list[str]:
    """The pieces of the main text, in page order, by hierarchical decoding.

    Each element is out with all below it, in with all below it, or left to its
    children (its own pieces are then in if it is likelier in than not). The
    best such labelling is found bottom-up; an element that is out can hold
    none that is in.
    """
    p = np.clip(p, 1e-4, 1 - 1e-4)
    size = np.array([sum(len(t) for _, t in x.pieces) for x in nodes], float)
    below = size.copy()
    for x in reversed(nodes):
        if x.parent:
            below[x.parent.order] += below[x.order]
    weight = np.where(size > 0, np.log2(2 + size), 0.5 * np.log2(2 + below))
    inside, outside, mixed = weight * np.log(p), weight * np.log(1 - p), np.zeros(len(nodes))
    best = np.zeros(len(nodes))
    for x in reversed(nodes):
        i = x.order
        kids = [c.order for c in x.children]
        mixed[i] = max(inside[i], outside[i]) if size[i] else weight[i] * np.log(0.5)
        if kids:
            mixed[i] += best[kids].sum() - 0.5
            inside[i] += inside[kids].sum()
            outside[i] += outside[kids].sum()
        best[i] = max(inside[i], outside[i], mixed[i])
    found: list[tuple[int, str]] = []

    def take(x):
        stack = [x]
        while stack:
            y = stack.pop()
            found.extend(y.pieces)
            stack.extend(y.children)

    todo = [nodes[0]]
    while todo:
        x = todo.pop()
        i = x.order
        if outside[i] >= best[i]:
            continue
        if inside[i] >= best[i]:
            take(x)
            continue
        if size[i] and p[i] > 0.5:
            found.extend(x.pieces)
        todo.extend(x.children)
    return [t for _, t in sorted(found)]
