"""Main text of web pages: boosted trees over DOM nodes, hierarchical decoding.

1. Training pages. No page is labelled, so texts of a bounded sample of pages
   (``FIT_PAGES``) are dressed in random page layouts (menus, headers, notices,
   adverts, forms, sidebars, comments, footers; semantic, plain or meaningless
   markup; broken and cut pages), where each block's label is known.
2. Gradient-boosted trees learn, per block element, whether its subtree belongs
   to the main text, from tags, attribute tokens, text, link and tag density,
   depth and siblings (``dom.features``).
3. Each page is decoded as a tree: an element is out with all below it, in with
   all below it, or left to its children (``dom.chosen``), so no descendant
   contradicts its ancestor.

Defined cases: a null or empty page, or one without text, gives the empty text;
a page without markup is one block; repeated rows are extracted alike; an empty
table gives no rows. All white space of Unicode counts as white space.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import dom
from cadenza.llm.boosting import Boosted
from cadenza.llm.common import body, table, text_chunks

FIT_PAGES, FIT_PAGE_CHARS, LAYOUTS = 200, 65_536, 900


class _Layout:
    """Random pages of known main text."""

    def __init__(self, paragraphs: list[str], seed: int):
        self.r = random.Random(seed)
        self.paragraphs = paragraphs
        self.words = sorted({w for p in paragraphs for w in p.split()}) or ["text"]

    def phrase(self, low: int, high: int) -> str:
        return " ".join(self.r.choice(self.words) for _ in range(self.r.randint(low, high))).strip()

    def paragraph(self) -> str:
        p = self.r.choice(self.paragraphs).split()
        if self.r.random() < 0.3 and len(p) > 8:
            p = p[:self.r.randint(2, len(p))]
        return " ".join(p)

    def element(self, tags: list[str], names: list[str], inner: str) -> str:
        """One of the tags, named tellingly, or not at all, or by a meaningless name."""
        tag = self.r.choice(tags)
        name = self.r.choice(names)
        style = self.r.random()
        if tag not in ("div", "section", "td") and style < 0.6:
            attrs = ""
        elif style < 0.85:
            attrs = f' {self.r.choice(["class", "class", "id"])}="{name}"'
        else:
            attrs = f' class="c{self.r.randint(100, 999)}"'
        return f"<{tag}{attrs}>{inner}</{tag}>"

    def links(self, n: int) -> str:
        items = [f'<a href="/{self.r.randint(1, 9999)}">{self.phrase(1, 4)}</a>' for _ in range(n)]
        if self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return self.r.choice([" | ", " ", ""]).join(items)

    def boiler(self, kind: str) -> str:
        r, e = self.r, self.element
        if kind == "menu":
            return e(["nav", "nav", "div"], ["menu", "nav", "navbar", "main-nav"], self.links(r.randint(3, 9)))
        if kind == "header":
            inner = r.choice([f"<h1>{self.phrase(1, 3)}</h1>", f"<p>{self.phrase(2, 6)}</p>", self.phrase(2, 5)])
            return e(["header", "header", "div"], ["header", "masthead", "top"],
                     inner + (self.boiler("menu") if r.random() < 0.5 else ""))
        if kind == "notice":
            text = r.choice([self.phrase(4, 14), self.paragraph()])
            return e(["div", "div", "aside", "section"], ["cookie-notice", "notice", "consent", "popup", "alert"],
                     f"<p>{text}</p>" + ("<button>OK</button>" if r.random() < 0.5 else ""))
        if kind == "ad":
            text = r.choice([self.phrase(2, 12), self.phrase(2, 12), self.paragraph()])
            return e(["div", "div", "div", "aside"], ["ad", "advert", "banner", "sponsored", "promo", "ads"],
                     r.choice([text, f"<p>{text}</p>", f'<a href="#">{text}</a>']))
        if kind == "form":
            return e(["form", "form", "div"], ["newsletter", "search", "subscribe", "login", "contact"],
                     f"<p>{self.phrase(3, 12)}</p><label>{self.phrase(1, 2)}</label><input name=q>"
                     f"<button>{self.phrase(1, 2)}</button>")
        if kind == "sidebar":
            inner = f"<h3>{self.phrase(1, 3)}</h3>" + r.choice(
                [self.links(r.randint(2, 7)), f"<p>{self.phrase(5, 25)}</p>", f"<p>{self.paragraph()}</p>"])
            return e(["aside", "aside", "div"], ["sidebar", "widget", "rail", "side"], inner)
        if kind == "related":
            return e(["section", "div", "aside"], ["related", "recommended", "share", "social", "popular"],
                     f"<h3>{self.phrase(1, 3)}</h3>" + self.links(r.randint(2, 6)))
        if kind == "comments":
            each = [e(["div", "li", "article", "section"], ["comment", "reply"],
                      f"<p>{self.phrase(1, 2)}</p><p>{self.paragraph()}</p>") for _ in range(r.randint(1, 6))]
            return e(["section", "div", "div"], ["comments", "comments", "responses", "discussion"],
                     r.choice(["", f"<h2>{self.phrase(1, 2)}</h2>", f"<h3>{self.phrase(1, 2)}</h3>"]) + "".join(each))
        text = "&copy; " + r.choice([self.phrase(2, 14), self.paragraph()])
        return e(["footer", "footer", "footer", "div"], ["footer", "bottom", "copyright", "legal"],
                 r.choice([text, f"<p>{text}</p>", self.links(3) + text]))

    def page(self) -> tuple[str, set[str]]:
        """(html, the main text's pieces)."""
        r = self.r
        main: set[str] = set()

        def said(text):
            main.add(" ".join(text.split()))
            return text

        parts = []
        if r.random() < 0.85:
            title = said(self.phrase(2, 12))
            h = f"<h1>{title}</h1>"
            parts.append(f"<header>{h}</header>" if r.random() < 0.15 else h)
        count = r.choice([1, 1, 2, 3, 5, 8, 13])
        for _ in range(count):
            kind = r.random()
            if kind < 0.72:
                text = said(self.paragraph() if count > 2 or r.random() < 0.5 else self.phrase(2, 12))
                parts.append(f"<p>{text}</p>" if r.random() < 0.8 else r.choice([f"<p><b>{text}<br>", f"<p>{text}"]))
            elif kind < 0.78:
                parts.append(f"<h2>{said(self.phrase(1, 6))}</h2>")
            elif kind < 0.84:
                parts.append("<ul>" + "".join(f"<li>{said(self.phrase(3, 20))}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.88:
                parts.append(f"<blockquote><p>{said(self.paragraph())}</p></blockquote>")
            elif kind < 0.91:
                parts.append("<table>" + "".join(f"<tr><td>{said(self.phrase(1, 4))}</td><td>{said(self.phrase(1, 4))}</td></tr>"
                                                 for _ in range(3)) + "</table>")
            elif kind < 0.93:
                parts.append(f"<figure><img src=x><figcaption>{said(self.phrase(3, 9))}</figcaption></figure>")
            elif kind < 0.95:
                parts.append(f"<div>{said(self.paragraph())}</div>")
            else:
                parts.append(self.boiler(r.choice(["ad", "ad", "related", "form", "notice"])))
        if r.random() < 0.12:
            parts.append(self.boiler(r.choice(["comments", "related", "form"])))
        names = ["content", "post", "article-body", "entry-content", "main", "story"]
        inner = self.element(["article", "article", "article", "main", "div", "div", "section"], names, "".join(parts))
        if r.random() < 0.3:
            inner = self.element(["main", "div", "section"], names + ["wrapper", "container"], inner)
        before = [k for k, c in (("notice", 0.2), ("header", 0.35), ("menu", 0.6), ("ad", 0.5), ("form", 0.1), ("sidebar", 0.15))
                  if r.random() < c]
        after = [k for k, c in (("ad", 0.2), ("related", 0.2), ("comments", 0.35), ("sidebar", 0.3), ("form", 0.2), ("notice", 0.1),
                                ("footer", 0.8)) if r.random() < c]
        if r.random() < 0.3:
            r.shuffle(before)
        out = "".join(map(self.boiler, before)) + inner + "".join(map(self.boiler, after))
        for _ in range(r.choice([0, 0, 1, 2])):
            out = f'<div class="{r.choice(["wrapper", "container", "page", "row"])}">{out}</div>'
        out = f"<!DOCTYPE html><html><head><title>{self.phrase(1, 5)}</title></head><body>{out}</body></html>"
        if r.random() < 0.1:
            out = out[:int(len(out) * r.uniform(0.6, 1.0))]
        return out, main


def train(pages: list[str], layouts: int = LAYOUTS, seed: int = 11) -> Boosted:
    """A model of ``layouts`` random pages with the paragraphs of ``pages``."""
    paragraphs = sorted({t for page in pages for x in dom.parse(page) if x.tag == "p" for _, t in x.pieces
                         if len(t) > 20})
    if len(paragraphs) < 20:  # too little to learn from: made-up prose
        r = random.Random(seed)
        vocabulary = ["".join(r.choice("aeioulnrst") for _ in range(r.randint(1, 9))) for _ in range(300)]
        paragraphs += [" ".join(r.choices(vocabulary, k=r.randint(4, 120))).capitalize() + "." for _ in range(200)]
    layout = _Layout(paragraphs, seed)
    rows, y, weight = [], [], []
    for _ in range(layouts):
        source, main = layout.page()
        nodes = dom.parse(source)
        inside, size = np.zeros(len(nodes)), np.zeros(len(nodes))
        for x in reversed(nodes):
            for _, t in x.pieces:
                size[x.order] += len(t)
                inside[x.order] += len(t) * (t in main)
            if x.parent:
                size[x.parent.order] += size[x.order]
                inside[x.parent.order] += inside[x.order]
        share = inside / np.maximum(size, 1)
        on = size > 0
        rows.append(dom.features(nodes)[on])
        y.append((share >= 0.5)[on])
        weight.append(np.abs(2 * share - 1)[on])
    return Boosted().fit(np.concatenate(rows), np.concatenate(y).astype(float), np.concatenate(weight) + 1e-3)


def extract(sources: list[str], model: Boosted) -> list[str]:
    """The main text of each page."""
    trees = [dom.parse(s) for s in sources]
    if not trees:
        return []
    p = model.predict(np.concatenate([dom.features(t) for t in trees]))
    at = np.cumsum([0] + [len(t) for t in trees])
    return ["\n".join(dom.chosen(t, p[a:b])) for t, a, b in zip(trees, at, at[1:], strict=False)]


def _sample(rows: DataFrame, most: int, chars: int = FIT_PAGE_CHARS) -> list[str]:
    """The pages with the least hashes: the hashes are chosen first, so that no
    task gathers more than ``most`` pages, however often one is repeated."""
    hashed = rows.where(F.length("text") <= chars).select("text", F.xxhash64("page_id", "text").alias("h"))
    least = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(most).collect()]
    if not least:
        return []
    found = hashed.where(F.col("h").isin(least)).dropDuplicates(["h"]).collect()
    return [r["text"] for r in sorted(found, key=lambda r: r["h"])]


def html_extract(pages: DataFrame, fit_pages: int = FIT_PAGES, fit_page_chars: int = FIT_PAGE_CHARS) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row. The model is fitted on at most
    ``fit_pages`` pages of at most ``fit_page_chars`` characters, which bounds what
    comes to the driver; every page is read in full."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        body(F.col("html")).alias("text"))
    model = train(_sample(rows, fit_pages, fit_page_chars))

    def run(batches):
        import pyarrow as pa
        for chunk in text_chunks(batches, 1 << 18):
            texts = extract(chunk.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("page_id"), chunk.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract(table(spark, sf_dir, "pages"))
