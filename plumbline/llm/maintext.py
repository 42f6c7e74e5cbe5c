"""Main text of web pages: flat blocks classified by a decision tree over their own and their neighbours' features."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: Elements whose content is no text of the page: those that hold no tags, and others.
PLAIN = ("script", "style", "title", "textarea")
RAW = ("noscript", "template", "iframe", "svg", "annotation-xml", "annotation", "object", "select", "button", "canvas", "video", "audio")
#: Elements that hold blocks; those that mark their content as surroundings, and those that mark it as the article.
HOLDERS = frozenset("body main article section div nav header footer aside form ul ol dl table menu dialog figure details blockquote fieldset".split())
SURROUND = frozenset("nav footer aside form menu dialog".split())
ARTICLE = frozenset("article main".split())
BLOCKS = HOLDERS | frozenset("html head p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody caption pre hr address figcaption summary legend center option".split())
#: Words in class, id and role that mark surroundings, and those that mark the article.
SURROUND_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidebars rail nav navigation navbar menu menus breadcrumb breadcrumbs "
    "footer header masthead topbar cookie cookies consent notice notices alert gdpr popup modal overlay newsletter subscribe subscription signup login search share sharing "
    "social related recommended recommendations comment comments commentlist disqus reply replies respond widget widgets toolbar pagination pager copyright legal disclaimer tags "
    "complementary contentinfo navigation form skip".split())
ARTICLE_NAMES = frozenset("article content post entry story body main text".split())

#: Words that turn a name around: such a class tells how the page is laid out, not what the element holds.
LAYOUT_NAMES = frozenset("no not non has have with without enabled disabled hide off".split())

#: A block of this many words is long; more words tell no more.
LONG = 30
FEATURES = ["surround", "header", "article", "beside_article", "heading", "words", "links", "words_before", "links_before", "words_after", "links_after"]

_ATTRIBUTES = r"(?![\w-])(?>(?:[^>\"'/]++|/(?!>)|\"[^\"]*+\"|'[^']*+')*+)"
#: A plain element that closes itself still has content if its closing tag comes before the next one of its name. Another one without a
#: closing tag ends at the next block.
_DROPPED = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(" + "|".join(PLAIN) + r")" + _ATTRIBUTES + r"(?:/>(?!(?:(?!<\1(?![\w-])).)*?</\1\s*>)|/?>.*?(?:</\1\s*>|\Z))"
    r"|<(" + "|".join(RAW) + r")" + _ATTRIBUTES + r"(?:/>|>(?:(?:(?!<\2(?![\w-])).)*?</\2\s*>|.*?(?=<\2(?![\w-])|</?(?:" + "|".join(sorted(BLOCKS - {"option"})) + r")(?![\w-])|\Z)))", re.S | re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[/a-zA-Z][^>]*\Z")
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HIDDEN = re.compile(r"\bhidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block(NamedTuple):
    text: str
    words: int
    links: float
    surround: int
    header: int
    article: int
    heading: int


def _names(attributes: str) -> set[str]:
    out: set[str] = set()
    for value in _NAMED.findall(attributes):
        for name in value.split():
            words = {p.lower() for p in _PART.findall(name)}
            if not words & LAYOUT_NAMES:
                out |= words
    return out


class Marks(NamedTuple):
    """What an element tells of all it holds; weak: told by a name, or by a form, which may hold a whole page."""

    surround: int = 0
    header: int = 0
    article: int = 0
    weak: int = 0


NONE = Marks()


def _marks(tag: str, attributes: str) -> Marks:
    if tag in ("body", "html"):
        return NONE
    if tag in ARTICLE:
        return Marks(surround=1) if attributes and _names(attributes) & {"comment", "reply"} else Marks(article=1)
    if attributes:
        if _HIDDEN.search(attributes):
            return Marks(surround=1)
        names = _names(attributes)
        if names:
            article = names & ARTICLE_NAMES
            around = names & SURROUND_NAMES
            if around and not (article and around <= {"header", "sidebar", "rail"}):
                return Marks(header=1) if around == {"header"} else Marks(surround=1, weak=int(tag not in SURROUND or tag == "form"))
            if article and tag in HOLDERS:
                return Marks(article=1)
    return Marks(surround=int(tag in SURROUND), header=int(tag == "header"), weak=int(tag == "form"))


class _Page:
    """The blocks of a page with the tree of elements that hold them, each element known by its number and its parent's."""

    def __init__(self) -> None:
        self.tags, self.parents, self.marks = ["html"], [0], [NONE]
        self.found: list[tuple[str, int, float, int, Marks, bool, bool]] = []

    def holder(self, tag: str, marks: Marks, parent: int) -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        self.marks.append(marks)
        return len(self.tags) - 1

    def _inherited(self, void: set[int]) -> list[tuple[int, int, int]]:
        """(surround, header, article) of every element. Within an article, a header of its own holds the article's title."""
        out = [(0, 0, 0)]
        for i in range(1, len(self.tags)):
            out.append(self._below(out[self.parents[i]], self.marks[i], i in void))
        return out

    @staticmethod
    def _below(above: tuple[int, int, int], m: Marks, void: bool = False) -> tuple[int, int, int]:
        return above[0] | (m.surround and not void), 1 if m.header else 0 if m.article else above[1], above[2] | m.article

    def _wrappers(self) -> set[int]:
        """Elements marked as surroundings that hold the page itself: at least as many words as stand outside of all surroundings, and
        the page's first h1; or no page has an h1, or it is a form, and it holds the largest article, none of which stands outside."""
        weak = [i for i, m in enumerate(self.marks) if m.weak and m.surround]
        if not weak:
            return set()
        state = self._inherited(set())
        held = [0] * len(self.tags)
        outside, title = 0, None
        for _, n, _, at, own, _, h1 in self.found:
            held[at] += n
            outside += 0 if state[at][0] or own.surround else n
            title = at if h1 and title is None else title
        for i in range(len(held) - 1, 0, -1):
            held[self.parents[i]] += held[i]
        articles = [i for i, m in enumerate(self.marks) if m.article and held[i]]
        largest = None if any(not state[i][0] for i in articles) else max(articles, key=lambda i: held[i], default=None)

        def above(i: int | None) -> set[int]:
            out = set()
            while i:
                out.add(i)
                i = self.parents[i]
            return out

        of_title, of_article = above(title), above(largest)
        return {i for i in weak if held[i] >= max(outside, 1) and (i in of_title or (i in of_article and (title is None or self.tags[i] == "form")))}

    def blocks(self) -> list[Block]:
        state = self._inherited(self._wrappers())
        out = []
        for text, n, links, at, own, heading, _ in self.found:
            out.append(Block(text, n, links, *(int(x) for x in self._below(state[at], own)), int(heading)))
        return out


def blocks(html: str) -> list[Block]:
    """The page as flat blocks in its order. Comments, scripts, styles and other elements without text are left out; tags need not be
    closed; character references are decoded and white space is one blank."""
    html = _DROPPED.sub(" ", html) if "<" in html else html
    page = _Page()
    held = [0]
    parts: list[tuple[str, bool]] = []
    own = NONE
    heading = link = title = False

    def flush() -> None:
        nonlocal parts
        if parts:
            text = " ".join("".join(p for p, _ in parts).split())
            if text:
                n = text.count(" ") + 1
                linked = sum(len(p.split()) for p, a in parts if a)
                page.found.append((text, n, min(1.0, linked / n), held[-1], own, heading, title))
            parts = []

    at = 0
    for m in _TAG.finditer(html):
        if m.start() > at:
            raw = html[at:m.start()]
            parts.append((entities.unescape(raw) if "&" in raw else raw, link))
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue  # a tag that the end of the page cuts
        tag = tag.lower()
        closing = bool(m[1] or m[4])
        if tag == "a":
            link = not closing
        elif tag == "br":
            parts.append((" ", link))
        elif tag in BLOCKS:
            flush()
            heading, title, own = False, False, NONE
            if tag in HOLDERS:
                if not closing:
                    held.append(page.holder(tag, _marks(tag, m[3] if m[2] else m[6]), held[-1]))
                else:
                    for i in range(len(held) - 1, 0, -1):
                        if page.tags[held[i]] == tag:
                            del held[i:]
                            break
            elif not closing:
                attributes = m[3] if m[2] else m[6]
                heading = tag[0] == "h" and tag[1:].isdigit()
                title = tag == "h1"
                own = _marks(tag, attributes) if attributes.strip() else own
            if tag in ("nav", "article", "footer", "header", "aside", "main"):
                link = False
    if at < len(html):
        raw = html[at:]
        parts.append((entities.unescape(raw) if "&" in raw else raw, link))
    flush()
    return page.blocks()


def feature_rows(page: list[Block]) -> list[list[float]]:
    free = sum(b.words for b in page if not b.surround)
    share = sum(b.words for b in page if b.article and not b.surround) / max(free, 1)  # of the words not marked as surroundings, those in an article
    none = Block("", 0, 0.0, 0, 0, 0, 0)
    size = lambda b: float(min(b.words, LONG))
    out = []
    for i, b in enumerate(page):
        p, q = page[i - 1] if i else none, page[i + 1] if i + 1 < len(page) else none
        out.append([float(b.surround), float(b.header and not b.article), float(b.article), 0.0 if b.article else share, float(b.heading), size(b), b.links, size(p), p.links, size(q), q.links])
    return out


#: Small labelled pages: mN is a main block of N words, bN one of the surroundings, lN a link of N words.
LABELLED = [
    "<nav><ul><li>{l1}</li><li>{l1}</li><li>{l2}</li></ul></nav><div class=ad>{b7}</div><article><h1>{m6}</h1><p>{m60}</p><p>{m5}</p><p>{m2}</p><p>{m1}</p><p>{m90}</p></article><footer>{b9}</footer>",
    "<header><div>{b3}</div><nav>{l1} {l1} {l1}</nav></header><main><h1>{m9}</h1><p>{m40}</p><h2>{m3}</h2><p>{m70}</p><ul><li>{m8}</li><li>{m4}</li></ul></main><aside><h3>{b2}</h3><p>{b25}</p></aside><footer><p>{b14}</p></footer>",
    "<div class=cookie-notice><p>{b30}</p></div><article><header><h1>{m8}</h1></header><p>{m30}</p><blockquote>{m20}</blockquote><p>{m3}</p></article><section id=comments><h2>{b2}</h2><p>{b40}</p><p>{b12}</p></section><footer>{b5}</footer>",
    "<div id=top>{l2} {l1} {l2}</div><div><h1>{m7}</h1><p>{m55}</p><p>{m35}</p><p>{m80}</p></div><div>{l3} {l4}</div><div>{b4}</div>",
    "<ul><li>{l1}</li><li>{l2}</li></ul><h1>{m5}</h1><p>{m45}</p><p>{m12}</p><p>{m65}</p><ul><li>{l5}</li><li>{l6}</li><li>{l4}</li></ul><p>{b3}</p>",
    "<div class=sidebar><h3>{b2}</h3><ul><li>{l4}</li></ul><p>{b18}</p></div><div class=content><h1>{m10}</h1><p>{m25}</p><p>{m3}</p><form><p>{b9}</p></form><p>{m50}</p></div><div class='related posts'><p>{l7}</p><p>{b22}</p></div>",
    "<article><h1>{m4}</h1><p>{m15}</p><aside>{b20}</aside><p>{m33}</p><div class=ad>{b6}</div><p>{m7}</p><p>{m1}</p><div class=share>{b3}</div></article><div class=comments><p>{b28}</p><p>{b3}</p></div>",
    "<header><h1>{b3}</h1><p>{b6}</p></header><article><h2>{m6}</h2><p>{m100}</p><table><tr><td>{m2}</td><td>{m3}</td></tr></table></article><footer><p>{b35}</p><p>{l2}</p></footer>",
    "<article><p>{m3}</p></article><footer>{b3}</footer>",
    "<nav>{l1} {l1}</nav><article><h1>{m3}</h1><p>{m6} {l2} {m6}</p><p>{l5}</p><p>{m22}</p></article><div class=newsletter>{b16}</div>",
    "<p>{b4}</p><div>{l1}</div><div>{l2}</div><p>{m48}</p><p>{m52}</p><p>{m6}</p><p>{m71}</p><div>{l3}</div><p>{b2}</p>",
    "<div class=notice>{b12}</div><p>{m38}</p><p>{m27}</p><div class=banner><p>{b45}</p></div><p>{m44}</p>",
    "<form><p>{b60}</p></form><main><p>{m4}</p><p>{m2}</p><nav>{l3}</nav><p>{m85}</p></main>",
    "<div id=brand>{b2}</div><article><h1>{m7}</h1><p>{m44}</p><p>{m6}</p><p>{m61}</p></article><div>{b4}</div><p>{b3}</p>",
    "<p>{b5}</p><div>{l2}</div><main><h1>{m5}</h1><p>{m80}</p><h2>{m2}</h2><p>{m36}</p></main><div>{b25}</div><h3>{b3}</h3><p>{l4}</p>",
    "<div>{b2}</div><div>{l1}</div><div>{l1}</div><h1>{m8}</h1><p>{m33}</p><h2>{m3}</h2><p>{m58}</p><p>{m4}</p><p>{m41}</p><div>{l2}</div><div>{b3}</div><div>{l1}</div>",
    "<div>{l2}</div><div>{b3}</div><div>{l3}</div><p>{m37}</p><p>{m9}</p><p>{m29}</p><p>{m11}</p><p>{m64}</p><div>{l6}</div><div>{b6}</div><div>{l2}</div>",
    "<div class=text><p>{m12}</p></div><h1>{m6}</h1><p>{m90}</p><p>{m47}</p><p>{m3}</p><p>{m70}</p><div>{l3}</div><div>{b2}</div>",
    "<table><tr><td>{l1}</td><td>{l2}</td></tr></table><h1>{m4}</h1><p>{m24}</p><p>{m8} {l3} {m20}</p><p>{m66}</p><p>{l7}</p><p>{b2}</p>",
    "<div>{l4}</div><div>{l5}</div><div>{b4}</div><div>{l6}</div><h1>{m9}</h1><p>{m18}</p><p>{m52}</p><p>{m13}</p><p>{m46}</p>",
    "<div>{b16}</div><article><h1>{m6}</h1><p>{m21}</p><p>{m73}</p><p>{m11}</p><p>{m37}</p></article><div>{b31}</div><p>{b12}</p><div>{l5}</div>",
    "<p>{b42}</p><div class=post><h1>{m5}</h1><p>{m57}</p><p>{m36}</p><p>{m15}</p><ul><li>{m4}</li><li>{m7}</li></ul></div><p>{b18}</p><p>{b9}</p>",
    "<main><p>{m8}</p><p>{m36}</p><p>{m62}</p><p>{m2}</p><p>{m14}</p></main><div>{b22}</div><div>{b50}</div>",
    "<article><h1>{m5}</h1><p>{m36}</p><p>{m36}</p><p>{m81}</p><p>{m36}</p><p>{m25}</p></article><p>{b10}</p><div>{l3}</div>",
    "<div>{b3}</div><h1>{m6}</h1><p>{m40}</p><p>{m5}</p><p>{m75}</p><h2>{m4}</h2><p>{m30}</p><ul><li>{m5}</li><li>{m9}</li><li>{m3}</li></ul><p>{m28}</p><div>{l3}</div><div>{l2}</div><div>{b5}</div>",
    "<h1>{m5}</h1><p>{m60}</p><p>{m33}</p><p>{m8}</p><p>{m47}</p><section id=comments><h2>{b2}</h2><p>{b64}</p><p>{b31}</p><p>{b12}</p><p>{b90}</p></section><footer><p>{b33}</p></footer>",
    "<div class=cookies><p>{b37}</p></div><aside><p>{b45}</p><p>{b28}</p></aside><div><h2>{m6}</h2><p>{m35}</p><p>{m71}</p><p>{m29}</p></div><div class=related><p>{b26}</p><p>{b39}</p></div>",
    "<form><p>{b34}</p><p>{b8}</p></form><p>{m31}</p><p>{m66}</p><p>{m28}</p><p>{m41}</p><div class=promo>{b52}</div><p>{m38}</p><div id=disqus><p>{b29}</p><p>{b77}</p></div>",
    "<article><h1>{m3}</h1><p>{m2}</p><p>{m1}</p><p>{l3}</p><p>{m4}</p><p>{l1}</p><p>{m3}</p><p>{m2}</p></article><footer>{b2}</footer>",
    "<div>{l1}</div><main><p>{l6}</p><ul><li>{l2}</li><li>{m1}</li><li>{l1}</li></ul><p>{m3}</p><p>{l2}</p><p>{m5}</p><p>{m1}</p></main><div>{b2}</div>",
    "<nav>{l1}</nav><article><h1>{m2}</h1><p>{m40}</p><p>{l8}</p><p>{m2}</p><p>{m5}</p></article><div>{b1}</div>",
    "<article><p>{m2}</p><p>{m5}</p><p>{m35}</p><p>{m3}</p></article>",
    "<h1>{m6}</h1><p>{m52}</p><p>{m31}</p><h2>{m3}</h2><p>{m44}</p><p>{m17}</p>",
    "<h1>{m4}</h1><h2>{m9}</h2><p>{m38}</p><p>{m12}</p><h3>{m2}</h3><p>{m61}</p><div>{l2}</div><div>{b2}</div>",
    "<header><h1>{b3}</h1><p>{b8}</p></header><div><h2>{m6}</h2><p>{m44}</p><p>{m29}</p><p>{m7}</p><p>{m35}</p></div><footer>{b9}</footer>",
    "<div id=header><h1>{b2}</h1><p>{b13}</p></div><h2>{m7}</h2><p>{m58}</p><h3>{m3}</h3><p>{m42}</p><div>{l2}</div>",
    "<div>{b4}</div><h1>{m7}</h1><p>{m36}</p><p>{m52}</p><div>{b2}</div>",
    "<p>{b2}</p><h2>{m5}</h2><p>{m49}</p><p>{m30}</p><p>{m11}</p><p>{m42}</p>",
    "<h1>{m5}</h1><p>{m34}</p><h2>{m2}</h2><p>{m57}</p><h2>{m1}</h2><p>{m15}</p><p>{m26}</p><h2>{m2}</h2><p>{m48}</p><div>{l1}</div>",
    "<div>{b2}</div><div>{b4}</div><div>{l2}</div><p>{m26}</p><p>{m34}</p><p>{m6}</p><p>{m54}</p><div>{b3}</div><div>{l4}</div><div>{b2}</div>",
]


def labelled_rows() -> list[tuple]:
    """(label, features) of the blocks of the labelled pages."""
    out = []
    for page in LABELLED:
        filled = re.sub(r"\{([mbl])(\d+)\}", lambda s: " ".join([{"m": "main", "b": "around", "l": "<a href=/x>link"}[s[1]]] + ["word"] * (int(s[2]) - 1)) + ("</a>" if s[1] == "l" else ""), page)
        page_blocks = blocks(filled)
        out += [(float(b.text.startswith("main") or " main" in b.text or (b.article and not b.surround and b.text.startswith("link"))), *f) for b, f in zip(page_blocks, feature_rows(page_blocks))]
    return out


def train(spark: SparkSession, depth: int = 10):
    """The decision tree as nested (feature, threshold, left, right), a leaf as whether its blocks are main text."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    table = spark.createDataFrame(labelled_rows(), ["label", *FEATURES]).coalesce(1)
    ready = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(table)
    model = DecisionTreeClassifier(featuresCol="x", labelCol="label", maxDepth=depth, maxBins=64, seed=1).fit(ready)

    def nested(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return bool(node.prediction() > 0.5)
        split = node.split()
        return (split.featureIndex(), split.threshold(), nested(node.leftChild()), nested(node.rightChild()))

    return nested(model._call_java("rootNode"))


def is_main(tree, features: list[float]) -> bool:
    while not isinstance(tree, bool):
        i, threshold, left, right = tree
        tree = left if features[i] <= threshold else right
    return tree


def main_text(html: str | None, tree) -> str:
    page = blocks(html or "")
    return "\n\n".join(b.text for b, f in zip(page, feature_rows(page)) if is_main(tree, f))


def extract(pages: DataFrame, tree=None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page: its main blocks in page order, joined by an empty line.

    A null html is empty and gives an empty text, as does a page without main text; pages that end inside a tag are read as far as
    they go; repeated rows are extracted alike; other columns are left out. The tree is trained on the labelled pages above unless
    one is given.
    """
    tree = train(pages.sparkSession) if tree is None else tree

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [main_text(h, tree) for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return pages.select("page_id", "url", "html").mapInPandas(rows, "page_id long, url string, text string, n_chars long")
