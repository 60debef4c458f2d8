"""Main text of web pages by points that paragraphs pass up the element tree."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storesales.llm.common import slices, type_of

# Elements whose text is never read.
_RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}

# Elements that are no part of an article.
_ASIDE = {
    "nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "svg", "canvas", "audio", "video",
    "object", "embed", "head", "input", "label", "option", "fieldset",
}

_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}

# Elements of running text; every other one begins and ends a block.
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
    "sup", "td", "th", "time", "tt", "u", "var", "wbr",
}

# Blocks that hold a paragraph and hand its points to the element around them.
_LEAVES = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "dt", "dd", "figcaption", "blockquote", "tr"}

_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_ARTICLES = {"article", "main"}

# Parts of class names and ids that mark something beside the article.
_BESIDE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
    "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "comment",
    "comments", "disqus", "respond", "reply", "replies", "sidebar", "sidebars", "aside", "widget", "widgets", "nav",
    "navbar", "navigation", "menu", "menus", "breadcrumb", "breadcrumbs", "footer", "masthead", "share", "sharing",
    "social", "related", "recommended", "recommendations", "newsletter", "subscribe", "subscription", "signup",
    "login", "popup", "modal", "overlay", "pagination", "pager", "toolbar", "skip", "hidden", "paywall",
}

_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu",
    "menubar", "toolbar", "form",
}

_WHOLE = {"content", "article", "body", "main", "wrapper", "container", "page"}

# Less than this share of a text's characters in links.
FEW_LINKS = 0.25

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_UNSHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _beside(tag: str, text: str, in_article: bool) -> bool:
    """Whether an element with these attributes stands beside the article."""
    if tag in _ASIDE:
        return True
    if tag == "header" and not in_article:
        return True
    if not text or text.isspace():
        return False
    for name, *values in _ATTRIBUTE.findall(text):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and _UNSHOWN.search(value) or name == "role" and value.lower() in _ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", *_ARTICLES):
            for word in value.split():
                if re.match(r"(?:has|with|no|is)[-_]", word):
                    continue
                parts = [p.lower() for p in _PARTS.findall(word)]
                if parts and parts[-1] in _WHOLE:
                    continue
                if any(p in _BESIDE or p == "header" and not in_article for p in parts):
                    return True
    return False


class Page:
    """Elements in page order (each after its parent) and the blocks of text in them."""

    def __init__(self, html: str):
        self.parents, self.tags, self.beside = [-1], ["#root"], [False]
        self.in_article, self.in_header = [False], [False]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self._open, self._text, self._linked, self._links = [0], [], 0, 0
        self._read(html)
        self._close_block()

    def _read(self, html: str) -> None:
        lowered = None
        last = {q: html.rfind(q) for q in "\"'"}
        at, size = 0, len(html)
        while at < size:
            start = html.find("<", at)
            if start < 0:
                start = size
            if start > at:
                self._add(entities.unescape(html[at:start]))
            if start == size:
                return
            after = html[start + 1 : start + 2]
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                at = size if end < 0 else end + 3
            elif after in ("!", "?") or after == "/" and not _NAME.match(html, start + 2):
                end = html.find(">", start)
                at = size if end < 0 else end + 1
            elif name := _NAME.match(html, start + 1 + (after == "/")):
                end = self._tag_end(html, name.end(), last)
                tag = name[0].lower()
                if after == "/":
                    self._close(tag)
                else:
                    self._start(tag, html[name.end() : end])
                at = min(size, end + 1)
                if after != "/" and tag in _RAW:
                    lowered = lowered if lowered is not None else _ascii_lower(html)
                    end = lowered.find(f"</{tag}", at)
                    at = size if end < 0 else end
            else:
                self._add("<")
                at = start + 1

    @staticmethod
    def _tag_end(html: str, at: int, last: dict[str, int]) -> int:
        """Place of the > that ends a tag, passing over quoted ones; quotes that never close do not count."""
        while True:
            end = html.find(">", at)
            if end < 0:
                return len(html)
            quote = min((p for q in last if (p := html.find(q, at, end)) >= 0), default=-1)
            if quote < 0 or last[html[quote]] <= quote:
                return end
            at = html.find(html[quote], quote + 1) + 1

    def _add(self, text: str) -> None:
        if not self.beside[self._open[-1]]:
            self._text.append(text)
            if self._links:
                self._linked += len(text)

    def _close_block(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            node = self._open[-1]
            while self.tags[node] in _INLINE:
                node = self.parents[node]
            if not self.in_header[node] or self.tags[node] in _HEADINGS:
                self.blocks.append((node, text, min(self._linked, len(text))))
        self._text, self._linked = [], 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("br", "td", "th"):
            self._add(" ")
        if tag not in _INLINE:
            self._close_block()
            self._imply_end(tag)
        if tag in _VOID:
            return
        parent = self._open[-1]
        self.parents.append(parent)
        self.tags.append(tag)
        self.beside.append(self.beside[parent] or _beside(tag, attributes, self.in_article[parent]))
        self.in_article.append(self.in_article[parent] or tag in _ARTICLES)
        self.in_header.append(self.in_header[parent] or tag == "header")
        if not attributes.endswith("/") or tag in _INLINE or tag in _LEAVES or tag == "div":
            self._open.append(len(self.tags) - 1)
            self._links += tag == "a"

    def _imply_end(self, tag: str) -> None:
        """A block ends an open paragraph, and an item, row or heading one of its own kind."""
        for i in range(len(self._open) - 1, 0, -1):
            open_ = self.tags[self._open[i]]
            if open_ == "p" or open_ == tag and tag in ("li", "tr", "dt", "dd", "option"):
                self._pop_to(i)
                return
            if open_ not in _INLINE:
                return

    def _close(self, tag: str) -> None:
        if tag not in _INLINE:
            self._close_block()
        elif tag in ("td", "th"):
            self._add(" ")
        for i in range(len(self._open) - 1, 0, -1):
            open_ = self.tags[self._open[i]]
            if open_ == tag:
                self._pop_to(i)
                return
            if tag in _INLINE and open_ not in _INLINE:
                return  # a stray end of running text ends nothing around it

    def _pop_to(self, i: int) -> None:
        self._links -= sum(self.tags[n] == "a" for n in self._open[i:])
        del self._open[i:]


def _ascii_lower(text: str) -> str:
    """Lower case that keeps every character's place."""
    return text.translate({c: c + 32 for c in range(65, 91)})


def points(text: str, linked: int) -> float:
    """What a paragraph passes on: for itself, its commas and its length, less the share that is links."""
    return (1 + text.count(",") + min(3.0, len(text) / 100)) * (1 - linked / len(text))


def main_text(html: str) -> str:
    """The article of a page: its blocks in page order, one per line; empty if there is none.

    Every paragraph gives its points to the element around it, half of them to
    the next one out and a third to the one after. The element with the most
    points, discounted by the share of its text that is links, is the container;
    an <article> or <main> around it takes its place. Else the outermost element
    with the same text does, and siblings with a fifth of its points, or long
    paragraphs with few links, are kept with it, and so are all headings, leads
    and sections with few links, however short, that follow each other up to
    one of these.
    """
    page = Page(html)
    size = len(page.tags)
    score, chars, linked = [0.0] * size, [0] * size, [0] * size
    for node, text, links in page.blocks:
        chars[node] += len(text)
        linked[node] += links
        target, share = page.parents[node] if page.tags[node] in _LEAVES else node, 1
        while target > 0 and share <= 3:
            score[target] += points(text, links) / share
            target, share = page.parents[target], share + 1
        if target == 0 and share <= 3:
            score[0] += points(text, links) / share
    for node in range(size - 1, 0, -1):
        chars[page.parents[node]] += chars[node]
        linked[page.parents[node]] += linked[node]
    net = [s * (1 - n / c) if c else 0.0 for s, n, c in zip(score, linked, chars, strict=True)]
    best = max(range(size), key=net.__getitem__)
    around = best
    while around > 0 and page.tags[around] not in _ARTICLES:
        around = page.parents[around]
    keep = [False] * size
    keep[around or best] = True
    beside = -1
    if not around and best:
        while page.parents[best] > 0 and chars[page.parents[best]] == chars[best]:
            best = page.parents[best]
        beside = page.parents[best]
        siblings = [node for node in range(1, size) if page.parents[node] == beside and chars[node]]
        few_links = [linked[node] < FEW_LINKS * chars[node] for node in siblings]
        strong = [
            node == best or net[node] >= 0.2 * net[best] or few and page.tags[node] in _LEAVES and chars[node] > 80
            for node, few in zip(siblings, few_links, strict=True)
        ]
        for order in (1, -1):
            near = False
            for node, few, own in list(zip(siblings, few_links, strong, strict=True))[::order]:
                near = own or near and few
                keep[node] = keep[node] or near
    for node in range(1, size):
        keep[node] = keep[node] or keep[page.parents[node]]
    # Text that stands directly beside the container belongs to it, too.
    return "\n".join(text for node, text, links in page.blocks if keep[node] or node == beside and links < FEW_LINKS * len(text))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; ``n_chars`` counts code points.

    NULL, empty and text-free pages have an empty text. Repeated rows are
    extracted each, NULL ids and urls stay NULL, an empty table gives an empty
    result, other columns are not read. A page is parsed in one pass whose time
    grows with its length only.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("text")
    )
    kind = type_of(rows, "page_id")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(parse, f"page_id {kind}, url string, text string, n_chars long")
