"""Main text of web pages by consensus host paths.

Each page is cut into elements; every container is scored by the text of the paragraphs in it (less links), and the
page votes for the path of its best container: tags and classes from the body down, digits generalised. A best container
outside article and main climbs while what the parent adds is no longer than itself and mostly unlinked headings and
paragraphs, so a heading, lead or closing block beside it stays; elements on a host's path climb likewise. Votes are
summed per host and path; each host's winner is the path with most votes. Pages are then extracted again from
the elements on the winning path, or, where a page has none with text, from its own best container.

An element counts as a menu, sidebar, notice and the like for its tag or role, or for a class or id that is, starts or
ends with such a word and does not tell of a layout ("has-sidebar"). The name alone does not leave out an element that
holds a main element, the page's only article elements, or most of its paragraph text (nearly all, for comments and
related pages).

Left out are scripts, styles, forms, menus, footers, sidebars, notices, adverts, comments of readers, hidden elements,
and headers without a heading. White space (as Python's ``str.split`` sees it) becomes one space, character references
are decoded, blocks follow in page order. A null or empty page has an empty text. A null url is a host of its own.
Broken markup, unclosed elements and very long pages are read to the end. Repeated rows each give their row, ties
between paths go to the higher total score, then to the smaller path, and an empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolith.llm.common import Scratch, table
from tempolith.llm.registry import query

# Elements of HTML by kind, and words that mark what is not the article.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp", "template", "svg", "math", "object", "select", "canvas", "audio", "video"}
SKIP = RAW | {"head", "nav", "aside", "footer", "form", "button", "menu", "dialog", "label", "fieldset", "datalist", "output", "input"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt",
          "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "nobr"}
PARAGRAPH = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "dd", "dt", "figcaption", "td", "th", "caption", "address", "summary"}
HEADING = {"h1", "h2", "h3"}
ENDS_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1",
          "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul", "li", "dd", "dt"}
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
             "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
NOT_ARTICLE = {"ad", "ads", "adv", "advert", "advertisement", "advertising", "adsense", "adbox", "banner", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies",
               "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "login", "comment",
               "comments", "commentlist", "disqus", "respond", "replies", "reply", "sidebar", "sidebars", "aside", "menu", "menus", "nav", "navbar", "navigation",
               "breadcrumb", "breadcrumbs", "pagination", "pager", "footer", "share", "sharing", "social", "related", "recommended", "widget", "toolbar", "masthead",
               "topbar", "skip", "search", "hidden", "noprint", "outbrain", "taboola"}
#: Of these, the ones that may well hold more text than the article.
READERS = {"comment", "comments", "commentlist", "disqus", "respond", "replies", "reply", "related", "recommended"}
#: Words before and after a mark that make a name tell of a layout ("has-sidebar", "search-page").
LAYOUT_BEFORE, LAYOUT_AFTER = {"has", "no", "not", "with", "without", "hide", "hides", "show", "is"}, {"page", "layout", "template", "open", "closed", "on", "off", "enabled", "disabled"}
#: An element is not left out for its name if it holds more than this share of the page's paragraph text.
MOST, NEARLY_ALL = 0.5, 0.9
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_DIGITS = re.compile(r"\d+")
_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def named(names: str) -> float:
    """Share of the page's paragraph text up to which a class or id leaves an element out, 0 where none does."""
    limit = 0.0
    for name in names.split():
        words = [m.lower() for m in _PART.findall(name)]
        words = [w for w in words if not w.isdigit()] or words
        if not words or len(words) > 1 and (words[-1] in LAYOUT_AFTER or not LAYOUT_BEFORE.isdisjoint(words[:-1])):
            continue
        hits = {words[0], words[-1], "".join(words)} & NOT_ARTICLE
        if hits:
            limit = max(limit, NEARLY_ALL if hits & READERS else MOST)
    return limit


class Page:
    """Elements of a page in order, and its text cut by the element it stands in."""

    def __init__(self, source: str):
        self.tag, self.parent, self.label, self.skip = ["#"], [-1], [""], [False]
        self.named = {}  # elements that their name leaves out, with their limit
        self.texts: list[tuple[int, str]] = []  # (element, text), an empty text for a block's edge
        self._read(source)
        self._names()
        self._headers()

    def _open(self, tag: str, attrs: str, parent: int) -> int:
        classes, skip = "", tag in SKIP
        if attrs:
            found = {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(attrs)}
            classes = ".".join(sorted({_DIGITS.sub("0", c).replace("/", "|") for c in found.get("class", "").split()}))
            if tag not in ("body", "html") and (limit := named(found.get("class", "") + " " + found.get("id", ""))):
                self.named[len(self.tag)] = limit
            skip = skip or "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in ROLES or bool(_HIDES.search(found.get("style", "")))
        self.tag.append(tag)
        self.parent.append(parent)
        self.label.append(f"{tag}.{classes}" if classes else tag)
        self.skip.append(skip or self.skip[parent])
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        stack, at, text = [0], 0, self.texts
        while True:
            m = _TOKEN.search(source, at)
            if m is None:
                if at < len(source):
                    text.append((stack[-1], source[at:]))
                return
            if m.start() > at:
                text.append((stack[-1], source[at:m.start()]))
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                if m[0].startswith("<![CDATA["):
                    text.append((stack[-1], html.escape(m[0][9:].removesuffix("]]>"))))
                continue
            if m[1] or m[4]:
                if tag == "br" or tag == "p" and not any(self.tag[e] == "p" for e in stack):
                    text.append((stack[-1], ""))
                    continue
                self._close(stack, tag)
            else:
                if tag in ENDS_P:
                    self._implied(stack, {"p"}, {"td", "th", "table", "button", "object"})
                if tag in CLOSED_BY:
                    self._implied(stack, *CLOSED_BY[tag])
                attrs = m[3] if m[2] else m[6]
                element = self._open(tag, attrs, stack[-1])
                if tag in RAW and not attrs.endswith("/"):
                    end = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", re.I).search(source, at)
                    at = end.end() if end else (len(source) if tag in ("script", "style", "textarea", "title") else at)
                elif tag not in VOID and not (attrs.endswith("/") and tag not in ENDS_P):
                    stack.append(element)
            if tag not in INLINE:
                text.append((stack[-1], ""))

    def _close(self, stack: list[int], tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[k]]
            if name == tag:
                del stack[k:]
                return
            if tag in INLINE and name not in INLINE:
                return  # an inline end tag does not reach over a block

    def _implied(self, stack: list[int], tags: set[str], stop: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[k]]
            if name in tags:
                del stack[k:]
                return
            if name in stop or name in ("div", "article", "section", "main", "body") and "p" in tags:
                return

    def _kind(self, element: int) -> tuple[int, bool, bool]:
        """Container of a text that stands in an element, whether it is linked, and whether it is in a paragraph."""
        linked = paragraph = False
        while element > 0 and (self.tag[element] in INLINE or self.tag[element] in PARAGRAPH):
            linked = linked or self.tag[element] == "a"
            paragraph = paragraph or self.tag[element] in PARAGRAPH
            element = self.parent[element]
        return element, linked, paragraph

    def _summed(self, sizes: list[int]) -> list[int]:
        """Of each element with all under it."""
        for e in range(len(sizes) - 1, 0, -1):
            sizes[self.parent[e]] += sizes[e]
        return sizes

    def _names(self) -> None:
        """Leaves out what a class or id marks, unless it holds the article."""
        marks = {e: limit for e, limit in self.named.items() if not self.skip[e] and self.tag[e] not in ("article", "main")}
        if not marks:
            return
        n = len(self.tag)
        plain, loose = [0] * n, [0] * n
        for element, text in self.texts:
            if text and not self.skip[element] and (size := len(text.strip())):
                _, linked, paragraph = self._kind(element)
                if not linked:
                    loose[element] += size
                    plain[element] += size if paragraph else 0
        sizes = self._summed(plain if any(plain) else loose)
        mains = self._summed([int(t == "main" and not k) for t, k in zip(self.tag, self.skip)])
        articles = [int(t == "article" and not k and e not in self.named) for e, (t, k) in enumerate(zip(self.tag, self.skip))]
        articles = self._summed(articles)
        # articles that no marked element holds are the page's; a marked one beside them holds others
        free, inside = 0, [False] * n
        for e in range(1, n):
            inside[e] = inside[self.parent[e]] or e in marks
            free += self.tag[e] == "article" and not self.skip[e] and not inside[e] and e not in self.named
        for e in range(1, n):
            up = self.parent[e]
            if e in marks and not self.skip[up]:
                if not (mains[e] or articles[e] and not free and articles[e] == articles[0] or sizes[e] > marks[e] * sizes[0]):
                    self.skip[e] = True
            self.skip[e] = self.skip[e] or self.skip[up]

    def _headers(self) -> None:
        """A header is left out unless it holds a heading and stands inside an article or main element."""
        headers = [e for e, t in enumerate(self.tag) if t == "header"]
        if not headers:
            return
        keep = set()
        for e, t in enumerate(self.tag):
            if t in HEADING:
                seen, up = [], self.parent[e]
                while up > 0:
                    if self.tag[up] == "header":
                        seen.append(up)
                    elif self.tag[up] in ("article", "main"):
                        keep.update(seen)
                    up = self.parent[up]
        out = set(headers) - keep
        for e in range(1, len(self.tag)):
            if e in out or self.parent[e] in out:
                out.add(e)
                self.skip[e] = True

    def path(self, element: int) -> str:
        names = []
        while element > 0 and self.tag[element] not in ("body", "html"):
            names.append(self.label[element])
            element = self.parent[element]
        return "/".join(reversed(names))

    def on(self, path: str) -> set[int]:
        """Elements with this path."""
        parts = path.split("/")
        depth = [0] * len(self.tag)  # parts that an element and all above it match, or -1
        found = set()
        for e in range(1, len(self.tag)):
            if self.tag[e] not in ("body", "html"):
                k = depth[self.parent[e]]
                depth[e] = k + 1 if 0 <= k < len(parts) and self.label[e] == parts[k] else -1
                if depth[e] == len(parts) and not self.skip[e]:
                    found.add(e)
        return found

    def scores(self) -> dict[int, float]:
        """Containers by the text of their paragraphs: in full for the nearest, less for those farther up."""
        found: dict[int, float] = defaultdict(float)
        for element, text in self.texts:
            if not text or self.skip[element] or not (size := len(text.strip())):
                continue
            up, linked, _ = self._kind(element)
            worth = -0.5 * size if linked else size
            for part in (1.0, 0.7, 0.4, 0.2):
                if up <= 0 or self.tag[up] == "html":
                    break
                bonus = 1.5 if self.tag[up] in ("article", "main") else 1.0 if self.tag[up] != "body" else 0.9
                found[up] += part * worth * bonus
                up = self.parent[up]
        return found

    def climbed(self, roots: set[int]) -> set[int]:
        """For each element the highest above it that adds only more of the article."""
        if all(self.tag[e] in ("article", "main") for e in roots):
            return roots
        n = len(self.tag)
        every, plain = [0] * n, [0] * n
        for element, text in self.texts:
            if text and not self.skip[element] and (size := len(text.strip())):
                _, linked, paragraph = self._kind(element)
                every[element] += size
                plain[element] += size if paragraph and not linked else 0
        every, plain = self._summed(every), self._summed(plain)
        found = set()
        for top in roots:
            up = top
            while self.tag[up] not in ("article", "main", "body", "html") and self.parent[up] > 0:
                up = self.parent[up]
                if self.skip[up] or self.tag[up] == "html":
                    break
                more = every[up] - every[top]
                if more > every[top] or 2 * (plain[up] - plain[top]) < more:
                    break
                if more:
                    top = up
            found.add(top)
        return found

    def best(self) -> tuple[int, float]:
        """The container that holds the article, 0 if there is none, and the score that decided."""
        scores = self.scores()
        if not scores:
            return 0, 0.0
        top = max(scores, key=lambda e: (scores[e], -e))
        return self.climbed({top}).pop(), scores[top]

    def text(self, roots: set[int]) -> str:
        """Text under the given elements, in page order."""
        inside = [e in roots for e in range(len(self.tag))]
        for e in range(1, len(self.tag)):
            inside[e] = inside[e] or inside[self.parent[e]]
        parts = [html.unescape(t) if t else " " for e, t in self.texts if not t or inside[e] and not self.skip[e]]
        return " ".join("".join(parts).split())


def vote(source: str | None) -> tuple[str, float] | None:
    """Path and score of a page's best container."""
    if not source:
        return None
    page = Page(source)
    best, score = page.best()
    return (page.path(best), score) if best else None


def extract(source: str | None, path: str | None) -> str:
    if not source:
        return ""
    page = Page(source)
    if path is not None:
        roots = page.on(path)
        if roots and (text := page.text(page.climbed(roots))):
            return text
    return page.text({page.best()[0]})


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path): each host's winner. Votes are summed before they are dealt by host, so a hot host is a few rows."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            votes = [(h, *v) for h, s in zip(frame["host"], frame["html"]) if (v := vote(s))]
            yield pd.DataFrame(votes, columns=["host", "path", "score"])

    votes = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).mapInPandas(work, "host string, path string, score double")
    paths = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum(F.round("score").cast("long")).alias("score"))
    top = paths.groupBy("host").agg(F.max(F.struct("votes", "score")).alias("top"))
    return paths.join(top, "host").filter(F.struct("votes", "score") == F.col("top")).groupBy("host").agg(F.min("path").alias("path"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    stage = Scratch(pages.sparkSession, "html")
    paths = stage.keep(host_paths(pages, url_col, html_col).select(F.col("host").alias("h"), "path"), "paths")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).withColumn("host", host_of(F.col("url")))
    rows = rows.join(paths, F.col("host") == F.col("h"), "left").select("page_id", "url", "html", "path")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            text = [extract(s, p) for s, p in zip(frame["html"], frame["path"])]
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": text, "n_chars": [len(t) for t in text]})

    return rows.mapInPandas(work, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")


@query("op6_html")
def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
