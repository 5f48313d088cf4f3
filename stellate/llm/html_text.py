"""Main text of web pages by tag-path ratios.

Method. A page is read into blocks: runs of text between block-level tags, each with its
root-to-leaf path of block-level tags and classes. Over each path the text length and the
punctuation of its blocks are summed up and divided by the number of its nodes. Both ratios
are smoothed over the page's paths (a Gaussian of the number of steps between two paths,
weighted by nodes) and fused: length and punctuation multiply, text inside links divides,
and a weak boilerplate mark lowers the result.

Paths that reach ``THRESHOLD`` of the best one are content. Where an article or main element
holds content, these elements are the roots: those with ``THRESHOLD`` of the text (outside
links, for each element of the path) of the largest, and those around them. A teaser beside
an article falls below that. Inside a root a wider smoothing decides, so that headings,
captions and cells near content stay: a path stays at ``INSIDE`` of the best one, that is,
unless it is links alone or lies far from content. Without such elements the text is the
blocks of the deepest node that holds all content, without those that are only links or in a
weakly marked element without content.

Marks. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, hidden
parts and reader comments go by tag, role, a ``class`` or ``id`` word that means nothing
else, or a name made of boilerplate words alone. Inline and unknown elements with such marks
go too. A boilerplate word beside words of another kind ("cookie-recipe") is a weak mark. A
heading in an article's own header is article text; other text there must be content.

Scale. One map over the pages; a page's work grows with its length.

Edge cases: null and empty html, and pages without any content, give an empty text; pages
cut off anywhere, unclosed tags and stray ``<`` are read as far as they go; pages without
any tag are one block; repeated rows give repeated results; very long pages are whole; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import os.path
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import slices, text_input

SIGMA, THRESHOLD = 1.0, 0.15
#: Smoothing and least share of the best score inside a root; factor of a weak mark, and its most text in links.
WIDE, INSIDE, WEAK, WEAK_LINKS = 3.0, 0.002, 0.25, 0.5
#: Steps, in units of the smoothing, at which a weight is 0 as a double.
REACH = 39
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*(?:>|\Z))""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、؛،]")
#: The end of a sentence.
_SENTENCE = re.compile(r"[.!?…。؟](?:\s|$)")
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
#: Fixed values of HTML: elements whose content is not markup, that hold nothing, that set off a block.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend",
    "li", "main", "menu", "nav", "noscript", "object", "ol", "option", "p", "pre", "search", "section", "select", "summary", "svg", "table",
    "tbody", "td", "template", "tfoot", "th", "thead", "tr", "ul", "audio", "video", "canvas", "map",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Blocks that hold text rather than other blocks.
LEAVES = HEADINGS | {"p", "li", "dd", "dt", "td", "th", "tr", "pre", "blockquote", "figcaption", "caption", "ul", "ol", "dl"}
#: Elements that a new one of the same group closes, inside the nearest of the containers.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
BOILERPLATE_TAGS = {
    "aside", "audio", "button", "canvas", "dialog", "fieldset", "footer", "form", "head", "map", "menu", "nav", "noscript", "object", "option", "search",
    "select", "svg", "template", "video",
}
BOILERPLATE_ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search", "toolbar"}
#: Words that mark an element wherever they stand in a name.
STRONG_WORDS = {
    "ad", "ads", "adsbygoogle", "adsense", "advert", "adverts", "advertisement", "advertising", "breadcrumb", "breadcrumbs", "byline", "comment", "comments",
    "consent", "copyright", "disqus", "footer", "gdpr", "masthead", "menu", "nav", "navbar", "navigation", "newsletter", "pager", "pagination", "popup",
    "promo", "recommended", "related", "replies", "respond", "sidebar", "signup", "social", "sponsor", "sponsored", "sponsors", "subscribe", "topbar",
}
STRONG_STARTS = ("advert", "breadcrumb", "newsletter", "sidebar", "sponsor")
#: Words that mark an element if its name holds no words of another kind.
WEAK_WORDS = {
    "banner", "cookie", "cookies", "discussion", "header", "login", "modal", "notice", "notices", "notification", "overlay", "promotion", "reply",
    "responses", "share", "sharing", "skip", "subscription", "toolbar", "widget", "widgets",
}
#: Words of names that say nothing of the kind of content.
NEUTRAL_WORDS = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "col", "container", "count", "fixed", "form", "global", "group", "icon", "icons",
    "id", "info", "inner", "item", "items", "js", "law", "left", "link", "links", "list", "main", "message", "outer", "page", "panel", "policy", "right",
    "row", "section", "site", "sticky", "text", "thread", "title", "to", "top", "wp", "wrap", "wrapper",
}
#: What an article calls the parts of its own header.
CONTENT_WORDS = {"article", "content", "entry", "headline", "post", "section", "story"}
LAYOUT_WORDS = {"has", "no", "with", "without"}


class Node:
    __slots__ = ("tag", "path", "dropped", "in_article", "weak", "header")

    def __init__(self, tag: str, label: str, parent: Node | None, dropped: bool, in_article: bool, weak: tuple[str, ...] = (), header: bool = False):
        self.tag, self.dropped, self.in_article, self.weak, self.header = tag, dropped, in_article, weak, header
        self.path = ((*parent.path, label) if label else parent.path) if parent else (label,)


def of_name(words: list[str]) -> int:
    """2 for a name that marks its element, 1 for a weak mark, 0 for none."""
    # "has-sidebar" tells of the page, not of the element
    own = [w for before, w in zip([""] + words, words) if before not in LAYOUT_WORDS]
    kinds = [kind(w) for w in own]
    if 2 in kinds:
        return 2
    weak = [w for w, k in zip(own, kinds, strict=True) if k == 1]
    if not weak or (set(weak) == {"header"} and CONTENT_WORDS & set(own)):
        return 0
    return 2 if all(k == 1 or w in NEUTRAL_WORDS or w.isdigit() for w, k in zip(own, kinds, strict=True)) else 1


@lru_cache(maxsize=1 << 16)
def kind(word: str) -> int:
    """2 and 1 for strong and weak words, alone or with a neutral word after them ("commentlist")."""
    if word in STRONG_WORDS or word.startswith(STRONG_STARTS):
        return 2
    if word in WEAK_WORDS:
        return 1
    for i in range(4, len(word) - 1):
        if word[i:] in NEUTRAL_WORDS and (word[:i] in STRONG_WORDS or word[:i] in WEAK_WORDS):
            return 2 if word[:i] in STRONG_WORDS else 1
    return 0


@lru_cache(maxsize=1 << 16)
def of_names(names: str) -> int:
    """The strongest mark of class names and ids."""
    return max((of_name([w for w in split if w]) for name in names.split() for split in ([w.lower() for w in _SPLIT.split(name)], _SPLIT.split(name.lower()))), default=0)


def hidden(attributes: dict[str, str]) -> bool:
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").lower() == "true"
        or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "").lower()))
    )


def mark(tag: str, attributes: dict[str, str], in_article: bool) -> int:
    """2 for boilerplate, 1 for a weak mark, 0 for none."""
    if tag in BOILERPLATE_TAGS or (tag == "header" and not in_article):
        return 2
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    if tag in ("html", "body", "article", "main") and "comment" not in names.lower():
        return 0
    if attributes.get("role", "").lower() in BOILERPLATE_ROLES or hidden(attributes):
        return 2
    return of_names(f"{names} {tag}" if "-" in tag else names)


class Page:
    """Blocks of one page: (path, text, characters inside links, tag), in page order.

    ``weak`` holds, for paths below a weakly marked element, the path of that element,
    ``header`` the paths of the text in an article's header, ``roots`` the number of article and main elements by path."""

    def __init__(self, source: str):
        self.blocks: list[tuple[tuple[str, ...], str, int, str]] = []
        self.weak: dict[tuple[str, ...], tuple[str, ...]] = {}
        self.header: set[tuple[str, ...]] = set()
        self.roots: Counter[tuple[str, ...]] = Counter()
        self.stack = [Node("", "", None, False, False)]
        self.text: list[str] = []
        self.link_chars, self.in_link = 0, 0
        at, n = 0, len(source)
        while at < n:
            token = _TOKEN.search(source, at)
            if token is None:
                self.add(source[at:])
                break
            self.add(source[at : token.start()])
            at = token.end()
            if token["name"] is None:
                if token[0].startswith("<![CDATA["):
                    self.add(html.escape(token[0][9:].removesuffix("]]>")))
                continue
            name = token["name"].lower()
            if not token["rest"].endswith(">"):
                break  # cut off inside a tag
            if token["end"]:
                self.close(name)
            else:
                self.open(name, token["rest"])
                if name in RAW:
                    stop = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                    at = stop.end() if stop else n
        self.flush()

    def add(self, text: str) -> None:
        if text and not self.stack[-1].dropped:
            self.text.append(text)
            if self.in_link:
                self.link_chars += len(text.strip())

    def flush(self) -> None:
        if self.text:
            text = " ".join(html.unescape("".join(self.text)).split())
            if text:
                node = self.stack[-1]
                self.blocks.append((node.path, text, self.link_chars, node.tag))
                if node.weak:
                    self.weak[node.path] = node.weak
                if node.header:
                    self.header.add(node.path)
            self.text, self.link_chars = [], 0

    def open(self, name: str, rest: str) -> None:
        if name == "br":
            self.add(" ")
        if name == "a":
            self.in_link = 1
        if name not in BLOCK:
            self.open_inline(name, rest)
            return
        self.flush()
        if name != "hr":
            self.in_link = 0 if name in ("p", "div", "article", "section") else self.in_link
        if any(x.tag == "p" for x in self.stack[-1:]):  # no block stands inside a paragraph
            self.stack.pop()
        group, containers = CLOSES.get(name, ((), ()))
        if group:
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag in group:
                    del self.stack[i:]
                    break
                if self.stack[i].tag in containers:
                    break
        if name in VOID:
            return
        top = self.stack[-1]
        attributes = self.attributes(rest)
        in_article = top.in_article or name in ("article", "main")
        marked = mark(name, attributes, top.in_article)
        header = top.in_article and name not in HEADINGS and (top.header or top.tag == "header") and name not in ("hgroup", "div")
        label = name + "".join(f".{c}" for c in sorted(attributes.get("class", "").split()))
        node = Node(name, label, top, top.dropped or marked == 2, in_article, top.weak, header)
        if marked == 1 and not node.weak:
            node.weak = node.path
        self.stack.append(node)
        if name in ("article", "main") and not node.dropped:
            self.roots[node.path] += 1

    def open_inline(self, name: str, rest: str) -> None:
        """Only dropped inline and unknown elements, and what is inside them, are kept track of."""
        if name in VOID or name in RAW or rest.endswith("/>"):
            return
        top = self.stack[-1]
        if top.dropped or (("=" in rest or "hidden" in rest or "-" in name) and mark(name, self.attributes(rest), top.in_article) == 2):
            self.stack.append(Node(name, "", top, True, top.in_article, top.weak, top.header))

    @staticmethod
    def attributes(rest: str) -> dict[str, str]:
        return {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(rest.rstrip(">/"))} if "=" in rest or "hidden" in rest else {}

    def close(self, name: str) -> None:
        if name == "a":
            self.in_link = 0
        if name not in BLOCK:
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag == name:
                    del self.stack[i:]
                    return
                if self.stack[i].tag in BLOCK:
                    return
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == name:
                self.flush()
                del self.stack[i:]
                return
            if self.stack[i].tag in ("article", "main", "body") and name in ("p", "div", "li", "td"):
                return  # a stray end tag


def steps(a: tuple[str, ...], b: tuple[str, ...]) -> int:
    """Steps in the tree from one path to another."""
    same = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        same += 1
    return len(a) + len(b) - 2 * same


def path_scores(blocks: list[tuple[tuple[str, ...], str, int, str]], sigma: float = SIGMA) -> dict[tuple[str, ...], float]:
    """Smoothed and fused ratios of all paths."""
    reach = int(REACH * sigma)
    length, punctuation, nodes, links = (defaultdict(int) for _ in range(4))
    for path, text, link_chars, _ in blocks:
        length[path] += len(text)
        punctuation[path] += len(_PUNCTUATION.findall(text))
        links[path] += min(link_chars, len(text))
        nodes[path] += 1
    # Sums of every node's paths by their length: what leaves a path's line at a node is the
    # node's sums without those of the next node on the line.
    ids: dict[tuple[int, str], int] = {}
    sums: list[dict[int, np.ndarray]] = [defaultdict(lambda: np.zeros(3))]
    lines = {}
    for p in length:
        line = [0]
        own = np.sqrt(nodes[p]) * np.array([length[p] / nodes[p], punctuation[p] / nodes[p], 1.0])
        for label in p:
            key = (line[-1], label)
            if key not in ids:
                ids[key] = len(sums)
                sums.append(defaultdict(lambda: np.zeros(3)))
            line.append(ids[key])
        for node in line[-reach - 1 :]:
            sums[node][len(p)] += own
        lines[p] = line
    out = {}
    for p, line in lines.items():
        n, total = len(p), np.zeros(3)
        for k in range(n, max(-1, n - reach - 1), -1):
            below = sums[line[k + 1]] if k < n else {}
            for m, held in sums[line[k]].items():
                if (d := n + m - 2 * k) <= reach:
                    total += np.exp(-(d**2) / (2 * sigma**2)) * (held - below.get(m, 0.0))
        smooth_length, smooth_punctuation = total[:2] / max(total[2], 1e-12)
        out[p] = float(smooth_length * (1 + smooth_punctuation) * (1 - links[p] / max(1, length[p])))
    return out


def kept_roots(page: Page, content: set[tuple[str, ...]]) -> set[tuple[str, ...]]:
    """Article and main elements that hold content and enough text, and those around them."""
    text: Counter[tuple[str, ...]] = Counter()
    for path, t, links, _ in page.blocks:
        if (inner := innermost(path, page.roots)) is not None:
            text[inner] += max(0, len(t) - links)
    each = {root: n / page.roots[root] for root, n in text.items()}
    if not any(innermost(path, page.roots) is not None for path in content):
        return set()
    kept = {root for root, n in each.items() if n > 0 and n >= THRESHOLD * max(each.values())}
    return kept | {root for root in each if any(k[: len(root)] == root for k in kept)}


def innermost(path: tuple[str, ...], roots: Counter[tuple[str, ...]]) -> tuple[str, ...] | None:
    return next((path[:k] for k in range(len(path), 0, -1) if path[:k] in roots), None)


def main_text(source: str | None) -> str:
    page = Page(source or "")
    blocks = page.blocks
    if not blocks:
        return ""
    scores = {p: s * WEAK if p in page.weak else s for p, s in path_scores(blocks).items()}
    best = max(scores.values())
    content = {p for p, s in scores.items() if s >= THRESHOLD * best and s > 0} or set(scores)
    # A weakly marked element that holds content is no boilerplate.
    fine = {page.weak[p] for p in content if p in page.weak}
    weak = {p for p, element in page.weak.items() if element not in fine}
    if roots := kept_roots(page, content):
        wide = path_scores(blocks, WIDE)
        chars, links, ends = Counter(), Counter(), set()
        for path, text, link_chars, _ in blocks:
            chars[path] += len(text)
            links[path] += min(link_chars, len(text))
            if _SENTENCE.search(text):
                ends.add(path)
        least = INSIDE * max(wide.values())
        inside = {
            p for p, s in wide.items()
            if innermost(p, page.roots) in roots
            and (s * (WEAK if p in weak else 1) >= least and s > 0 or p[-1].split(".")[0] in HEADINGS)
            and (p not in weak or links[p] <= WEAK_LINKS * chars[p])
            and (p not in page.header or p in content and p in ends)
        }
        if inside:
            return " ".join(text for path, text, _, _ in blocks if path in inside)
    root = os.path.commonprefix([p for p in content if scores[p] > 0])
    while root and root[-1].split(".")[0] in LEAVES:
        root = root[:-1]
    return " ".join(text for path, text, _, _ in blocks if path[: len(root)] == root and (path in content or (scores[path] > 0 and path not in weak)))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2):
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
        )


def extract_pages(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars``."""
    kind = pages.schema[id_column].dataType.simpleString()
    source = text_input(pages, F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).cast("string").alias("html"))
    return source.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars bigint")
