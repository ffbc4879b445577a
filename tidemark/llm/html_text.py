"""The main text of web pages, found by scores in the tree of their elements."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
#: Fixed values of the language of web pages.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe svg math textarea title object".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
PARAGRAPH = set("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 figcaption summary div section article main body".split())
TITLES = {"h1", "article", "main"}
TEXTUAL = set("p pre blockquote h1 h2 h3 h4 h5 h6".split())
HOLDER = set("article body center dd div figure main section table tbody td tr ul ol dl blockquote html".split())
#: What never holds main text, by element, by role and by the words of class and id.
OUT_TAGS = RAW | set("head nav menu button select dialog search".split())
OUT_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
TALK_WORDS = set("comment comments disqus replies reply".split())
#: What holds none unless most of the page's text is in it.
ODD_TAGS = set("aside fieldset footer form".split())
ODD_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies disclaimer footer gdpr "
    "header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promotion related share "
    "sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Names such as has-sidebar, no-comments and ad-free speak about the element, not of it.
ABOUT = re.compile(r"(?:has|no|non|with|without)[-_].*|.*[-_](?:free|enabled|disabled)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
#: An opening tag ends these open elements, up to the nearest of the second group.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"})} | {
    t: ({"td", "th"} if t in ("td", "th") else {"tr", "td", "th"}, {"table"}) for t in ("td", "th", "tr")
}


#: Kinds of elements: main text or not is open, is known only from the rest of the page, or is clear.
OPEN, ODD, TALK, OUT = range(4)


class _Tree:
    """Elements in page order with their parents, and pieces of text with element and block.

    Depths of open elements are held by tag, so a tag costs the same at any depth.
    """

    def __init__(self, page: str) -> None:
        self.tag, self.parent, self.kind, self.link = ["html"], [-1], [OPEN], [False]
        self.pieces: list[tuple[int, int, str]] = []
        self.open, self.depths = [0], defaultdict(list)
        at, block, body = 0, 0, False
        while True:
            found = TOKEN.search(page, at)
            text = page[at : found.start() if found else len(page)]
            if text:
                self.pieces.append((self.open[-1], block, html.unescape(text)))
            if not found:
                return
            at = found.end()
            tag = found[2] or found[5]
            if tag is None:
                continue
            tag, closing, attributes = tag.lower(), found[1] or found[4], found[3] or found[6] or ""
            if tag in BLOCK:
                block += 1
            if tag == "br":
                self.pieces.append((self.open[-1], block, " "))
            elif closing:
                self._close(self._nearest((tag,)))
            elif tag not in VOID:
                if tag in BLOCK:
                    self._end({"p"}, HOLDER - {"p"})
                if tag in ENDS:
                    self._end(*ENDS[tag])
                if tag == "html" or tag == "body" and body:
                    continue
                body |= tag == "body"
                above = self.open[-1]
                self.kind.append(self._kind(tag, attributes))
                self.tag.append(tag)
                self.parent.append(above)
                self.link.append(self.link[above] or tag == "a")
                if tag in RAW:
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                    at = end.end() if end else len(page)
                elif not attributes.endswith("/") or tag in BLOCK:
                    self.depths[tag].append(len(self.open))
                    self.open.append(len(self.tag) - 1)

    def _nearest(self, tags: Iterable[str]) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def _close(self, depth: int) -> None:
        while depth and len(self.open) > depth:
            self.depths[self.tag[self.open.pop()]].pop()

    def _end(self, tags: set[str], stop: set[str]) -> None:
        depth = self._nearest(tags)
        if depth and depth > self._nearest(stop):
            self._close(depth)

    def _kind(self, tag: str, attributes: str) -> int:
        if tag in OUT_TAGS:
            return OUT
        kind = ODD if tag in ODD_TAGS or tag == "header" and not self._nearest(("article", "main")) else OPEN
        if not attributes or tag in ("html", "body", "main", "article"):
            return kind
        for name, a, b, c, hidden in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), (a or b or c).lower()
            if name in ("class", "id"):
                words = {w for own in value.split() if not ABOUT.fullmatch(own) for w in re.split(r"[^a-z0-9]+", own)}
                kind = max(kind, TALK if words & TALK_WORDS else ODD if words & ODD_WORDS else OPEN)
            if hidden or name == "role" and value in OUT_ROLES - {"form"} or name == "aria-hidden" and value == "true":
                return OUT
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return OUT
        return kind

    def lengths(self, skip: list[bool]) -> tuple[list[int], list[int]]:
        """Characters in each element with all below it, and those of them in links."""
        total, linked = [0] * len(self.tag), [0] * len(self.tag)
        for i, _, text in self.pieces:
            if not skip[i]:
                length = len(text.strip())
                total[i] += length
                linked[i] += length if self.link[i] else 0
        for i in range(len(self.tag) - 1, 0, -1):
            total[self.parent[i]] += total[i]
            linked[self.parent[i]] += linked[i]
        return total, linked

    def outside(self) -> list[bool]:
        """Elements that hold no main text.

        Comments go unless a title is in them. An odd element stays only if over half
        of the text outside links, comments and clear cases is in it, and a title too;
        where the rest of the page has no title, a paragraph or heading will do for
        forms and names. A title is an h1, article or main element.
        """
        n = len(self.tag)
        titled, plain = [t in TITLES for t in self.tag], [t in TEXTUAL for t in self.tag]
        for i in range(n - 1, 0, -1):
            titled[self.parent[i]] |= titled[i]
            plain[self.parent[i]] |= plain[i]
        out = [k == OUT or k == TALK and not titled[i] for i, k in enumerate(self.kind)]
        clear = [k == OPEN for k in self.kind]
        for i in range(1, n):
            out[i] |= out[self.parent[i]]
            clear[i] &= clear[self.parent[i]]
        named = any(c and t in TITLES for c, t in zip(clear, self.tag))
        total, linked = self.lengths(out)
        for i in range(1, n):
            if self.kind[i] in (ODD, TALK) and not out[i]:
                most = (total[i] - linked[i]) * 2 > total[0] - linked[0]
                holds = titled[i] or plain[i] and not named and self.tag[i] not in ("footer", "aside", "header")
                out[i] = not (most and holds)
            out[i] |= out[self.parent[i]]
        return out


def scores(tree: _Tree, out: list[bool]) -> list[float]:
    """Points of each container: all of its own paragraphs', half of those a level
    further down, and a third again for each level below; less the share of links."""
    n = len(tree.tag)
    near = [0] * n
    for i in range(1, n):
        near[i] = i if tree.tag[i] in PARAGRAPH else near[tree.parent[i]]
    size, commas = [0] * n, [0] * n
    for i, _, text in tree.pieces:
        if not out[i] and (length := len(text.strip())):
            size[near[i]] += length
            commas[near[i]] += text.count(",") + text.count("，") + text.count("、")
    own, below = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if size[i] and not out[i]:
            given = min(size[i] / 100, 3) + commas[i] + (1 if size[i] >= 25 else 0)
            # A holder of plain text is a paragraph of its own.
            itself = i == 0 or tree.tag[i] in HOLDER and tree.tag[i] not in ("td", "dd", "blockquote")
            own[i if itself else tree.parent[i]] += given
        if i:
            below[tree.parent[i]] += own[i] / 2 + below[i] / 3
    total, linked = tree.lengths(out)
    return [
        (own[i] + below[i]) * (1 - linked[i] / total[i]) if total[i] and tree.tag[i] in HOLDER and not out[i] else 0.0
        for i in range(n)
    ]


def main_text(page: str | None) -> str:
    """The blocks of the best container and its siblings, one per line.

    Each paragraph outside menus, adverts and the like gives points for its length
    and its commas to the elements above it, see ``scores``; of equal containers the
    first is best. It stands for the article or main element it is in, if any. With it
    stay siblings with a fifth of its points, and sibling paragraphs, headings and
    elements with paragraphs in them, however short, if less than half of their text
    is in links. A page without scored paragraphs gives all text that is not in an
    excluded element.
    """
    tree = _Tree(page or "")
    n = len(tree.tag)
    out = tree.outside()
    score, (total, linked) = scores(tree, out), tree.lengths(out)
    best = max(range(n), key=lambda i: (score[i], -i))
    up = best
    while up >= 0:
        if tree.tag[up] in ("article", "main"):
            best = up
        up = tree.parent[up]
    plain = [t in TEXTUAL for t in tree.tag]
    for i in range(n - 1, 0, -1):
        plain[tree.parent[i]] |= plain[i] and not out[i]
    kept = [False] * n
    kept[best] = True
    if score[best] and tree.parent[best] >= 0:
        for i in range(1, n):
            if tree.parent[i] == tree.parent[best] and not out[i]:
                kept[i] |= plain[i] and linked[i] * 2 < total[i] or score[i] >= score[best] / 5
    for i in range(1, n):
        kept[i] |= kept[tree.parent[i]]
    blocks: dict[int, list[str]] = {}
    for i, block, text in tree.pieces:
        if kept[i] and not out[i]:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract_text(pages: DataFrame, html_column: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of each page in column ``into``.

    Null and empty pages give an empty text, an empty table an empty one; every page
    is read whole, in time that grows with its length, and keeps its row, repeats too.
    A column named ``into`` is replaced, all others stay.
    """
    pages = pages.drop(into) if into != html_column else pages
    names = [c for c in pages.columns if c != html_column]
    rows = pages.select(*names, F.col(html_column).cast("string").alias(html_column))
    schema = StructType([*rows.select(*names).schema]).add(into, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(html_column)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array([t.encode("utf-8", "replace").decode() for t in texts], pa.string())], [*names, into]
            )

    return rows.mapInArrow(run, schema)
