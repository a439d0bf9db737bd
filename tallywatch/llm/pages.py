"""Main text of web pages by composite text density.

Each element has a density: its characters per tag, raised where few of them are link text and lowered where many are.
The element whose children's densities have the greatest sum is where the article lies. The lowest density on the way
from it up to the body is the threshold, and every other branch that reaches it gives its own element of greatest sum.
An element inside an article or main element stands for all of that, and a first heading beside or above it belongs to it.

Before that, elements go that say by tag, role, class or id that they are no part of the article: menus, headers,
footers, sidebars, notices, adverts, forms, reader comments. A class or id removes no element that holds the main
element or the first heading (or, on a page without these, an article), nor, on a page without any, half of the text.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Elements by what they mean.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody tfoot "
    "thead tr ul caption".split()
)
ENDS_SAME = {
    "li": ("li", {"ul", "ol", "menu", "dir"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}),
    "tr": ("tr", {"table", "tbody", "thead", "tfoot"}), "td": ("td th", {"tr"}), "th": ("td th", {"tr"}),
    "option": ("option", {"select", "datalist"}),
}
OUTSIDE_TAGS = frozenset(
    "nav header footer aside form button select input label menu dialog fieldset object audio video canvas".split()
)
OUTSIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar status toolbar".split()
)
OUTSIDE_NAMES = frozenset(
    "nav navbar navigation menu menubar submenu breadcrumb breadcrumbs header masthead topbar footer sidebar aside rail "
    "ad ads advert adverts advertisement advertisements advertising adbox adslot sponsor sponsored sponsors promo promos "
    "promotion banner cookie cookies consent gdpr notice notices notification notifications alert alerts warning "
    "disclaimer popup modal overlay newsletter subscribe subscription signup login register search share sharing social "
    "related recommended recommendations trending popular pagination pager toolbar widget widgets comment comments "
    "commentlist disqus respond reply replies feedback copyright legal skip form forms".split()
)
# Elements that hold one piece of text and are never an article by themselves.
TEXT_ONLY = frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption caption address summary legend tr td th thead tbody tfoot "
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr hr ul ol dl table figure".split()
)
ARTICLE_TAGS = frozenset("main h1".split())
NEVER_OUTSIDE = frozenset("html body main h1 h2 h3 h4 h5 h6".split())

# Elements that hold paragraphs, or are one.
HOLDERS = BLOCKS | {"td", "th"}

_TOKEN = re.compile(r"<!--|<!|<\?|<(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TAG_REST = re.compile(r"""[^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class _Tree:
    """Elements in page order as parallel lists; the parent of an element comes before it.

    The depths of open elements are kept per tag, so that no step walks over elements that it does not close.
    """

    def __init__(self) -> None:
        self.tag, self.parent, self.outside = ["#root"], [0], [False]
        self.runs: list[tuple[int, str]] = []  # (element, text) in page order; text None ends a block
        self.open = [0]
        self.depths: dict[str, list[int]] = {}
        self.holders: list[int] = []  # depths of open elements in which a paragraph ends

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self._end_paragraph()
        if tag in ENDS_SAME:
            names, scope = ENDS_SAME[tag]
            self._close(names.split(), scope)
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.outside.append(_outside(tag, attributes))
        node = len(self.tag) - 1
        if tag in BLOCKS:
            self.runs.append((node, None))
        elif tag in ("br", "td", "th", "img"):
            self.runs.append((self.open[-1], " "))
        if tag not in VOID:
            self.depths.setdefault(tag, []).append(len(self.open))
            if tag in HOLDERS:
                self.holders.append(len(self.open))
            self.open.append(node)

    def _cut(self, depth: int) -> None:
        """Close the open element at this depth and all in it."""
        for node in self.open[depth:]:
            self.depths[self.tag[node]].pop()
        while self.holders and self.holders[-1] >= depth:
            self.holders.pop()
        del self.open[depth:]

    def end(self, tag: str) -> None:
        if self.depths.get(tag):
            self._cut(self.depths[tag][-1])
        if tag in BLOCKS:
            self.runs.append((self.open[-1], None))

    def _end_paragraph(self) -> None:
        if self.holders and self.tag[self.open[self.holders[-1]]] == "p":
            self._cut(self.holders[-1])

    def _innermost(self, tags: Iterable[str]) -> int:
        """Depth of the innermost open element with one of the tags, 0 for none."""
        return max((self.depths[tag][-1] for tag in tags if self.depths.get(tag)), default=0)

    def _close(self, names: Iterable[str], scope: Iterable[str]) -> None:
        depth = self._innermost(names)
        if depth > self._innermost(scope):
            self._cut(depth)


def _outside(tag: str, attributes: str) -> int:
    """0 for an element that may be article, 1 for one that its names put outside, 2 for one that is outside anyway."""
    if tag in OUTSIDE_TAGS:
        return 2
    if not attributes or tag in NEVER_OUTSIDE:
        return 0
    found = 0
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return 2
        if name == "role" and value.lower() in OUTSIDE_ROLES:
            return 2
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return 2
        if name in ("class", "id") and any(w.lower() in OUTSIDE_NAMES for w in _NAME.findall(value)):
            found = 1
    return found


def _parse(page: str) -> _Tree:
    tree, at, n = _Tree(), 0, len(page)
    while at < n:
        found = _TOKEN.search(page, at)
        if found is None:
            tree.runs.append((tree.open[-1], page[at:]))
            break
        if found.start() > at:
            tree.runs.append((tree.open[-1], page[at: found.start()]))
        kind = found.group()
        if kind == "<!--":
            end = page.find("-->", found.end())
            at = n if end < 0 else end + 3
            continue
        if kind in ("<!", "<?"):
            end = page.find(">", found.end())
            at = n if end < 0 else end + 1
            continue
        rest = _TAG_REST.match(page, found.end())
        at = rest.end()
        if at < n and page[at] != ">":  # a quote that nothing closes
            end = page.find(">", at)
            at = n if end < 0 else end
        attributes = page[found.end(): at]
        at += 1
        closing, tag = found.group(1), found.group(2).lower()
        if closing:
            tree.end(tag)
            continue
        tree.start(tag, attributes)
        if attributes.endswith("/") and tag not in VOID and tag in ("svg", "math"):
            tree.end(tag)
        elif tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = n if end is None else end.start()
            if tag not in ("textarea",):
                tree.outside[-1] = 2
    return tree


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in page order, joined by two line feeds; empty if there is none."""
    if not page:
        return ""
    tree = _parse(page)
    n = len(tree.tag)
    runs = [(node, None if text is None else html.unescape(text) if "&" in text else text) for node, text in tree.runs]
    sizes = [0 if text is None else len("".join(text.split())) for _, text in runs]

    outside = [False] * n
    held = _subtree_sums(tree, runs, sizes, [kind == 2 for kind in tree.outside])
    some = ARTICLE_TAGS if ARTICLE_TAGS & set(tree.tag) else {"article"}
    marked = [not kind and tag in some for tag, kind in zip(tree.tag, tree.outside)]
    for node in range(n - 1, 0, -1):
        marked[tree.parent[node]] |= marked[node] and tree.outside[node] < 2
    for node in range(1, n):
        kind = tree.outside[node]
        named = kind == 1 and not (marked[node] if marked[0] else 2 * held[node] >= held[0])
        outside[node] = outside[tree.parent[node]] or kind == 2 or named

    content = _content(tree, runs, sizes, outside)
    blocks, block = [], []
    for node, text in [*runs, (0, None)]:
        if text is None:
            whole = " ".join("".join(block).split())
            if whole:
                blocks.append(whole)
            block = []
        elif content[node]:
            block.append(text)
    return "\n\n".join(blocks)


def _subtree_sums(tree: _Tree, runs: list, sizes: list[int], away: list[bool]) -> list[int]:
    """Characters below each element, without those below elements that are away."""
    gone = list(away)
    for node in range(1, len(gone)):
        gone[node] = gone[node] or gone[tree.parent[node]]
    sums = [0] * len(gone)
    for (node, _), size in zip(runs, sizes):
        if not gone[node]:
            sums[node] += size
    for node in range(len(sums) - 1, 0, -1):
        sums[tree.parent[node]] += sums[node]
    return sums


def _content(tree: _Tree, runs: list, sizes: list[int], outside: list[bool]) -> list[bool]:
    """Which elements belong to the article."""
    n, parent = len(tree.tag), tree.parent
    linked = [False] * n
    for node in range(1, n):
        linked[node] = tree.tag[node] == "a" or linked[parent[node]]
    chars, link_chars, tags, link_tags, direct = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    for (node, _), size in zip(runs, sizes):
        if size and not outside[node]:
            chars[node] += size
            direct[node] += 0 if linked[node] else size
            link_chars[node] += size if linked[node] else 0
    for node in range(n - 1, 0, -1):
        if not outside[node]:
            up = parent[node]
            chars[up] += chars[node]
            link_chars[up] += link_chars[node]
            tags[up] += tags[node] + 1
            link_tags[up] += link_tags[node] + (tree.tag[node] == "a")
    none = [False] * n
    if not chars[0]:
        return none
    body_share = link_chars[0] / chars[0]
    density = [0.0] * n
    for node in range(n):
        c, lc = chars[node], link_chars[node]
        if c and not outside[node]:
            t, lt = max(tags[node], 1), max(link_tags[node], 1)
            base = math.log(c * lc / max(c - lc, 1) + body_share * c + math.e)
            density[node] = c / t * math.log(max(c * t / (max(lc, 1) * lt), 1)) / math.log(max(base, 1 + 1e-9)) if base > 1 \
                else c / t * math.log(max(c * t / (max(lc, 1) * lt), 1)) * 1e9
    sums = [float(d) for d in direct]
    for node in range(1, n):
        if not outside[node]:
            sums[parent[node]] += density[node]
    return _marked(tree.tag, parent, outside, density, sums)


def _marked(tags: list[str], parent: list[int], outside: list[bool], density: list[float], sums: list[float]) -> list[bool]:
    n = len(parent)
    sums = [-1.0 if tag in TEXT_ONLY else s for tag, s in zip(tags, sums)]
    best = list(range(n))  # the element of greatest sum in each subtree, the outermost among equals
    for node in range(n - 1, 0, -1):
        up = parent[node]
        if not outside[node] and sums[best[node]] > sums[best[up]]:
            best[up] = best[node]
    at = best[0]
    threshold = density[at]
    while at:
        at = parent[at]
        threshold = min(threshold, density[at])
    content, reached, whole = [False] * n, [False] * n, _wholes(tags, parent)
    for node in range(n):
        reached[node] = not outside[node] and (not node or reached[parent[node]]) and density[node] >= threshold
        if reached[node]:
            content[whole[best[node]]] = True
    above = set()
    for node in range(n - 1, 0, -1):
        if content[node] or node in above:
            above.add(parent[node])
    for node in range(1, n):
        title = tags[node] == "h1" and parent[node] in above
        content[node] = not outside[node] and (content[node] or content[parent[node]] or title)
    return content


def _wholes(tags: list[str], parent: list[int]) -> list[int]:
    """For every element the outermost article around it, or else the innermost main element, or itself."""
    article, main, whole = [0] * len(tags), [0] * len(tags), list(range(len(tags)))
    for node in range(1, len(tags)):
        article[node] = article[parent[node]] or (node if tags[node] == "article" else 0)
        main[node] = node if tags[node] == "main" else main[parent[node]]
        whole[node] = article[node] or main[node] or node
    return whole


def extract(pages: DataFrame, page: str = "html", into: str = "text") -> DataFrame:
    """The rows of `pages` with the main text as column `into`, which replaces one of that name, in place of the markup.

    NULL and empty pages, and pages without text, give an empty text. Other columns pass unchanged; no shuffle.
    """
    names, at = pages.columns, pages.columns.index(page)
    numbered = pages.toDF(*(f"c{i}" for i in range(len(names))))
    kept = [i for i, name in enumerate(names) if i != at and name != into]
    schema = T.StructType([numbered.schema.fields[i] for i in kept] + [T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts = [main_text(value.as_py()) for value in part.column(at)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in kept), pa.array(texts, pa.string())], schema=pa.schema(
                        [part.schema.field(i) for i in kept] + [("text", pa.string())]))

    return numbered.mapInArrow(run, schema).toDF(*(names[i] for i in kept), into)
