"""The main text of web pages by scoring their element trees.

A page is read into a tree once, without building objects per element. Paragraphs
get points for their length and commas and pass them to the elements around them, less
with each level. A container's points are discounted by its share of link text. The
best container and those of its siblings that look like it are kept; elements that
are no part of an article by their kind or role are left out throughout, and so are forms
and what bears such a name, unless it holds most of the page's points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, text_runs

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img br".split()
)
#: Never part of an article, whatever stands in them.
DROPPED = frozenset(
    "script style noscript template nav aside footer button select textarea input option optgroup "
    "iframe object embed svg canvas audio video map menu dialog head title fieldset datalist".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form tablist status".split()
)
#: Words in an element's class or id that mark what surrounds an article.
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promoted promotion "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager sidebar sidebars aside footer foot "
    "masthead topbar toolbar cookie cookies consent gdpr notice notices banner banners alert popup popover modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations trending comment comments "
    "commentlist disqus respond reply replies widget widgets skip copyright legal disclaimer hidden".split()
)
#: The page's own frame, and what holds articles: not judged by class or id.
FRAME = frozenset("html body main article".split())
PARAGRAPHS = frozenset("p pre td blockquote dd".split())
CONTAINERS = frozenset("article main section div td blockquote body".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
LEAST_PARAGRAPH = 25
#: A form, or what is named like surroundings, stays with this share of the page's points.
MOST = 0.8


class _Tree(HTMLParser):
    """Elements as parallel lists in page order; ``texts`` holds (element, text) and (element, None) for a block's edge."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.out, self.doubtful = ["#page"], [-1], [False], [False]
        self.texts: list[tuple[int, str | None]] = []
        self.open = [0]

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and tag in self.tags:
            return
        if tag not in INLINE:
            self._close({"p"}, {"td", "th", "button", "object", "table", "article", "div", "section", "li"} if tag != "p" else {"td", "th", "button", "object", "table"})
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        top = self.open[-1]
        if tag == "br":
            self.texts.append((top, " "))
            return
        me = len(self.tags)
        self.tags.append(tag)
        self.parents.append(top)
        self.out.append(self.out[top] or self._outside(tag, dict(attrs), top))
        self.doubtful.append(tag == "form" or self._named(tag, dict(attrs)))
        if tag not in INLINE:
            self.texts.append((me, None))
        if tag not in VOID:
            self.open.append(me)

    def _close(self, tags, border):
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[depth]]
            if tag in tags:
                self._pop(depth)
                return
            if tag in border:
                return

    def _pop(self, depth):
        for me in self.open[depth:]:
            if self.tags[me] not in INLINE:
                self.texts.append((self.parents[me], None))
        del self.open[depth:]

    def _outside(self, tag, attrs, top) -> bool:
        if tag in DROPPED or (attrs.get("role") or "").lower() in DROPPED_ROLES:
            return True
        if tag == "header" and not any(self.tags[i] in ("article", "main") for i in self.open):
            return True
        return "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or bool(re.search(r"display\s*:\s*none", attrs.get("style") or "", re.I))

    def _named(self, tag, attrs) -> bool:
        if tag in FRAME and not (tag == "article" and self._inside("article")):
            return False
        named = f"{attrs.get('class') or ''} {attrs.get('id') or ''}"
        if named == " ":
            return False
        words = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", named).lower())
        return not DROPPED_NAMES.isdisjoint(words)

    def _inside(self, tag) -> bool:
        return any(self.tags[i] == tag for i in self.open)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tags[self.open[depth]] == tag:
                self._pop(depth)
                return

    def handle_data(self, data):
        if not self.out[self.open[-1]]:
            self.texts.append((self.open[-1], data))


def _scores(tree: _Tree) -> tuple[list[float], list[int], list[int], list[float]]:
    """Points, text length and link text length of each element, and what it gives as a paragraph."""
    n = len(tree.tags)
    length, links, commas = [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[tree.parents[i]] or tree.tags[i] == "a"
    for i, text in tree.texts:
        if text:
            size = len("".join(text.split()))
            length[i] += size
            commas[i] += text.count(",") + text.count("،") + text.count("、") + text.count("，")
            if linked[i]:
                links[i] += size
    # what stands in inline elements belongs to the block around them
    own = list(length)
    for i in range(n - 1, 0, -1):
        p = tree.parents[i]
        if tree.tags[i] in INLINE:
            own[p] += own[i]
            commas[p] += commas[i]
        length[p] += length[i]
        links[p] += links[i]
    points, gains = [0.0] * n, [0.0] * n
    for i in range(1, n):
        # a paragraph, or text that stands in a container itself
        if tree.out[i] or tree.tags[i] in INLINE or own[i] < LEAST_PARAGRAPH:
            continue
        is_paragraph = tree.tags[i] in PARAGRAPHS or tree.tags[i] == "li"
        if not is_paragraph and tree.tags[i] not in CONTAINERS:
            continue
        gain = (1 + commas[i] + min(own[i] / 100, 3)) * (1 - links[i] / max(length[i], 1))
        gains[i] = gain
        around, level = (tree.parents[i], 1) if is_paragraph else (i, 1)
        while around > 0 and level < 1000:  # further up next to nothing arrives
            points[around] += gain / level
            around, level = tree.parents[around], level * 2 if level < 2 else level * 3
    return points, length, links, gains


def _without_surroundings(tree: _Tree, gains: list[float]) -> bool:
    """Leaves out each doubtful element that holds less than ``MOST`` of what is left of the page, or stands beside an article; whether there were any."""
    n, out, held = len(tree.tags), tree.out, list(gains)
    for i in range(n - 1, 0, -1):
        held[tree.parents[i]] += held[i]
    left, dropped = held[0], False
    in_articles = sum(held[i] for i in range(1, n) if tree.tags[i] in ("article", "main") and not out[i])
    inside = [0.0] * n  # what the articles in an element, and those around it, hold
    for i in range(n - 1, 0, -1):
        inside[i] += held[i] if tree.tags[i] in ("article", "main") and not out[i] else 0
        inside[tree.parents[i]] += inside[i]
    around = [0.0] * n
    for i in range(1, n):
        p = tree.parents[i]
        around[i] = around[p] + (held[p] if tree.tags[p] in ("article", "main") and not out[p] else 0)
        if out[p]:
            out[i] = True
        elif tree.doubtful[i] and not out[i] and (not held[i] or held[i] < MOST * left or in_articles - inside[i] - around[i] > 1e-9):
            out[i] = dropped = True
            left -= held[i]
    return dropped


def main_text(html: str) -> str:
    """The text blocks of a page's article, one a line; empty if it has none."""
    tree = _Tree()
    tree.feed(re.sub(r"<[/!?a-zA-Z][^<>]*\Z", "", html))  # a tag that the page's end cuts off
    tree.close()
    tree._pop(1)
    points, length, links, gains = _scores(tree)
    if _without_surroundings(tree, gains):
        tree.texts = [(i, text) for i, text in tree.texts if text is None or not tree.out[i]]
        points, length, links, _ = _scores(tree)
    n, tags, parents = len(tree.tags), tree.tags, tree.parents
    density = [links[i] / length[i] if length[i] else 0.0 for i in range(n)]
    best, most = 0, 0.0
    for i in range(1, n):
        if not tree.out[i] and tags[i] not in PARAGRAPHS and points[i] * (1 - density[i]) > most:
            best, most = i, points[i] * (1 - density[i])
    # an article is kept whole, with its title
    around = best
    while around > 0:
        if tags[around] in ("article", "main") and tags[best] != "article":
            best = around
        around = parents[around]
    kept = [False] * n
    kept[best] = True
    if best > 0 and tags[best] not in ("article", "main", "body"):
        for i in range(1, n):
            if parents[i] == parents[best] and not tree.out[i]:
                similar = points[i] > 0 and points[i] * (1 - density[i]) >= 0.2 * most
                paragraph = tags[i] in PARAGRAPHS and (length[i] > 80 and density[i] < 0.25 or 0 < length[i] <= 80 and not links[i])
                heading = tags[i] in ("h1", "h2", "h3", "header") and not links[i]
                kept[i] = kept[i] or similar or paragraph or heading
    for i in range(1, n):
        kept[i] = kept[i] or kept[parents[i]]
    # a list of links is a menu
    count = [0] * n
    for i in range(n - 1, 0, -1):
        count[i] += tags[i] == "a"
        count[parents[i]] += count[i]
    out = tree.out
    for i in range(1, n):
        out[i] = out[i] or out[parents[i]] or tags[i] in ("ul", "ol") and count[i] >= 3 and density[i] > 0.8
    blocks, block = [], []
    for i, text in [*tree.texts, (0, None)]:
        if text is None:
            line = " ".join("".join(block).split())
            if line:
                blocks.append(line)
            block = []
        elif kept[i] and not out[i]:
            block.append(text)
    return "\n".join(blocks)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """One row per row: its id, the columns of ``keep``, ``text`` and ``n_chars``.

    Character references are decoded, white space in a block is one space, blocks stand
    in page order with a line break between. A null or empty page, and one without
    text, gives an empty text. Broken markup is read as browsers do as far as the text
    is concerned; no page is refused or cut.
    """
    keep = keep or []
    rows = pages.select(F.col(html_col).cast("string").alias("__html"), F.col(id_col), *keep)
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in [id_col, *keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_runs(batch.column(0)):
                part = batch.slice(lo, hi - lo)
                texts = [main_text(h) if h else "" for h in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, *keep, "text", "n_chars"])

    return rows.mapInArrow(run, f"{fields}, text string, n_chars long")


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return extract(table(spark, sf_dir, "pages"), keep=["url"])
