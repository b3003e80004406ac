"""Main text of web pages from streaming parser events.

The standard library's parser sends the events of a page, one after another, to a line builder:
block tags end a line, inline tags do not, and elements that never hold an article's text are
passed over. Every line has the text-to-tag ratio of its characters to the tags met in it, each
link counting more. The ratios are smoothed with a Gaussian and lines are clustered by a
threshold in units of the smoothed ratios' deviation; regions are the runs of lines with one
container, and a region with content lines is kept with all its lines, so that a short paragraph
between long ones stays. Without <article> or <main>, the region is the element that holds most of
the content lines.

Classes, ids, roles and tags such as nav or form hide parts outside the article, but never the only
article or (classes and forms), on a page without one, most of the page's text. Inside an article a
class hides a part only if all its words do. A page's time is linear in its events: list items, cells
and paragraphs end where the next begins, and a line keeps its block, not its path.

Defined cases: null or empty html gives an empty text; a page without an article container is
judged by the ratios alone; unclosed tags are closed by the parser's events or the page's end;
white space inside a block is one space; character references are decoded; copies and repeated
rows are done one by one; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# HTML elements by their part in a page.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol
    option p pre section summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("""head nav header footer aside menu form script style noscript template svg iframe object
    button select textarea input dialog canvas math video audio""".split())
CONTENT = frozenset(["article", "main"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
LINES = HEADINGS | {"p", "pre"}
# Words of class, id and role that mark parts outside the article.
OUTSIDE = re.compile(r"""(?xi)(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner|cookie\w*|consent|notice|
    alert|popup|modal|overlay|nav\w*|menu\w*|breadcrumb\w*|sidebar|side|aside|widget\w*|footer|header|masthead|
    comment\w*|disqus\w*|replies|reply|respond|discussion|related|recommend\w*|share|sharing|social|newsletter|
    subscri\w*|login|signup|search|pagination|pager|skip|toc|copyright|legal)(?:$|[\s_-])""")
#: The same for readers' comments, which may be articles of their own.
COMMENTS = re.compile(r"(?i)(?:^|[\s_-])(?:comment\w*|disqus\w*|replies|reply|respond|discussion)(?:$|[\s_-])")
OUTSIDE_ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alert alertdialog
    menu menubar toolbar""".split())
#: Inside an article, a class or id hides a part if all its words are of the first kind or, beside one of these, of the second.
INSIDE = re.compile(r"""(?ix)ads? | advert\w* | sponsor\w* | promo\w* | banner | cookie\w* | consent | notice | alert | popup |
    modal | overlay | nav\w* | menu\w* | breadcrumb\w* | sidebar | aside | widget\w* | footer | comment\w* | disqus\w* |
    replies | reply | respond | related | recommend\w* | share | sharing | social | newsletter | subscri\w* | login | signup |
    pagination | pager""")
PLAIN = re.compile(r"""(?ix)box | container | wrapper | block | lists? | section | area | inner | unit | slot | links? |
    buttons? | bar | form | items? | top | bottom | left | right | posts? | articles | stories | icons? | panel | \d+""")
#: Elements passed over by their tag that are shown if the page's articles are in them, as a form around a page is.
AROUND = frozenset("nav header footer aside menu form dialog".split())
#: Open elements that a start tag ends, and the elements beyond which it ends none.
_CELL, _TABLE = frozenset(["td", "th"]), frozenset(["table"])
ENDS = {"p": (frozenset(["p"]), BLOCKS), "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
        "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
        "tr": (frozenset(["tr"]) | _CELL, _TABLE), "td": (_CELL, frozenset(["tr"]) | _TABLE), "th": (_CELL, frozenset(["tr"]) | _TABLE),
        "tbody": (frozenset(["thead", "tbody", "tfoot"]), _TABLE), "tfoot": (frozenset(["thead", "tbody", "tfoot"]), _TABLE),
        "option": (frozenset(["option"]), frozenset(["select", "datalist"]))}
#: Open elements that are looked at for one that ends; beyond them, a part counts as nested.
NEAR = 32
# end of fixed values

SIGMA, RADIUS, LINK_TAGS = 1.0, 2, 3
#: A line is content if its smoothed ratio is above the mean minus this part of the deviation.
SPREAD = 1.0
_SPACE = re.compile(r"\s+")


class Node:
    """An open block element: its number in the page, tag, depth and parent block."""

    __slots__ = ("number", "tag", "depth", "parent")

    def __init__(self, number: int, tag: str, depth: int, parent: Node | None):
        self.number, self.tag, self.depth, self.parent = number, tag, depth, parent


class Lines(HTMLParser):
    """Builds the lines (text, tags, region, inside an article, heading, block) of a page from its
    events; elements whose numbers are in `shown` are not passed over for what may be shown."""

    def __init__(self, shown: frozenset[int] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool, bool, Node | None]] = []
        self.shown, self.number = shown, 0
        self.block: Node | None = None  # the innermost open block element
        self.nodes: list[Node] = []
        self.marked: list[list] = []  # open elements that may be shown: number, depth, by tag or role
        self.found: dict[int, list] = {}  # characters, comments, holds an article, by tag or role, by number
        self.closed = 0  # depth of elements that are never shown
        self.characters = self.by_tag = 0
        self.open: list[tuple[str, bool, bool, bool]] = []  # tag, passed over, content container, block
        self.count: Counter[str] = Counter()  # open elements by tag
        self.hidden = self.content = self.headings = self.region = self.regions = self.tags = 0
        self.text: list[str] = []

    def end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.lines.append((text, self.tags, self.region, self.content > 0, self.headings > 0, self.block))
        self.text, self.tags = [], 0

    def _outside(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        """Why an element is passed over: '' not at all, 'class', 'form' or 'tag' may be shown, 'never' not."""
        shown = self.number in self.shown
        if tag in SKIPPED:
            if shown or tag == "header" and self.content:  # a header inside an article is part of it
                return ""
            return "never" if tag not in AROUND else "form" if tag == "form" else "tag"
        named = [v for n, v in attrs if n in ("class", "id") and v]
        if tag in CONTENT:
            return "class" if not shown and any(map(COMMENTS.search, named)) else ""
        if tag in ("html", "body"):
            return ""
        role = False
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true") \
                    or (name == "style" and value and re.search(r"display\s*:\s*none", value)):
                return "never"
            role |= name == "role" and bool(value) and value.lower() in OUTSIDE_ROLES
        if shown:
            return ""
        if any(inside(v) if self.content else OUTSIDE.search(v) for v in named):
            return "class"
        return "tag" if role else ""

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS and not self.hidden:
            self.end_line()
        self.tags += LINK_TAGS if tag == "a" else 1
        if tag in VOID:
            self.text.append(" " if tag == "br" else "")
            return
        self._implied(tag)
        self.number += 1
        why, content, block = self._outside(tag, attrs), tag in CONTENT, tag in BLOCKS
        if content and not why and not self.closed and self.marked:
            self.found[self.marked[-1][0]][2] = True
        self.open.append((tag, bool(why), content, block))
        self.count[tag] += 1
        self.headings += tag in HEADINGS
        if block:
            self.block = Node(self.number, tag, len(self.open), self.block)
            self.nodes.append(self.block)
        if why == "never":
            self.closed = self.closed or len(self.open)
        elif why:
            value = " ".join(v or "" for n, v in attrs if n in ("class", "id"))
            self.marked.append([self.number, len(self.open), why == "tag"])
            self.by_tag += why == "tag"
            self.found[self.number] = [0, why == "class" and bool(COMMENTS.search(value)), False, why == "tag"]
        self.hidden += bool(why)
        self.content += content
        if content and not self.hidden:
            self.regions += 1
            self.region = self.regions

    def _implied(self, tag: str) -> None:
        """Closes what a start tag ends without an end tag: paragraphs, list items, cells and the like."""
        ended, bounds = ENDS.get(tag, (None, None))
        if not ended:
            return
        to = None
        for i in range(len(self.open) - 1, max(-1, len(self.open) - 1 - NEAR), -1):
            name = self.open[i][0]
            if name in ended:
                to = i
                if tag != "tr":  # a row ends the cell and the row around it
                    break
            elif name in bounds or name in SKIPPED or name in CONTENT:
                break
        if to is not None:
            self._close(to)

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCKS and not self.hidden:
            self.end_line()
        self.tags += 1
        self.text.append(" " if tag == "br" else "")

    def _close(self, to: int) -> None:
        while len(self.open) > to:
            depth = len(self.open)
            tag, outside, content, block = self.open.pop()
            self.count[tag] -= 1
            self.headings -= tag in HEADINGS
            if block:
                self.block = self.block.parent
            if self.marked and self.marked[-1][1] == depth:
                number, _, by_tag = self.marked.pop()
                self.by_tag -= by_tag
                if self.marked:  # what it holds, the one around it holds too
                    size, _, article, _ = self.found[number]
                    around = self.found[self.marked[-1][0]]
                    around[0] += size
                    around[2] |= article
            if self.closed == depth:
                self.closed = 0
            self.hidden -= outside
            self.content -= content
            if content and not outside and not self.hidden:
                self.regions += 1
                self.region = self.regions

    def handle_endtag(self, tag):
        if tag in BLOCKS and not self.hidden:
            self.end_line()
        self.tags += 1
        if not self.count[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._close(i)
                return
            if self.open[i][1] and tag not in SKIPPED and tag not in CONTENT:
                return  # an end tag does not leave a part that is passed over

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)
        if not self.closed:
            n = len("".join(data.split()))
            if not self.by_tag:
                self.characters += n
            if self.marked:
                self.found[self.marked[-1][0]][0] += n

    def wrappers(self) -> set[int]:
        """Elements passed over that must be shown: those around the articles of a page that shows none,
        or, if it has none at all, those of over half of its text."""
        holds = {n for n, (_, comments, article, _) in self.found.items() if article and not comments}
        if any(x[3] for x in self.lines):
            return set()
        if any(article for _, _, article, _ in self.found.values()):
            return holds
        return {n for n, (size, comments, _, by_tag) in self.found.items()
                if not comments and not by_tag and 2 * size > self.characters}

    def finish(self) -> list[tuple[str, int, int, bool, bool, Node | None]]:
        self.close()
        self.end_line()
        self._close(0)
        return self.lines


def inside(value: str) -> bool:
    """Whether a class or id marks a part of an article that is not its text."""
    for name in value.split():
        words = [w for w in re.split(r"[_-]+", name) if w]
        if any(map(INSIDE.fullmatch, words)) and all(INSIDE.fullmatch(w) or PLAIN.fullmatch(w) for w in words):
            return True
    return False


def smoothed(x: np.ndarray) -> np.ndarray:
    """x convolved with a Gaussian; the kernel's part inside the page counts as all of it."""
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    pad = np.convolve(np.ones(len(x)), kernel)[RADIUS:RADIUS + len(x)]
    return np.convolve(x, kernel)[RADIUS:RADIUS + len(x)] / pad


def holder(nodes: list[Node], dense: list[Node | None]) -> Node | None:
    """The innermost element that holds over half of the dense lines; paragraphs and headings are no holders."""
    count = Counter(x.number for x in dense if x)
    for x in reversed(nodes):  # children come after their parents
        if x.parent and x.number in count:
            count[x.parent.number] += count[x.number]
    return next((x for x in reversed(nodes) if x.tag not in LINES and 2 * count[x.number] > len(dense)), None)


def members(nodes: list[Node], region: Node | None) -> set[int]:
    """Numbers of the blocks whose lines are in the region; of a page's body, its own paragraphs alone."""
    if region is None or region.tag in ("html", "body"):
        return {x.number for x in nodes if x.parent is region and x.tag in LINES}
    held = {region.number}
    for x in nodes:
        if x.parent and x.parent.number in held:
            held.add(x.number)
    return held


def main_text(html: str) -> str:
    """Lines of the content regions of a page, joined by newlines."""
    if not html:
        return ""
    shown: frozenset[int] = frozenset()
    while True:
        parser = Lines(shown)
        parser.feed(html)
        lines = parser.finish()
        more = parser.wrappers() - shown
        if not more:
            break
        shown |= more
    if any(x[3] for x in lines):  # an article container bounds the regions
        lines = [x for x in lines if x[3]]
    if not lines:
        return ""
    ratio = smoothed(np.array([len(text) / max(1, tags) for text, tags, *_ in lines]))
    dense = ratio >= ratio.mean() - SPREAD * ratio.std()
    if not lines[0][3]:  # without one, the region is the run of dense lines with its gaps and headings,
        first, last = np.flatnonzero(dense)[[0, -1]]
        while first and lines[first - 1][4]:
            first -= 1
        region = holder(parser.nodes, [x[5] for x, d in zip(lines, dense, strict=True) if d])
        own = members(parser.nodes, region)
        return "\n".join(x[0] for i, x in enumerate(lines) if first <= i <= last or x[5] and x[5].number in own)
    kept = {x[2] for x, d in zip(lines, dense, strict=True) if d}
    return "\n".join(x[0] for x in lines if x[2] in kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages."""
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))

    def make():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(x) for x in b.column("html").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])
        return step
    return common.map_arrow(pages, make, "page_id long, url string, text string, n_chars long")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page: its main text and the number of its code points."""
    common.prepare(spark)
    return extract(common.read(spark, sf_dir, "pages"))
