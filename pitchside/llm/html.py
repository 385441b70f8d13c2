"""Main text of web pages by text-to-tag ratios.

A page is read once as a stream of parser events and cut into lines, one
per block element, each with its text, the tags inside it and how much of it
is link text. The ratio of unlinked text to tags per line is smoothed with a
Gaussian and the lines are split into two clusters by a threshold on the
logarithm of that level; the lines of the upper cluster are the content
regions. The lower cluster lies at 0, the level of lines without text.
What the markup itself names as something else (menus, headers, footers,
asides, adverts, notices, forms, scripts, comments) takes part with ratio 0
and is never content: by its tag, its role, or a whole class or id that says
so (``cookie-notice``, ``site-footer``, but not ``with-sidebar``). A form around
the whole page or a menu that is never closed is read after all if the page has
no paragraph and no article outside and far more text inside. Ends that HTML implies are kept: a block ends the head, a
link ends the link before it, and a target without ``href`` is no link. ``article`` and ``main`` raise the level of their lines
by ``SEED`` and decide nothing alone: a list of links in an article falls
into the lower cluster, and a story beside a teaser article is kept. A short
advert or notice without a telling name that stands between paragraphs is
smoothed into them and stays.

Pages are independent: one Arrow pass, no shuffle. Defined results: null or
empty html has the empty text; markup that ends early is read as far as it
goes; repeated rows are extracted alike; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0
SEED = 32.0  # an article or main part raises the level of its lines by this factor
LINK_SHARE = 0.6
PARAGRAPH = 80  # unlinked characters of a line that make a page's story
BULK = 4  # times that, and times the text outside, a container must hold to be read as the page
LIST_SHARE = 0.63  # smoothed: below it a linked line has no linked neighbour

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary
table tbody tfoot thead tr ul""".split())
SKIPPED = frozenset("""head title nav footer aside form script style noscript template button select textarea
iframe object svg canvas audio video menu dialog""".split())
ROOTS = frozenset(["html", "body", "article", "main"])
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion
banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription
sidebar widget widgets related recommended share sharing social breadcrumb breadcrumbs menu nav navbar navigation
pagination pager footer masthead toolbar comment comments disqus respond replies login signup""".split())
# Parts of a class or id that say where or how, not what (fixed values).
MODIFIERS = frozenset("""site main page left right top bottom global primary secondary sub section block box area wrapper
wrap container list item items inner outer bar panel group links link icons buttons button message text form field
row col column slot unit space zone fixed sticky mobile desktop small large the""".split())
WRAPPERS = frozenset("nav header form menu".split())  # tags that can by mistake hold the page
HARD = frozenset("title style script noscript template button select textarea iframe object svg canvas audio video".split())
IN_HEAD = frozenset("head title meta link style script base noscript template".split())
WORD = re.compile("[a-z0-9]+")


def says_other(value: str) -> bool:
    """A class or id whose parts name something else and nothing besides."""
    for token in value.lower().split():
        parts = set(WORD.findall(token))
        if parts & NAMES and parts <= NAMES | MODIFIERS:
            return True
    return False



class Line:
    __slots__ = ("parts", "tags", "linked", "skips", "marked")

    def __init__(self, skips: tuple[int, ...], marked: bool) -> None:
        self.parts: list[str] = []
        self.tags = 0
        self.linked = 0
        self.skips = skips  # the containers around it that are something else
        self.marked = marked


class LineReader(HTMLParser):
    """Parser events to lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, tuple[int, ...], bool, bool]] = []  # tag, skips, inside article or main, a link
        self.depth: dict[str, int] = {}
        self.links = 0
        self.by_tag: list[bool] = []  # of each skipped container: a wrapper, and only its tag says so
        self.lines: list[Line] = [Line((), False)]
        self.linked_text = False  # since the open link began

    def state(self) -> tuple[tuple[int, ...], bool]:
        return self.open[-1][1:3] if self.open else ((), False)

    def new_line(self) -> None:
        self.lines.append(Line(*self.state()))

    def names_other(self, tag: str, attrs: dict[str, str], marked: bool) -> str:
        """'' (content), 'tag' (only the tag says otherwise) or 'name'."""
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or tag in HARD:
            return "name"
        if tag not in ("html", "body", "main"):
            if attrs.get("role") in ROLES or says_other(attrs.get("class", "")) or says_other(attrs.get("id", "")):
                return "name"
        elif tag != "main" and attrs.get("role") in ROLES and (attrs.get("class") or attrs.get("id")):
            return "name"
        return "tag" if tag in SKIPPED or tag == "header" and not marked else ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.depth.get("head") and tag not in IN_HEAD:
            self.pop("head")
            self.new_line()
        self.lines[-1].tags += 1
        if tag in VOID:
            if tag == "hr":
                self.new_line()
            elif tag == "br":
                self.lines[-1].parts.append(" ")
            return
        if tag == "a" and self.depth.get("a") or tag in BLOCKS and self.links and self.linked_text and self.open[-1][0] == "a":
            self.pop("a")
        if tag == "p" and self.depth.get("p") or tag in ("li", "tr", "dt", "dd") and self.depth.get(tag):
            self.close_implied(tag)
        skips, marked = self.state()
        values = {k: v or "" for k, v in attrs}
        other = self.names_other(tag, values, marked)
        if other:
            skips = (*skips, len(self.by_tag))
            self.by_tag.append(other == "tag" and tag in WRAPPERS)
        marked = marked or tag in ("article", "main") or values.get("role") == "main"
        link = tag == "a" and "href" in values
        self.open.append((tag, skips, marked, link))
        self.depth[tag] = self.depth.get(tag, 0) + 1
        self.links += link
        if link:
            self.linked_text = False
        if tag in BLOCKS or self.state() != (self.lines[-1].skips, self.lines[-1].marked):
            self.new_line()
        elif tag in ("td", "th", "option"):
            self.lines[-1].parts.append(" ")

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def close_implied(self, tag: str) -> None:
        """A new item ends the open one of its kind in the same container."""
        for name, *_ in reversed(self.open):
            if name == tag:
                return self.pop(tag)
            if name in BLOCKS:
                return None

    def pop(self, tag: str) -> None:
        while self.open:
            name, _, _, link = self.open.pop()
            self.depth[name] -= 1
            self.links -= link
            if name == tag:
                return

    def handle_endtag(self, tag: str) -> None:
        self.lines[-1].tags += 1
        if self.depth.get(tag):
            before = self.state()
            self.pop(tag)
            if tag in BLOCKS or self.state() != before:
                self.new_line()

    def handle_data(self, data: str) -> None:
        line = self.lines[-1]
        line.parts.append(data)
        if self.links > 0:
            line.linked += len(data)
            self.linked_text = self.linked_text or not data.isspace()


def released(lines: list[tuple[str, Line]], by_tag: list[bool]) -> set[int]:
    """Wrappers named by their tag alone that must be the page itself."""
    out: set[int] = set()
    while True:
        inside: dict[int, int] = {}
        outside, story = 0, False
        for text, line in lines:
            plain = max(0, len(text) - line.linked)
            held = [k for k in line.skips if k not in out]
            if not held:
                outside += plain
                story = story or plain >= PARAGRAPH or line.marked and plain > 0
            elif by_tag[held[0]] and len(held) == 1:
                inside[held[0]] = inside.get(held[0], 0) + plain
        best = max(inside, key=lambda k: inside[k], default=None)
        if story or best is None or inside[best] < BULK * max(PARAGRAPH, outside):
            return out
        out.add(best)


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing, renormalised at the ends."""
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-k * k / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        lo, hi = max(0, i - reach), min(len(values), i + reach + 1)
        weights = kernel[lo - i + reach:hi - i + reach]
        out.append(sum(w * v for w, v in zip(weights, values[lo:hi])) / sum(weights))
    return out


def threshold(values: list[float]) -> float:
    """Two-means split of levels whose lower cluster lies at 0."""
    high = max(values, default=0.0)
    for _ in range(32):
        above = [v for v in values if v >= high / 2]
        if not above or sum(above) / len(above) == high:
            break
        high = sum(above) / len(above)
    return high / 2


def lines_of(html: str) -> tuple[list[tuple[str, Line]], list[bool]]:
    """The lines with text of a page, and of its skipped containers whether
    only their tag says so."""
    reader = LineReader()
    try:
        reader.feed(html)
        reader.close()
    except AssertionError:  # an unknown marked section; read it as a comment
        reader = LineReader()
        reader.feed(html.replace("<![", "<!--["))
        reader.close()
    return [(text, line) for line in reader.lines if (text := " ".join("".join(line.parts).split()))], reader.by_tag


def main_text(html: str | None) -> str:
    """The content lines of a page, joined by an empty line."""
    lines, by_tag = lines_of(html or "")
    page = released(lines, by_tag)
    shares = [line.linked / len(text) for text, line in lines]
    # a lone linked line inside an article is no list of links
    usable = [page.issuperset(line.skips) and (share <= LINK_SHARE or line.marked and near <= LIST_SHARE)
              for (_, line), share, near in zip(lines, shares, smoothed(shares))]
    ratios = [max(0, len(text) - line.linked) / max(1, line.tags) if use else 0.0
              for (text, line), use in zip(lines, usable)]
    level = [math.log1p(v * (SEED if line.marked else 1.0)) if use else 0.0
             for v, (_, line), use in zip(smoothed(ratios), lines, usable)]
    cut = threshold(level)
    return "\n\n".join(text for (text, _), use, v in zip(lines, usable, level) if use and v >= cut)


def _extract(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = [main_text(h.as_py()) for h in part.column("html")]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return (rows.mapInArrow(_extract, "page_id long, url string, text string")
            .withColumn("n_chars", F.char_length("text").cast("long")))
