"""Main text of HTML pages by the text-to-tag ratio of their lines.

The standard library's parser streams a page's events. Block-level tags end a line; a line
knows its text, the number of tags in it and the element it stands in. The ratio of text to
tags per line is smoothed with a Gaussian kernel over neighbouring lines, and the smoothed
ratios are split into two clusters by a threshold halfway between their means. The lines above
the threshold are seeds of content. Their region is the article or main element that holds most
of their text, with its sibling articles and a lead before it, or else the lowest element that
holds all seeds; it gives its lines in page order, short ones too, except those in elements that
are never part of an article.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SIGMA = 1.0
#: Clusters of lines whose mean ratios differ by less than this factor are one.
ALIKE = 1.5

# HTML elements by their role, and names that sites give to parts of a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("button canvas datalist dialog head iframe math noscript object option script "
             "select style svg template textarea title audio video label".split())
FURNITURE = set("nav header footer aside form menu fieldset".split())
CONTAINERS = set("article aside blockquote body center dd details div dl figure footer form "
                 "header html main menu nav ol section table tbody td tr ul fieldset".split())
BLOCKS = CONTAINERS | set("address caption dt figcaption h1 h2 h3 h4 h5 h6 hgroup hr legend li "
                          "p pre summary th thead tfoot".split())
#: What a head may hold, hidden elements that are often left open, and tags that end these.
IN_HEAD = set("base link meta noscript script style template title".split())
LEFT_OPEN = set("button label option select title".split())
ENDING = set("article aside body footer h1 h2 h3 h4 h5 h6 header main nav p section table".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PARTS = set("ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs "
            "comment comments consent cookie cookies disqus footer gdpr header masthead menu "
            "modal nav navbar navigation newsletter notice notices pagination popup promo "
            "promoted promotion recommended related reply replies respond share sharing "
            "sidebar signup skip social sponsor sponsored subscribe subscription toolbar "
            "widget widgets alert discussion login search teaser".split())
COMMENTS = set("comment comments reply replies respond disqus discussion".split())
#: Names that a wrapper inside an article may also have from its topic; its text decides.
TOPICS = set("alert discussion header login notice notices search social".split())
#: Elements of text, cut only if a whole name is that of a part; headings are never cut by name.
TEXTS = set("blockquote figcaption p pre".split())
#: A part's name behind one of these words says what a wrapper has, not what it is.
HAVING = set("has with no without is hide show".split())
ROLES = set("navigation banner contentinfo complementary search form alert dialog menu menubar "
            "alertdialog toolbar".split())

_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def names_part(value: str) -> set[str]:
    """The names of page parts in a class or id."""
    found = set()
    for name in value.split():
        words = [w.lower() for w in _NAME.findall(name)]
        if not HAVING & set(words):
            found |= PARTS & set(words)
    return found


class Lines(HTMLParser):
    """The lines of a page: text, number of tags, element; and the tree of elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag = [-1], ["html"]
        self.cut = [""]  # "", "tag", "form", "name" or "topic"
        self.open, self.hidden = [0], []
        self.within: list[str] = []  # containers opened in hidden elements
        self.lines: list[tuple[str, int, int, bool]] = []
        self._text: list[str] = []
        self._tags, self._heading = 0, ""

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)

    def _end_line(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            self.lines.append((text, self._tags, self.open[-1], bool(self._heading)))
        self._text, self._tags = [], 0

    def _cut_of(self, tag: str, attrs) -> str:
        given = {k: v or "" for k, v in attrs}
        if "hidden" in given or given.get("aria-hidden") == "true" \
                or "display:none" in given.get("style", "").replace(" ", "").lower():
            return "tag"
        if tag in ("html", "body"):
            return ""
        parts = names_part(given.get("class", "")) | names_part(given.get("id", ""))
        if tag in ("article", "main"):
            return "name" if parts & COMMENTS else ""
        if tag == "form":
            return "name" if parts & COMMENTS else "form"
        if tag in FURNITURE or given.get("role", "").lower() in ROLES:
            return "tag"
        if tag in TEXTS:
            parts &= set(f"{given.get('class', '')} {given.get('id', '')}".lower().split())
        if tag in HEADINGS or not parts:
            return ""
        topics = TOPICS if tag == "section" else TOPICS - COMMENTS
        return "topic" if parts <= topics else "name"

    def _end_hidden(self, tag: str, ends: bool) -> None:
        """End hidden elements that were left open, and a head before what it cannot hold."""
        if ends:
            while self.hidden and self.hidden[-1] in LEFT_OPEN:
                self.hidden.pop()
        if self.hidden == ["head"] and tag not in IN_HEAD:
            self.hidden = []
        if not self.hidden:
            self.within = []

    def handle_starttag(self, tag, attrs):
        if self.hidden:
            in_title = self.hidden == ["head", "title"] and tag in BLOCKS | {"body"}
            self._end_hidden(tag, tag in ENDING or in_title)
        if tag in HIDDEN:
            self.hidden.append(tag)
            return
        if self.hidden:
            if tag in CONTAINERS:
                self.within.append(tag)
            return
        if tag in BLOCKS:
            self._end_line()
            self._heading = tag if tag in HEADINGS else ""
            if tag in ("article", "main"):  # furniture that was left open ends here
                self.open = [n for n in self.open if self.tag[n] not in FURNITURE] or [0]
        elif tag == "br":
            self._text.append(" ")
        self._tags += 1
        cut = self._cut_of(tag, attrs) if attrs or tag in FURNITURE else ""
        if tag in CONTAINERS or (cut and tag not in VOID):
            if cut and tag not in BLOCKS:
                self._end_line()
            self.parent.append(self.open[-1])
            self.tag.append(tag)
            self.cut.append(cut)
            self.open.append(len(self.tag) - 1)

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag not in HIDDEN:
            self.handle_starttag(tag, attrs)
            if tag not in VOID:
                self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.hidden:
            if tag in self.hidden:
                while self.hidden.pop() != tag:
                    pass
            elif tag in ("body", "html", "article", "main"):
                self.hidden = []
            elif tag in self.within:
                while self.within.pop() != tag:
                    pass
            elif tag in CONTAINERS and any(self.tag[n] == tag for n in self.open[1:]):
                self._end_hidden(tag, True)  # the end of what they stand in
            if not self.hidden:
                self.within = []
            if tag in HIDDEN or self.hidden:
                return
        if tag in BLOCKS:
            self._end_line()
            self._heading = ""
        self._tags += 1
        for at in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[at]] == tag:
                if tag not in BLOCKS:
                    self._end_line()
                del self.open[at:]
                break

    def handle_data(self, data):
        if not self.hidden:
            self._text.append(data)

    def finish(self) -> None:
        self.close()
        self._end_line()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; the ends repeat."""
    reach = int(np.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach, mode="edge"), kernel / kernel.sum(), "valid")


def threshold(values: np.ndarray) -> float:
    """Halfway between the means of the two clusters that it parts; alike values are one."""
    cut = values.mean()
    for _ in range(100):
        low, high = values[values < cut], values[values >= cut]
        if not len(low) or not len(high):
            return float(values.min())
        moved = (low.mean() + high.mean()) / 2
        if high.mean() < ALIKE * low.mean():
            return float(values.min())
        if abs(moved - cut) < 1e-9:
            break
        cut = moved
    return float(cut)


def main_text(html: str) -> str:
    """The text of the page's content region, blocks joined by an empty line."""
    page = Lines()
    page.feed(html)
    page.finish()
    if not page.lines:
        return ""
    texts, tags, nodes, headings = zip(*page.lines)
    lengths = np.array([len(t) for t in texts], float)
    raw = lengths / np.maximum(1, tags)
    ratios = smoothed(raw)
    bar = threshold(ratios)
    strong = (ratios >= bar) & (raw >= bar)
    cut, only_headings = cut_elements(page, nodes, lengths, raw >= bar)
    usable = np.array([not cut[v] and (h or not only_headings[v])
                       for v, h in zip(nodes, headings)])
    if not usable.any():
        return ""
    seeds = usable & (ratios >= bar)
    if not seeds.any():
        seeds = usable & (ratios == ratios[usable].max())
    strong &= seeds
    if not strong.any():
        strong = seeds
    chosen = usable & in_region(page, nodes, headings, lengths, seeds, strong, usable)
    return "\n\n".join(t for t, use in zip(texts, chosen) if use)


def summed(page: Lines, nodes, values) -> np.ndarray:
    """Each element's sum over the lines in it and below it."""
    total = np.bincount(nodes, values, len(page.tag))
    for at in range(len(total) - 1, 0, -1):  # children come after their parents
        total[page.parent[at]] += total[at]
    return total


def cut_elements(page: Lines, nodes, lengths, strong) -> tuple[list[bool], list[bool]]:
    """Which elements are no part of an article, and which give their headings only."""
    n = len(page.tag)
    telling = summed(page, nodes, strong)
    holds_main, in_main = np.zeros(n, bool), [False] * n
    for at in range(n - 1, 0, -1):  # the wrapper of an article is not cut by name
        if holds_main[at] or page.tag[at] in ("article", "main") and not page.cut[at]:
            holds_main[page.parent[at]] = True
    for at in range(1, n):
        in_main[at] = in_main[page.parent[at]] or page.tag[at] in ("article", "main")

    def cuts(forms: np.ndarray) -> tuple[list[bool], list[bool]]:
        cut, only_headings = [False] * n, [False] * n
        for at in range(1, n):
            above, kind = page.parent[at], page.cut[at]
            own = bool(kind)
            if kind in ("name", "topic") and holds_main[at] or kind == "form" and forms[at]:
                own = False
            if kind == "topic" and in_main[above] and telling[at]:
                own = False
            if own and page.tag[at] == "header" and in_main[above]:
                own, only_headings[at] = False, True  # an article's own header: its headings
            only_headings[at] |= only_headings[above]
            cut[at] = cut[above] or own
        return cut, only_headings

    found = cuts(np.zeros(n, bool))
    if "form" in page.cut:  # some pages stand in one form as a whole
        open_cut, _ = cuts(np.ones(n, bool))
        shown = lengths * [not open_cut[v] for v in nodes]
        held = summed(page, nodes, shown)
        telling = summed(page, nodes, strong & (shown > 0))
        forms = (held > held[0] / 2) & (telling >= 2)
        if any(forms[at] for at in range(n) if page.cut[at] == "form"):
            found = cuts(forms)
    return found


def in_region(page: Lines, nodes, headings, lengths, seeds, strong, usable) -> np.ndarray:
    """The lines of the region of content, by the seeds in it."""
    n, nodes = len(page.tag), np.array(nodes)
    weight = summed(page, nodes, lengths * seeds)
    sure = summed(page, nodes, strong)
    mains = [v for v in range(n)
             if page.tag[v] in ("article", "main") and weight[v] >= weight[0] / 2]
    inside = np.zeros(n, bool)
    if mains:
        best = max(mains, key=lambda v: (weight[v], v))
        beside = [v for v in range(1, n) if page.parent[v] == page.parent[best] and sure[v]]
        inside[best] = True
        inside[[v for v in beside if page.tag[v] == "article" or v < best]] = True
    else:
        # Children come after their parents, so the last one that holds all is the lowest.
        best = max(v for v in range(n) if sure[v] >= sure[0])
        inside[best] = page.tag[best] not in ("html", "body")
    for v in range(1, n):
        inside[v] |= inside[page.parent[v]]
    lines = inside[nodes]
    if mains:  # a lead that stands bare before the article
        first = np.flatnonzero(lines)[0]
        lines[:first] |= strong[:first] & (nodes[:first] == page.parent[best])
    elif not inside[best]:
        # Without a wrapper: what stands beside a seed, and all from the first seed to the last.
        lines = np.isin(nodes, nodes[seeds])
        first = np.flatnonzero(strong)[0]
        while first and (headings[first - 1] or not usable[first - 1]):
            first -= 1
        lines[first:np.flatnonzero(seeds)[-1] + 1] = True
    return lines


def extract(html: str) -> Column:
    """The main text of a column of pages; a null or empty page has an empty text.

    Whole pages are read, however long; equal pages get equal texts, and an empty table none.
    """
    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([main_text(x) if x else "" for x in column.to_pylist()], pa.string())
    return run(F.col(html))
