"""Main text of web pages.

The standard library's parser streams a page into lines, one for each block of text, with the
number of its characters, of its characters inside links, and of the tags around it. The
text-to-tag ratios are smoothed by a Gaussian over neighbouring lines, and a threshold parts
them into two clusters. A region is a run of lines in one container; a region that reaches
the content cluster is kept whole, so that short lines inside an article stay; so is a region
between kept ones of its container, unless most of it is links. Menus, headers,
footers, sidebars, notices, adverts, forms, comments and whatever isn't shown have ratio
nought and are never kept; headings in the header of an article are part of it. Where a page
has an article or main element, only its regions compete. Class and id names that speak of a
state ("comments-enabled") drop nothing, and a page that would be left without any text is
read again without regard to names.

Defined cases: a null, empty or text-free page gives empty text. Unclosed and crossed tags
are allowed; end tags that HTML lets out are implied by the next start tag or the container's end. White space (also the no-break space) inside a block becomes one space, and a
line break element counts as white space. Repeated pages are extracted one by one. Each page
is parsed by itself, whatever its size.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0
#: Share of the mean smoothed ratio that a region must reach.
THRESHOLD = 0.5

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option "
    "p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Containers whose nesting is followed; others need no end tag to be read right.
FOLLOWED = frozenset(
    "article aside body button center datalist details dialog div dl fieldset figure footer form head header iframe "
    "main menu nav noscript object ol search section select span svg table template textarea title ul video audio "
    "canvas math".split()
)
#: Other blocks are followed as well, without a region of their own, so that ends left out are seen.
PLAIN = BLOCKS - FOLLOWED - VOID - {"html"} | {"option", "optgroup"}
HEAD = frozenset("base link meta noscript script style template title".split())
ENDS_P = BLOCKS - frozenset("body caption dd dt frameset head html legend li option select tbody td tfoot th thead title tr".split())
IN_LIST = (BLOCKS - {"address", "div", "p"}) | {"button", "object", "template"}
IN_TABLE = frozenset(("table", "template"))
IN_SELECT = frozenset(("select", "datalist"))
PARTS = ("tbody", "thead", "tfoot", "caption")
#: Start tag: what it ends if that is open, and the elements that shield it.
ENDS = {
    "li": (("li",), IN_LIST), "dd": (("dd", "dt"), IN_LIST), "dt": (("dd", "dt"), IN_LIST),
    "td": (("td", "th"), IN_TABLE | {"tr"}), "th": (("td", "th"), IN_TABLE | {"tr"}), "tr": (("tr", "caption"), IN_TABLE),
    **{x: (PARTS, IN_TABLE) for x in PARTS},
    "option": (("option",), IN_SELECT), "optgroup": (("option", "optgroup"), IN_SELECT),
}
IN_P = frozenset("button caption object table td th template".split())
#: What shields an element from an end tag that isn't its own.
SHIELDS = {
    "p": IN_P, "li": frozenset(("ol", "ul", "menu")) | IN_P, "dd": IN_P | {"dl"}, "dt": IN_P | {"dl"},
    **{x: IN_TABLE for x in (*PARTS, "tr", "td", "th")},
}

DROPPED = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form head header iframe math menu nav noscript object "
    "search select svg template textarea title video".split()
)
DROPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adslot adsense advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment "
    "commentlist comments consent cookie cookies copyright disqus dropdown footer gdpr header masthead menu modal "
    "nav navbar navigation newsletter notice notices overlay paging pagination popup promo promoted promotion "
    "related replies respond share sharing sidebar sidebars signup social sponsor sponsored subscribe "
    "subscription toolbar widget widgets".split()
)
#: Beside these, a name tells how something is set, not what it holds.
LAYOUT_NAMES = frozenset("closed disabled enabled free has no off on open with without".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: How an open element is dropped: whole, or but for its headings.
SHOWN, NOT_HEADINGS, WHOLE = range(3)
NAME = re.compile(r"[a-z]+")


class Line:
    __slots__ = ("article", "linked", "region", "tags", "text")

    def __init__(self, text: str, linked: int, tags: int, region: int, article: bool):
        self.text, self.linked, self.tags, self.region, self.article = text, linked, tags, region, article


class Lines(HTMLParser):
    """Turns parser events into lines. Region -1 is never kept."""

    def __init__(self, by_name: bool = True):
        super().__init__(convert_charrefs=True)
        self.by_name = by_name
        self.lines: list[Line] = []
        self.pieces: list[str] = []
        self.linked = 0
        self.links = 0
        self.tags = 0
        self.regions = 0
        #: The region that each region lies in.
        self.within: dict[int, int] = {0: 0}
        #: Open followed elements: tag, how dropped, inside an article, region; and how many there are of each tag.
        self.open: list[tuple[str, int, bool, int]] = [("", SHOWN, False, 0)]
        self.counts: Counter[str] = Counter()
        self.hidden: str | None = None

    def finish_line(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            _, dropped, article, region = self.open[-1]
            self.lines.append(Line(text, min(self.linked, len(text)), self.tags, -1 if dropped else region, article))
            self.tags = 0
        self.pieces, self.linked = [], 0

    def drops(self, tag: str, attrs: dict[str, str]) -> bool:
        if tag in DROPPED or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return True
        if attrs.get("role", "").lower() in DROPPED_ROLES:
            return True
        if tag in ("html", "body", "main") or not self.by_name:
            return "display:none" in attrs.get("style", "").replace(" ", "").lower()
        for key in ("class", "id"):
            for name in attrs.get(key, "").lower().split():
                words = set(NAME.findall(name))
                if words & DROPPED_NAMES and not words & LAYOUT_NAMES:
                    return True
        return "display:none" in attrs.get("style", "").replace(" ", "").lower()

    def end(self, tags, shields=frozenset()) -> None:
        """Ends the innermost open element of ``tags`` with all in it, unless a shield is in between."""
        if not any(self.counts[tag] for tag in tags):
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] in tags:
                self.counts.subtract(x[0] for x in self.open[at:])
                del self.open[at:]
                return
            if self.open[at][0] in shields:
                return

    def begin(self, tag: str, *state) -> None:
        self.open.append((tag, *state))
        self.counts[tag] += 1

    def imply_ends(self, tag: str) -> None:
        if tag not in HEAD and tag not in ("head", "html") and self.open[-1][0] == "head":
            self.end(("head",))
        if tag in ENDS:
            self.end(*ENDS[tag])
        if tag in ENDS_P or tag in ("li", "dd", "dt"):
            self.end(("p",), IN_P)

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self.finish_line()
        elif tag == "br":
            self.pieces.append(" ")
        self.imply_ends(tag)
        if tag in ("script", "style"):
            self.hidden = tag
        if tag == "a":
            self.links += 1
        if tag in VOID:
            return
        named = {k: v or "" for k, v in attrs}
        drops = WHOLE if self.drops(tag, named) else SHOWN
        if tag == "header" and self.open[-1][2] and not self.drops("div", named):
            drops = NOT_HEADINGS
        if tag in PLAIN and not drops:
            _, dropped, article, region = self.open[-1]
            self.begin(tag, SHOWN if tag in HEADINGS and dropped == NOT_HEADINGS else dropped, article, region)
            return
        if tag not in FOLLOWED and not drops:
            return
        if tag == "span" and not drops:
            return
        _, dropped, article, region = self.open[-1]
        if tag in ("article", "main"):
            article = True
            self.regions += 1
            region = self.regions
        elif not article and tag not in ("span",):
            self.regions += 1
            region = self.regions
        self.within.setdefault(region, self.open[-1][3])
        self.begin(tag, max(dropped, drops), article, region)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self.finish_line()
        if tag == self.hidden:
            self.hidden = None
        if tag == "a" and self.links:
            self.links -= 1
        self.end((tag,), SHIELDS.get(tag, frozenset()))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("script", "style"):
            self.handle_endtag(tag)

    def handle_data(self, data):
        if self.hidden:
            return
        self.pieces.append(data)
        if self.links:
            self.linked += len(data.strip())

    def close(self):
        super().close()
        self.finish_line()


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, math.ceil(3 * sigma))
    x = np.arange(-reach, reach + 1)
    kernel = np.exp(-(x**2) / (2 * sigma**2))
    return np.convolve(ratios, kernel / kernel.sum(), mode="full")[reach : reach + len(ratios)]


def between(lines: list[Line], usable: np.ndarray, content: set[int], within: dict[int, int]) -> set[int]:
    """Regions that aren't mostly links and have kept lines of their container before and behind them."""
    kept: dict[int, list[int]] = {}  # container: first and last kept line in it
    own: dict[int, list[int]] = {}  # other region: first and last line, characters, and those in links
    for at, (x, ok) in enumerate(zip(lines, usable, strict=True)):
        if not ok:
            continue
        if x.region not in content:
            seen = own.setdefault(x.region, [at, at, 0, 0])
            seen[1:] = [at, seen[2] + len(x.text), seen[3] + x.linked]
            continue
        region = x.region
        while True:
            kept.setdefault(region, [at, at])[1] = at
            if within[region] == region:
                break
            region = within[region]
    out = set()
    for region, (first, last, size, linked) in own.items():
        around = kept.get(within[region])
        if around and around[0] < first and last < around[1] and 2 * linked < size:
            out.add(region)
    return out


def main_text(html, sigma: float = SIGMA, threshold: float = THRESHOLD) -> str:
    if not isinstance(html, str) or not html:
        return ""
    return selected(html, True, sigma, threshold) or selected(html, False, sigma, threshold)


def selected(html: str, by_name: bool, sigma: float, threshold: float) -> str:
    """Text of the kept regions; names of classes and ids drop elements only if ``by_name``."""
    parser = Lines(by_name)
    parser.feed(html)
    parser.close()
    lines = parser.lines
    semantic = any(x.article and x.region >= 0 for x in lines)
    ratios = np.array([
        0.0 if x.region < 0 or (semantic and not x.article)
        else (len(x.text) - x.linked + 0.01) / max(1, x.tags)
        for x in lines
    ])
    usable = ratios > 0
    if not usable.any():
        return ""
    smooth = smoothed(ratios, sigma)
    bar = threshold * smooth[usable].mean()
    content = {x.region for x, ok, s in zip(lines, usable, smooth, strict=True) if ok and s >= bar}
    content |= between(lines, usable, content, parser.within)
    return "\n".join(x.text for x, ok in zip(lines, usable, strict=True) if ok and x.region in content)


def extract(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: id, url, main text and its length in code points."""
    base = pages.select(F.col(id_column).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    @F.pandas_udf("string")
    def text_of(column: pd.Series) -> pd.Series:
        return column.map(main_text, na_action=None).astype(object)

    out = base.select("page_id", "url", text_of("html").alias("text"))
    return out.select(
        F.col("page_id").alias(id_column), F.col("url").alias(url), "text", F.char_length("text").cast("long").alias("n_chars")
    )

