"""Main text of web pages from streaming parser events.

The standard library's ``HTMLParser`` emits events, never a tree. They become
lines: the text between two block boundaries, with the number of tags met in it
and the regions it lies in. Then, for each page:

1. the text-to-tag ratio of every line, smoothed with a Gaussian along the page;
2. a threshold between the two clusters of smoothed ratios (two means);
3. the regions that hold a line above the threshold are content, and all their
   lines are kept. Several such regions inside one that is not the whole page
   stand for that one, without its parts that are mostly links. Lists, tables,
   quotes and figures belong to the region around them, unless they are mostly
   links. Markup that names its purpose (``nav``, ``aside``, ``footer``, a class
   such as ``sidebar`` or ``comments``) is left out before, hidden elements, adverts
   within a line and the text of form controls as well. A form goes unless it holds
   the article or half of the page's text. An article wins over the class of what
   surrounds it if no other one has text; inside it a class or id must
   name nothing else, or hold mostly links or controls, to leave a section out.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

#: Tags whose content is never text of the page; they don't part a line.
SILENT = frozenset("title script style noscript template svg math iframe object canvas audio video map".split())
#: Tags that hold something other than the article.
OTHER = frozenset("nav footer aside menu dialog".split())
FORMS = frozenset(("form", "fieldset"))
#: Controls' own text is never text of the page either.
MUTE = SILENT | frozenset("button select textarea".split())
#: Markup of another kind in the page, which knows self-closed elements.
FOREIGN = frozenset(("svg", "math"))
#: Tags that begin or end a line.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul caption option".split())
#: Blocks that are regions: they go on the stack and must be closed.
REGIONS = frozenset("article aside body center details dialog div fieldset footer form header html main menu nav section "
                    "table tbody td th tr ul ol dl blockquote figure head".split()) | OTHER | FORMS
#: Regions that belong to the one around them, and the parts of a table.
NESTED = frozenset("ul ol dl blockquote figure table".split())
CELLS, PARTS = frozenset(("td", "th")), frozenset("tbody tr td th".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words of a class or id that name something other than the article.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|menus|breadcrumbs?|header|masthead|topbar|footer|foot|sidebar|aside|ads?|adverts?|"
    r"advertisement|adsense|adslot|banner|promo|promotion|sponsor|sponsored|cookies?|consent|gdpr|notices?|popup|modal|"
    r"overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|comments?|commentlist|disqus|"
    r"replies|respond|form|search|pagination|pager|widget|skip)(?:$|[\s_-])")
#: Words of a class or id that only tell of the layout around (``has-sidebar``) or of the article's own head (``entry-header``).
LAYOUT = re.compile(r"(?:^|(?<=[\s_-]))(?:(?:has|with|without|no)[_-][a-z]+|(?:post|entry|article|story)[_-]header)(?=$|[\s_-])")
#: In the names of headings, and inside an article, this tells of the article's own head.
HEAD = re.compile(r"(?:^|(?<=[\s_-]))header(?=$|[\s_-])")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of an id that only say that something is a box, and those that name comments whatever their title.
BOX = frozenset("section area box container wrapper wrap block list posts bar button buttons item items left right top bottom inner outer".split())
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
#: Words that name adverts and the like wherever they stand, also on a part of a line.
ADVERTS = frozenset("ad ads advert adverts advertisement adsense adslot banner promo promotion sponsor sponsored cookie cookies consent gdpr "
                    "popup modal overlay newsletter subscribe pagination pager breadcrumb breadcrumbs".split())
#: Last words of a class that name what it is, whatever stands before them.
HEADWORDS = COMMENTS | frozenset("ads advert adverts advertisement sidebar nav navbar navigation footer newsletter cookies pagination "
                                 "breadcrumb breadcrumbs popup modal".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
CONTROLS = frozenset("input button select textarea".split())
WORD = re.compile(r"[^\W_]+")
#: Tags that may stand in a head; any other one ends a head that was not closed.
IN_HEAD = frozenset("title meta link style script base noscript template object".split())
ARTICLE = frozenset(("article", "main"))
#: Where a name in camel case is parted.
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def names_only(names: str, words: frozenset[str] | None = None) -> bool:
    """One of the names (a class or id) says nothing but that it holds something other
    than the article; with ``words`` only these count."""
    for name in names.split():
        parts = [w for w in WORD.findall(name) if not w.isdigit()]
        told = [w for w in parts if w not in BOX]
        if told and all(w in words if words else NAMES.search(w) for w in told):
            return True
        if told and not words and told[-1] in HEADWORDS:
            return True
    return False


#: Share of a region's characters in links from which it is no part of the content around it.
LINKS = 0.5
SIGMA = 1.0


class Lines(HTMLParser):
    """Collects (text, tags, region, article, characters in links, named) of every line;
    region numbers grow with the page, ``parents`` holds the one around each,
    ``kinds`` their tags and ``whole`` those that are the whole page. ``named`` lines are
    those of an article that stands in a region whose class or id names something else."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, int, int]] = []
        # Tag, region, left out (1: by a class or id, 2: by anything else), article.
        self.stack: list[tuple[str, int, int, int]] = [("", 0, 0, 0)]
        self.regions, self.tags, self.text = 0, 0, []
        self.parents, self.kinds, self.whole = [0], [""], {0}
        self.in_link, self.linked = False, 0
        # Open elements that are no regions and whose text is left out: tag, size of the stack, what came
        # first in them (text or block), inner elements of that tag.
        self.muted: list[list] = []
        # Regions inside an article that only a name speaks against: class, id, title; those without a line so far.
        self.suspects: dict[int, tuple[str, str, str]] = {}
        self.heading, self.untitled, self.controls, self.forms = False, [], [], []

    def flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            _, region, out, article = self.stack[-1]
            if text and (not out or (out == 1 and article)):
                self.lines.append((text, self.tags, region, article, self.linked, out))
                for r in self.untitled:
                    self.suspects[r] = (*self.suspects[r][:2], text if self.heading else "")
                self.untitled = []
            self.text = []
        self.tags, self.linked, self.heading = 0, 0, False

    def boundary(self, tag: str) -> None:
        """A block begins or ends: so does a line, and what can't reach beyond it."""
        self.flush()
        if self.muted:
            self.muted = [m for m in self.muted if self.stays(m, tag)]

    @staticmethod
    def stays(muted: list, tag: str) -> bool:
        name = muted[0]
        if name == "p" or name in HEADINGS:
            return False
        if name in BLOCKS:
            return name != tag
        if name == "select":
            return tag == "option"
        if name in ("button", "label"):
            return tag == "div"
        muted[2] = muted[2] or "block"
        return name in MUTE or muted[2] == "block"  # an element around blocks, not one in a line that was never closed

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.boundary(tag)
        elif tag == "br":
            self.text.append(" ")
        elif tag == "a":
            self.in_link = True
        self.tags += 1
        if self.stack[-1][0] == "head" and tag not in IN_HEAD:
            self.stack.pop()
            self.muted = [m for m in self.muted if m[1] <= len(self.stack)]
        if tag in CONTROLS:
            self.controls.append(self.stack[-1][1])
        given = {k: v for k, v in reversed(attrs) if v is not None}
        kind, ident = (LAYOUT.sub("", CAMEL.sub("-", given.get(key, "")).lower()) for key in ("class", "id"))
        self.heading = tag in HEADINGS or (self.heading and tag not in BLOCKS)
        if self.heading or self.stack[-1][3]:
            kind, ident = HEAD.sub("", kind), HEAD.sub("", ident)
        role = given.get("role", "").lower()
        hidden = role in ROLES and role != "form" or tag not in ("html", "body") and (
            any(k == "hidden" for k, _ in attrs) or bool(HIDDEN.search(given.get("style", ""))))
        if tag in VOID:
            return
        if tag not in REGIONS:
            for m in self.muted:
                m[3] += m[0] == tag
            if tag in BLOCKS:  # a paragraph, heading or item; ids are often made from headings
                mute = hidden or names_only(kind) or (not self.heading and not self.stack[-1][3] and names_only(ident))
                mute = mute or (tag == "legend" and self.in_form())
            else:
                mute = hidden or tag in MUTE or names_only(kind, ADVERTS) or (tag == "label" and self.in_form())
            if mute:
                self.muted.append([tag, len(self.stack), "", 0])
            return
        if tag in ARTICLE:  # an article is never part of an unclosed menu, header or form
            while self.stack[-1][0] in ("nav", "header", "footer", "form", "menu", "ul", "ol"):
                self.stack.pop()
        _, _, out, article = self.stack[-1]
        self.regions += 1
        self.parents.append(self.stack[-1][1])
        self.kinds.append(tag)
        if tag in ("html", "body"):
            self.whole.add(self.regions)
        if tag in FORMS or role == "form":
            self.forms.append(self.regions)
        named = False
        if tag in ARTICLE:
            named = tag == "article" and bool(re.search(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies)|related|sidebar|ads?)(?:$|[\s_-])", kind)
                                              or re.fullmatch(r"(?:comments?|repl(?:y|ies)|related|sidebar|ads?)(?:[_-]?\d+)?", ident))
        elif tag not in ("html", "body") and NAMES.search(f"{kind} {ident}"):
            if article:
                self.suspects[self.regions] = (kind, ident, "")
                self.untitled.append(self.regions)
            else:
                named = not COMMENTS.isdisjoint(w for x in (*kind.split(), *ident.split()) for w in WORD.findall(x)[-1:])
                out = max(out, 1)
        if named or hidden or tag == "head" or tag in OTHER or (tag == "header" and not article):
            out = 2
        if tag in ARTICLE and out < 2:
            article = article or self.regions
        self.stack.append((tag, self.regions, out, article))

    def in_form(self) -> bool:
        return any(s[0] in FORMS for s in self.stack)

    def handle_startendtag(self, tag, attrs):
        """HTML knows no self-closing regions: the tag opens one, but for markup of another kind."""
        if tag in FOREIGN or any(m[0] in FOREIGN for m in self.muted):
            self.tags += 1
        else:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.boundary(tag)
        elif tag == "a":
            self.in_link = False
        self.tags += 1
        if tag in REGIONS:
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i][0] == tag:
                    del self.stack[i:]
                    self.muted = [m for m in self.muted if m[1] <= i]
                    break
                if self.stack[i][0] in ARTICLE and tag not in ("html", "body"):
                    break  # a stray end tag does not end the article around it
        else:
            for i in range(len(self.muted) - 1, -1, -1):
                if self.muted[i][0] == tag:
                    if self.muted[i][3]:
                        self.muted[i][3] -= 1
                    else:
                        del self.muted[i:]
                    break

    def left_out(self) -> set[int]:
        """Regions that are left out for what they hold, with those in them. Forms, unless
        they hold an article or half of the page's text; and regions of an article whose
        class or id speaks against them: a class that names nothing else, such an id if it is
        not made from the title, or mostly links or form controls."""
        if not self.suspects and not self.forms:
            return set()
        n = len(self.parents)
        sizes, linked, counts, controls, articles = ([0] * n for _ in range(5))
        for text, _, region, article, in_links, _ in self.lines:
            sizes[region] += len(text)
            linked[region] += in_links
            counts[region] += 1
            articles[article] += 1
        for region in self.controls:
            controls[region] += 1
        for r in range(n - 1, 0, -1):
            for total in (sizes, linked, counts, controls, articles):
                total[self.parents[r]] += total[r]
        out: set[int] = set()
        forms = set(self.forms)
        for r in range(1, n):
            if self.parents[r] in out:
                out.add(r)
            elif r in forms:
                if articles[r] or 2 * sizes[r] >= sizes[0]:
                    self.whole.add(r)
                else:
                    out.add(r)
            if r in self.suspects and r not in out:
                kind, ident, title = self.suspects[r]
                words = [w for w in WORD.findall(ident) if not w.isdigit()]
                named = (words and all(w in BOX or NAMES.search(w) for w in words) and any(w not in BOX for w in words)
                         and (not COMMENTS.isdisjoint(words) or words != [w for w in WORD.findall(title.lower()) if not w.isdigit()]))
                if named or names_only(kind) or linked[r] >= LINKS * sizes[r] or controls[r] >= counts[r]:
                    out.add(r)
        return out

    def handle_data(self, data):
        if self.muted:
            if not data.isspace():
                for m in self.muted:
                    m[2] = m[2] or "text"
            return
        self.text.append(data)
        if self.in_link:
            self.linked += len(data.strip())


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing of width ``sigma`` lines; the window is cut at the page's ends."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(ratios, kernel)[reach:reach + len(ratios)]
    return total / np.convolve(np.ones(len(ratios)), kernel)[reach:reach + len(ratios)]


def two_means(values: np.ndarray) -> float:
    """Threshold halfway between the means of two clusters (all values, if they are one)."""
    low, high = float(values.min()), float(values.max())
    if high - low < 1e-9:
        return low
    cut = (low + high) / 2
    for _ in range(20):
        above = values >= cut
        now = (values[~above].mean() + values[above].mean()) / 2
        if abs(now - cut) < 1e-9:
            break
        cut = now
    return float(cut)


def layout_tables(kinds: list[str], tables: list[int], counts: list[int]) -> set[int]:
    """Tables that lay out a page: of one row, or with a cell of several lines. 0 is
    that of cells outside a table."""
    rows = Counter(t for t, kind, n in zip(tables, kinds, counts) if kind == "tr" and n)
    return ({0} | {r for r, kind in enumerate(kinds) if kind == "table" and rows[r] < 2}
            | {t for t, kind, n in zip(tables, kinds, counts) if kind in CELLS and n > 1})


def widened(lines: list[tuple[str, int, int, int, int, int]], above: set[int], parents: list[int], kinds: list[str],
            whole: set[int]) -> set[int]:
    """The regions that stay, from those that hold a line above the threshold.

    Lists, tables, quotes and figures that are not mostly links count for the
    region around them, and stay with it. If a region that is not the whole page
    holds all that count, the regions in it that are not mostly links stay too.
    Cells of a table that lays out the page count for themselves.
    """
    n = len(parents)  # a region's number is above those around it
    sizes, linked, counts = [0] * n, [0] * n, [0] * n
    for text, _, region, _, in_links, _ in lines:
        sizes[region] += len(text)
        linked[region] += in_links
        counts[region] += 1
    own_links = [0 < size and in_links >= LINKS * size for size, in_links in zip(sizes, linked)]
    for r in range(n - 1, 0, -1):
        for total in (sizes, linked, counts):
            total[parents[r]] += total[r]
    links = [0 < size and in_links >= LINKS * size for size, in_links in zip(sizes, linked)]
    tables = [0] * n
    for r in range(1, n):
        tables[r] = r if kinds[r] == "table" else tables[parents[r]]
    layout = layout_tables(kinds, tables, counts)
    home = list(range(n))
    for r in range(1, n):
        if kinds[r] in NESTED and not links[r] and r not in layout or kinds[r] in PARTS and tables[r] not in layout:
            home[r] = home[parents[r]]
    kept = {home[r] for r in above}
    holds = [int(r in kept) for r in range(n)]
    for r in range(n - 1, 0, -1):
        holds[parents[r]] += holds[r]
    inmost = max(r for r, k in enumerate(holds) if k == len(kept))
    inside = [r in kept or (r == inmost and r not in whole) for r in range(n)]
    for r in range(1, n):
        if not inside[r] and inside[parents[r]]:
            if kinds[r] in NESTED or (kinds[r] in CELLS and tables[r] in layout):
                inside[r] = not links[r]
            else:
                inside[r] = kinds[r] in PARTS or parents[r] not in whole
    return kept | {r for r in range(n) if inside[r] and (kinds[r] in NESTED or kinds[r] in PARTS or not own_links[r])}


def main_text(html: str | None) -> str:
    """The article of a page: its lines in page order, joined by a newline.

    Empty for null, empty or text-free pages. A page cut off in the middle gives
    what it has; an incomplete last tag is no text.
    """
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    out = parser.left_out()
    lines = [line for line in parser.lines if line[2] not in out] if out else parser.lines
    plain = [line for line in lines if not line[5]]
    article = [line for line in plain if line[3]]  # markup that says where the article is
    if not article:
        named = [line for line in lines if line[5]]
        if sum(len(line[0]) for line in named) >= sum(len(line[0]) for line in plain):
            article = named
    lines, region = (article, 3) if article else (plain, 2)
    if not lines:
        return ""
    ratios = smoothed(np.array([len(t) / max(1, tags) for t, tags, *_ in lines], float))
    cut = two_means(ratios)
    kept = {line[region] for line, ratio in zip(lines, ratios) if ratio >= cut}
    if region == 2:
        kept = widened(lines, kept, parser.parents, parser.kinds, parser.whole)
    return "\n".join(line[0] for line in lines if line[region] in kept)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row (one pass, no shuffle); nulls in
    page_id and url stay null, a null html gives an empty text."""
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    schema = rows.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return map_arrow(rows, run, schema)
