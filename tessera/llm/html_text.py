"""Main-text extraction from HTML by line-block distribution.

Markup is stripped to text lines, one for each block-level stretch, and a line weighs its text length; text in links weighs
nothing. Elements that are page furniture by name or role (menus, footers, side bars, forms, notices) make no lines, nor do
those whose class or id says so. Words of layout (side bar, header, menu) alone do not decide, though: where nothing surges
outside such elements, the one that holds most of the page's text is a wrapper and no furniture. Sums of the weights over a sliding window of lines surge where the article begins and dive where it
ends; all lines between the first surge and the last dive stay, and so do the lines next to them in the same container. In a
page that marks articles or a main part the marked parts with the text stay whole: those of at least a third of the heaviest
one's weight (lighter ones are teaser cards), provided that together they outweigh the text beside them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, packed, small_batches, table, unpacked

#: Elements whose content is no text (fixed values).
RAW = frozenset("script style noscript template iframe object svg math canvas audio video select textarea button datalist head title".split())
#: Elements whose content is read to their own end tag without markup inside (fixed values of the HTML standard).
OPAQUE = frozenset("script style textarea title iframe noscript xmp noembed noframes".split())
#: Elements that begin and end a block (fixed values).
BLOCK = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("nav footer aside menu dialog search".split())
#: Furniture unless most of the page's text stands in it, as where a form is put around the whole page.
WRAPPERS = frozenset("form header".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of class and id that mark furniture (fixed values).
WORDS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|adsense|banner|sponsor|sponsored|promo|promotion|sidebar|side-bar|nav|navbar|navigation|menu|breadcrumb|breadcrumbs"
    r"|masthead|topbar|footer|cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommended"
    r"|widget|comment|comments|commentlist|respond|reply|replies|disqus|discussion|pagination|pager|toolbar|skip|copyright|legal|disclaimer)(?:$|[\s_-]|\d)", re.I
)
#: Such a word says nothing after one of these: a class like "has-sidebar" describes a layout (fixed values).
LAYOUT = re.compile(r"(?:^|\s)(?:has|no|with|without|is|js|hide|page|template|layout)[_-][^\s]*", re.I)
#: Words of things that hold no article, however long they are: readers' comments, notices, adverts (fixed values).
NEVER = re.compile(
    r"(?:^|[\s_-])(?:comment|comments|commentlist|respond|reply|replies|disqus|discussion|cookie|cookies|consent|gdpr|notice|notices|alert|popup|newsletter|subscribe|signup|login|ad|ads"
    r"|advert|adverts|advertisement|advertising|adsense|sponsor|sponsored|breadcrumb|breadcrumbs|pagination|pager|skip|copyright|disclaimer)(?:$|[\s_-]|\d)", re.I
)
#: Quantifiers are possessive, and a quote without a partner is a character like others, so that no text is read twice.
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*+(?:>|$)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++)")
#: More such words, for outside an article's own elements.
OUTER = re.compile(r"(?:^|[\s_-])(?:header|foot|aside|top-bar|bottom)(?:$|[\s_-]|\d)", re.I)
SPACE = re.compile(r"\s+")
#: Elements whose lines belong together (fixed values); headings, paragraphs and lists belong to the one around them.
CONTAINERS = frozenset("article body center div main section table td th".split())
#: What an opening element closes when it is left open (fixed values of the HTML standard).
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


KEPT, WRAPPER, GONE = 0, 1, 2


def furniture(name: str, attributes: str, inside_main: bool) -> int:
    """``GONE`` for page furniture, ``WRAPPER`` for what is furniture unless it holds most of the text, else ``KEPT``."""
    if name in FURNITURE:
        return GONE
    kind = WRAPPER if name == "form" or name == "header" and not inside_main else KEPT
    if "=" not in attributes:
        return GONE if re.search(r"\bhidden\b", attributes, re.I) else kind
    if re.search(r"(?:^|\s)hidden(?:\s|$|=)", attributes, re.I):
        return GONE
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
    if found.get("role", "").lower() in ROLES or found.get("aria-hidden", "").lower() == "true":
        return GONE
    if name in ("body", "html", "main", "article"):
        return KEPT
    names = LAYOUT.sub(" ", f"{found.get('class', '')} {found.get('id', '')}")
    if NEVER.search(names):
        return GONE
    return WRAPPER if WORDS.search(names) or not inside_main and OUTER.search(names) else kind


@dataclass
class Lines:
    """What a page's lines are: text, characters outside links, marked part (0: none), container, wrappers around."""

    text: list[str] = field(default_factory=list)
    weight: list[int] = field(default_factory=list)
    part: list[int] = field(default_factory=list)
    container: list[int] = field(default_factory=list)
    wrappers: list[tuple | None] = field(default_factory=list)

    def where(self, good: list[bool]) -> Lines:
        return Lines(*[[x for x, g in zip(column, good, strict=True) if g] for column in (self.text, self.weight, self.part, self.container, self.wrappers)])


def parsed(html: str) -> Lines:
    """All lines outside ``GONE`` elements, in one pass; no text is looked at more than a few times."""
    lines = Lines()
    piece: list[str] = []
    plain = 0
    # Open elements: name, gone, marked part, in a link, container, wrappers as a linked list, index of the innermost block.
    root = ("", False, 0, False, 0, None, -1)
    stack: list[tuple] = [root]
    open_now: dict[str, int] = {}

    def end_line() -> None:
        nonlocal plain
        if piece:
            line = SPACE.sub(" ", unescape("".join(piece))).strip()
            if line:
                top = stack[-1]
                lines.text.append(line)
                lines.weight.append(min(plain, len(line)))
                lines.part.append(top[2])
                lines.container.append(top[4])
                lines.wrappers.append(top[5])
            piece.clear()
            plain = 0

    def pop_to(k: int) -> None:
        for gone in stack[k:]:
            open_now[gone[0]] -= 1
        del stack[k:]

    at, n = 0, len(html)
    while at < n:
        m = TOKEN.search(html, at)
        stop = m.start() if m else n
        if stop > at and not stack[-1][1]:
            piece.append(html[at:stop])
            plain += 0 if stack[-1][3] else stop - at
        if not m:
            break
        at = m.end()
        name = m.group(2)
        if not name:
            if m.group(0).startswith("<![CDATA[") and not stack[-1][1]:
                piece.append(m.group(0)[9:-3])
            continue
        name = name.lower()
        if m.group(1):
            if name in BLOCK:
                end_line()
            if open_now.get(name):
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                pop_to(k)
            continue
        if name in OPAQUE:
            close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
            shut = html.find(">", close.end()) if close else -1
            at = n if shut < 0 else shut + 1
            continue
        if name in BLOCK:
            end_line()
            inner = stack[-1][6]
            if name not in ("html", "body") and inner > 0 and (stack[inner][0] == "p" or stack[inner][0] in CLOSES.get(name, ())):
                pop_to(inner)  # an open paragraph or item ends where a block or the next begins
        elif name == "br":
            piece.append(" ")
        if name in VOID or m.group(3).endswith("/") and name not in BLOCK:
            continue
        _, gone, part, link, container, wrappers, inner = stack[-1]
        kind = GONE if gone or name in RAW else furniture(name, m.group(3), part > 0)
        if kind == WRAPPER:
            wrappers = (at, wrappers)
        if name in ("article", "main") and not part:
            part = at
        stack.append((name, kind == GONE, part, link or name == "a", at if name in CONTAINERS else container, wrappers, len(stack) if name in BLOCK else inner))
        open_now[name] = open_now.get(name, 0) + 1
    end_line()
    return lines


def surge_to_dive(weights: np.ndarray, window: int, least: int) -> tuple[int, int]:
    """[first, last) line of the text between the first surge and the last dive; empty if no window reaches ``least``."""
    n = len(weights)
    if not n:
        return 0, 0
    total = np.concatenate([[0], np.cumsum(weights)])
    ends = np.minimum(np.arange(n) + window, n)
    sums = total[ends] - total[:-1]  # of the lines from each on
    rich = np.flatnonzero((sums >= least) & (weights > 0))
    if not len(rich):
        return 0, 0
    first = rich[0]
    back = total[1:] - total[np.maximum(np.arange(n) + 1 - window, 0)]  # of the lines up to each
    last = np.flatnonzero((back >= least) & (weights > 0))[-1]
    return int(first), int(last) + 1


def outside_furniture(lines: Lines, window: int, least: int) -> Lines:
    """The lines outside wrappers, if they surge or a marked part is among them. Else a wrapper that holds over half of all
    text is none, and only the lines in other ones go."""
    rest = lines.where([not x for x in lines.wrappers])
    if len(rest.text) == len(lines.text) or any(rest.part) or surge_to_dive(np.array(rest.weight, np.int64), window, least)[1]:
        return rest
    held: dict[int, int] = {}
    for w, around in zip(lines.weight, lines.wrappers, strict=True):
        while around and w:
            held[around[0]] = held.get(around[0], 0) + w
            around = around[1]
    full = {k for k, w in held.items() if w >= least and 2 * w > sum(lines.weight)}
    bad: dict[int, bool] = {}

    def is_bad(around: tuple | None) -> bool:
        path = []
        while around and around[0] not in bad:
            path.append(around[0])
            around = around[1]
        answer = bad[around[0]] if around else False
        for k in reversed(path):
            answer = bad[k] = answer or k not in full
        return answer

    return lines.where([not is_bad(x) for x in lines.wrappers])


def main_text(html: str | None, window: int = 3, least: int = 60) -> str:
    """The page's article; empty for null, empty and markup-only pages.

    If no window of ``window`` lines holds ``least`` characters, the page is short and all its lines outside furniture stay.
    """
    if not html:
        return ""
    lines = outside_furniture(parsed(html), window, least)
    parts: dict[int, int] = {}
    for p, w in zip(lines.part, lines.weight, strict=True):
        if p:
            parts[p] = parts.get(p, 0) + w
    if parts:
        most = max(parts.values())
        full = {p for p, w in parts.items() if 3 * w >= most}
        own = sum(parts[p] for p in full)
        beside = [w if not p else 0 for p, w in zip(lines.part, lines.weight, strict=True)]
        first, last = surge_to_dive(np.array(beside, np.int64), window, least)
        if own >= sum(beside[first:last]):  # what is beside it, where it surges
            return "\n".join(t for t, p in zip(lines.text, lines.part, strict=True) if p in full)
        lines = lines.where([not p or parts[p] >= least for p in lines.part])
    first, last = surge_to_dive(np.array(lines.weight, np.int64), window, least)
    if first == last:
        return "\n".join(lines.text)
    within = lines.container
    while first and within[first - 1] == within[first]:
        first -= 1
    while last < len(within) and within[last] == within[last - 1]:
        last += 1
    return "\n".join(lines.text[first:last])


def extract_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] | None = None, window: int = 3, least: int = 60) -> DataFrame:
    """Each row of ``pages`` with ``text`` and ``n_chars`` (code points). Rows never meet, so there is no shuffle.

    Input columns named ``text`` or ``n_chars`` are replaced; null html gives empty text; empty tables give empty results.
    """

    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def extract(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, window, least) for h in html], dtype=object)

    rows = pages.select(packed(pages, ("text", "n_chars"), keep), extract(pages[f"`{html_col}`"]).alias("text"))
    return rows.select(*unpacked(rows), "text", F.length("text").cast("long").alias("n_chars"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"), keep=("page_id", "url")).select("page_id", "url", "text", "n_chars")
