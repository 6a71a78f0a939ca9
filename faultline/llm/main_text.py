"""Main text of web pages by the distribution of text over line blocks.

A page's markup is stripped to lines, one per block element. Each line has a
weight: its length, less its links. A block is a line with the two that
follow; where the summed weight of blocks surges over a threshold the main
text begins, where it dives below it ends, and what lies between is kept,
short lines included.

Lines of menus, page headers and footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments are stripped with their elements. In a page with an
``article`` or ``main`` element, lines outside it weigh nothing and any
weight inside is a surge.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import ship

ship(__name__)

WINDOW = 3
SURGE = 80

# fixed values of HTML: elements by their role
NEVER = frozenset("head script style noscript template iframe object svg math canvas textarea select".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
ASIDE = frozenset("nav aside form footer menu dialog button".split())
MAIN = frozenset(("article", "main"))
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# elements whose end tag may be left out: what begins ends them, up to what holds them
FLOW = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section "
    "summary table ul".split()
)
LISTS = frozenset("ul ol menu dir".split())
ROWS = frozenset("tr tbody thead tfoot caption colgroup".split())
CELLS = ROWS | {"td", "th"}
# elements that the end tags of those around them do not reach into
SCOPE = frozenset("table td th caption object template marquee applet button html".split())
IN_HEAD = frozenset("title meta link base script style noscript template head html".split())
IMPLIED = (
    (frozenset("p".split()), FLOW, SCOPE),
    (frozenset("li".split()), frozenset("li".split()), LISTS | SCOPE),
    (frozenset("dt dd".split()), frozenset("dt dd".split()), SCOPE | {"dl"}),
    (frozenset("td th".split()), CELLS, frozenset("table template".split())),
    (frozenset("tr caption colgroup".split()), ROWS, frozenset("table template".split())),
    (
        frozenset("tbody thead tfoot".split()),
        frozenset("tbody thead tfoot".split()),
        frozenset("table template".split()),
    ),
    (frozenset("option".split()), frozenset("option optgroup".split()), frozenset(("select",))),
)
FORMATTING = frozenset("a b big code em font i s small strike strong tt u".split())
# classes, ids and roles, whole, that mark what is not the main text
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe subscription share sharing social related "
    "recommended comment comments disqus respond reply replies complementary contentinfo search".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # a quote opens a value only behind an equals sign; any other one is part of a name
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*)?)*+)(?:>|\Z)",
    re.S,
)
# known phrases: the marks of these parts with what such parts are called
PHRASES = frozenset(
    f"{mark}-{part}"
    for marks, parts in (
        (
            "ad ads advert advertisement banner sponsor sponsored promo cookie consent gdpr newsletter "
            "popup modal subscribe subscription",
            "banner bar block box container content dialog form label message modal notice overlay "
            "popup section signup slot unit widget wrapper",
        ),
        ("share sharing social", "bar block box buttons container icons links list widget wrapper"),
        (
            "related recommended",
            "articles block box container content items links list news pages posts products section "
            "stories widget wrapper",
        ),
        (
            "comment comments disqus respond reply replies",
            "area block box container form list section thread title widget wrapper",
        ),
        (
            "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer search",
            "area bar block box container content form inner items left links list main menu primary "
            "right section secondary top widget wrapper",
        ),
    )
    for mark in marks.split()
    for part in parts.split()
) | frozenset(
    f"{part}-{mark}"
    for part in "bottom footer header left main page primary right secondary side site top".split()
    for mark in "ad ads banner nav navbar navigation menu sidebar footer search".split()
) | frozenset(
    "ad-banner banner-ad google-ad google-ads adsbygoogle nav-bar side-bar pop-up site-notice "
    "privacy-notice legal-notice social-media social-share post-comments article-comments "
    "sign-up-form skip-nav".split()
)
ATTRIBUTE = re.compile(
    r"([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?"
)
NUMBER = re.compile(r"-\d+$")
SPACE = re.compile(r"\s+")


def marked(attributes: str) -> bool:
    """Whether an element says that it is not the main text."""
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name in ("class", "id", "role"):
            for token in value.replace("_", "-").split():
                token = NUMBER.sub("", re.sub("-+", "-", token))
                if token in MARKS or token in PHRASES:
                    return True
    return False


def closes_itself(attributes: str) -> bool:
    """Whether a tag ends in a slash that is not part of an unquoted value."""
    if not attributes.endswith("/"):
        return False
    last = None
    for last in ATTRIBUTE.finditer(attributes):
        pass
    return last is None or last.end() < len(attributes)


def depth_left(stack: list[str], closing: bool, name: str) -> int:
    """How many of the open elements stay open at a tag."""
    if not closing:
        left = len(stack)
        if "head" in stack and name not in IN_HEAD:
            left = stack.index("head")
        for ended, by, stop in IMPLIED:
            if name in by:
                for i in range(left - 1, -1, -1):
                    if stack[i] in ended:
                        left = i
                        break
                    if stack[i] in stop:
                        break
        return left
    table_part = name in CELLS or name == "table"
    for i in range(len(stack) - 1, -1, -1):
        if stack[i] == name:
            return i
        if table_part:
            if stack[i] in ("table", "template"):
                break
        elif stack[i] in SCOPE or (
            name in INLINE and name not in FORMATTING and stack[i] not in INLINE
        ):
            break
    return len(stack)


def lines(page: str) -> list[tuple[str, int, bool]]:
    """(text, weight, in the main element) of each block of a page.

    The open elements are kept in a stack, and end where HTML ends them: at
    their end tag, at that of an element around them, or, if theirs may be
    left out, at what cannot be inside. A skipped part ends with its element.
    """
    out: list[tuple[str, int, bool]] = []
    held: list[str] = []
    stack: list[str] = []
    linked = main_depth = 0
    #: Open elements around the skipped one, none while nothing is skipped.
    skip: int | None = None
    in_link = False
    raw = ""

    def close() -> None:
        nonlocal linked
        text = SPACE.sub(" ", "".join(held)).strip()
        if text:
            out.append((text, max(0, len(text) - 2 * linked), main_depth > 0))
        held.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and skip is None and not raw:
            text = entities.unescape(text) if "&" in text else text
            held.append(text)
            linked += len(text) * in_link

    at = 0
    for tag in TOKEN.finditer(page):
        add(page[at : tag.start()])
        at = tag.end()
        closing, name, attributes = tag.group(1), (tag.group(2) or "").lower(), tag.group(3) or ""
        if raw:
            if closing and name == raw:
                raw = ""
            continue
        if not name:
            continue
        own = closes_itself(attributes)
        left = depth_left(stack, bool(closing), name)
        ended = len(stack) > left
        if closing and ended and name in FORMATTING and not INLINE.issuperset(stack[left:]):
            # the blocks in it go on without it
            del stack[left]
            if skip is not None and skip >= left:
                skip = None if skip == left else skip - 1
        else:
            if mains := sum(x in MAIN for x in stack[left:skip]):
                close()
                main_depth -= mains
            del stack[left:]
            if skip is not None and left <= skip:
                skip = None
        if skip is not None:
            # a part that was left open does not swallow the main text
            if name in MAIN and not closing and not marked(attributes):
                del stack[skip:]
                skip = None
            else:
                if not closing and not own:
                    if name in RAW:
                        raw = name
                    elif name not in VOID:
                        stack.append(name)
                continue
        if name not in INLINE:
            close()
        elif name == "br":
            held.append(" ")
        if closing:
            in_link = in_link and name != "a"
        elif name in RAW and not own:
            raw = name
        elif name not in VOID and not own:
            outer = name == "header" and not main_depth
            body = name in ("html", "body")
            if name in NEVER or name in ASIDE or outer or (not body and marked(attributes)):
                skip = len(stack)
            elif name in MAIN:
                main_depth += 1
            elif name == "a":
                in_link = True
            stack.append(name)
    add(page[at:])
    close()
    return out


def kept(weights: list[int], surge: int) -> list[tuple[int, int]]:
    """Ranges of lines between the surges and dives of their blocks."""
    w = np.array(weights, np.int64)
    if not w.any():
        return []
    total = np.r_[0, np.cumsum(w), np.full(WINDOW, w.sum())]
    blocks = total[WINDOW : WINDOW + len(w)] - total[: len(w)]
    if not (blocks >= surge).any():
        surge = int(blocks.max())
    dense = np.flatnonzero(blocks >= surge)
    out: list[tuple[int, int]] = []
    for i in dense.tolist():
        end = min(i + WINDOW, len(w))
        if out and i <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((i, end))
    # lines without weight at an edge belong to the surge or dive, not the text
    trimmed = []
    for start, end in out:
        heavy = np.flatnonzero(w[start:end])
        trimmed.append((start + int(heavy[0]), start + int(heavy[-1]) + 1))
    return trimmed


def main_text(page: str | None) -> str:
    """The main text of a page, empty for a null, empty or textless one."""
    found = lines(page or "")
    if any(inside for _, _, inside in found):
        weights = [len(text) if inside else 0 for text, _, inside in found]
        ranges = kept(weights, 1)
        return "\n".join(t for s, e in ranges for t, _, inside in found[s:e] if inside)
    ranges = kept([w for _, w, _ in found], SURGE)
    return "\n".join(t for s, e in ranges for t, _, _ in found[s:e])


def extract(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        part["text"] = [main_text(h) for h in part.pop("html")]
        yield part


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Null and empty html, and pages without main text, give an empty text.
    Nulls in the other columns stay, rows that repeat are extracted each, an
    empty table gives no row, and other columns are not read.
    """
    read = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    ids = {f.name: f.dataType.simpleString() for f in read.schema.fields}
    # ids travel as text, which keeps nulls and 64 bits through pandas
    as_text = read.select(F.col("page_id").cast("string"), "url", "html")
    found = as_text.mapInPandas(extract, "page_id string, url string, text string")
    return found.select(
        F.col("page_id").cast(ids["page_id"]),
        "url",
        "text",
        F.length("text").cast("long").alias("n_chars"),
    )
