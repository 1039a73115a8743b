"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.llm.common import map_tables

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*>",
    re.S,
)
ATTR = re.compile(r"(?P<key>[^\s\"'>/=][^\s>/=]*)(?:\s*=\s*(?:\"(?P<a>[^\"]*)\"|'(?P<b>[^']*)'|(?P<c>[^\s\"'>]+))?)?")
NAMING = set("class id role itemprop".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
# HTML's elements by their part in a page, and the names sites give to parts that are no article.
RAW = "script style noscript template textarea title iframe object svg math canvas audio video select".split()
CHROME = "nav aside footer form dialog menu button head map applet".split()
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ENDED_BY = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}
OTHER = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs header masthead topbar footer bottombar sidebar aside rail widget widgets notice notices cookie cookies consent gdpr alert "
    "comment comments disqus reply replies respond discussion form login signup signin subscribe subscription newsletter search popup modal overlay "
    "share sharing social related recommended recommendations pagination pager toolbar copyright legal disclaimer hidden contentinfo complementary "
    "dialog alertdialog".split()
)
OWN = set("article articles articlebody post entry story main content".split())
LAYOUT = set("has with no without".split())
#: Inside an article, names that only parts around its text have; other words of OTHER may be its subject.
SURE = set(
    "ad ads adv advert adverts advertisement advertisements advertising adsense nav navbar navigation menubar breadcrumb breadcrumbs sidebar cookie cookies gdpr "
    "comment comments disqus respond footer signup signin login subscribe newsletter popup pagination pager contentinfo complementary dialog alertdialog modal".split()
)
#: Words beside which a name in an article still names such a part, as in user-comments or comment-list; other words make it a subject.
BESIDE = SURE | set("article body entry post story user reader site page main widget list section area wrapper container box block group thread form item links inner outer slot unit top bottom left right header title text count".split())
MAIN = {"main", "article"}
#: Mark of a headline in a main element, outside its articles.
HEADLINE = 3
#: Never left out for their names; an article within another, such as a reader's comment, can be.
HELD = {"main", "article", "h1", "h2", "h3", "h4", "h5", "h6"}


def _labels(attrs: str) -> tuple[set[str], bool]:
    """Words of class, id, role and the like; whether the element is hidden."""
    words, hidden = set(), False
    for m in ATTR.finditer(attrs):
        value, key = m["a"] or m["b"] or m["c"] or "", m["key"].lower()
        if key == "hidden":
            hidden |= value.lower() != "until-found"
        elif key == "aria-hidden":
            hidden |= value.lower() == "true"
        elif key == "aria-modal":
            if value.lower() == "true":
                words.add("modal")
        elif key in NAMING:
            words.update(w.lower() for w in WORD.findall(value))
    return words, hidden


def _chrome(words: set[str], in_article: bool) -> bool:
    """Whether the words of an element's names say that it is no article text."""
    if in_article:
        named = words & SURE
        return bool(named and not words & LAYOUT and not {w for w in words - BESIDE if not w.isdigit()})
    return bool(words & (OTHER - {"header"}) and not words & LAYOUT or "header" in words and not words & OWN)


def blocks(page: str | None) -> list[tuple[str, int, int]]:
    """Blocks of a page in order: text with single spaces, characters outside links, and 2 in an article, 3 in another headline of a main part, 1 elsewhere in one, else 0.

    Markup is stripped here: tags, comments, scripts, styles, and elements whose kind or name
    says that they are menu, header, footer, sidebar, notice, advert, form or reader comment.
    Such an element ends at its own end tag, at the next start of a main or article element, or,
    where HTML lets the end tag out, at the tag that ends it.
    """
    out: list[tuple[str, int, int]] = []
    parts: list[str] = []
    linked, links, skip, depth, article, at, headline = 0, 0, "", 0, [], 0, False
    page = page or ""

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((text, max(0, len(text) - linked), 2 if "article" in article else HEADLINE if article and headline else len(article[:1])))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not skip:
            plain = html.unescape(text) if "&" in text else text
            parts.append(plain)
            if links:
                linked += len(" ".join(plain.split()))

    while True:
        m = TOKEN.search(page, at)
        add(page[at : m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        if m["name"] is None:
            continue
        name, closing, attrs = m["name"].lower(), bool(m["close"]), m["attrs"]
        if skip:
            if name in MAIN and not closing and not (article and name == "article"):
                skip = ""
            elif not closing and name in ENDED_BY.get(skip, ()):
                skip = ""
            elif name == skip:
                depth += -1 if closing else 1
                if depth <= 0:
                    skip = ""
                    continue
            if skip:
                if not closing and name in RAW:
                    at = _raw_end(page, at, name)
                continue
        if closing:
            if name in BLOCK:
                flush()
            if name == "h1":
                headline = False
            if name == "a":
                links = max(0, links - 1)
            elif article and name in MAIN and name in article:
                while article.pop() != name:
                    pass
            continue
        if name in RAW:
            if name != "svg" or not attrs.rstrip().endswith("/"):
                at = _raw_end(page, at, name)
            continue
        if name in BLOCK:
            flush()
        if name == "br":
            add(" ")
        if name in VOID:
            continue
        words, hidden = _labels(attrs) if attrs.strip() else (set(), False)
        named = _chrome(words, bool(article))
        page_header = name == "header" and not article
        if name not in ("html", "body") and (hidden or name in CHROME or page_header or (named and (name not in HELD or article and name == "article"))):
            flush()
            skip, depth = name, 1
        elif name in MAIN:
            article.append(name)
        elif name == "a":
            links += 1
        elif name in BLOCK:
            headline = name == "h1"
    flush()
    return out


def _raw_end(page: str, at: int, name: str) -> int:
    """Place after the end tag of an element whose inside is no text; the end of the page if it has none."""
    m = re.compile(rf"</{name}\s*>", re.I).search(page, at)
    return m.end() if m else len(page)


def main_text(page: str | None, window: int = 3, surge: int = 86) -> str:
    """Text between surge and dive points of the page's line blocks, one block a line.

    Each block is a line whose length counts the characters outside links, none if they are a quarter of it or less. Lengths are
    summed over ``window`` lines from each line on. A region starts at a line with more text outside links than inside where the sum
    surges above ``surge``, and lasts to the dive, the first line with nothing in its window. All lines of a region stay whole, in page order.

    Article elements, or else main elements, are trusted if they hold as much text as the rest of the page, or if the rest
    is no more than ``window`` lines of ``surge`` characters. Lines in them count all characters, and any sum of them above 0 is a surge, so that short
    paragraphs stay; lines outside are summed apart, by a quarter of their length. The headline of a main element belongs to what it holds.
    """
    lines = blocks(page)
    if not lines:
        return ""
    size = np.array([len(x[0]) for x in lines], np.int64)
    plain = np.array([x[1] for x in lines], np.int64)
    mark = np.array([x[2] for x in lines])
    text = plain * (4 * plain > size)
    keep = np.zeros(len(lines), bool)
    for inside in (mark >= 2, mark >= 1):
        outside = text[~inside].sum()
        if (inside & (mark != HEADLINE)).any() and (outside <= window * surge or outside <= text[inside].sum()):
            keep |= _regions(size * inside, inside, window, 0)
            keep |= _regions(text * ~inside, ~inside & (2 * plain > size), window, 4 * surge)
            break
    else:
        keep |= _regions(text, 2 * plain > size, window, surge)
        if not keep.any():
            keep = text > 0
    return "\n".join(x[0] for x, k in zip(lines, keep) if k)


def _regions(weight: np.ndarray, opens: np.ndarray, window: int, least: int) -> np.ndarray:
    """Which lines lie between a line that ``opens`` a region, with a sum above ``least``, and the next with a sum of 0."""
    total = np.concatenate([[0], np.cumsum(weight)])
    sums = total[np.minimum(np.arange(len(weight)) + window, len(weight))] - total[:-1]
    keep, within = np.zeros(len(weight), bool), False
    for i in range(len(weight)):
        within = sums[i] > 0 if within else bool(opens[i] and weight[i] and sums[i] > least)
        keep[i] = within
    return keep


def extract(pages: DataFrame, window: int = 3, surge: int = 86) -> DataFrame:
    """(page_id, url, text, n_chars) of every page row, from the whole html.

    Null or empty html gives an empty text, null page_id and url pass through, repeated rows
    give a row each, other columns are ignored. Broken markup is read as far as it goes: an
    unclosed comment or script lasts to the end of the page.
    """

    def work(rows: pa.Table) -> pa.Table:
        text = [main_text(x, window, surge) for x in rows["html"].to_pylist()]
        return pa.table({"page_id": rows["page_id"], "url": rows["url"], "text": pa.array(text, pa.string()), "n_chars": pa.array(map(len, text), pa.int64())})

    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return map_tables(read, work, "page_id long, url string, text string, n_chars long")
