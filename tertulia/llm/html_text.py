"""Main text of raw web pages, by the distribution of text over lines of blocks.

A page is cut into lines at its block tags. Chrome (menus, headers, footers, sidebars,
notices, adverts, forms, reader comments, told by tag, role, class or id) is stripped like
scripts, styles and markup comments, and each piece of it, however deep, leaves one empty
line. On every page text lengths are summed over windows of `WINDOW` lines; main text starts
where the sum surges to `SURGE` and ends where it dives to nothing, and all lines between are
kept. Where no sum surges, all text outside chrome is kept. What is found so is then held
against the page's own mark of its article (article, main, or an element so named): where the
mark covers more than half of the characters found, the article's lines are the text, with
its short first and last ones; a mark that covers less, as of teasers, changes nothing.

Class and id tell chrome by their tokens; one that only speaks of a state (`no-sidebar`,
`has-sidebar`, `comments-open`, `search-result`) does not. Neither an article or main, nor what
encloses the first one before any main text was seen, is chrome by such names, and where names
leave no text at all, a page whose windows surge without them is read without them.

Character references are decoded, blanks within a block become one, blocks are joined by a
newline in page order. A null or empty page has the empty text, as has one without any text
outside chrome. Broken markup (unclosed or stray tags, a page cut off in a tag) is read as
far as it goes: an element whose content is skipped, as a script or noscript, ends at the next
block tag where its end tag is missing, and a head needs none. Text of formulas and drawings is
text, their titles and annotations are not. Nothing is recursive, so depth is no limit, and work is linear in the page.
Each row is taken by itself, so repeated rows and null ids give the same as any other.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tertulia.llm.words import BATCH_ROWS, bounded_batches

WINDOW = 3
#: Characters of text in a window at which the main text surges.
SURGE = 80

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|</?([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+(?=>|\Z)|[^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
NAME = re.compile(r"[a-z0-9]+")

# HTML elements by what they mean for text.
RAW = frozenset("script style noscript template textarea iframe object canvas audio video title select desc metadata annotation annotation-xml".split())
CODE = frozenset("script style".split())  # their first end tag ends them
CHROME = frozenset("nav header footer aside form dialog menu button".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr ruby rt rp "
                   "math semantics mrow mi mn mo ms mtext mspace mstyle msup msub msubsup mfrac msqrt mroot mover munder munderover mpadded "
                   "mphantom menclose mfenced mtable mtr mtd merror svg g path rect circle ellipse line polyline polygon use defs symbol "
                   "tspan textpath lineargradient radialgradient stop clippath mask marker pattern image".split())
ARTICLE_TAGS = frozenset("article main".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu form".split())
CHROME_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget widgets related recommended "
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "popup modal overlay newsletter subscribe subscription share sharing social comment comments reply replies respond disqus "
    "login signup search pagination pager copyright disclaimer toolbar".split())
CHROME_STARTS = ("comment", "advert", "adsby", "sidebar", "cookie", "breadcrumb", "newsletter", "sitenav", "topnav", "mainnav", "navmenu",
                 "sitefooter", "pagefooter", "siteheader", "pageheader")
ARTICLE_NAMES = frozenset("article articlebody maincontent".split())
# First and last words of tokens that tell a state and name no element.
STATE_FIRST = frozenset("no has have with without is not hide show non".split())
STATE_LAST = frozenset("open opened closed enabled disabled on off active visible hidden result results".split())


def _named(attributes: str) -> tuple[set[str], bool]:
    """Words of class, id and role, and whether the element is hidden."""
    names, hidden = set(), False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            hidden = True
        else:
            for token in value.split():
                words = NAME.findall(token)
                if key == "role":
                    names.update("role:" + w for w in words)
                elif words and not (len(words) > 1 and (words[0] in STATE_FIRST or words[-1] in STATE_LAST)):
                    names.update(words)
    return names, hidden


def _chrome_by_tag(tag: str, in_article: bool) -> bool:
    """A header inside an article holds its title; an article inside an article is a comment."""
    return tag in CHROME and not (tag == "header" and in_article) or tag == "article" and in_article


def _chrome_by_name(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is chrome by what its role says or as it is hidden, and by its class or id."""
    if tag in ("html", "body", "main") or not attributes or tag in INLINE and tag not in ("span", "a"):
        return False, False
    names, hidden = _named(attributes)
    found = names & CHROME_NAMES
    if in_article:
        found -= {"header"}
    named = tag != "article" and (bool(found) or any(n.startswith(CHROME_STARTS) for n in names))
    return hidden or any("role:" + r in names for r in CHROME_ROLES), named


def _skipped(page: str, tag: str) -> dict[int, int]:
    """Where the content of each element of this tag that has its end tag ends, by where it starts."""
    ends: dict[int, int] = {}
    starts: list[int] = []
    for m in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", page, re.I):
        if not m[1]:
            starts.append(m.start())
        elif tag in CODE:
            ends.update(dict.fromkeys(starts, m.end()))
            starts.clear()
        elif starts:
            ends[starts.pop()] = m.end()
    return ends


def lines(page: str) -> list[tuple[str, bool]]:
    """Each line in page order, empty where chrome was, and whether an article encloses it."""
    out, enclosing = _lines(page, frozenset())
    if enclosing:
        out, _ = _lines(page, enclosing)
    if not any(text for text, _ in out):
        plain, _ = _lines(page, None)
        lengths = np.array([len(text) for text, _ in plain], int)
        if len(plain) and np.convolve(lengths, np.ones(WINDOW, int)).max() >= SURGE:
            return plain
    return out


def _lines(page: str, exempt: frozenset[int] | None) -> tuple[list[tuple[str, bool]], frozenset[int]]:
    """The lines, with elements that start at `exempt` (None: all) no chrome by class or id, and
    the starts of elements so named that enclose the page's first article."""
    enclosing: frozenset[int] = frozenset()
    seen = 0  # characters of text so far
    found_article = False
    skipped: dict[str, dict[int, int]] = {}
    out: list[tuple[str, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool, int]] = []  # tag, chrome, article, start if chrome by class or id alone
    open_tags: dict[str, int] = {}
    chrome = article = sure_chrome = 0
    raw = False  # inside an element to skip that has no end tag

    def close() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            nonlocal seen
            seen += len(text)
            out.append((text, article > 0))

    def push(tag: str, is_chrome: bool, is_article: bool, named_at: int) -> None:
        nonlocal chrome, article, sure_chrome
        if is_chrome and not chrome:
            out.append(("", False))
        stack.append((tag, is_chrome, is_article, named_at))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        chrome += is_chrome
        sure_chrome += is_chrome and named_at < 0
        article += is_article

    def pop() -> None:
        nonlocal chrome, article, sure_chrome
        tag, was_chrome, was_article, named_at = stack.pop()
        open_tags[tag] -= 1
        chrome -= was_chrome
        sure_chrome -= was_chrome and named_at < 0
        article -= was_article

    at = 0
    while at < len(page):
        m = TOKEN.search(page, at)
        text = page[at: m.start() if m else len(page)]
        if raw and m and m[1] and m[1].lower() not in INLINE:
            raw, text = False, ""
        if text and not chrome and not raw:
            parts.append(text)
        if not m:
            break
        at = m.end()
        if not m[1]:
            continue
        tag, ending = m[1].lower(), page.startswith("</", m.start())
        if tag not in INLINE:
            if not chrome:
                close()
        if not ending:
            if tag in RAW:
                if not m[2].endswith("/"):
                    if tag not in skipped:
                        skipped[tag] = _skipped(page, tag)
                    end = skipped[tag].get(m.start())
                    at, raw = (end, False) if end else (at, True)
            elif tag not in VOID and tag != "head":
                names = _named(m[2])[0] if m[2] else set()
                sure, named = _chrome_by_name(tag, m[2], article > 0)
                sure = sure or _chrome_by_tag(tag, article > 0)
                named = named and not sure and exempt is not None and m.start() not in exempt
                if tag in ARTICLE_TAGS and not found_article and seen < SURGE and not sure and not sure_chrome:
                    found_article = True
                    enclosing = frozenset(e[3] for e in stack if e[1])
                push(tag, sure or named, tag in ARTICLE_TAGS or bool(names & ARTICLE_NAMES), m.start() if named else -1)
        elif open_tags.get(tag):
            while stack[-1][0] != tag:
                pop()
            pop()
    if not chrome:
        close()
    return out, enclosing


def surging(found: list[tuple[str, bool]], window: int = WINDOW, surge: int = SURGE) -> list[tuple[str, bool]]:
    """The lines with text from each surge to its dive; all of them where no sum surges."""
    if not found:
        return []
    lengths = np.array([len(text) for text, _ in found])
    sums = np.convolve(lengths, np.ones(window, int))[window - 1:]
    kept, surged = [], False
    for line, total in zip(found, sums.tolist()):
        surged = total >= surge or surged and total > 0
        if surged and line[0]:
            kept.append(line)
    return kept or [line for line in found if line[0]]


def between(found: list[tuple[str, bool]], window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The texts of the lines from surge to dive, or of the article that holds most of them."""
    kept = surging(found, window, surge)
    marked = sum(len(text) for text, inside in kept if inside)
    if 2 * marked > sum(len(text) for text, _ in kept):
        return [text for text, inside in found if inside and text]
    return [text for text, _ in kept]


def main_text(page: str) -> str:
    return "\n".join(between(lines(page)))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points)."""
    bounded_batches(pages.sparkSession)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for low in range(0, rows.num_rows, BATCH_ROWS):
                part = rows.slice(low, BATCH_ROWS)
                texts = [main_text(p or "") for p in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"),
    ).mapInArrow(extract, "page_id long, url string, text string, n_chars long")


def op10(pages: DataFrame) -> DataFrame:
    return extracted(pages)
