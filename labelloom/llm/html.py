"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element. Elements that are never an article's text
(scripts, menus, forms, adverts and the like, by name, role or class) end a line and are taken out; one
that is never closed takes nothing out. The length of a line is its text outside links. Lengths are summed
over sliding windows of BLOCK lines; a text surges where the sum rises from nothing and dives where it falls
back to nothing. A region between surge and dive is accepted if it reaches SURGE, or is the longest there is;
the text is all regions from the one before the first accepted to the one after the last, so that short
titles and endings stay.

Where an article or main element holds text outside links, the markers shift the borders: links count as text
in it, a region that holds marked lines is accepted whatever its length, and surge and dive move to the
first and the last marked lines of the region.

Every step takes time linear in the page: tags are listed once, and one stack gives where elements end.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 3
# Code points that a window must hold for a region to count as text.
SURGE = 80

# Attributes of a tag, quoted values whole; possessive, so that a tag without an end is given up at once.
_ATTRIBUTES = r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_RAW = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*+>"
    r"|<(script|style|noscript|template|svg|math|select|textarea|iframe|object|button|canvas|video|audio|map)\b"
    + _ATTRIBUTES + r">.*?(?:</\1\s*>|\Z)", re.S | re.I)
_HEAD = re.compile(r"<head\b[^<>]*+>", re.I)
_HEAD_END = re.compile(r"</head\s*>", re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)(" + _ATTRIBUTES + ")>")
_HINTS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu|sidebar|side|aside|footer|"
    r"header|masthead|breadcrumbs?|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|comments?|commentlist|respond|reply|"
    r"replies|disqus|share|sharing|social|related|recommend\w*|newsletter|subscribe|subscription|signup|login|search|pagination|"
    r"pager|toolbar|widget|copyright|legal|disclaimer|skip|contentinfo|complementary|form|dialog|tags|byline-social)"
    r"(?=$|[\s_-])", re.I)
# Within an article: adverts, menus, notices, forms, share bars and comments only; other words name its own parts there.
_NOISE_WITHIN = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu|sidebar|aside|footer|breadcrumbs?|"
    r"cookies?|consent|gdpr|notice|alert|popup|modal|comments?|commentlist|respond|disqus|share|sharing|social|related|recommend\w*|"
    r"newsletter|subscribe|subscription|signup|login|pagination|pager|form|dialog|byline-social)(?=$|[\s_-])", re.I)
_COMMENT = re.compile(r"(?:^|[\s_-])comments?(?=$|[\s_-])", re.I)
# What names comments themselves, not a wrapper that says it has some.
_COMMENTS = re.compile(r"(?:^|\s)comments?(?:[_-](?:list|section|area|thread|container))?(?=$|\s)", re.I)
_DROPPED = {"nav", "footer", "aside", "form", "dialog", "menu", "fieldset", "label", "input", "option", "datalist"}
# Outside forms these stand in an article's own sentences.
_KEPT_WITHIN = {"label"}
_MAIN = {"article", "main"}
_KEPT = {"html", "body", "article", "main"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
           "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
           "u", "var", "wbr", "br", "center"}
# What stands in an article and is not it, even with articles of its own.
_BESIDE = {"nav", "footer", "aside"}
_OPEN_ENDED = {"p", "li", "dt", "dd", "td", "th", "tr"}


def _unwanted(name: str, attributes: str, inside: bool) -> bool:
    if name in _DROPPED and not (inside and name in _KEPT_WITHIN):
        return True
    if name == "header" and not inside:
        return True
    if not attributes or name in ("html", "body"):
        return False
    hints = " ".join(a or b or c for a, b, c in _HINTS.findall(attributes))
    if name in _KEPT:
        return bool(_COMMENT.search(hints))
    return bool((_NOISE_WITHIN if inside else _NOISE).search(hints)) or bool(_HIDDEN.search(attributes))


def _without_heads(page: str) -> str:
    kept, at = [], 0
    while (start := _HEAD.search(page, at)) and (end := _HEAD_END.search(page, start.end())):
        kept.append(page[at:start.start()])
        at = end.end()
    return " ".join([*kept, page[at:]])


def element_ends(tags: list[re.Match]) -> list[int]:
    """Where the element of every start tag ends; its start tag's end if it is empty or never closed.

    A block's end tag closes the innermost open block of its name and all blocks within; of these only
    paragraphs, items and cells count as closed, just before it. They also end where a sibling of
    their name starts. Inline elements pair by name alone, across blocks too.
    """
    ends = [tag.end() for tag in tags]
    blocks: list[tuple[int, str]] = []
    count: defaultdict[str, int] = defaultdict(int)
    inline: defaultdict[str, list[int]] = defaultdict(list)

    def close_innermost(place: int):
        i, name = blocks.pop()
        count[name] -= 1
        if name in _OPEN_ENDED:
            ends[i] = place

    for i, tag in enumerate(tags):
        name = tag[2].lower()
        if name in _INLINE:
            if not tag[1]:
                inline[name].append(i)
            elif inline[name]:
                ends[inline[name].pop()] = tag.end()
        elif tag[1]:
            if count[name]:
                while blocks[-1][1] != name:
                    close_innermost(tag.start())
                ends[blocks.pop()[0]] = tag.end()
                count[name] -= 1
        elif name not in _VOID and not tag[3].rstrip().endswith("/"):
            if name in _OPEN_ENDED and blocks and blocks[-1][1] == name:
                close_innermost(tag.start())
            blocks.append((i, name))
            count[name] += 1
    return ends


def _holds_text(tag: re.Match, name: str, end: int, mains: list[int], depth: int) -> bool:
    """Whether the unwanted element up to `end` holds an article or main that is not beside the text.

    `mains` are the places of all such start tags, and `depth` of them are open. Comments are beside it
    within one that is open, and if the page has others elsewhere.
    """
    held = bisect_left(mains, end) - bisect_left(mains, tag.end())
    if not held or (depth and name in _BESIDE):
        return False
    hints = " ".join(a or b or c for a, b, c in _HINTS.findall(tag[3]))
    if depth and _COMMENTS.search(hints):
        return False
    return held + depth == len(mains) or not _COMMENT.search(hints)


def lines_of(page: str) -> tuple[list[str], list[int], list[bool]]:
    """Lines, their lengths outside links, and whether each stands in an article or main element."""
    page = _without_heads(_RAW.sub(" ", page))
    tags = list(_TAG.finditer(page))
    ends = element_ends(tags)
    mains = [t.start() for t in tags if not t[1] and t[2].lower() in _MAIN and not _unwanted(t[2].lower(), t[3], False)]
    lines, sizes, within = [], [], []
    text: list[str] = []
    linked = links = main = 0

    def end_line():
        nonlocal linked
        line = " ".join(unescape("".join(text)).split())
        if line or (lines and lines[-1]):
            lines.append(line)
            sizes.append(max(0, len(line) - linked))
            within.append(main > 0)
        text.clear()
        linked = 0

    def add(piece: str):
        nonlocal linked
        if piece:
            text.append(piece)
            if links:
                linked += len(" ".join(unescape(piece).split()))

    at = 0
    for tag, end in zip(tags, ends, strict=True):
        if tag.start() < at:
            continue  # in an element that was taken out
        add(page[at:tag.start()])
        name, closing = tag[2].lower(), bool(tag[1])
        at = tag.end()
        if not closing and _unwanted(name, tag[3], main > 0):
            if (end > at or name in _DROPPED) and not _holds_text(tag, name, end, mains, main):
                if name not in _INLINE:
                    end_line()
                else:
                    text.append(" ")
                at = end
                continue
        if name == "a":
            links = max(0, links - 1) if closing else links + 1
        elif name in ("br", "img", "wbr"):
            text.append(" " if name != "wbr" else "")
        elif name not in _INLINE:
            end_line()
            links = 0
            if name in _MAIN:
                main = max(0, main - 1) if closing else main + 1
    add(page[at:])
    end_line()
    return lines, sizes, within


def regions(sizes: list[int]) -> list[tuple[int, int, int]]:
    """(surge, dive, peak) of every stretch of lines whose windows hold text."""
    found, start, peak = [], None, 0
    for i in range(len(sizes) + 1):
        window = sum(sizes[max(0, i - BLOCK + 1):i + 1]) if i < len(sizes) else 0
        if window and start is None:
            start, peak = i, 0
        if window:
            peak = max(peak, window)
        elif start is not None:
            found.append((start, i, peak))
            start = None
    return found


def main_text(page: str | None) -> str:
    """Text of the article of a page, its blocks joined by one space; empty for null, empty and text-free pages."""
    if not page:
        return ""
    lines, sizes, within = lines_of(page)
    marked = any(w and s for w, s in zip(within, sizes, strict=True))
    if marked:
        sizes = [len(line) if w else s for line, s, w in zip(lines, sizes, within, strict=True)]
    found = regions(sizes)
    if marked:
        accepted = [i for i, (first, last, _) in enumerate(found) if any(within[first:last])]
    else:
        least = min(SURGE, max((peak for _, _, peak in found), default=0))
        accepted = [i for i, (_, _, peak) in enumerate(found) if peak >= least]
    if not accepted:  # links only: what is marked, if anything
        return " ".join(line for line, w in zip(lines, within, strict=True) if w and line)
    kept = found[max(0, accepted[0] - 1):accepted[-1] + 2]
    return " ".join(lines[i] for first, last, _ in kept for i in range(first, last) if lines[i] and (within[i] or not marked))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p) for p in batch.column(2).to_pylist()]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                               pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of (page_id, url, html); other columns are ignored."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")
