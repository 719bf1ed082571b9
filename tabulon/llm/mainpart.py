"""Main text of HTML pages by the line-block distribution.

Markup is stripped to lines, one per block element. Elements that are no article text by their kind, role or class (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments) leave a gap of ``WINDOW`` empty lines,
unless they stand between blocks of one article or of one parent element. A class that only contains such a word
("content-sidebar-wrap") can be that of a wrapper: its element stays if it holds more than half of the page's text (and of the
text in ``article`` or ``main`` elements, if there are any); what a class has or has not ("has-sidebar", "comments-open") is no mark. If the page has an ``article`` (or else a ``main``) element with text, lines outside count as empty; without one, link text
does not count. The text lengths are summed over sliding windows of ``WINDOW`` lines. The distribution surges where a
sum reaches ``SURGE`` characters (or the page's largest sum, if that is less) and dives where it is zero; the lines of a
rise are kept from its foot to the dive.

Character references are decoded once, white space within a block (line breaks too) becomes one space, blocks are
trimmed, empty ones dropped, the rest joined by line feeds. Defined cases: null or empty html, or a page without text, has
the empty text; an unclosed comment, script or skipped element reaches to the end of its parent or page; rows are
independent, so repeated rows and ties give repeated results; texts of any length are read whole; other columns pass through.
"""
from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tabulon.llm.common import free_name, table

WINDOW, SURGE = 3, 86

#: A quote opens a value right after the equals sign only.
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|=(?!\s*["'])|[^>=])*)>|</?[a-zA-Z][^>]*>""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=\s|=|/|$)|display\s*:\s*none""", re.I)
_WORDS = re.compile(r"[A-Za-z]+")
_TOKENS = re.compile(r"[^\s\"']+")
#: Elements whose end only their own end tag marks.
RAW = frozenset("script style textarea title xmp noembed noframes".split())
SKIPPED = RAW | frozenset("head nav header footer aside form menu noscript template svg canvas iframe object select button "
                          "dialog audio video map datalist".split())
BLOCKS = frozenset("address article blockquote body center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
                   "hgroup hr html legend li main ol p pre section summary table tbody tfoot thead tr ul caption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class, id or role that mark an element as no article text.
MARKS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
                  "navigation menu header footer masthead sidebar aside complementary contentinfo cookie cookies consent gdpr "
                  "notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments "
                  "commentlist disqus reply replies related recommended recommendations share sharing social breadcrumb "
                  "breadcrumbs pagination pager search toolbar widget skip".split())
COMMENTS = frozenset("comment comments commentlist disqus reply replies".split())
#: Words before or after a mark by which a class tells what the page has or shows.
BEFORE = frozenset("has no not with without hide show".split())
AFTER = frozenset("open closed on off enabled disabled none".split())
CONTAINERS = frozenset(("html", "body", "main", "article"))
#: Elements whose children count as blocks of one parent.
PARENTS = frozenset("body main article section div td blockquote".split())
#: Elements that can be wrappers of the whole page.
WRAPPERS = PARENTS | {"table", "center"}
GAP = ("", 0, 0, False, False, -1, 0)


def _skips(tag: str, attributes: str) -> int:
    """0: the element stays; 1: it may be a wrapper, what it holds decides; 2: it is skipped."""
    if tag in SKIPPED:
        return 2
    if tag in ("html", "body") or not attributes or attributes.isspace():
        return 0
    if _HIDDEN.search(attributes):
        return 2
    marks, found = COMMENTS if tag in CONTAINERS else MARKS, 0
    for _, value in _NAMES.findall(attributes):
        for token in _TOKENS.findall(value):
            words = [w.lower() for w in _WORDS.findall(token)]
            marked = [w in marks for w in words]
            if not any(marked):
                continue
            first = marked.index(True)
            if not BEFORE.isdisjoint(words[:first]) or not AFTER.isdisjoint(words[first:]):
                continue
            if all(marked) or words[0] in COMMENTS or words[-1] in COMMENTS or tag not in WRAPPERS:
                return 2
            found = 1
    return found


def lines_of(page: str) -> list[tuple[str, int, int, bool, bool, int, int]]:
    """(text, length, length without links, inside an article, inside main, parent, wrapper) per block; a skipped element is a ``GAP``."""
    lines, buffer, linked = [], [], 0
    outer, named = [0], set()  # the wrapper around each wrapper; tags of wrappers besides ``PARENTS``
    at, n = 0, len(page)
    article = main = links = 0
    skipping, depth = "", 0
    parents, born = [("", 0, 0)], 0

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(buffer).split())
        if text:
            lines.append((text, len(text), len(text) if not linked else max(0, len(text.replace(" ", "")) - linked), article > 0, main > 0, *parents[-1][1:]))
        buffer.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        text = references.unescape(text)
        buffer.append(text)
        if links:
            linked += len("".join(text.split()))

    while at < n:
        m = _TAG.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text and not skipping:
            add(text)
        if not m:
            break
        at, end, tag = m.end(), m.group(1), (m.group(2) or "").lower()
        if not tag:
            continue
        if skipping:
            if tag == skipping:
                depth += -1 if end else 1
            # A paragraph ends where the next block begins; a parent's end closes what it holds.
            over = depth <= 0 or (skipping == "p" and tag in BLOCKS) or (end and tag in CONTAINERS)
            if not over:
                continue
            own_end = depth <= 0
            skipping, depth = "", 0
            if own_end:
                continue
        skips = 0 if end else _skips(tag, m.group(3) or "")
        if skips == 2:
            close()
            lines.append(GAP)
            if tag in RAW:
                found = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
                at = found.end() if found else n
            elif tag not in VOID and not (m.group(3) or "").endswith("/"):
                skipping, depth = tag, 1
            continue
        if tag == "br" or tag in ("td", "th"):
            buffer.append(" ")
        elif tag in BLOCKS:
            close()
            links = 0 if tag not in ("li",) else links
        if skips and tag not in PARENTS:
            named.add(tag)
        if tag in PARENTS or tag in named:
            if not end:
                born += 1
                if skips:
                    outer.append(parents[-1][2])
                parents.append((tag, born, len(outer) - 1 if skips else parents[-1][2]))
            elif any(x[0] == tag for x in parents):
                while parents.pop()[0] != tag:
                    pass
        step = -1 if end else 1
        if tag == "article":
            article = max(0, article + step)
        elif tag == "main":
            main = max(0, main + step)
        elif tag == "a":
            links = 0 if end else 1
    close()
    return _without(lines, outer) if len(outer) > 1 else lines


def _without(lines: list, outer: list[int]) -> list:
    """Lines of a wrapper with half of the text or less are gaps."""
    held = next((k for k in (3, 4) if any(x[1] and x[k] for x in lines)), None)
    text, own = [0] * len(outer), [0] * len(outer)
    for x in lines:
        text[x[6]] += x[2]
        own[x[6]] += x[1] if held and x[held] else 0
    for k in range(len(outer) - 1, 0, -1):
        text[outer[k]] += text[k]
        own[outer[k]] += own[k]
    stays = [True]
    for k in range(1, len(outer)):
        stays.append(stays[outer[k]] and 2 * text[k] > text[0] and (not held or 2 * own[k] > own[0]))
    return [x if stays[x[6]] else GAP for x in lines]


def _spaced(lines: list) -> list:
    """Gaps as ``WINDOW`` empty lines each; none between lines of one article, of main or of one parent."""
    out, gap = [], False
    for line in lines:
        if line is GAP:
            gap = True
            continue
        last = out[-1] if out else GAP
        if gap and not (last[5] == line[5] or last[3] and line[3] or last[4] and line[4]):
            out += [GAP] * WINDOW
        gap = False
        out.append(line)
    return out


def main_text(page: str) -> str:
    lines = _spaced(lines_of(page))
    inside = next((k for k in (3, 4) if any(x[1] and x[k] for x in lines)), None)
    lengths = [(x[1] if x[inside] else 0) if inside else x[2] for x in lines]
    sums = [sum(lengths[i:i + WINDOW]) for i in range(len(lines))]
    surge = min(SURGE, max(sums, default=0))
    kept, rise, rose = [], [], False
    for i, total in enumerate([*sums, 0]):
        if total:
            if rise or lengths[i]:  # a rise begins with its first text
                rise.append(i)
            rose = rose or total >= surge
        else:
            if rose:
                kept += rise
            rise, rose = [], False
    return "\n".join(lines[i][0] for i in kept if lines[i][0] and (not inside or lines[i][inside]))


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page in column ``text`` (replaced if there)."""
    kept = pages.drop(text) if text != html else pages.drop(html)
    given = free_name(pages, "_html")
    source = kept.withColumn(given, pages[html])
    place = len(source.columns) - 1
    schema = T.StructType([*kept.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [main_text(x or "") for x in b.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:place], pa.array(done, pa.string())], [*b.schema.names[:place], text])

    return source.mapInArrow(run, schema)


def op7_main_text(spark, folder):
    return extract(table(spark, folder, "pages").select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
