"""Main text of web pages by nearest-URL page differencing.

Pages are sorted by host and URL path, so that the neighbours of a page come from the same template; the
one with the longer common path is its partner. Their text lines are aligned by longest common subsequence,
and shared lines are deleted. Differencing decides on pages that declare no article, on lines outside a
declared article, and on lines inside one whose class hints at furniture without proving it. What an article
declared by markup says without such a hint stays, shared or not: articles of one host repeat passages, and
the text of an article is to be kept whole. Lines that elements declare to be furniture (menus, forms,
scripts, notices, comments and so on) go on their own evidence, and so do lines outside a declared article.
A page without an article loses what is declared and what it shares; only where it has no partner to show what is shared
do short lines of links, three or more in a row, count as a menu. Two pages with the same lines throughout are
copies and keep them.

Sort ranges do not show in the result: the pages at their edges are handed to the ranges beside them.
"""

from __future__ import annotations

import html
import itertools
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm.common import pieces_for, table, text_bytes

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: An attribute and its value; a quote that is not closed runs to the end, other values to white space or the tag's end.
ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*|(?=>)))?")
GAP = re.compile(r"[\s/]*")
#: Elements of the HTML standard by their role.
RAW = {"script", "style", "noscript", "template", "title", "textarea", "iframe", "xmp"}
FURNITURE = RAW | {"head", "nav", "aside", "form", "button", "select", "option", "label", "fieldset", "dialog", "menu", "svg", "object", "audio", "video", "canvas", "map"}
EDGE = {"header", "footer"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"}
#: Words in a class, id or role that declare furniture; inside an article only those of a container do.
HINTS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "replies", "sidebar", "signup", "sponsor", "sponsored", "subscribe"}
#: Words that hint at furniture, for differencing to decide; outside an article they declare it.
WEAK = {"complementary", "modal", "pagination", "pager", "popup", "promo", "promotion", "recommended", "related", "search", "share", "sharing", "social", "toolbar", "topbar", "widget"}
CONTAINER = {"div", "section", "aside", "ul", "ol", "dl", "table", "details", "center", "article"}
#: Words that stand beside these in a name without another meaning: only a name made of both declares or hints.
NEUTRAL = {"area", "bar", "block", "body", "bottom", "box", "col", "column", "container", "content", "footer", "group", "header", "holder", "inner", "item", "items", "left", "link", "links", "list", "main", "module", "outer", "page", "panel", "primary", "right", "secondary", "section", "site", "slot", "text", "top", "unit", "wrap", "wrapper"}
#: Bytes of html in a sort range; on a page without a partner so many consecutive lines of links, each of so few words, are a menu.
RANGE_BYTES, LINKS, LINK_WORDS = 4_000_000, 3, 3
SPACE = re.compile(r"\s+")


@dataclass
class Line:
    text: str
    article: bool  # inside a declared article
    furniture: bool  # declared
    hinted: bool  # for differencing to decide
    link: bool  # link text only
    boxed: bool  # hinted by a container, which decides where there is no page to hold against

    @property
    def flags(self) -> int:
        return self.article + 2 * self.furniture + 4 * self.hinted + 8 * self.link + 16 * self.boxed


def named(attributes: dict[str, str]) -> set[str]:
    """Words of HINTS and WEAK that names in class, id or role consist of, beside neutral ones and numbers."""
    out: set[str] = set()
    for k in ("class", "id", "role"):
        for token in attributes.get(k, "").split():
            words = {w for w in re.split(r"[^a-z]+", token) if w}
            if words <= HINTS | WEAK | NEUTRAL:
                out |= words & (HINTS | WEAK)
    return out


def tags(source: str) -> Iterator[tuple[int, int, str, bool, dict[str, str], bool]]:
    """Tags and comments in order: where each begins and ends, its name (empty for comments and declarations), whether it is
    an end tag, its attributes (the first of equal names), and whether a slash of its own ends it.

    One pass forward, as the HTML standard reads them: quotes inside an unquoted value are part of it, and a tag or quote
    that is not closed runs to the end of the page. The receiver may send a place to go on from."""
    at, size = source.find("<"), len(source)
    while at >= 0:
        end, name, closing, attributes, empty = at + 1, "", False, {}, False
        if source.startswith("<!--", at):
            stop = source.find("-->", at + 4)
            end = stop + 3 if stop >= 0 else size
        elif source[at + 1 : at + 2] in ("!", "?"):
            stop = source.find(">", at)
            end = stop + 1 if stop >= 0 else size
        else:
            closing = source[at + 1 : at + 2] == "/"
            m = NAME.match(source, at + 1 + closing)
            if not m:
                at = source.find("<", at + 1)
                continue
            name, here = m[0].lower(), m.end()
            while True:
                gap = GAP.match(source, here)
                if source.startswith(">", gap.end()) or gap.end() == size:
                    end, empty = min(gap.end() + 1, size), gap[0].endswith("/")
                    break
                m = ATTRIBUTE.match(source, here)
                attributes.setdefault(m[1].lower(), (m[2] or "").strip("\"'").lower() if m[2] and m[2][0] in "\"'" else (m[2] or "").lower())
                here = m.end()
        skip = yield at, end, name, closing, attributes, empty
        at = source.find("<", max(end, skip or 0))


@dataclass
class Page:
    host: str
    path: str
    texts: list[str]
    flags: list[int]


class _Open:
    """The open elements: name, furniture, inside an article, hinted, hinted by a container. What is asked of it is kept beside the list, so that no
    tag makes a walk over elements that stay open."""

    def __init__(self):
        self.items: list[tuple[str, bool, bool, bool, bool]] = []
        self.names: Counter[str] = Counter()
        self.blocks: list[int] = []

    @property
    def top(self) -> tuple[str, bool, bool, bool, bool]:
        return self.items[-1] if self.items else ("", False, False, False, False)

    def push(self, item: tuple[str, bool, bool, bool, bool]) -> None:
        if item[0] in BLOCK:
            self.blocks.append(len(self.items))
        self.items.append(item)
        self.names[item[0]] += 1

    def close(self, k: int) -> None:
        """Closes the elements from place k on."""
        for name, *_ in self.items[k:]:
            self.names[name] -= 1
        del self.items[k:]
        while self.blocks and self.blocks[-1] >= k:
            self.blocks.pop()

    def last(self, name: str) -> int | None:
        if not self.names[name]:
            return None
        k = len(self.items) - 1
        while self.items[k][0] != name:
            k -= 1
        return k


def lines(source: str | None) -> list[Line]:
    """Text blocks in page order with what markup says of them; character references decoded, white space as one space.
    Time is linear in the page, however it is broken."""
    out: list[Line] = []
    stack = _Open()
    buffer: list[str] = []
    plain = False  # whether the block has text outside links
    source = source or ""

    def flush() -> None:
        nonlocal plain
        text = SPACE.sub(" ", html.unescape("".join(buffer))).strip()
        buffer.clear()
        if text:
            _, furniture, inside, hinted, boxed = stack.top
            out.append(Line(text, inside, furniture, hinted, not plain, boxed))
        plain = False

    def take(piece: str) -> None:
        nonlocal plain
        buffer.append(piece)
        plain = plain or (not stack.names["a"] and bool(piece.strip()))

    at, skip, scan = 0, None, tags(source)
    while True:
        try:
            begin, end, name, closing, attributes, empty = scan.send(skip)
        except StopIteration:
            break
        skip = None
        take(source[at:begin])
        at = end
        if not name:
            continue
        if name in BLOCK:
            flush()
        elif name == "br":
            buffer.append(" ")
        if closing:
            k = stack.last(name)
            if k is not None:
                if any(s[1] for s in stack.items[k:]):
                    flush()
                stack.close(k)
            continue
        if name in VOID or empty:
            continue
        if name in RAW:
            found = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = skip = found.end() if found else len(source)
            continue
        if name in ("p", "li", "dd", "dt", "tr", "td", "th", "option"):  # elements whose end tag may be left out
            k = len(stack.items) - 1 if stack.top[0] == name else None
            if name == "p" and k is None and stack.blocks and stack.items[stack.blocks[-1]][0] == "p":
                k = stack.blocks[-1]  # a paragraph also closes one that inline elements left open
            if k is not None:
                stack.close(k)
        _, gone, inside, hinted, boxed = stack.top
        marked = named(attributes) if attributes else set()
        furniture = name in FURNITURE or (name in EDGE and (not inside or name == "footer")) or "hidden" in attributes or attributes.get("aria-hidden") == "true"
        if name == "article":
            furniture = furniture or bool(marked & {"comment", "comments", "replies", "related", "recommended", "sponsored"})
        elif name not in ("html", "body", "main"):
            furniture = furniture or ((name in CONTAINER or not inside) and bool(marked & HINTS))
            hinted = hinted or bool(marked)
            boxed = boxed or (inside and name in CONTAINER and bool(marked & WEAK))
        if furniture and not gone and name not in BLOCK:
            flush()
        inside = inside or name in ("article", "main") or attributes.get("role") in ("main", "article")
        stack.push((name, gone or furniture, inside, hinted, boxed))
    take(source[at:])
    flush()
    return out


def _prefix_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Lengths of the longest common subsequences of a and b[:j] for j = 0..len(b), a bit for each place of b."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    whole = (1 << len(b)) - 1
    v = whole
    for x in a:
        u = v & places.get(x, 0)
        if u:
            v = ((v + u) | (v - u)) & whole
    bits = np.unpackbits(np.frombuffer(v.to_bytes(-(-len(b) // 8) or 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.r_[0, np.cumsum(bits == 0)]


def _aligned(a: list[int], b: list[int], at: int, out: set[int]) -> None:
    """Adds to out at + the places in a of a longest common subsequence, in memory linear in the lines: halves of a
    meet where the lengths on both sides add up to the most."""
    if not a or not b:
        return
    if len(a) * len(b) <= 4096:
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
        i = j = 0
        while i < len(a) and j < len(b):
            if a[i] == b[j]:
                out.add(at + i)
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
        return
    if len(a) == 1:
        if a[0] in b:
            out.add(at)
        return
    half = len(a) // 2
    cut = int((_prefix_lengths(a[:half], b) + _prefix_lengths(a[half:][::-1], b[::-1])[::-1]).argmax())
    _aligned(a[:half], b[:cut], at, out)
    _aligned(a[half:], b[cut:], at + half, out)


def common(a: list[str], b: list[str]) -> set[int]:
    """Places in a of a longest common subsequence of lines."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    out = {*range(head), *range(len(a) - tail, len(a))}
    # Lines that the other page lacks cannot be aligned.
    x, y = range(head, len(a) - tail), range(head, len(b) - tail)
    has_a, has_b = {a[i] for i in x}, {b[j] for j in y}
    x, y = [i for i in x if a[i] in has_b], [j for j in y if b[j] in has_a]
    number = {t: k for k, t in enumerate(has_a & has_b)}
    found: set[int] = set()
    _aligned([number[a[i]] for i in x], [number[b[j]] for j in y], 0, found)
    return out | {x[k] for k in found}


def shared_path(a: Page, b: Page | None) -> int:
    """Length of the common path; -1 on another host."""
    if b is None or a.host != b.host:
        return -1
    n = 0
    for x, y in zip(a.path, b.path, strict=False):
        if x != y:
            break
        n += 1
    return n


def main_text(own: Page, before: Page | None, after: Page | None) -> tuple[str, int]:
    """The text, and how many lines differencing has deleted."""
    # A copy of the page cannot tell its text from its template; the other neighbour may.
    others = [p for p in (before, after) if shared_path(own, p) >= 0 and p.texts != own.texts]
    partner = max(others, key=lambda p: shared_path(own, p), default=None)
    shared = common(own.texts, partner.texts) if partner else set()
    if len(shared) == len(own.texts):
        partner, shared = None, set()
    declared = any(f & 1 and not f & 2 for f in own.flags)
    menu: set[int] = set()
    run: list[int] = []
    for k, f in enumerate([*own.flags, 0]):
        if f & 8:
            run.append(k)
        else:
            short = not partner and len(run) >= LINKS and all(own.texts[j].count(" ") < LINK_WORDS for j in run)
            menu |= set(run) if short else set()
            run = []
    kept, deleted = [], 0
    for k, (text, f) in enumerate(zip(own.texts, own.flags, strict=True)):
        article, furniture, hinted = f & 1, f & 2, f & 4
        gone = k in shared and (not article or bool(hinted) or bool(furniture))
        deleted += gone
        gone = gone or (not partner and bool(f & 16))
        if not gone and not furniture and (article or (not declared and k not in menu)):
            kept.append(text)
    return "\n".join(kept), deleted


def _split(url: str | None) -> tuple[str, str]:
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)", url or "")
    return (m[1].lower(), m[2]) if m else ("", url or "")


def _key(url: str | None, page_id: int | None, digest: int) -> tuple:
    host, path = _split(url)
    return host, path, url is not None, url or "", page_id is not None, page_id or 0, digest


PARSED = "range int, guest boolean, page_id bigint, url string, host string, path string, digest bigint, texts array<string>, flags array<int>"
PLACED = "range int, host string, path string, has_url boolean, url string, has_id boolean, page_id bigint, digest bigint"
OUT = "page_id bigint, url string, text string, n_shared bigint"
KINDS = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32())}


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[t]) for c, t in zip(cols, types, strict=True)], names=list(names))


def _place(bounds: list[tuple]):
    """The sort range of each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_key(*r) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield _table([(bisect_right(bounds, k), *k) for k in keys], PLACED)

    return run


def _parse(bounds: list[tuple], guests: dict[tuple, list[int]]):
    """Lines of each page for its own sort range, and as a guest for those whose edge it stands beside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                rows = []
                for url, page_id, digest, source in zip(*(c.to_pylist() for c in batch.slice(k, 256).columns), strict=True):
                    key, found = _key(url, page_id, digest), lines(source)
                    page = (page_id, url, key[0], key[1], digest, [x.text for x in found], [x.flags for x in found])
                    rows.append((bisect_right(bounds, key), False, *page))
                    rows += [(other, True, *page) for other in guests.get(key, ())]
                yield _table(rows, PARSED)

    return run


def _differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by range and key; each page sees its neighbours in the range, guests included."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                for n, guest, page_id, url, host, path, texts, flags in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    yield n, guest, page_id, url, Page(host, path, texts, flags)

    before, now, out = None, None, []
    for after in itertools.chain(rows(), [None]):
        if now is not None and not now[1]:
            sides = [x[4] if x is not None and x[0] == now[0] else None for x in (before, after)]
            out.append((now[2], now[3], *main_text(now[4], *sides)))
        before, now = now, after
        if len(out) >= 512:
            yield _table(out, OUT)
            out = []
    yield _table(out, OUT)


def _bounds(keys: DataFrame, ranges: int, each: int = 32) -> list[tuple]:
    """Keys that cut the pages into about equal ranges, from about `each` keys a range, those of certain hashes.

    They only say where a page is worked on."""
    if ranges < 2:
        return []
    step = max(1, keys.count() // (each * ranges))
    some = sorted(_key(*r) for r in keys.where(F.pmod(F.xxhash64("digest"), F.lit(step)) == 0).collect())
    return sorted({some[len(some) * k // ranges] for k in range(1, ranges)}) if some else []


def _guests(keys: DataFrame, bounds: list[tuple]) -> dict[tuple, list[int]]:
    """Key -> ranges that the page at the edge of its own range stands beside; ranges without pages are passed over."""
    if not bounds:
        return {}
    key = F.struct(*[c.split()[0] for c in PLACED.split(", ")[1:]])
    found = keys.mapInArrow(_place(bounds), PLACED).groupBy("range").agg(F.min(key).alias("first"), F.max(key).alias("last")).collect()
    found.sort(key=lambda r: r["range"])
    out: dict[tuple, list[int]] = {}
    for a, b in itertools.pairwise(found):
        out.setdefault(tuple(a["last"]), []).append(b["range"])
        out.setdefault(tuple(b["first"]), []).append(a["range"])
    return out


def extract(pages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """page_id, url, text, n_chars, n_shared of each page; n_shared: the lines that differencing deleted.

    A null or empty html has an empty text; null urls form one host; repeated rows are each other's
    partners and, being copies, lose nothing to each other; a page alone on its host has no partner; of two
    neighbours with paths equally close the one before counts; an empty table gives no rows. A page of any
    number of lines is aligned in memory linear in them. Other columns are not read. A host with a third of
    all pages spreads over many sort ranges, whose number follows the bytes of html and does not show in
    the result. The parsed pages are shuffled once. Keys of pages, about 35 for each `range_bytes` of html, reach
    the driver.
    """
    rows = pages.select("url", F.col("page_id").cast("long").alias("page_id"), F.xxhash64("page_id", "url", "html").alias("digest"), "html")
    keys = rows.select("url", "page_id", "digest")
    ranges = pieces_for(text_bytes(rows, "html"), range_bytes, 1)
    bounds = _bounds(keys, ranges)
    parsed = rows.mapInArrow(_parse(bounds, _guests(keys, bounds)), PARSED)
    ordered = parsed.repartition(ranges, "range").sortWithinPartitions("range", "host", "path", F.col("url").asc_nulls_first(), F.col("page_id").asc_nulls_first(), "digest")
    found = ordered.select("range", "guest", "page_id", "url", "host", "path", "texts", "flags").mapInArrow(_differenced, OUT)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main texts of all pages."""
    return extract(table(spark, sf_dir, "pages"))
