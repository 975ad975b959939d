"""Main text of web pages by nearest-URL differencing.

Pages of a host are put in the order of their URL paths, and each is paired with the neighbour
that shares the longer start of the path. The text lines of both are aligned by a longest common
subsequence, and lines of the page that the other has too are deleted: they belong to the site.

Markup settles only what says what it is: scripts, styles, forms, nav, header, footer, aside and
elements whose class or id name says so, whole or by its parts (an advert is another one on each
page, so no comparison finds it); a notice inside an article is part of it until it is shared. All
other lines are compared. Neighbours also share lines of their articles (quotes, the same passage
in two stories), so a shared line inside an article or main element needs more evidence than a pair:
it goes if four pages or more, and at least half of the host's, share it with their own nearest page.
Four pages are two pairs at least, so some of them are not each other's neighbours. A line that is
a page's heading, or repeats its title or a heading, is never deleted there.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

_MARK = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
_VALUE = re.compile(r">|=\s*[\"']")
_ATTR = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements whose content is no markup.
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "canvas", "object"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "dfn", "em", "font", "i", "ins", "del", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
_DROPPED = {"nav", "aside", "footer", "form", "button", "select", "dialog", "menu", "head", *_RAW}
_DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
#: Whole names of classes and ids that say what an element is.
_NAMES = set(
    "ad ads adbox adslot advert adverts advertisement banner breadcrumb breadcrumbs comment comments comment-list cookie cookie-banner cookie-notice "
    "disqus footer masthead menu nav navbar navigation newsletter notice notices pagination popup promo reader-comments replies share-buttons sidebar "
    "skip-link social-links sponsored subscribe toolbar topbar".split()
)
#: Of those, what inside an article can be the article's own.
_OWN_IN_CONTENT = {"notice", "notices"}
#: Last parts of names like site-footer, and first or last parts of names like ad-slot; none after the words of ``_ABOUT``.
_LAST_PARTS = {"breadcrumb", "breadcrumbs", "footer", "masthead", "menu", "nav", "navbar", "navigation", "pagination", "sidebar", "toolbar", "topbar"}
_ANY_PARTS = {"ad", "ads", "adbox", "adslot", "advert", "advertisement", "adverts", "comments", "cookie", "cookies", "disqus", "newsletter", "sponsored"}
_ABOUT = {"has", "hide", "is", "no", "show", "with", "without"}
_NEVER = {"html", "body", "article", "main"}
_CONTENT = {"article", "main"}
#: An open one ends where another of these starts.
_CLOSED_BY = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _attributes(attrs: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}


def _boilerplate(name: str, found: dict[str, str], in_content: bool) -> bool:
    if name in _DROPPED or (name == "header" and not in_content):
        return True
    if not found:
        return False
    if "hidden" in found or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True
    if found.get("role", "").lower() in _DROPPED_ROLES and name not in ("html", "body"):
        return True
    names = set(f"{found.get('class', '')} {found.get('id', '')}".lower().split())
    if name in _NEVER:  # a comment can be an article; a page with a sidebar is still a page
        return name == "article" and bool(names & {"comment", "comments", "reader-comments"})
    if names & (_NAMES - _OWN_IN_CONTENT if in_content else _NAMES) or ("header" in names and not in_content):
        return True
    return any(_by_parts(n, in_content) for n in names)


def _by_parts(name: str, in_content: bool) -> bool:
    """If the parts of a class or id name say that the element is none of the page's text. Parts of the page's frame count
    outside of content only: an article can have a footer or a menu of its own."""
    parts = [p for p in re.split(r"[-_]+", name) if p]
    if len(parts) < 2 or parts[0] in _ABOUT:
        return False
    return parts[0] in _ANY_PARTS or parts[-1] in _ANY_PARTS or (not in_content and parts[-1] in _LAST_PARTS)


def tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, is a closing one, name, attributes) of a page's tags; comments and declarations have no name.
    What is no markup belongs to the tag before it: a script ends where its closing tag does.

    The page is read once from left to right: a tag's end is the first ``>`` outside a quoted value.
    Where a quote is not closed, quotes say nothing from there on; a tag without an end is text.
    """
    at, quotes = 0, True
    while m := _MARK.search(page, at):
        if m[1]:
            end = page.find("-->", m.end())
            end = len(page) if end < 0 else end + 3
            yield m.start(), end, False, "", ""
        else:
            end, i = -1, m.end()
            while quotes and (v := _VALUE.search(page, i)):
                if v[0] == ">":
                    end = v.start()
                    break
                i = page.find(v[0][-1], v.end()) + 1
                quotes = i > 0
            if end < 0:
                quotes, end = False, page.find(">", m.end())
                if end < 0:
                    return
            attrs, end = page[m.end() : end], end + 1
            if m[4] and not m[3] and m[4].lower() in _RAW:
                close = re.compile(rf"</{m[4]}\s*>", re.I).search(page, end)
                end = close.end() if close else len(page)
            yield m.start(), end, bool(m[3]), (m[4] or "").lower(), attrs
        at = end


_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_TITLE = re.compile(r"<title[^>]*>(.*?)(?:</title|$)", re.I | re.S)


def lines_of(page: str) -> list[tuple[str, bool]]:
    """The page's text lines, a block each, without what markup tells to be no content; and if a line
    is inside an explicit content element."""
    return [(text, inside) for text, inside, _ in marked_lines(page)]


def marked_lines(page: str) -> list[tuple[str, bool, bool]]:
    """``lines_of``, and if a line names the page or a part of it: a heading inside content, and anywhere what repeats the
    title, a first heading or, inside content, another heading."""
    out: list[tuple[str, bool, bool]] = []
    titles: set[str] = set()
    headings: set[str] = set()
    parts: list[str] = []
    stack: list[tuple[str, bool, bool, int]] = []  # name, in dropped, in content, last block element at or below it
    places: dict[str, list[int]] = defaultdict(list)  # where in the stack an element of that name is open
    dropped = content = False
    at = 0

    def flush() -> None:
        if parts:
            line = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if line:
                out.append((line, content, False))
                if places["h1"]:
                    titles.add(line)
                elif any(places[h] for h in _HEADINGS):
                    headings.add(line)

    def close(i: int) -> None:
        for name, *_ in stack[i:]:
            places[name].pop()
        del stack[i:]

    for start, end, closing, name, attrs in tags(page):
        if not dropped:
            parts.append(page[at:start])
        at = end
        if not name:
            continue
        if name == "title" and not closing and (m := _TITLE.match(page[start:end])):
            titles.add(" ".join(html.unescape(m[1]).split()))
        if name not in _INLINE and name != "br":
            flush()
        elif name == "br" and not dropped:
            parts.append(" ")
        if closing:
            if places[name]:
                close(places[name][-1])
        elif name not in _VOID and name not in _RAW:
            # an open item ends, if no block element but it is open above it
            ended = max((places[k][-1] for k in _CLOSED_BY.get(name, ()) if places[k]), default=-1)
            if ended >= 0 and ended >= stack[-1][3]:
                close(ended)
            dropped, content, block = stack[-1][1:] if stack else (False, False, 0)
            found = _attributes(attrs) if attrs.strip(" /") else {}
            dropped = dropped or _boilerplate(name, found, content)
            if name not in _INLINE and name != "p":
                block = len(stack)
            places[name].append(len(stack))
            stack.append((name, dropped, content or name in _CONTENT or found.get("role", "").lower() == "main", block))
        dropped, content = stack[-1][1:3] if stack else (False, False)
    if not dropped:
        parts.append(page[at:])
    flush()
    return [(line, inside, line in titles or (inside and line in headings)) for line, inside, _ in out]


def _prefix_lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The length of a longest common subsequence of ``a`` and each leading part of ``b``: a bit per place of ``b``."""
    full = (1 << len(b)) - 1
    held = full
    for x in a:
        mask = held & int.from_bytes(np.packbits(b == x, bitorder="little").tobytes(), "little")
        held = (held + mask | held - mask) & full
    bits = np.unpackbits(np.frombuffer(held.to_bytes(-(-len(b) // 8), "little"), np.uint8), bitorder="little")[: len(b)]
    return np.append(0, np.cumsum(bits == 0))


def common_lines(a: list, b: list, most_pairs: int = 2_000_000) -> list[int]:
    """The places in ``a`` of a longest common subsequence of both.

    Few equal pairs are worked off one by one; beyond ``most_pairs`` (lines that a page repeats
    over and over) ``a`` is halved and ``b`` cut where both parts' subsequences are longest in
    sum, so memory grows with the lines and not with their pairs.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    where: dict = defaultdict(list)
    for j in range(len(b) - tail - 1, head - 1, -1):
        where[b[j]].append(j)
    middle: list[int] = []
    if sum(len(where.get(x, ())) for x in a[head : len(a) - tail]) > most_pairs and len(a) - tail - head > 1:
        number = {x: i for i, x in enumerate(where)}
        x, y = (np.array([number.get(v, -1) for v in s[head : len(s) - tail]]) for s in (a, b))
        half = len(x) // 2
        ahead, back = _prefix_lengths(x[:half], y), _prefix_lengths(x[half:][::-1], y[::-1])[::-1]
        cut = int((ahead + back).argmax())
        left, right = common_lines(x[:half].tolist(), y[:cut].tolist(), most_pairs), common_lines(x[half:].tolist(), y[cut:].tolist(), most_pairs)
        middle = [head + i for i in left] + [head + half + i for i in right]
    else:
        ends: list[int] = []
        links: list[tuple] = []
        for i in range(head, len(a) - tail):
            for j in where.get(a[i], ()):
                k = bisect_left(ends, j)
                link = (i, links[k - 1] if k else None)
                if k == len(ends):
                    ends.append(j)
                    links.append(link)
                else:
                    ends[k], links[k] = j, link
        last = links[-1] if links else None
        while last:
            middle.append(last[0])
            last = last[1]
        middle.reverse()
    return [*range(head), *middle, *range(len(a) - tail, len(a))]


_URL = re.compile(r"^\s*(?:[a-z][a-z0-9+.-]*:)?(?://)?([^/?#]*)([^?#]*)", re.I)
LINES = "row long, page_id long, url string, host string, path string, lines array<struct<text: string, inside: boolean, title: boolean>>"


def extracted(pages: DataFrame) -> DataFrame:
    """Each page's lines, host and path (without query, fragment, ending and last slash)."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("inside", pa.bool_()), ("title", pa.bool_())]))
        for frame in frames:
            split = [_URL.match(u or "") for u in frame["url"].to_pylist()]
            host = [m[1].lower().removeprefix("www.") for m in split]
            path = [re.sub(r"(\.html?|/)+$", "", m[2]) for m in split]
            lines = [[{"text": t, "inside": s, "title": n} for t, s, n in marked_lines(h or "")] for h in frame["html"].to_pylist()]
            columns = [frame["row"], frame["page_id"], frame["url"], pa.array(host, pa.string()), pa.array(path, pa.string()), pa.array(lines, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "page_id", "url", "host", "path", "lines"])

    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, LINES)


def neighbours(rows: DataFrame) -> DataFrame:
    """row, host, path, the 64-bit hashes of the page's lines, which are inside a content element, which are titles, and path and
    hashes of the neighbours in (host, path, page_id, row) order, if of the same host.

    Pages without a line have nothing to compare and are left out of the order. Rows are dealt by
    ranges of that order and the neighbour across a range's edge is looked up, so a host with most
    pages is spread over all tasks and the pairs do not depend on the ranges.
    """
    ids = F.transform("lines", lambda x: F.xxhash64(x["text"]))
    keys = rows.where(F.size("lines") > 0).select("row", "host", "path", "page_id", ids.alias("ids"), F.transform("lines", lambda x: x["inside"]).alias("inside"), F.transform("lines", lambda x: x["title"]).alias("title"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["host", "path", "page_id", "row"]
    dealt = stored(keys.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()))
    item = F.struct("host", "path", "page_id", "row", "ids")
    edges = dealt.groupBy("part").agg(F.min(item).alias("low"), F.max(item).alias("high"))
    parts = Window.orderBy("part")  # a row per range
    edges = edges.select("part", F.lag("high").over(parts).alias("left"), F.lead("low").over(parts).alias("right"))
    own = Window.partitionBy("part").orderBy(*order)
    near = dealt.withColumn("before", F.lag(item).over(own)).withColumn("after", F.lead(item).over(own))
    near = near.join(edges, "part").withColumn("before", F.coalesce("before", "left")).withColumn("after", F.coalesce("after", "right"))
    side = lambda c: F.when(F.col(f"{c}.host") == F.col("host"), F.struct(f"{c}.row", f"{c}.path", f"{c}.ids")).alias(c)
    return near.select("row", "host", "path", "ids", "inside", "title", side("before"), side("after"))


def differences(pairs: DataFrame) -> DataFrame:
    """row, host, other (the row of the page compared, null on a host's only page), the shared lines' places outside
    of content elements, and place and hash of those inside. Titles and headings are compared, but not among these.

    A page that shares all its lines is a copy of its neighbour and not told apart from the site by
    it, and one that shares none is of another kind; then the page's other neighbour is taken, and
    if that is such a one as well, nothing counts as shared.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("place", pa.int32()), ("id", pa.int64())]))
        for frame in frames:
            out: list[tuple] = []
            for r in frame.to_pylist():
                found = [s for s in (r["before"], r["after"]) if s]
                alike = lambda s: next((i for i, (x, y) in enumerate(zip(s["path"], r["path"])) if x != y), min(len(s["path"]), len(r["path"])))
                other, common = None, []
                for s in sorted(found, key=alike, reverse=True):
                    other = s["row"] if other is None else other
                    common = common_lines(r["ids"], s["ids"])
                    if 0 < len(common) < len(r["ids"]):
                        other = s["row"]
                        break
                    common = []
                common = [i for i in common if not r["title"][i]]
                within = [{"place": i, "id": r["ids"][i]} for i in common if r["inside"][i]]
                out.append((r["row"], r["host"], other, [i for i in common if not r["inside"][i]], within))
            types = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int32()), kind]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(types)], ["row", "host", "other", "outside", "within"])

    return pairs.mapInArrow(run, "row long, host string, other long, outside array<int>, within array<struct<place: int, id: long>>")


def deletions(found: DataFrame, least_share: float = 0.5, least_pages: int = 4) -> DataFrame:
    """row and the places of the lines to delete, of the pages that lose any. A line inside content needs ``least_pages`` pages
    that share it, of different pairs then, and ``least_share`` of its host's."""
    pages = found.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    within = found.where(F.size("within") > 0).select("row", "host", F.explode("within").alias("line")).select("row", "host", "line.place", "line.id")
    held = within.select("row", "host", "id").distinct().groupBy("host", "id").agg(F.count(F.lit(1)).alias("n"))
    site = held.join(pages, "host").where((F.col("n") >= least_pages) & (F.col("n") >= least_share * F.col("pages"))).select("host", "id")
    inside = within.join(site, ["host", "id"]).groupBy("row").agg(F.collect_list("place").alias("places"))
    outside = found.where(F.size("outside") > 0).select("row", F.col("outside").alias("places"))
    return outside.unionByName(inside).groupBy("row").agg(F.flatten(F.collect_list("places")).alias("places"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row.

    All lines that markup does not settle are compared with the nearest page of the host. Shared
    ones go; inside article and main they go by the evidence of ``deletions``. Null html gives an
    empty text; a null or odd URL is of the host ''; rows that repeat a page_id stay apart; an
    empty table gives no rows. Blocks are joined by one line feed; nothing else is cut.
    """
    rows = stored(extracted(pages), "zstd")
    gone = stored(deletions(stored(differences(neighbours(rows)))))
    met = rows.join(gone, "row", "left")
    every = F.when(F.size("lines") > 0, F.sequence(F.lit(0), F.size("lines") - 1)).otherwise(F.array().cast("array<int>"))
    left = F.array_except(every, F.coalesce("places", F.array().cast("array<int>")))
    text = F.array_join(F.transform(left, lambda i: F.col("lines")[i]["text"]), "\n")
    return met.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
