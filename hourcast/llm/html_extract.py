"""Main text of pages by nearest-URL page differencing.

Each page becomes text lines (its blocks), marked by where they stand: inside
what the page itself names its article, inside what it names boilerplate, or
neither.  Pages of a host with equal lines are one content, at the first of
their paths.  Contents are ordered by URL path; each is paired with the
neighbour whose path shares more with its own, their lines are aligned by the
longest common subsequence, and shared lines are deleted.  Lines inside the
named article stay: passages that two articles quote are not boilerplate.  Of
pairs that share nearly all lines that are neither named article nor named
boilerplate (near copies of one page) nothing is deleted.

The order by path is a distributed sort; a page at the edge of a sorted range
finds its neighbour through the ranges' first and last rows.  Only line hashes
are sorted, paired and aligned; deletions go back to the pages.

Defined results: null html is an empty text.  Pages with a null id or URL, and
pages whose content is alone on their host, are not paired.  Every row gives
one row; rows of equal id may differ in URL and html.  Very long pages are processed whole, in
one pass over their tags and in rows of bits over their lines.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

COPY_SHARE = 0.9
BROADCAST_IDS = 1 << 20

_OPEN = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"([^\s=/\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+|[0-9]+", re.I)

# Elements whose content is no text of the page, up to their own end tag; of the first, the
# content is no markup either, and without an end tag they reach to the end of the page.
RAW_TEXT = {"script", "style", "textarea", "title"}
RAW = RAW_TEXT | {"noscript", "template", "iframe", "svg", "math", "object", "canvas", "audio", "video"}
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
          "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
          "var", "wbr", "nobr", "link", "meta"}
CLUTTER_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "head", "fieldset", "datalist"}
CLUTTER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar",
                 "toolbar", "form"}
# Class and id names are clutter if all their words are clutter or companions and one is clutter.
COMPANIONS = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "desktop", "footer", "global", "group", "icons",
    "inner", "item", "items", "left", "link", "links", "list", "main", "mobile", "module", "outer", "page", "panel", "posts", "primary", "right",
    "row", "secondary", "section", "site", "slot", "sticky", "top", "unit", "wrap", "wrapper", "articles", "stories", "links", "media", "thread"}
CLUTTER_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "commentlist", "consent", "cookie", "cookies", "disqus", "dialog", "footer", "form", "gdpr", "header", "login", "masthead",
    "menu", "menus", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pagination", "pager",
    "popup", "promo", "promoted", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing",
    "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "topbar", "trending", "widget",
    "widgets"}
# Inside the article these name its own parts.
OWN_NAMES = {"header", "notice", "notices", "banner"}
MAIN_NAMES = {"article", "articlebody", "entrycontent", "postcontent", "postbody", "maincontent", "storybody"}
OUT, PLAIN, MAIN = 0, 1, 2


def clutter_name(words: list[str], inside: bool) -> bool:
    """Whether the words of a class or id name boilerplate: "site-header" and
    "related-posts" do, "has-sidebar", "share-price" and an article's own "header" don't."""
    names = {w for w in words if not w.isdigit()}
    found = names & CLUTTER_NAMES
    if inside:
        found -= OWN_NAMES
    return bool(found) and names <= CLUTTER_NAMES | COMPANIONS


def tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of the page's tags, comments and declarations
    (these without a name), in one pass: what is looked for in vain once is not looked for
    again.  The content of RAW elements is passed over."""
    at, quoting = 0, True
    lost: set[str] = set()  # quotes and end tags that do not occur again
    while True:
        i = page.find("<", at)
        if i < 0:
            return
        if page.startswith("<!--", i):
            end = page.find("-->", i + 4)
            at = len(page) if end < 0 else end + 3
            yield i, at, "", False, ""
            continue
        if page.startswith("<![CDATA[", i):
            at = i + 9
            yield i, at, "", False, ""
            continue
        m = _OPEN.match(page, i)
        if m is None:
            at = i + 1
            if page[i + 1:i + 2] in ("!", "?"):
                end = page.find(">", i)
                if end < 0:
                    return
                at = end + 1
                yield i, at, "", False, ""
            continue
        pos = m.end()
        while True:
            stop = _STOP.search(page, pos)
            if stop is None:
                break
            q = stop[0]
            if q == ">":
                break
            close = -1 if q in lost or not quoting else page.find(q, stop.end())
            if close < 0:
                lost.add(q)
            pos = stop.end() if close < 0 else close + 1
        if stop is None:
            # No end outside quotes: from here on quotes mean nothing.
            quoting = False
            end = page.find(">", m.end())
            if end < 0:
                return
            at = end + 1
        else:
            at = stop.end()
        name, closing = m[1].lower(), page[i + 1] == "/"
        attributes = page[m.end():at - 1]
        yield i, at, name, closing, attributes
        if name in RAW and not closing and not attributes.endswith("/"):
            end = None if name in lost else _RAW_END[name].search(page, at)
            if end is not None:
                at = end.start()
            elif name in RAW_TEXT:
                yield at, len(page), "", False, ""
                return
            else:
                lost.add(name)


def region(tag: str, attributes: str, inside: bool) -> int | None:
    """The region that an element opens, or None where it keeps its parent's."""
    if tag in ("article", "main"):
        a = attributes.lower() if "comment" in attributes.lower() else ""
        return OUT if a else MAIN
    if tag in CLUTTER_TAGS or tag == "header" and not inside:
        return OUT
    if not attributes or tag in ("html", "body"):
        return None
    for name, v1, v2, v3 in _ATTR.findall(attributes):
        name, value = name.lower(), (v1 or v2 or v3).lower()
        if name == "role":
            if value in CLUTTER_ROLES:
                return OUT
            if value in ("main", "article"):
                return MAIN
        elif name in ("class", "id"):
            for token in value.split():
                words = _NAME.findall(token)
                if "".join(words) in MAIN_NAMES:
                    return MAIN
                if clutter_name(words, inside) and not (inside and tag in INLINE):
                    return OUT
        elif name == "itemprop" and value == "articlebody":
            return MAIN
        elif name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return OUT
    return OUT if re.search(r"(?:^|\s)hidden(?:\s|$)", _ATTR.sub(" ", attributes)) else None


def lines_of(page: str | None) -> list[tuple[int, str]]:
    """(region, text) of each block with text, in page order."""
    out: list[tuple[int, str]] = []
    if not page:
        return out
    stack: list[tuple[str, int]] = []
    here, buffer, at, raw = PLAIN, [], 0, ""

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(buffer).replace("]]>", ""))).strip()
        buffer.clear()
        if text:
            out.append((here, text))

    for start, end, tag, closing, attributes in tags(page):
        if start > at and not (raw and closing and tag == raw):
            buffer.append(page[at:start])
        at = end
        if not tag:
            continue
        if tag in RAW:
            raw = "" if closing or attributes.endswith("/") else tag
            continue
        raw = ""
        if tag not in INLINE:
            flush()
        if tag in VOID:
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if here != stack[i][1] and tag in INLINE:
                        flush()
                    here = stack[i][1]
                    del stack[i:]
                    break
            continue
        opened = region(tag, attributes, here == MAIN)
        if tag in ("article", "main") and opened == MAIN and here == OUT and not any(t in ("article", "main") for t, _ in stack):
            stack.clear()  # an unclosed menu or advert ends where the article begins
        if opened is not None and tag in INLINE:
            flush()
        stack.append((tag, here))
        if opened == OUT or opened == MAIN and here != OUT or opened == MAIN and not stack[:-1]:
            here = opened
    buffer.append(page[at:])
    flush()
    return out


def hashes(lines: list[str]) -> list[int]:
    """A 64-bit hash of each line, the same on every machine."""
    return [int.from_bytes(blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) for x in lines]


def common_subsequence(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``.  The common beginning and
    end are matched as they are; what is between goes by the increasing runs of matching
    positions (Hunt and Szymanski), or by rows of bits where lines repeat so that there are
    many matching pairs."""
    n, m, first, last = len(a), len(b), 0, 0
    while first < min(n, m) and a[first] == b[first]:
        first += 1
    while last < min(n, m) - first and a[n - 1 - last] == b[m - 1 - last]:
        last += 1
    mid_a, mid_b = a[first:n - last], b[first:m - last]
    where: dict[int, list[int]] = {}
    for j, x in enumerate(mid_b):
        where.setdefault(x, []).append(j)
    pairs = sum(len(where.get(x, ())) for x in mid_a)
    inner = by_pairs(mid_a, where) if pairs <= 8 * (len(mid_a) + len(mid_b)) else by_bits(mid_a, where, len(mid_b))
    return [*range(first), *(first + i for i in inner), *range(n - last, n)]


def by_pairs(a: list[int], where: dict[int, list[int]]) -> list[int]:
    tails: list[int] = []
    nodes: list[tuple] = []
    for i, x in enumerate(a):
        for j in reversed(where.get(x, ())):
            k = bisect_left(tails, j)
            node = (i, nodes[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                nodes.append(node)
            else:
                tails[k] = j
                nodes[k] = node
    out, node = [], nodes[-1] if nodes else None
    while node:
        out.append(node[0])
        node = node[1]
    return out[::-1]


def by_bits(a: list[int], where: dict[int, list[int]], m: int) -> list[int]:
    """Bit j of row i is zero where b's line j makes the common subsequence of a's first i lines
    longer.  Every ``step``-th row is kept, and those between are made again on the way back."""
    masks: dict[int, int] = {}
    for x in set(a) & set(where):
        bits = bytearray(m // 8 + 1)
        for j in where[x]:
            bits[j >> 3] |= 1 << (j & 7)
        masks[x] = int.from_bytes(bits, "little")
    full = (1 << m) - 1

    def rows(v: int, lines: list[int]) -> Iterator[int]:
        for x in lines:
            u = v & masks.get(x, 0)
            v = ((v + u) | (v - u)) & full
            yield v

    step = max(1, int(len(a) ** 0.5))
    v, kept = full, []
    for i in range(0, len(a), step):
        kept.append(v)
        for v in rows(v, a[i:i + step]):
            pass
    out, j = [], m
    for block in range(len(kept) - 1, -1, -1):
        lines = a[block * step:(block + 1) * step]
        table = [kept[block], *rows(kept[block], lines)]
        i = len(lines)
        while i and j:
            bit = 1 << (j - 1)
            if table[i] & bit:
                # As long without b's last lines: on to the next that counts.
                j = ((table[i] | -(1 << j)) ^ -1).bit_length()
            elif not table[i - 1] & bit:
                i -= 1
            else:
                i, j = i - 1, j - 1
                out.append(block * step + i)
    return out[::-1]


def neighbours(keys: DataFrame) -> DataFrame:
    """(page_id, mate): the page of the same host with the nearest path; keys
    (page_id, host, path) are sorted in ranges, and ranges joined at their ends."""
    order = ["host", "path", "page_id"]
    k = keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    k = materialise(k, "html-sorted")
    me = F.struct("host", "path", "page_id")
    w = Window.partitionBy("part").orderBy(*order)
    k = k.select("part", *order, F.lag(me).over(w).alias("before"), F.lead(me).over(w).alias("after"))
    ends = materialise(k.groupBy("part").agg(F.min(me).alias("first"), F.max(me).alias("last")), "html-ends")
    w = Window.orderBy("part")  # one row per range
    ends = ends.select("part", F.lag("last").over(w).alias("left"), F.lead("first").over(w).alias("right"))
    k = k.join(F.broadcast(ends), "part")
    before, after = F.coalesce("before", "left"), F.coalesce("after", "right")

    def shared(other):
        # Characters up to the first that differs.
        same = F.zip_with(F.split("path", ""), F.split(other["path"], ""), lambda x, y: x.eqNullSafe(y))
        first = F.array_position(same, False)
        size = F.when(first > 0, first - 1).otherwise(F.size(same))
        return F.when(other["host"] == F.col("host"), size)

    k = k.select("page_id", "host", "path", before.alias("b"), after.alias("a"))
    k = k.withColumn("sb", shared(F.col("b"))).withColumn("sa", shared(F.col("a")))
    mate = F.when(F.col("sb").isNotNull() & (F.col("sa").isNull() | (F.col("sb") >= F.col("sa"))), F.col("b")["page_id"]).when(
        F.col("sa").isNotNull(), F.col("a")["page_id"])
    return k.select("page_id", mate.alias("mate")).filter("mate is not null")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", content: str = "html") -> DataFrame:
    """page_id, url, text of every page."""
    p = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(content).alias("html"))

    def outline(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            lines = [lines_of(x) for x in b["html"]]
            keys = [hashes([t for _, t in x]) for x in lines]
            regions = [bytes(r for r, _ in x) for x in lines]
            digests = [blake2b(f"{h}\0{len(r)}\0".encode("utf-8", "surrogatepass") + r + np.array(k, np.int64).tobytes(), digest_size=16).digest()
                       for h, r, k in zip(b["host"], regions, keys)]
            yield pd.DataFrame({"page_id": b["page_id"], "host": b["host"], "path": b["path"], "hash": b["hash"],
                                "content": digests, "lines": keys, "regions": regions})

    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    p = p.withColumn("host", host).withColumn("hash", F.md5("html"))
    keyed = p.filter("page_id is not null and url is not null").select("page_id", "host", path.alias("path"), "hash", "html")
    lined = materialise(keyed.mapInPandas(
        outline, "page_id long, host string, path string, hash string, content binary, lines array<long>, regions binary"), "html-lines")
    contents = lined.groupBy("host", "content").agg(F.min("path").alias("path"))
    pairs = neighbours(contents.withColumnRenamed("content", "page_id")).withColumnRenamed("page_id", "content")
    one = materialise(lined.select("content", "lines", "regions").dropDuplicates(["content"]), "html-contents")
    other = one.select(F.col("content").alias("mate"), F.col("lines").alias("mate_lines"), F.col("regions").alias("mate_regions"))
    pairs = one.join(pairs, "content").join(other, "mate").select("content", "lines", "regions", "mate_lines", "mate_regions")

    def difference(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, sizes, drops = [], [], []
            for i, lines, regions, mate, mate_regions in zip(b["content"], b["lines"], b["regions"], b["mate_lines"], b["mate_regions"]):
                gone = [j for j in common_subsequence(list(lines), list(mate)) if regions[j] == PLAIN]
                if gone and len(gone) < COPY_SHARE * max(r.count(PLAIN) for r in (regions, mate_regions)):
                    ids.append(i)
                    sizes.append(len(lines))
                    drops.append(gone)
            yield pd.DataFrame({"content": pd.Series(ids, dtype=object), "_lines": np.array(sizes, np.int32), "_drop": pd.Series(drops, dtype=object)})

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= BROADCAST_IDS // 16 else df

    drop = materialise(pairs.mapInPandas(difference, "content binary, _lines int, _drop array<int>"), "html-drop")
    # One row for each page_id, host and html.
    drop = lined.select("page_id", "host", "hash", "content").distinct().join(small(drop), "content").drop("content")
    side = small(materialise(drop, "html-drop"))
    full = p.join(side, ["page_id", "host", "hash"], "left").select("page_id", "url", "html", "_lines", "_drop")

    def main_text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = []
            for page, n, drop in zip(b["html"], b["_lines"], b["_drop"]):
                lines = lines_of(page)
                best = MAIN if any(r == MAIN for r, _ in lines) else PLAIN
                gone = set(drop) if drop is not None and n == len(lines) else ()
                texts.append("\n".join(t for j, (r, t) in enumerate(lines) if r == best and j not in gone))
            yield pd.DataFrame({"page_id": b["page_id"].astype("Int64"), "url": b["url"], "text": texts})

    return full.mapInPandas(main_text, "page_id long, url string, text string")
