"""Main text of web pages by differencing against the nearest page of the same host.

Pages of a host are put in order of their URL path. A page's partner is the
neighbour (before or after) that shares the longer start of the path. The
text lines (blocks) of both are aligned by longest common subsequence, and
lines they share are deleted: what a site repeats is not the article. A
partner that shares more than ``COPY_SHARE`` of the lines may be a copy; then
only lines that the other neighbour shares as well are deleted.

Differencing alone is wrong in two ways, which the markup mends. Two articles
may quote one passage: a line inside ``article`` or ``main`` that is not mostly
link text is sure text and stays. And a site's menu, advert or footer may differ
from page to page: menus, headers, footers, sidebars, notices, adverts, forms,
scripts and reader comments known by their elements, roles and class names go
even where no neighbour repeats them. Where a page marks its main part, only
lines inside it stay. Every other line is doubtful, and differencing decides it.
A page all of whose remaining lines are shared (a copy under a second URL) keeps
them.

The html is parsed once, where it is read. Pages are counted by (host, path,
content) first, which cuts that order into at most ``RANGES`` ranges of like
size; the lines that may stay, and the hashes of all lines, are shuffled by
range, sorted there and differenced in passing. The first and last page of a
range also go to the range beside it, as hashes. Equal rows (same url and html)
are one page; one with more copies than a range has rows is differenced once,
and its copies are given the text by a salted join.

Null html: empty text. Null url: host and path are empty, such pages are a
host of their own. Malformed markup is read leniently. Repeated ids and rows,
very long pages, extra columns with any names and empty tables are fine.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.running import range_bases
from cadastra.llm.url_filter import split_url
from cadastra.operators.materialize import materialize

#: ranges of the order of all pages: two pages of each, without their text, are known to every task
RANGES = 16384
#: pages of a range, at least
RANGE_ROWS = 1024
#: a partner that shares more of a page's lines is asked together with the other neighbour
COPY_SHARE = 0.8
#: tasks that give the copies of one page its text
SALTS = 16
#: characters of text in one batch out
OUT_CHARS = 1 << 22
#: pages parsed at a time
SLICE = 256

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([A-Za-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_RAW = {n: re.compile(rf"</{n}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I)
        for n in ("script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes", "svg", "math", "select", "object")}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# elements that end a line of text
_BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
          "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
          "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody",
          "td", "tfoot", "th", "thead", "tr", "ul"}
# elements and roles that are never part of the main text
_AWAY = {"head", "nav", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "input", "label", "audio", "video", "canvas"}
_AWAY_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog",
               "alert", "alertdialog", "toolbar", "status"}
# words in class names and ids of what is not main text
_AWAY_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
               "comments", "commentlist", "respond", "cookie", "cookies", "consent", "gdpr", "disclaimer", "footer", "header", "masthead",
               "menu", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "alert", "popup", "modal",
               "overlay", "promo", "promoted", "promotion", "related", "recommended", "share", "sharing", "sidebar", "social",
               "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget", "pagination", "pager", "skip", "login",
               "signup", "disqus", "paywall", "toc", "copyright"}
_CLOSES_P = _BLOCK - {"html", "body", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "summary"}
# elements whose end tag may be omitted: what they close when they start, and inside which element
_CELL = {"td", "th", "caption"}
_ROW = _CELL | {"tr"}
_LIST = _BLOCK - {"address", "div", "p", "li", "dd", "dt"}
_CLOSES = {"li": ({"li"}, _LIST), "dd": ({"dd", "dt"}, _LIST), "dt": ({"dd", "dt"}, _LIST),
           "td": (_CELL, {"table"}), "th": (_CELL, {"table"}), "tr": (_ROW, {"table"}),
           **dict.fromkeys(("tbody", "thead", "tfoot"), (_ROW | {"tbody", "thead", "tfoot"}, {"table"}))}
_P_WITHIN = {"html", "table", "td", "th", "caption", "button"}


def _words(value: str) -> set[str]:
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", value)
    return set(re.split(r"[^a-z0-9]+", spaced.lower()))


def lines(page: str | None) -> list[tuple[str, str, float]]:
    """``(text, place, link share)`` of every text block; place: ``main``, ``away`` or ``body``."""
    out: list[tuple[str, str, float]] = []
    if not page:
        return out
    stack: list[tuple[str, str]] = []  # open elements that matter, with the place inside them
    place, text, linked, in_link = "body", [], 0, 0

    def flush():
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            out.append((joined, place, min(1.0, linked / len(joined))))
        text.clear()
        linked = 0

    def end_open(names: set[str], within: set[str]):
        """Closes the open elements of these names that no element of ``within`` stands above."""
        nonlocal place
        low = None
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                low = i
            elif stack[i][0] in within:
                break
        if low is not None:
            del stack[low:]
            place = stack[-1][1] if stack else "body"

    def add(raw: str):
        nonlocal linked
        if raw:
            s = html.unescape(raw)
            text.append(s)
            if in_link:
                linked += len(" ".join(s.split()))

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            tail = page[at:]
            add(tail)
            break
        add(page[at : m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            if m.group().startswith("<![CDATA["):
                text.append(m.group()[9:].removesuffix("]]>"))
            continue
        name, closing = name.lower(), bool(m.group(1))
        if not closing and name in _RAW:
            stop = _RAW[name].search(page, at)
            at = stop.end() if stop else end
            continue
        if name == "br":
            text.append(" ")
            continue
        if name == "a":
            in_link = 0 if closing else 1
            continue
        if name in _BLOCK:
            flush()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if name not in _BLOCK and stack[i][1] != (stack[i - 1][1] if i else "body"):
                        flush()
                    del stack[i:]
                    place = stack[-1][1] if stack else "body"
                    break
            continue
        if name in _CLOSES:  # an end tag that was omitted
            end_open(*_CLOSES[name])
        if name in _CLOSES_P or name in ("li", "dd", "dt", "summary"):
            end_open({"p"}, _P_WITHIN)
        if name in _VOID or m.group(3).rstrip().endswith("/"):
            continue
        if name == "body":  # whatever the head left open ends here
            stack.clear()
            place = "body"
        attrs = {a.lower(): (b or c or d) for a, b, c, d in _ATTR.findall(m.group(3))} if m.group(3).strip() else {}
        bare = [w for w in re.split(r"[\s]+", _ATTR.sub(" ", m.group(3)).lower()) if w]
        role = (attrs.get("role") or "").lower()
        marked = _words(attrs.get("class", "") + " " + attrs.get("id", ""))
        hidden = "hidden" in bare or attrs.get("aria-hidden") == "true" or re.search(
            r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""))
        inside = place
        if place != "away":
            if (name in _AWAY or (name == "header" and place != "main") or role in _AWAY_ROLES or hidden
                    or (marked & _AWAY_WORDS and name not in ("html", "body", "article", "main"))
                    or (name == "article" and marked & {"comment", "comments", "related", "promo", "ad"})):
                inside = "away"
            elif name in ("article", "main") or role in ("main", "article") or attrs.get("itemprop") == "articleBody":
                inside = "main"
        if inside != place or name in _BLOCK:
            if inside != place and name not in _BLOCK:
                flush()
            stack.append((name, inside))
            place = inside
    flush()
    return out


# ---- alignment -----------------------------------------------------------------------------


def common(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Positions in ``a`` of one longest common subsequence with ``b``."""
    n, m = len(a), len(b)
    head = 0
    while head < min(n, m) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(n, m) - head and a[n - 1 - tail] == b[m - 1 - tail]:
        tail += 1
    a_, b_ = a[head : n - tail], b[head : m - tail]
    here = np.isin(a_, b_)
    inner = np.flatnonzero(here) + head
    b_ = b_[np.isin(b_, a_)]
    x = a[inner]
    mid: list[int] = [int(inner[i]) for i in _lcs(x, b_)]
    return [*range(head), *mid, *range(n - tail, n)]


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """LCS lengths of ``a`` with every start of ``b``."""
    row = np.zeros(len(b) + 1, np.int64)
    for v in a:
        best = row.copy()
        best[1:] = np.maximum(best[1:], row[:-1] + (b == v))
        row = np.maximum.accumulate(best)
    return row


def _lcs(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Divide and conquer: memory grows with the lines, not with their product."""
    if len(a) == 0 or len(b) == 0:
        return []
    if len(a) == 1:
        return [0] if a[0] in b else []
    half = len(a) // 2
    left = _lengths(a[:half], b)
    right = _lengths(a[half:][::-1], b[::-1])[::-1]
    cut = int(np.argmax(left + right))
    return _lcs(a[:half], b[:cut]) + [half + i for i in _lcs(a[half:], b[cut:])]


# ---- what the markup and the partners say ----------------------------------------------------

# kinds of lines: sure text; kept unless shared; link text of a page without main part; gone in any case
SURE, DOUBTFUL, LINKS, GONE = "sdlx"


def kinds(found: list[tuple[str, str, float]]) -> str:
    """One letter for every line of a page."""
    marked = any(place == "main" for _, place, _ in found)
    out = []
    for _, place, link in found:
        if place != ("main" if marked else "body"):
            out.append(GONE)
        elif marked:
            out.append(DOUBTFUL if link > 0.5 else SURE)
        else:
            out.append(LINKS if link > 0.5 else DOUBTFUL)
    return "".join(out)


def keep(kind: str, wanted: list[str], shared: set[int]) -> str:
    """The text: ``wanted`` holds the lines whose kind is not GONE."""
    places = [(i, k) for i, k in enumerate(kind) if k != GONE]
    kept = [t for (i, k), t in zip(places, wanted) if k == SURE or (k == DOUBTFUL and i not in shared)]
    return "\n".join(kept or wanted)


def main_text(page: str | None, shared: set[int]) -> str:
    """Main text of one page, given the numbers of the lines its partner shares."""
    found = lines(page)
    kind = kinds(found)
    return keep(kind, [t for (t, _, _), k in zip(found, kind) if k != GONE], shared)


def _shared_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def shared_lines(path: str, own: np.ndarray, before: tuple[str, np.ndarray] | None,
                 after: tuple[str, np.ndarray] | None) -> set[int]:
    """Numbers of the lines to delete, given the (path, line hashes) of the neighbours on the host."""
    near = [p for p in (before, after) if p is not None]
    if not near or not len(own):
        return set()
    near.sort(key=lambda p: -_shared_start(path, p[0]))  # of two alike the one before is first
    drop = set(common(own, near[0][1]))
    if len(near) == 2 and len(drop) > COPY_SHARE * len(own):
        drop &= set(common(own, near[1][1]))
    return drop


# ---- the operator ---------------------------------------------------------------------------


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


_PARSED = "url string, host string, path string, key binary, whole boolean, range int, hashes array<long>, kinds string, text string"
_COUNTS = ["n_shared_lines", "n_deleted_lines", "n_decided_lines"]


def _parse(ranges: list[tuple[tuple[str, str, bytes], tuple[str, str, bytes]]]):
    """Parses pages (page_id, url, host, path, key, whole, html) and deals them to their ranges."""
    lows = [low for low, _ in ranges]
    guests: dict[bytes, list[int]] = {}  # edge pages that the range beside must know
    for r in range(1, len(ranges)):
        last, first = ranges[r - 1][1], ranges[r][0]
        if last[0] == first[0]:
            guests.setdefault(last[2], []).append(r)
            guests.setdefault(first[2], []).append(r - 1)

    def parse(batches) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            url, host, path, key, whole = (batch.column(i).to_pylist() for i in range(1, 6))
            at, hashes, kind, text, guest = [], [], [], [], []
            for i, page in enumerate(batch.column(6)):
                found = lines(page.as_py())
                k = kinds(found)
                at.append(bisect_right(lows, (host[i], path[i], key[i])) - 1)
                hashes.append([_hash(t) for t, _, _ in found])
                kind.append(k)
                text.append("\n".join(t for (t, _, _), x in zip(found, k) if x != GONE))
                if key[i] in guests and key[i] not in sent:
                    sent.add(key[i])
                    guest += [(i, r) for r in guests[key[i]]]
            extra = [i for i, _ in guest]
            ids = pa.concat_arrays([batch.column(0), pa.nulls(len(extra), batch.column(0).type)])
            yield pa.RecordBatch.from_arrays([
                ids, *(pa.array(v + [v[i] for i in extra], t) for v, t in
                       ((url, pa.string()), (host, pa.string()), (path, pa.string()), (key, pa.binary()))),
                pa.array(whole + [None] * len(extra), pa.bool_()),
                pa.array(at + [r for _, r in guest], pa.int32()),
                pa.array(hashes + [hashes[i] for i in extra], pa.list_(pa.int64())),
                pa.array(kind + [None] * len(extra), pa.string()),
                pa.array(text + [None] * len(extra), pa.string()),
            ], names=["page_id", "url", "host", "path", "key", "whole", "range", "hashes", "kinds", "text"])

    return parse


def _runs(batches) -> Iterator[dict]:
    """Equal neighbours in the order as one page: its rows' ids, or none for the page of another range."""
    run = None
    for batch in batches:
        ids = batch.column(0)
        url, host, path, key, whole, at, hashes, kind, text = (batch.column(i) for i in range(1, 10))
        for i in range(batch.num_rows):
            k, r = key[i].as_py(), at[i].as_py()
            if run is None or run["key"] != k or run["range"] != r:
                if run is not None:
                    yield run
                run = {"key": k, "range": r, "url": url[i].as_py(), "host": host[i].as_py(), "path": path[i].as_py(),
                       "hashes": np.array(hashes[i].values.to_numpy(zero_copy_only=False), np.int64),
                       "kinds": kind[i].as_py(), "text": text[i].as_py(), "rows": []}
            if whole[i].as_py() is not None:  # no guest
                run["rows"].append((ids[i], whole[i].as_py()))
    if run is not None:
        yield run


def _difference(batches) -> Iterator[pa.RecordBatch]:
    """Pages in order in; page_id, url, key, whole, text and line counts of the rows out."""
    names = ["page_id", "url", "key", "whole", "text", *_COUNTS]
    types = [pa.string(), pa.binary(), pa.bool_(), pa.string(), *[pa.int32()] * len(_COUNTS)]
    out: list[list] = [[] for _ in names]
    chars = 0

    def made():
        ids = pa.array([x.as_py() for x in out[0]], out[0][0].type)
        return pa.RecordBatch.from_arrays([ids, *(pa.array(v, t) for v, t in zip(out[1:], types))], names=names)

    def beside(page, other):
        same = other is not None and other["range"] == page["range"] and other["host"] == page["host"]
        return (other["path"], other["hashes"]) if same else None

    before, page = None, None
    for after in _with_end(_runs(batches)):
        if page is not None and page["rows"]:
            drop = shared_lines(page["path"], page["hashes"], beside(page, before), beside(page, after))
            k = page["kinds"]
            text = keep(k, page["text"].split("\n") if page["text"] else [], drop)
            counts = (len(drop), sum(k[i] != SURE for i in drop), sum(k[i] == DOUBTFUL for i in drop))
            for row, whole in page["rows"]:
                for column, v in zip(out, (row, page["url"], page["key"], whole, text, *counts)):
                    column.append(v)
                chars += len(text) + 64
                if chars > OUT_CHARS:
                    yield made()
                    out, chars = [[] for _ in names], 0
        before, page = page, after
    if out[0]:
        yield made()


def _with_end(runs):
    yield from runs
    yield None


def _ranges(pages: DataFrame) -> tuple[list, DataFrame | None]:
    """(first and last (host, path, key) of every range, in order; pages with more copies than a range has rows)."""
    order = ["host", "path", "key"]
    sizes = pages.groupBy(*order).agg(F.count(F.lit(1)).alias("n"))
    sizes = materialize(sizes.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    width = max(RANGE_ROWS, -(-total // RANGES))
    weighed = sizes.withColumn("w", F.when(F.col("n") > width, 1).otherwise(F.col("n")))
    bases = range_bases(weighed.groupBy("part").agg(F.sum("w").alias("w")), "part", "w")
    upto = F.sum("w").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    at = F.floor((F.col("base") + F.coalesce("upto", F.lit(0))) / width)
    edges = weighed.withColumn("upto", upto).join(bases, "part").groupBy(at.alias("r")).agg(
        F.min(F.struct(*order)).alias("low"), F.max(F.struct(*order)).alias("high")).collect()  # at most RANGES + 1 rows

    def triple(x):
        return x["host"], x["path"], bytes(x["key"])

    ranges = [(triple(e["low"]), triple(e["high"])) for e in sorted(edges, key=lambda e: e["r"])]
    copied = sizes.where(F.col("n") > width).select("key")  # at most total / width <= RANGES rows
    return ranges, copied if copied.take(1) else None


def _content_key() -> Column:
    """Rows that agree in url and html are one page."""
    url = F.concat(F.when(F.col("url").isNull(), "0").otherwise("1"), F.coalesce("url", F.lit("")))
    return F.unhex(F.sha1(F.concat(F.sha1(F.coalesce("html", F.lit(""))), url)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, and the page's shared lines of every row.

    ``n_shared_lines`` counts the lines that the partner shares, ``n_deleted_lines`` those of them that
    are not sure text, ``n_decided_lines`` those that the markup alone would have kept.
    """
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))
    host, path = split_url(F.col("url"))
    src = src.select("page_id", "url", host.alias("host"), path.alias("path"), _content_key().alias("key"),
                     F.lit(True).alias("whole"), "html")
    ranges, copied = _ranges(src.select("host", "path", "key"))
    rest = src
    if copied is not None:
        one = src.join(F.broadcast(copied), "key", "left_semi").groupBy("key").agg(
            *[F.first(c).alias(c) for c in ("page_id", "url", "host", "path", "html")])
        rest = src.join(F.broadcast(copied), "key", "left_anti").select(src.columns).unionByName(
            one.withColumn("whole", F.lit(False)))
    page_id = f"page_id {src.schema['page_id'].dataType.simpleString()}"
    dealt = rest.mapInArrow(_parse(ranges), f"{page_id}, {_PARSED}")
    done = dealt.repartition("range").sortWithinPartitions("range", "host", "path", "key").mapInArrow(
        _difference, f"{page_id}, url string, key binary, whole boolean, text string, " + ", ".join(f"{c} int" for c in _COUNTS))
    out = ["page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), *_COUNTS]
    if copied is None:
        return done.select(out)
    done = materialize(done)
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    copies = src.select("page_id", "url", "key").join(F.broadcast(copied), "key", "left_semi").withColumn("salt", salt)
    texts = done.where("NOT whole").select("key", "text", *_COUNTS, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return done.where("whole").select(out).unionByName(copies.join(texts, ["key", "salt"]).select(out))
