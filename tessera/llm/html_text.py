"""Main text of web pages: markup roles first, then a host suffix array over what markup leaves open.

A page is cut into blocks.  Markup settles most of them: blocks of an article or main element are the text;
blocks of menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles are not.
On a page without an article or main element, the blocks that markup leaves open are judged by their host:
the token streams of its pages are concatenated, a suffix array finds the substrings of at least ``LONG``
tokens that repeat across distinct pages, and the tokens they cover are boilerplate; unique runs stay.

A class, id or role that names such a part drops an element (within an article only if its whole name does), but not the page's text in it: a main element counts wherever
no markup role drops it, an article also below a layout's name (``content-sidebar-wrap``, ``no-sidebar``), and below any other
name if the page has no text in an article or main element elsewhere (else it is a teaser in a list of related ones).

Where a page has an article, what lies outside it is not main text, and what lies inside is not put to the
suffix array: hosts carry copies of whole articles and shared passages, which it would take for boilerplate.  A host's pages are dealt into parts of
at most about ``PART_PAGES`` by a hash, so a host of any size is worked on in parts.  What repeats across the parts is found by the
hashes of all runs of ``LONG`` tokens: a token lies in a repeated substring exactly if it lies in such a run that another page holds.

Defined results.  A null or empty page has the text "".  Repeated rows (same page_id) give one row each and
are one page to the suffix array.  A null url is a host of its own.  Extra columns are not looked at; an
empty table gives an empty result.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded, by_key, long_grams, sorted_groups, written

LONG = 8
PART_PAGES = 2000
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|=\s*[^\s>\"'][^\s>]*|[^>])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
RAW = {"script", "style", "noscript", "template", "textarea", "svg", "math", "iframe", "object", "title"}
DROPPED = RAW | {"nav", "header", "footer", "aside", "form", "menu", "select", "button", "dialog", "head"}
MAIN = {"article", "main"}
HINTS = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
                  "cookies disclaimer footer gdpr header masthead menu modal nav navbar navigation newsletter notice popup promo "
                  "related share sharing sidebar social sponsor sponsored subscribe widget".split())
#: Words that make a class name with a hint the name of a layout, not of a part.
LAYOUT = frozenset("no has with without wrap wrapper container content layout".split())
#: Words that make a hint's name the name of a part that holds it (``share-buttons``): within an article the whole name must be such words.
PARTS = LAYOUT | frozenset("area bar block blocks body box button buttons card feed form group header heading inner item items label line link links "
                           "list message outer panel post posts section signup slot stories story strip text title top bottom unit zone".split())
ANCHORED = {"h1", "h2", "h3", "h4", "h5", "h6", "p"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
          "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
KEEP, OPEN, SPARE = 1, 0, 2
#: Why an element is dropped, weakest first; a main or an article in it may count after all but below a role.
BY_LAYOUT, BY_NAME, BY_ROLE = 1, 2, 3


def hinted(attributes: str, element: str, inside: bool) -> int:
    """Whether class, id or role names a part that isn't main text, and how: BY_NAME, BY_LAYOUT or 0.

    Within an article (``inside``) such a word alone says little (``related-work``, ``ad-hoc``): there a name counts if all its words
    name a part, and neither inline elements nor the ids of headings and paragraphs, which are places to link to, count.
    """
    found = 0
    if inside and element in INLINE:
        return found
    for key, v in ATTRIBUTE.findall(attributes):
        if key.lower() not in ("class", "id", "role") or inside and key.lower() == "id" and element in ANCHORED:
            continue
        for name in v.strip("\"'").lower().split():
            words = [w for w in re.split(r"[^a-z]+", name) if w]
            if HINTS.intersection(words) and (not inside or all(w in HINTS or w in PARTS for w in words)):
                found = max(found, BY_LAYOUT if LAYOUT.intersection(words) else BY_NAME)
    return found


def blocks(page: str) -> list[tuple[int, str]]:
    """(role, text) of the blocks of a page that markup doesn't drop, in order: KEEP in an article, else OPEN."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int, int]] = []  # name, why dropped or 0, KEEP or SPARE in a main part
    text: list[str] = []

    def flush() -> None:
        if text:
            t = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if t:
                out.append((stack[-1][2] if stack else OPEN, t))

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at and not (stack and stack[-1][1]):
            text.append(page[at:stop])
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name not in INLINE:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if name in INLINE and any(x[0] not in INLINE for x in stack[k + 1:]):
                        break  # a stray end tag does not close the blocks around it
                    del stack[k:]
                    break
            continue
        if name == "br" or name in INLINE:
            if name in ("br", "wbr", "img"):
                text.append(" " if name == "br" else "")
                continue
            dropped, main = stack[-1][1:] if stack else (0, OPEN)
            if dropped < BY_NAME and m[3]:
                dropped = max(dropped, hinted(m[3], name, main != OPEN))
            if not m[3].endswith("/"):
                stack.append((name, dropped, main))
            continue
        flush()
        if name in VOID:
            continue
        while stack and (stack[-1][0] == "p" or stack[-1][0] in INLINE or stack[-1][0] in CLOSES.get(name, ())):
            if stack[-1][0] in INLINE and not any(x[0] == "p" for x in stack):
                break
            stack.pop()
        dropped, main = stack[-1][1:] if stack else (0, OPEN)
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if name == "article" and main != OPEN and hinted(m[3], name, True) == BY_NAME:
            dropped = BY_ROLE  # a reader's comment or a teaser, not an article of the page
        elif name in MAIN and dropped < BY_ROLE:
            main = KEEP if name == "main" or dropped < BY_NAME and main != SPARE else SPARE
            dropped = 0
        elif name in DROPPED:
            dropped = BY_ROLE
        elif dropped < BY_NAME and name not in ("html", "body"):
            dropped = max(dropped, hinted(m[3], name, main != OPEN))
        stack.append((name, dropped, main))
    flush()
    if any(role == KEEP for role, _ in out):
        return [(role, t) for role, t in out if role != SPARE]
    return [(KEEP if role == SPARE else role, t) for role, t in out]


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The suffix array of an integer sequence, by prefix doubling."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        second = np.full(n, -1, np.int64)
        second[:n - k] = rank[k:] if k < n else 0
        order = np.lexsort((second, rank))
        step = np.empty(n, np.int64)
        a, b = rank[order], second[order]
        step[order] = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
        rank = step
        if rank.max() == n - 1 or k >= n:
            return order
        k *= 2


def common_prefixes(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix in order with the one before it."""
    n = len(s)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    values, where, before, out, h = s.tolist(), place.tolist(), order.tolist(), [0] * n, 0
    for i in range(n):
        p = where[i]
        if p == 0:
            h = 0
            continue
        j = before[p - 1]
        while i + h < n and j + h < n and values[i + h] == values[j + h]:
            h += 1
        out[p] = h
        h = max(0, h - 1)
    return np.array(out)


def repeated_tokens(pages: list[np.ndarray], long: int = LONG) -> list[np.ndarray]:
    """For each page's tokens, which lie in a substring of ``long`` or more that another page holds too."""
    total = sum(len(p) for p in pages) + len(pages)
    s, own = np.empty(total, np.int64), np.empty(total, np.int64)
    at = 0
    for k, p in enumerate(pages):
        s[at:at + len(p)] = p
        s[at + len(p)] = -1 - k  # a separator of its own
        own[at:at + len(p) + 1] = k
        at += len(p) + 1
    order = suffix_array(s)
    lcp = common_prefixes(s, order)
    # for every suffix the longest prefix shared with a suffix of another page: next such one up and down
    best = np.zeros(total, np.int64)
    page = own[order].tolist()
    for low, high, link in ((range(1, total), -1, lcp.tolist()), (range(total - 2, -1, -1), 1, [*lcp[1:].tolist(), 0])):
        shared = 0
        for x in low:
            shared = link[x] if page[x + high] != page[x] else min(shared, link[x])
            if shared > best[order[x]]:
                best[order[x]] = shared
    hit = np.zeros(total + 1, np.int64)
    starts = np.flatnonzero(best >= long)
    np.add.at(hit, starts, 1)
    np.add.at(hit, starts + best[starts], -1)
    cover = np.cumsum(hit[:-1]) > 0
    out, at = [], 0
    for p in pages:
        out.append(cover[at:at + len(p)])
        at += len(p) + 1
    return out


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, roles, texts (of the blocks left by markup, in order)."""

    def run(batches):
        for b in batches:
            found = [blocks(h) if h else [] for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array([[r for r, _ in x] for x in found], pa.list_(pa.int8())),
                 pa.array([[t for _, t in x] for x in found], pa.list_(pa.string()))], ["page_id", "url", "roles", "texts"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, roles array<tinyint>, texts array<string>")


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def repeated_runs(rows: DataFrame, long: int) -> DataFrame:
    """host, page_id, key, starts: where runs of ``long`` open tokens start that another page of the host holds too."""

    def run(batches):
        import xxhash

        for b in batches:
            for host, i, key, r, x in zip(*(b.column(c).to_pylist() for c in ("host", "page_id", "key", "roles", "texts"))):
                h = np.array([xxhash.xxh3_64_intdigest(w) for role, text in zip(r, x) if role == OPEN for w in text.split()], np.uint64)
                h1, h2 = long_grams(h, long, 1), long_grams(h, long, 2)
                n = len(h1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([host] * n, pa.int64()), pa.array([i] * n, pa.int64()), pa.array([key] * n, pa.int64()),
                     pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(np.arange(n, dtype=np.int32))],
                    ["host", "page_id", "key", "h1", "h2", "at"])

    runs = written(rows.select("host", "page_id", "key", "roles", "texts").mapInArrow(
        run, "host long, page_id long, key long, h1 long, h2 long, at int"))
    page = F.struct("page_id")  # a null page_id is a page
    often = runs.groupBy("host", "h1", "h2").agg(F.min(page).alias("low"), F.max(page).alias("high"))
    often = written(often.where(~F.col("low.page_id").eqNullSafe(F.col("high.page_id"))).select("host", "h1", "h2"))
    found = runs.join(bounded(often), ["host", "h1", "h2"]).groupBy("host", "page_id", "key").agg(F.collect_set("at").alias("starts"))
    return written(found)


def unique_runs(undecided: DataFrame, long: int = LONG, part_pages: int = PART_PAGES) -> DataFrame:
    """page_id, url, text of the pages that have open blocks: those blocks less what repeats on the host."""
    rows = undecided.withColumn("host", F.xxhash64(host_of(F.col("url"))))
    parts = rows.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / F.lit(part_pages)).cast("int").alias("parts"))
    rows = rows.join(parts, "host").withColumn("part", F.pmod(F.xxhash64("page_id"), F.col("parts")).cast("int"))
    rows = rows.withColumn("key", F.xxhash64("roles", "texts"))
    split = rows.where("parts > 1")
    if split.isEmpty():
        rows = rows.withColumn("starts", F.lit(None).cast("array<int>"))
    else:
        own = repeated_runs(split, long).select(F.struct("host", "page_id", "key").alias("of"), "starts")
        same = (F.col("host") == F.col("of.host")) & F.col("page_id").eqNullSafe(F.col("of.page_id")) & (F.col("key") == F.col("of.key"))
        rows = rows.join(own, same, "left").drop("of")

    def run(batches):
        import xxhash

        for t in sorted_groups(batches, ["host", "part"]):
            ids, urls = t.column("page_id").to_pylist(), t.column("url").to_pylist()
            roles, texts, starts = (t.column(c).to_pylist() for c in ("roles", "texts", "starts"))
            streams = {}
            for i, r, x in zip(ids, roles, texts):
                words = [w for role, text in zip(r, x) if role == OPEN for w in text.split()]
                streams.setdefault(i, words)
            names = list(streams)
            coded = [np.array([xxhash.xxh3_64_intdigest(w) >> 1 for w in streams[i]], np.int64) for i in names]
            cover = dict(zip(names, repeated_tokens(coded, long))) if len(names) > 1 else {}
            out = []
            for i, r, x, across in zip(ids, roles, texts, starts):
                off = cover.get(i)
                if across:
                    off = np.zeros(sum(len(text.split()) for role, text in zip(r, x) if role == OPEN), bool) if off is None else off.copy()
                    for k in across:
                        off[k:k + long] = True
                at, kept = 0, []
                for role, text in zip(r, x):
                    if role == OPEN:
                        words = text.split()
                        if off is not None:
                            words = [w for w, o in zip(words, off[at:at + len(words)].tolist()) if not o]
                        at += len(text.split())
                        text = " ".join(words)
                    if text:
                        kept.append(text)
                out.append("\n".join(kept))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(out, pa.string())],
                                             ["page_id", "url", "text"])

    return by_key(rows.select("host", "part", "page_id", "url", "roles", "texts", "starts"), ["host", "part"], ["page_id"]).mapInArrow(
        run, "page_id long, url string, text string")


def main_text(pages: DataFrame, long: int = LONG) -> DataFrame:
    """page_id, url, text of every row of ``pages``."""
    table = written(parsed(pages))
    is_open = F.array_contains("roles", F.lit(OPEN).cast("tinyint")) & ~F.array_contains("roles", F.lit(KEEP).cast("tinyint"))
    settled = F.transform(F.filter(F.arrays_zip("roles", "texts"), lambda b: b["roles"] == KEEP), lambda b: b["texts"])
    plain = table.where(~is_open).select("page_id", "url", F.array_join(settled, "\n").alias("text"))
    return plain.union(unique_runs(table.where(is_open), long))


def op6_html_text(spark, sf_dir: str) -> DataFrame:
    text = main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return text.withColumn("n_chars", F.length("text").cast("long"))
