"""Main text of web pages by differencing each page against the nearest one of its host."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import query, table
from .kernels import by_size

# Elements that start and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
# Elements whose content is not text, and elements that are not part of an article.
RAW = frozenset("script style template noscript iframe object svg canvas textarea title select math audio video".split())
ASIDE = frozenset("nav footer aside form menu dialog button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in class, id or role that name parts beside the article.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar complementary footer contentinfo masthead banner header topbar cookie cookies consent "
    "gdpr notice notices alert popup modal dialog overlay newsletter subscribe signup login search comment comments "
    "disqus respond reply replies share sharing social related recommended pagination pager toolbar skip".split()
)
CONTAINERS = frozenset(("article", "main"))
TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)>?|[!?/][^>]*>?)""", re.S)
NAMES = re.compile(r"""(?:^|\s)(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORD = re.compile("[a-z]+")
PLACE = re.compile(r"^[a-z][a-z0-9+.-]*://([^/?#]*)([^?#]*)", re.I)
COPY = 0.8  # share of a page's characters from which a pair counts as copies


def place(url: str | None) -> tuple[str, str]:
    """Host and path; empty where there is none."""
    found = PLACE.match(url or "")
    return (found[1].lower(), found[2]) if found else ("", "")


def beside(tag: str, attributes: str, inside: bool) -> bool:
    """Does the element stand beside the article?"""
    if tag in ASIDE or (tag == "header" and not inside):
        return True
    if tag in CONTAINERS or tag in ("body", "html") or "=" not in attributes and "hidden" not in attributes:
        return False
    for name, value in NAMES.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style":
            if "display:none" in value.replace(" ", ""):
                return True
        elif name in ("class", "id", "role"):
            for one in value.split():
                words = WORD.findall(one)
                if words and (words[0] in BESIDE or words[-1] in BESIDE) and not (inside and words[-1] == "header"):
                    return True
    return False


def lines(html: str) -> list[tuple[str, bool]]:
    """The blocks of a page outside menus, forms and the like; True for those inside an article or main."""
    out: list[tuple[str, bool]] = []
    run: list[str] = []
    inside = {"article": 0, "main": 0}
    ever = {"article": False, "main": False}
    zone, depth = "", 0  # the element beside the article that is open
    marks: list[tuple[bool, bool]] = []

    def end_block() -> None:
        text = " ".join(unescape("".join(run)).split())
        run.clear()
        if text:
            out.append((text, False))
            marks.append((inside["article"] > 0, inside["main"] > 0))

    at = 0
    while True:
        found = TAG.search(html, at)
        if not zone and (found.start() if found else len(html)) > at:
            run.append(html[at : found.start() if found else len(html)])
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        closing = bool(found[1])
        if tag in RAW and not closing:
            end = re.compile(f"</{tag}[\\s/>]", re.I).search(html, at)
            if end is None and tag not in ("script", "style", "template"):
                continue
            at = len(html) if end is None else max(html.find(">", end.start()) + 1, end.end())
            continue
        if zone:
            if closing:
                depth -= tag == zone
            elif tag == zone:
                depth += zone not in ("p", "li")
            if depth <= 0 or zone in ("p", "li") and tag in BLOCKS:
                zone = ""
                if depth <= 0:
                    continue
            else:
                continue
        if tag in BLOCKS:
            end_block()
        elif tag == "br":
            run.append(" ")
        if closing:
            if tag in CONTAINERS:
                inside[tag] = max(0, inside[tag] - 1)
        elif tag not in VOID and beside(tag, found[3], any(inside.values())):
            if re.compile(f"</{tag}[\\s/>]", re.I).search(html, at) or tag in ("p", "li"):
                zone, depth = tag, 1
        elif tag in CONTAINERS:
            inside[tag] += 1
            ever[tag] = True
    end_block()
    which = 0 if ever["article"] and any(m[0] for m in marks) else 1
    return [(text, mark[which]) for (text, _), mark in zip(out, marks)]


def common(a: list[str], b: list[str]) -> list[bool]:
    """Which lines of ``a`` are in the longest common subsequence of both.

    Common ends are taken off, lines found on one side only can't be in it, and the rest is done with one
    bit per line of ``b``, so the time is the product of what is left over the word size.
    """
    out = [False] * len(a)
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        out[start] = True
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        out[-1 - end] = True
        end += 1
    there = set(b[start : len(b) - end])
    left = [i for i in range(start, len(a) - end) if a[i] in there]
    if not left:
        return out
    here = {a[i] for i in left}
    other = [x for x in b[start : len(b) - end] if x in here]
    masks: dict[str, int] = {}
    for j, x in enumerate(other):
        masks[x] = masks.get(x, 0) | 1 << j
    full = (1 << len(other)) - 1
    rows = [full]  # a 0 bit: the subsequence grows by one at this line of b
    for i in left:
        row, match = rows[-1], masks[a[i]]
        rows.append(((row + (row & match)) | (row & ~match)) & full)
    j = len(other)
    for k in range(len(left), 0, -1):
        # the line is in it if leaving it out makes the subsequence up to j shorter
        low = (1 << j) - 1
        if (~rows[k] & low).bit_count() > (~rows[k - 1] & low).bit_count():
            out[left[k - 1]] = True
            line = a[left[k - 1]]
            j -= 1
            while other[j] != line:
                j -= 1
    return out


def main_text(page: list[tuple[str, bool]], neighbours: list[list[tuple[str, bool]]], protect: bool) -> str:
    """The page's lines without those shared with the first neighbour that is not a copy.

    With ``protect``, lines inside an article or main element stay, shared or not, for articles share passages
    that are theirs. Without a neighbour to tell, the lines beside such an element go.
    """
    texts = [x for x, _ in page]
    shared, compared = [False] * len(texts), False
    for other in neighbours:
        found = common(texts, [x for x, _ in other])
        size = sum(len(x) for x, s in zip(texts, found) if s)
        if size < COPY * sum(map(len, texts)) and size < COPY * max(1, sum(len(x) for x, _ in other)):
            shared, compared = found, True
            break
    if protect and any(p for _, p in page):
        return "\n".join(x for (x, p), s in zip(page, shared) if p or compared and not s)
    return "\n".join(x for x, s in zip(texts, shared) if not s)


def prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


PARSED = "bucket long, halo boolean, host string, path string, page_id long, url string, lines array<string>, inside array<boolean>"
OUT = "page_id long, url string, text string, n_chars long"


def _key(host: str, path: str, page_id: int | None) -> str:
    return f"{host}\x01{path}\x01{'' if page_id is None else page_id + (1 << 63):020}"


def _parse_task(batches: Iterator[pa.RecordBatch], firsts: list[str], lasts: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in by_size(batches, "html"):
        rows = []
        for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
            host, path = place(url)
            key = _key(host, path, page_id)
            found = lines(html or "")
            bucket = max(0, bisect_right(firsts, key) - 1)
            row = host, path, page_id, url, [x for x, _ in found], [p for _, p in found]
            rows.append((bucket, False, *row))
            if host and key == firsts[bucket] and bucket:
                rows.append((bucket - 1, True, *row))
            if host and key == lasts[bucket] and bucket + 1 < len(firsts):
                rows.append((bucket + 1, True, *row))
        names = [c.split()[0] for c in PARSED.split(", ")]
        kinds = [pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.bool_())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _difference_task(batches: Iterator[pa.RecordBatch], protect: bool) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket, host, path and page; each sees the row before it and the one after it."""

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in batch.schema.names))

    def finish(before, row, after):
        bucket, _, host, path, page_id, url, texts, inside = row
        near = [x for x in (before, after) if x is not None and host and x[0] == bucket and x[2] == host]
        near.sort(key=lambda x: -prefix(x[3], path))
        text = main_text(list(zip(texts, inside)), [list(zip(x[6], x[7])) for x in near], protect)
        return page_id, url, text, len(text)

    done: list = []

    def batch_of(rows_: list) -> pa.RecordBatch:
        kinds = pa.int64(), pa.string(), pa.string(), pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows_), kinds)], [c.split()[0] for c in OUT.split(", ")])

    before = row = None
    for after in rows():
        if row is not None and not row[1]:
            done.append(finish(before, row, after))
        before, row = row, after
        if len(done) >= 256:
            yield batch_of(done)
            done = []
    if row is not None and not row[1]:
        done.append(finish(before, row, None))
    if done:
        yield batch_of(done)


def extract(pages: DataFrame, protect: bool = True) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row of ``pages`` (page_id, url, html).

    Pages are sorted by host, path and page_id in ranges; the first and last page of a range also go to the range
    beside it, so that every page meets its two neighbours, of which the one with the longer common path is the
    nearest. A host of any size is spread over ranges. Lines are aligned by longest common subsequence, and
    shared ones deleted; a neighbour that shares 80 % of the characters is a copy and is passed over. With
    ``protect`` (see ``main_text``) differencing never takes text out of an article element, which copies and
    shared passages would lose otherwise.

    A null html gives the empty text; a null or odd url has no host and so no neighbour; a null page_id stays null;
    repeated rows are copies; other columns are ignored; an empty table gives no rows.
    """
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )

    def keys(batches):
        for batch in batches:
            found = [_key(*place(u), p) for p, u in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["key"])

    spark = pages.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = pages.select("page_id", "url").mapInArrow(keys, "key string").repartitionByRange(n, "key")
    ends = ranges.groupBy(F.spark_partition_id()).agg(F.min("key").alias("a"), F.max("key").alias("b")).orderBy("a").collect()
    firsts, lasts = [r.a for r in ends] or [""], [r.b for r in ends] or [""]
    parsed = pages.mapInArrow(lambda b: _parse_task(b, firsts, lasts), PARSED)
    placed = parsed.repartition("bucket").sortWithinPartitions("bucket", "host", "path", "page_id", F.xxhash64("lines"))
    return placed.mapInArrow(lambda b: _difference_task(b, protect), OUT)


@query("op1_page_differencing")
def op1(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
