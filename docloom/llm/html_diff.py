"""Main text of web pages: nearest-URL page differencing over the blocks of the markup.

Pages are sorted by host and path over the cluster, so a page's neighbour in the order is the page whose
path is nearest; a busy host is many partitions, not one. A page is parted into text blocks, and
those of elements that are never content (menus, forms, notices and so on) are left out. The blocks are aligned
with the neighbour's by longest common subsequence, and the shared ones, the site's frame, are deleted. Where the markup names
the article and the bulk of the prose stands in it, the text is what it holds; there shared headings and
passages of ``PROSE`` words stay, and nothing goes where the neighbour is a near copy.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialize, shuffle_partitions

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noframes"}
_SKIP = {"nav", "footer", "aside", "form", "head", "svg", "button", "select", "dialog", "menu", "object", "canvas", "audio", "video", "map", "math"}
_BLOCK = set("address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()) | _SKIP
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words of the names that are never content. A class, id or role counts where every part of the whole name is one of them.
_NOISE = set(
    "ad ads adv advert adverts advertisement advertisements adsense sponsor sponsored sponsors promo promos promotion promotions banner banners cookie cookies consent gdpr notice notices alert alerts newsletter subscribe subscription signup login "
    "sidebar sidebars side menu menus nav navbar navigation breadcrumb breadcrumbs footer footers comment comments reply replies respond disqus discussion share sharing social related recommended popup popups modal modals overlay toolbar widget widgets search contentinfo complementary skip".split()
)
_FRAME = {"header", "masthead", "topbar", "banner"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_HOLDS = {False: re.compile(r"<(?:article|main)\b", re.I), True: re.compile(r"<(?:article|main|h1)\b", re.I)}
#: Elements whose end tag may be omitted, with the start tags that end them.
_ROW = {"tr", "tbody", "thead", "tfoot"}
_ENDS = {"p": _BLOCK, "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"} | _ROW, "th": {"td", "th"} | _ROW, "tr": _ROW, "option": {"option", "optgroup"}}


def _noisy(name: str, attrs: str, in_article: bool) -> bool:
    """Whether an element's own names say that it is a menu, a notice or the like; an id counts outside articles only."""
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "id" and (in_article or name in ("section", "article")):
            continue
        for token in [value] if key == "aria-label" else value.split():
            parts = [x for x in re.split(r"[-_]+", token) if x]
            if parts and (all(x in _NOISE for x in parts) or (not in_article and token in _FRAME)):
                return True
    return False


#: A block of so many words is a passage: it tells where the main text is, and stays in an article though the neighbour has it.
PROSE = 20
#: The part of a block: outside of the main text, in it, in a named article, and there a heading or passage.
OUTSIDE, INSIDE, NAMED, SPARED = range(4)


def parts(page: str) -> tuple[list[str], list[int]]:
    """The text blocks of a page in order, and the part of each.

    Character references are decoded, white space in a block is one space, blank blocks are left out.
    """
    found: list[tuple[str, str, bool]] = []  # text, named element, in a heading
    depth = {"article": 0, "main": 0}
    heading, article = False, False
    part: list[str] = []
    at, n = 0, len(page)

    def close() -> None:
        if part:
            text = " ".join(html.unescape("".join(part)).split())
            part.clear()
            if text:
                found.append((text, "article" if depth["article"] else "main" if depth["main"] else "", heading))

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            part.append(page[at:])
            break
        if m.start() > at:
            part.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if name in _BLOCK:
                close()
                heading = heading and name not in _HEADINGS
            if name in depth and depth[name]:
                depth[name] -= 1
            continue
        if name == "br":
            part.append(" ")
            continue
        if name in _VOID or m[3].endswith("/"):
            if name in _BLOCK:
                close()
            continue
        skip = name in _SKIP or (name == "header" and not depth["article"])
        raw = name in _RAW
        if not skip and not raw and m[3] and name not in _HEADINGS and name not in ("html", "body", "main"):
            skip = _noisy(name, m[3], bool(depth["article"]))
        if raw or skip:
            past = _past(page, at, name, raw)
            # what holds the article is no menu, whatever it is called
            if raw or name == "head" or article or not (name == "article" or _HOLDS[name not in _SKIP].search(page, at, past)):
                if name in _BLOCK or skip:
                    close()
                at = past
                continue
        if name in _BLOCK:
            close()
            heading = name in _HEADINGS
        if name in depth:
            depth[name] += 1
            article = article or name == "article"
    close()
    lines = [x[0] for x in found]
    words = [len(x.split()) for x in lines]
    for kinds in (("article",), ("article", "main")):
        inside = [x[1] in kinds for x in found]
        prose = [0, 0]
        for n, a in zip(words, inside, strict=True):
            prose[a] += n * (n >= PROSE)
        if any(inside) and prose[1] >= prose[0]:
            return lines, [(SPARED if x[2] or n >= PROSE else NAMED) if a else OUTSIDE for x, n, a in zip(found, words, inside, strict=True)]
    return lines, [INSIDE] * len(lines)


def blocks(page: str) -> list[str]:
    """The blocks of the main text before differencing."""
    return [x for x, k in zip(*parts(page), strict=True) if k != OUTSIDE]


def difference(lines: list[str], kinds: list[int], other: list[str] | None) -> str:
    """The main text without what it shares with another page of the host."""
    shared = [False] * len(lines) if other is None else common_lines(lines, other)
    if NAMED in kinds or SPARED in kinds:
        size = [len(x) * (k != OUTSIDE) for x, k in zip(lines, kinds, strict=True)]
        near_copy = 2 * sum(n for n, s in zip(size, shared, strict=True) if s) > sum(size)
        shared = [s and k != SPARED and not near_copy for s, k in zip(shared, kinds, strict=True)]
    return "\n".join(x for x, s, k in zip(lines, shared, kinds, strict=True) if k != OUTSIDE and not s)


def _past(page: str, at: int, name: str, raw: bool) -> int:
    """The place after the element that has begun: its end tag, or the tag that ends it where that may be omitted.

    The page's end where there is none.
    """
    if raw:
        m = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
        return m.end() if m else len(page)
    inside = [name]
    while (m := _TAG.search(page, at)) is not None:
        at = m.end()
        if m[2] is None:
            continue
        other = m[2].lower()
        if m[1]:
            if other in inside:
                while inside.pop() != other:
                    pass
                if not inside:
                    return at
            elif name in _ENDS and other in _BLOCK and other != "p":  # the end of what the element stands in
                return m.start()
            continue
        while inside:
            k = len(inside) - 1
            while k > 0 and inside[k] not in _BLOCK and inside[k] not in _ENDS:  # inline elements do not stop it
                k -= 1
            if other not in _ENDS.get(inside[k], ()):
                break
            del inside[k:]
        if not inside:
            return m.start()
        if other in _RAW:
            at = _past(page, at, other, True)
        elif other not in _VOID and not m[3].endswith("/"):
            inside.append(other)
    return len(page)


def common_lines(a: list[str], b: list[str]) -> list[bool]:
    """Which entries of ``a`` are in a longest common subsequence with ``b`` (bit-parallel, exact)."""
    shared = [False] * len(a)
    lo, hi, n = 0, len(a), len(b)
    while lo < min(hi, n) and a[lo] == b[lo]:
        shared[lo] = True
        lo += 1
    while hi > lo and n > lo and a[hi - 1] == b[n - 1]:
        hi, n = hi - 1, n - 1
        shared[hi] = True
    where: dict[str, int] = {}
    for j, x in enumerate(b[lo:n]):
        where[x] = where.get(x, 0) | 1 << j
    width = n - lo
    full = (1 << width) - 1
    rows, v = [], full
    for x in a[lo:hi]:
        rows.append(v)
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    rows.append(v)
    # a zero bit in row i marks where the length over the first columns grows
    j = width
    for i in range(hi - lo, 0, -1):
        while j > 0 and rows[i] >> (j - 1) & 1:
            j -= 1
        if j == 0:
            break
        if rows[i - 1] >> (j - 1) & 1:  # the length grew with this line
            shared[lo + i - 1] = True
            j -= 1
    return shared


def _key(url: str | None) -> tuple[str, str]:
    rest = re.sub(r"^[a-zA-Z][\w+.-]*:", "", url or "").lstrip("/")
    host, _, path = rest.partition("/")
    return host.lower(), re.split(r"[?#]", path)[0]


def _near(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class _Group:
    """Pages that stand together and have the same blocks; they are no help to each other."""

    def __init__(self, host: str, first: str, last: str, lines: list[str], kinds: list[int]):
        self.host, self.first, self.last, self.lines, self.kinds = host, first, last, lines, kinds

    def same(self, x: _Group) -> bool:
        return self.host == x.host and self.lines == x.lines and self.kinds == x.kinds

    def text(self, before: _Group | None, after: _Group | None) -> str:
        """The main text, given the groups ahead and behind: the one with the nearer path is the partner."""
        beside = [(_near(x.last if x is before else x.first, self.first if x is before else self.last), x) for x in (before, after) if x is not None and x.host == self.host]
        return difference(self.lines, self.kinds, max(beside, key=lambda x: x[0])[1].lines if beside else None)

    def pack(self) -> bytes:
        return zlib.compress(json.dumps([self.host, self.first, self.last, self.lines, self.kinds]).encode())

    @staticmethod
    def unpack(raw: bytes) -> _Group:
        return _Group(*json.loads(zlib.decompress(raw)))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of each page, packed, so that the shuffle and the disk have little to hold."""
    for batch in batches:
        packed = [zlib.compress(json.dumps(parts(page), ensure_ascii=False).encode("utf-8", "surrogatepass"), 6) for page in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(1, batch.num_columns)), pa.array(packed, pa.binary())], [*batch.schema.names[1:], "blocks"])


_PARTS = "page_id long, url string, part int, edge int, text string, kept binary"


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages come sorted by host and path. Those of the first and the last group of the partition have an ``edge``,
    and no text yet; what their texts need follows as at most four groups with ``kept``, in order.
    """
    out: list[tuple] = []
    part: int | None = None
    number = 0  # of the present group
    before: _Group | None = None
    present: _Group | None = None
    rows: list[tuple] = []  # of the present group
    kept: list[tuple[int, _Group]] = []  # the first two and the last two groups

    def end(after: _Group | None) -> None:
        nonlocal kept, number
        edge = number if number == 0 or after is None else None
        text = None if edge is not None else present.text(before, after)
        out.extend((page_id, url, part, edge, text, None) for page_id, url in rows)
        kept = [*kept[:2], *kept[2:][-1:], (number, present)]
        number += 1

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) if out else [[]] * 6
        out.clear()
        types = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["page_id", "url", "part", "edge", "text", "kept"])

    for batch in batches:
        for page_id, url, packed, at in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            part = at
            host, path = _key(url)
            now = _Group(host, path, path, *json.loads(zlib.decompress(packed).decode("utf-8", "surrogatepass")))
            if present is None:
                present = now
            elif present.same(now):
                present.last = path
            else:
                end(now)
                before, present, rows = present, now, []
            rows.append((page_id, url))
        yield flush()
    if present is not None:
        end(None)
        # a group that both of the bounds have is one; of more than two, only the first and the last wait
        out.extend((None, None, part, k, None, g.pack()) for k, g in kept)
        yield flush()


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the groups at the edges, from the groups of all partitions in order; three are held at a time."""
    out: list[tuple] = []
    before: _Group | None = None
    present: _Group | None = None
    places: list[tuple[int, int]] = []

    def end(after: _Group | None) -> None:
        if places:
            text = present.text(before, after)
            out.extend((part, edge, text) for part, edge in places)

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) if out else [[]] * 3
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.string()), strict=True)], ["part", "edge", "edge_text"])

    for batch in batches:
        for part, edge, kept in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            now = _Group.unpack(kept)
            if present is not None and present.same(now):
                present.last = now.last
            else:
                if present is not None:
                    end(now)
                before, present, places = present, now, []
            places.append((part, edge))
        yield flush()
    if present is not None:
        end(None)
        yield flush()


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    A null or empty page, or one without any content, has the empty text. A null url is a host of its own. Repeated
    rows give equal texts. The text of a page does not depend on the partitions: the groups at their edges are
    differenced afterwards in one task, which gets at most four pages of each partition. An
    empty table gives an empty result; other columns are ignored.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = F.regexp_replace(url, r"^[a-zA-Z][\w+.-]*:/*", "")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), F.lower(F.substring_index(rest, "/", 1)).alias("host"), F.regexp_replace(rest, r"[?#].*$", "").alias("path"))
    order = ["host", "path", "url", "page_id"]
    rows = rows.select("html", "page_id", "url", "host", "path").mapInArrow(_parse, "page_id long, url string, host string, path string, blocks binary")
    rows = rows.repartitionByRange(shuffle_partitions(pages.sparkSession), *order).sortWithinPartitions(*order)
    done = materialize(rows.select("page_id", "url", "blocks", F.spark_partition_id().alias("part")).mapInArrow(_extract, _PARTS), "pages")
    edges = done.where(F.col("kept").isNotNull()).select("part", "edge", "kept").coalesce(1).sortWithinPartitions("part", "edge")
    texts = edges.mapInArrow(_edges, "part int, edge int, edge_text string")
    found = done.where(F.col("kept").isNull())
    wait = found.where(F.col("edge").isNotNull()).join(texts, ["part", "edge"], "left").select("page_id", "url", F.col("edge_text").alias("text"))
    out = found.where(F.col("edge").isNull()).select("page_id", "url", "text").unionByName(wait)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op9_html_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(load(spark, sf_dir, "pages"))
