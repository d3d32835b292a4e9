"""Main text of web pages.

A page is cut into lines, one for each block. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments that markup names as
such (by element, role, class or id) never give lines; what an ``article`` or
``main`` element, or one whose class or id names the content, holds is preferred
to what stands outside.

Page differencing then judges the lines of every page. Pages are put in order of
host and URL path. A page's lines are aligned, by their longest common
subsequence, with those of the nearest pages of its host: of the ``NEAR`` pages
before and behind it, the up to ``ENOUGH`` that share the longest start of the
path. A page of which shared lines make up ``COPY`` of both texts is a copy and
tells nothing of the template; the next nearest takes its place. Lines shared
with most of the pages compared are the template's and deleted. Articles also
quote and repeat each other's lines (licences, copies), so inside a landmark up to
``ENOUGH_INSIDE`` and at least ``LEAST_INSIDE`` pages are compared, and all of
them must share a line.

The order is cut in ranges of about equally many pages, one for each shuffle
partition; a range's task also gets the ``NEAR`` pages next to its ends. So a host
with a third of all pages is spread over as many tasks as any other rows, and the
lines of a page are shuffled once. The ranges' ends (at most 2 * ``NEAR`` keys for
each partition) are what is collected and broadcast.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import Counter, deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .. import tables as shared
from .urls import host_path

NEAR, ENOUGH, COPY = 4, 3, 0.8
ENOUGH_INSIDE, LEAST_INSIDE = 6, 4
#: Rows times columns up to which an alignment is kept whole; larger ones are halved first.
WHOLE = 1 << 27
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg math object select button".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option optgroup p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
_SKIP = frozenset("aside dialog footer form head menu nav".split())
_SKIP_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
_SKIP_WORDS = frozenset(
    "ad ads adsbygoogle adv advert adverts advertisement advertising alert alerts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright discussion disqus disclaimer footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promoted promotion related reply replies respond search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription toolbar widget widgets".split()
)
_LANDMARKS = frozenset(("article", "main"))
#: Whole class names or ids of elements that hold an article where there is no landmark element.
_CONTENT = frozenset(
    "article articlebody article-body article-content article-text content content-body entry entry-content main main-content maincontent post post-body "
    "post-content post-text story story-body story-content".split()
)
_CLOSES = {"li": "ul ol menu dir", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table", "option": "select"}
_CLOSES = {k: frozenset(v.split()) for k, v in _CLOSES.items()}
_PAIRED = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}


def _hidden(name: str, attributes: dict[str, str], inside: bool) -> bool:
    if name in ("html", "body"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I) or attributes.get("role", "").lower() in _SKIP_ROLES:
        return True
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    if name in _LANDMARKS:
        return bool({"comment", "comments", "reply", "replies"} & set(re.split(r"[^a-z0-9]+", named)))
    found = _SKIP_WORDS.intersection(re.split(r"[^a-z0-9]+", named))
    return bool(found - {"header"} if inside else found)  # an article's own header holds its title


def _content(attributes: dict[str, str]) -> bool:
    if attributes.get("role") == "main" or attributes.get("itemprop") == "articleBody":
        return True
    return not _CONTENT.isdisjoint(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split())


def lines(page: str) -> tuple[list[str], list[str], bool]:
    """The lines that may be main text, the others that markup does not rule out, and whether a landmark holds the first."""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, bool, int]] = []  # name, skipped, inside: 2 a landmark element, 1 one named for content
    skip, inside, landmark, at = False, 0, 0, 0
    text: list[str] = []

    def flush() -> None:
        if text:
            line = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if line:
                out.append((line, inside))

    def pop(k: int) -> None:
        nonlocal skip, inside
        del stack[k:]
        _, skip, inside = stack[-1] if stack else ("", False, 0)

    while m := _TOKEN.search(page, at):
        if not skip and m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        block, closing = name in _BLOCK, bool(m[1] or m[4])
        if block:
            flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop(k)
                    break
            continue
        if name in _VOID:
            continue
        raw = m[3] if m[2] else m[6]
        if name in _RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if block and stack and stack[-1][0] == "p":
            pop(len(stack) - 1)
        if name in _CLOSES:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in _CLOSES[name]:
                    break
                if stack[k][0] in _PAIRED.get(name, (name,)):
                    pop(k)
                    break
        attributes = _attributes(raw) if raw.strip(" /") else {}
        drop = skip or name in _SKIP or bool(attributes) and _hidden(name, attributes, inside > 0)
        if name == "header" and not skip:
            drop = not inside
        level = 0
        if not drop and name not in ("html", "body"):
            level = 2 if name in _LANDMARKS else int(bool(attributes) and _content(attributes))
        if raw.endswith("/") and not block:
            continue
        if block or drop != skip or level > inside:
            stack.append((name, drop, max(inside, level)))
            skip, inside, landmark = drop, max(inside, level), max(landmark, level)
    if not skip:
        text.append(re.sub(r"<[a-zA-Z/!?].*\Z", "", page[at:], flags=re.S))
    flush()
    return [x for x, own in out if own >= landmark], [x for x, own in out if own < landmark], landmark > 0


def _rows(a: list[str], b: list[str]) -> Iterator[int]:
    """After each line of ``a`` a number of len(b) bits; zeros up to place j count the common subsequence with b[:j]."""
    where: dict[str, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = (v + u | v - u) & full
        yield v


def _lengths(a: list[str], b: list[str]) -> np.ndarray:
    """The length of the longest common subsequence of ``a`` with b[:j] for every j."""
    v = (1 << len(b)) - 1
    for v in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.r_[0, np.cumsum(1 - bits.astype(np.int64))]


def common(a: list[str], b: list[str]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    Bit-parallel, one big number for each line of ``a``; large alignments are cut
    in halves (Hirschberg), so equal lines by the thousand cost no pairs.
    """
    lo, most = 0, min(len(a), len(b))
    while lo < most and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < most - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    both = set(a[lo : len(a) - hi]) & set(b[lo : len(b) - hi])
    at = [k for k in range(lo, len(a) - hi) if a[k] in both]
    x, y = [a[k] for k in at], [v for v in b[lo : len(b) - hi] if v in both]
    return [*range(lo), *(at[k] for k in _inner(x, y)), *range(len(a) - hi, len(a))]


def _inner(a: list[str], b: list[str]) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > WHOLE and len(a) > 1:
        half = len(a) // 2
        through = _lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]
        cut = int(through.argmax())
        return [*_inner(a[:half], b[:cut]), *(half + k for k in _inner(a[half:], b[cut:]))]
    rows = list(_rows(a, b))
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            out.append(i)
            j -= 1
    return out[::-1]


class Page:
    """A page in the order of its host's paths, with the lines it may keep and its other ones."""

    __slots__ = ("host", "path", "own", "rest", "landmark")

    def __init__(self, host: str, path: str, own: list[str], rest: list[str], landmark: bool):
        self.host, self.path, self.own, self.rest, self.landmark = host, path, own, rest, landmark

    def pack(self) -> bytes:
        return zstandard.ZstdCompressor(level=1).compress("\n".join(["1" if self.landmark else "0", str(len(self.own)), *self.own, *self.rest]).encode())

    @classmethod
    def unpack(cls, host: str, path: str, packed: bytes) -> Page:
        flag, n, *found = zstandard.ZstdDecompressor().decompress(packed).decode().split("\n")
        return cls(host, path, found[: int(n)], found[int(n) :], flag == "1")


def _alike(a: str, b: str) -> int:
    """The length of the common start."""
    if a == b:
        return len(a)
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def template(page: Page, before: list[Page], behind: list[Page]) -> set[int]:
    """Places of the page's lines that are its host's template; ``before`` and ``behind`` are its neighbours, nearest first."""
    near = [(-_alike(page.path, q.path), k, side, q) for side, qs in enumerate((before, behind)) for k, q in enumerate(qs) if q.host == page.host]
    compared, times = 0, [0] * len(page.own)
    chars = sum(map(len, page.own))
    for *_, q in sorted(near, key=lambda x: x[:3]):
        places = common(page.own, q.own + q.rest)
        held = sum(len(page.own[k]) for k in places)
        if places and held >= COPY * chars and held >= COPY * sum(map(len, q.own)):
            continue
        compared += 1
        for k in places:
            times[k] += 1
        if compared == (ENOUGH_INSIDE if page.landmark else ENOUGH):
            break
    if page.landmark:
        return {k for k, n in enumerate(times) if n == compared} if compared >= LEAST_INSIDE else set()
    return {k for k, n in enumerate(times) if 2 * n > compared}


Key = tuple[bytes, bytes, int, int]


class Ranges:
    """The ranges of the pages' order, from the first and last keys of each."""

    def __init__(self, ends: list[list[Key]]):
        """``ends`` has the sorted end keys of each range that is not empty, in order."""
        self.bounds = [keys[0] for keys in ends]
        self.lent: dict[Key, list[int]] = {}
        for k in range(len(ends)):
            for step, side in ((-1, slice(-NEAR, None)), (1, slice(None, NEAR))):
                near: list[Key] = []
                j = k + step
                while 0 <= j < len(ends) and len(near) < NEAR:
                    near = ends[j] + near if step < 0 else near + ends[j]
                    j += step
                for key in near[side]:
                    self.lent.setdefault(key, []).append(k)

    def of(self, key: Key) -> tuple[int, list[int]]:
        """The range that ``key`` is in, and those that borrow it."""
        return bisect_right(self.bounds, key) - 1, self.lent.get(key, [])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and last ``NEAR`` keys of a sorted partition."""
    first: list[tuple] = []
    last: list[tuple] = []
    for b in batches:
        rows = list(zip(*(c.to_pylist() for c in (b.slice(0, NEAR)).columns)))
        first += rows[: NEAR - len(first)]
        last = [*last, *zip(*(c.to_pylist() for c in b.slice(max(0, b.num_rows - NEAR)).columns))][-NEAR:]
    rows = sorted({*first, *last}, key=lambda r: (r[0].encode(), r[1].encode(), r[2], r[3]))
    columns = list(zip(*rows)) if rows else [(), (), (), ()]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
    part = TaskContext.get().partitionId()
    yield pa.record_batch([pa.array([part] * len(rows), pa.int32()), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=["part", "host", "path", "k1", "k2"])


def ranges(keys: DataFrame, parts: int) -> Ranges:
    """``keys`` (host, path, k1, k2), distinct, cut in ``parts`` ranges; collects their ends."""
    order = ["host", "path", "k1", "k2"]
    dealt = keys.select(order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ends: dict[int, list[Key]] = {}
    for r in dealt.mapInArrow(_ends, "part int, host string, path string, k1 long, k2 long").collect():
        ends.setdefault(r.part, []).append((r.host.encode(), r.path.encode(), r.k1, r.k2))
    return Ranges([sorted(ends[k]) for k in sorted(ends)])


def _cut(cuts) -> Callable:
    """Rows with their packed lines, for their own range and those that borrow them; rows that are equal within a batch once."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = cuts.value
        for b in batches:
            take, packed, part, own = [], [], [], []
            times: Counter = Counter()
            first: dict[tuple[int, int], int] = {}
            keys = list(zip(*(b.column(c).to_pylist() for c in ("host", "path", "k1", "k2"))))
            for k, key in enumerate(keys):
                times[key[2:]] += 1
                first.setdefault(key[2:], k)
            page = b.column("html")
            for k in first.values():
                host, path, k1, k2 = keys[k]
                mine, lent = found.of((host.encode(), path.encode(), k1, k2))
                lines_of = Page("", "", *lines(page[k].as_py() or "")).pack()
                for r in (mine, *lent):
                    take.append(k)
                    packed.append(lines_of)
                    part.append(r)
                    own.append(times[k1, k2] if r == mine else 0)
            kept = b.drop_columns(["html"]).take(pa.array(take, pa.int64()))
            yield pa.record_batch([*kept.columns, pa.array(packed, pa.binary()), pa.array(part, pa.int32()), pa.array(own, pa.int64())], names=[*kept.schema.names, "packed", "part", "n"])

    return of


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a range's pages in their order; borrowed ones (n is 0) give no row."""
    held: deque[list] = deque()  # page, n, id, URL, key
    at = 0  # the place in ``held`` of the next page to judge
    kind = None

    def judge(last: bool) -> Iterator[list]:
        nonlocal at
        while at < len(held) and (last or at + NEAR < len(held)):
            page, n, *_ = held[at]
            if n:
                near = [h[0] for h in held]
                gone = template(page, near[max(0, at - NEAR) : at][::-1], near[at + 1 : at + 1 + NEAR])
                yield [*held[at][1:4], " ".join(x for k, x in enumerate(page.own) if k not in gone)]
            if at == NEAR:
                held.popleft()
            else:
                at += 1

    def batch(rows: list[list]) -> pa.RecordBatch:
        n, ids, urls, texts = zip(*rows)
        return pa.record_batch([pa.array(ids, kind), pa.array(urls, pa.string()), pa.array(n, pa.int64()), pa.array(texts, pa.string())], names=["page_id", "url", "n", "text"])

    for b in batches:
        kind, rows = b.column("page_id").type, []
        for i, u, host, path, k1, k2, packed, n in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "host", "path", "k1", "k2", "packed", "n"))):
            if held and held[-1][4] == (host, path, k1, k2):
                held[-1][1] += n  # equal rows of another task
                continue
            rows += judge(False)
            held.append([Page.unpack(host, path, packed), n, i, u, (host, path, k1, k2)])
        if rows:
            yield batch(rows)
    if rows := list(judge(True)):
        yield batch(rows)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): one row for each row of ``pages``.

    Null or empty html gives an empty text. A null URL has an empty host and
    path like any other without ``://``, and such pages are neighbours. Pages
    with equal host and path (ties) follow each other by a hash of the row. Equal
    rows (id, URL and html) count as one page when pages are compared and come
    out as often as they went in. An unclosed element ends with the page. Pages
    are cut and aligned whole, however long. An empty table gives no rows; other
    columns are unused.
    """
    spark = pages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    host, path = host_path(F.col("url"))
    source = source.withColumns({"host": host, "path": path, "k1": F.xxhash64("page_id", "url", "html"), "k2": F.xxhash64(F.lit("page"), "html", "url", "page_id")})
    keys = shared.table(source.select("host", "path", "k1", "k2").distinct(), "keys")
    cuts = spark.sparkContext.broadcast(ranges(keys, parts))
    kind = source.schema["page_id"].dataType.simpleString()
    cut = source.mapInArrow(_cut(cuts), f"page_id {kind}, url string, host string, path string, k1 long, k2 long, packed binary, part int, n long")
    dealt = cut.repartitionById(parts, "part").sortWithinPartitions("host", "path", "k1", "k2")
    judged = dealt.mapInArrow(_judged, f"page_id {kind}, url string, n long, text string")
    # Repeated rows come out again, a thousand at a time.
    judged = judged.withColumn("left", F.explode(F.sequence(F.col("n"), F.lit(1), F.lit(-1000)))).withColumn("left", F.explode(F.sequence(F.lit(1), F.least(F.col("left"), F.lit(1000)))))
    return judged.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
