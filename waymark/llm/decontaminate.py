"""Documents that hold a benchmark item, by edit distance over words.

Words are lower-cased, with ASCII punctuation taken as space. An item of n words
is in a document if some passage is within floor(n / 5) word edits of it
(similarity 0.8 or more).

Items of more than ``PART`` words are cut into equal parts: of an item's edits,
at least one part has no more than its share. Windows of a document that have a
part's size and the parts themselves are embedded by CGK random walks: in every
step the walk puts out the word under its pointer and moves on if a random bit of
step and word says so, which turns edits into a bounded number of differing
places. Bit-sampling LSH compares ``PLACES`` sampled places in each of ``TABLES``
tables for each walk; pairs that agree in one table are verified by the exact edit
distance of the whole item (Myers' bit-parallel approximate matching) over the
text around them. The number of walks follows from a part's size and edits: as
many as find ``RECALL`` of simulated passages with all their edits (deleted,
replaced and inserted words, at random places and evenly spread). If
``MOST_WALKS`` are not enough, every window of such a part is verified.

Windows are tried where they may fit: a part keeps at least
size - 2 - 3 * edits of its runs of three words (of floor(size / (edits + 1))
words where that is less than one), so places with fewer of them on neighbouring
diagonals hold no passage. This leaves nothing out, whatever the part's size.

Items are sent to all tasks in blocks of at most ``BLOCK`` items, one pass over
the documents for each block; nothing is shuffled but the pairs found.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .wordhash import Rolling, U, buffers, mix, pieces, word_hashes, words

RUN, PERCENT = 3, 20
PART, TABLES, PLACES = 20, 6, 2
RECALL, TRIALS, MOST_WALKS = 0.9995, 4000, 48
BLOCK, SEED = 10_000, 7
_FILTER = 22
_PUNCTUATION = np.arange(256, dtype=np.uint8)
_PUNCTUATION[[c for c in range(128) if not chr(c).isalnum() and c > 32]] = 32


def _normal(column) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, offsets = buffers(pc.utf8_lower(column))
    return _PUNCTUATION[data], offsets


def edits_allowed(n: int) -> int:
    return n * PERCENT // 100


def distance(item: list[int], passage: list[int]) -> int:
    """The least edits between ``item`` and any part of ``passage``."""
    m = len(item)
    at: dict[int, int] = defaultdict(int)
    for k, x in enumerate(item):
        at[x] |= 1 << k
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, now, best = full, 0, m, m
    for x in passage:
        eq = at.get(x, 0)
        same = eq | down
        diag = ((((eq & up) + up) ^ up) | eq) & full
        plus, minus = (down | ~(diag | up)) & full, up & diag
        now += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1) & full, (minus << 1) & full  # a match may start anywhere
        up, down = (minus | ~(same | plus)) & full, plus & same
        best = min(best, now)
    return best


def _run(size: int, edits: int) -> tuple[int, int]:
    """The length of runs that are counted, and how many of a part must survive its edits."""
    # Where edits can hit every run of three, the longest part that no edit hits is the run.
    run = RUN if size - RUN + 1 - RUN * edits >= 1 else min(RUN, size // (edits + 1))
    return run, max(size - run + 1 - run * edits, 1)


def lsh_keys(symbols: np.ndarray, first: int, walks: int) -> np.ndarray:
    """The keys (rows x tables) of equally long word sequences, for ``walks`` walks from number ``first`` on."""
    rows, n = symbols.shape
    out = np.zeros((rows, walks * TABLES), U)
    padded = np.concatenate([symbols, np.zeros((rows, 1), U)], axis=1)
    k = np.arange(rows)
    for walk in range(walks):
        random = np.random.default_rng([SEED, n, first + walk])
        seeds = random.integers(0, 2**63, size=2 * n // 61 + 1, dtype=np.uint64)
        # Walks reach the end after about 2 n steps; sample where words still come.
        chosen = [random.choice(2 * n, size=min(PLACES, 2 * n), replace=False) for _ in range(TABLES)]
        at_step = defaultdict(list)
        for t, places in enumerate(chosen):
            for j in places.tolist():
                at_step[j].append(t)
        pointer = np.zeros(rows, np.int64)
        for j in range(max(at_step) + 1):
            if j % 61 == 0:
                coin = mix(padded ^ seeds[j // 61])
                coin[:, n] = 0  # at the end the walk stays
            if j in at_step:
                word = padded[k, pointer]
                for t in at_step[j]:
                    col = walk * TABLES + t
                    out[:, col] += mix(word + U((j + 1) * 0x9E3779B97F4A7C15 & 2**64 - 1))
            pointer += ((coin[k, pointer] >> U(j % 61)) & U(1)).astype(np.int64)
    number = np.arange(first * TABLES + 1, (first + walks) * TABLES + 1, dtype=U)
    return mix(out ^ number * U(0x9E3779B97F4A7C15))


def _edited(rng: np.random.Generator, size: int, edits: int) -> list[int]:
    """The places 0 to size - 1 after ``edits`` edits; -1 is another word."""
    even = np.linspace(0, size - 1, edits + 2)[1:-1].round().astype(int)
    places = even if rng.random() < 0.5 else rng.choice(size, edits, replace=False)
    how = rng.integers(0, 4)
    out: list[int] = []
    for k in range(size):
        if k not in places:
            out.append(k)
            continue
        kind = how if how < 3 else rng.integers(0, 3)
        out += ([], [-1], [k, -1])[kind]
    return out


@lru_cache(maxsize=None)
def walks_needed(size: int, edits: int) -> int:
    """The least number of walks that finds ``RECALL`` of simulated passages; 0 if ``MOST_WALKS`` do not."""
    if not edits:
        return 1
    rng = np.random.default_rng([SEED, size, edits])
    run, _ = _run(size, edits)
    windows, owner = [], []
    for trial in range(TRIALS):
        body = _edited(rng, size, edits)
        text = [*[-1] * size, *body, *[-1] * (2 * size)]
        starts = {k - text[k] for k in range(size, size + len(body)) if text[k] >= 0 and all(text[k + x] == text[k] + x for x in range(run))}
        for s in starts:
            windows.append(text[s : s + size])
            owner.append(trial)
    owner = np.array(owner)
    place = np.array(windows)
    part = rng.integers(1, 2**63, size=(TRIALS, size), dtype=np.uint64)
    other = rng.integers(1, 2**63, size=place.shape, dtype=np.uint64)
    words_of = np.where(place >= 0, part[owner[:, None], np.maximum(place, 0)], other)
    found = np.zeros(TRIALS, bool)
    for walk in range(MOST_WALKS):
        same = (lsh_keys(words_of, walk, 1) == lsh_keys(part, walk, 1)[owner]).any(axis=1)
        found[owner[same]] = True
        if found.mean() >= RECALL:
            return walk + 1
    return 0


class Items:
    """A block of benchmark items: their parts, indexed by runs and by LSH keys."""

    def __init__(self, ids: list, texts: list[str | None]):
        data, offsets = _normal(pa.array(texts, pa.string()))
        starts, ends, bounds = words(data, offsets)
        h = word_hashes(data, starts, ends)
        self.ids, self.words = [], []
        for i, a, b in zip(ids, bounds, bounds[1:]):
            if b > a:  # an item without words is in no document
                self.ids.append(i)
                self.words.append(h[a:b])
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.edits = self.size * PERCENT // 100
        of, at, size, edits, symbols = [], [], [], [], []
        for i, w in enumerate(self.words):
            several = -(-len(w) // PART)
            edge = np.arange(several + 1) * len(w) // several
            for a, b in zip(edge.tolist(), edge[1:].tolist()):
                of.append(i)
                at.append(a)
                size.append(b - a)
                edits.append(int(self.edits[i]) // several)
                symbols.append(w[a:b])
        #: By part: item, place in the item, words, edits, surviving runs, walks.
        self.part_item, self.part_at, self.part_size, self.part_edits = (np.array(x, np.int64) for x in (of, at, size, edits))
        shape = [(*_run(n, e), walks_needed(n, e)) for n, e in zip(size, edits)]
        run, self.need, self.walks = (np.array(x, np.int64) for x in (zip(*shape) if shape else ((), (), ())))
        self.runs = {}
        for k in sorted(set(run.tolist())):
            gram, part, off = [], [], []
            for i in np.flatnonzero(run == k):
                g = Rolling(symbols[i]).all(k)
                gram.append(g)
                part.append(np.full(len(g), i))
                off.append(np.arange(len(g)))
            gram, part, off = map(np.concatenate, (gram, part, off))
            order = np.argsort(gram, kind="stable")
            maybe = np.zeros(1 << _FILTER, bool)
            maybe[gram >> U(64 - _FILTER)] = True
            self.runs[k] = gram[order], part[order], off[order], maybe
        #: By part size: walks, sorted keys, and the part of each.
        self.tables = {}
        for n in sorted(set(size)):
            own = np.flatnonzero((self.part_size == n) & (self.walks > 0))
            if len(own):
                walks = int(self.walks[own].max())
                keys = lsh_keys(np.stack([symbols[i] for i in own]), 0, walks)
                order = np.argsort(keys.ravel(), kind="stable")
                self.tables[n] = walks, keys.ravel()[order], np.repeat(own, keys.shape[1])[order]


def _windows(items: Items, h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, part, start) of the windows in which a part may be: enough of its runs on neighbouring diagonals."""
    rolling, found = Rolling(h), [(np.zeros(0, np.int64),) * 3]
    text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for k, (gram, of, off, maybe) in items.runs.items():
        g = rolling.all(k)
        hit = np.flatnonzero(maybe[g >> U(64 - _FILTER)])
        hit = hit[text_of[hit] == text_of[hit + k - 1]]
        lo, hi = np.searchsorted(gram, g[hit], "left"), np.searchsorted(gram, g[hit], "right")
        n = hi - lo
        entry = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = np.repeat(hit, n)
        part, start = of[entry], place - off[entry]
        text = text_of[place]
        order = np.lexsort((start, part, text))
        part, start, text = part[order], start[order], text[order]
        own = np.arange(len(part))
        other = own + items.need[part] - 1
        own, other = own[other < len(part)], other[other < len(part)]
        reach = 2 * items.part_edits[part[own]]
        good = (part[own] == part[other]) & (text[own] == text[other]) & (start[other] - start[own] <= reach)
        # All runs from the first to the last of such a group show where the part may start.
        change = np.zeros(len(part) + 1, np.int64)
        np.add.at(change, own[good], 1)
        np.add.at(change, other[good] + 1, -1)
        keep = np.cumsum(change[:-1]) > 0
        text, part, start = text[keep], part[keep], start[keep]
        if len(part):
            new = np.r_[True, (text[1:] != text[:-1]) | (part[1:] != part[:-1]) | (start[1:] != start[:-1])]
            found.append((text[new], part[new], start[new]))
    text, part, start = (np.concatenate(x) for x in zip(*found))
    return text, part, start


def _candidates(items: Items, h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, start of the whole item) of the pairs that agree in an LSH table."""
    text, part, start = _windows(items, h, bounds)
    size = items.part_size[part]
    whole = (start >= bounds[text]) & (start + size <= bounds[text + 1])
    # Windows over a text's end, and parts for which walks fall short, are verified as they are.
    sure = ~whole | (items.walks[part] == 0)
    found = [(text[sure], part[sure], start[sure])]
    for n, (walks, keys, of) in items.tables.items():
        own = np.flatnonzero(~sure & (size == n))
        at, first = np.unique(start[own], return_index=True)
        where = text[own][first]
        for a in range(0, len(at), 20_000):
            s, t = at[a : a + 20_000], where[a : a + 20_000]
            got = lsh_keys(h[s[:, None] + np.arange(n)], 0, walks)
            lo, hi = np.searchsorted(keys, got.ravel(), "left"), np.searchsorted(keys, got.ravel(), "right")
            row = np.flatnonzero(hi > lo)
            many = (hi - lo)[row]
            entry = np.repeat(lo[row], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            row = np.repeat(row // got.shape[1], many)
            found.append((t[row], of[entry], s[row]))
    text, part, start = (np.concatenate(x) for x in zip(*found))
    return text, items.part_item[part], start - items.part_at[part]


def _regions(items: Items, h: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, first, last): words of a text that hold any passage around a candidate."""
    text, i, start = _candidates(items, h, bounds)
    order = np.lexsort((start, i, text))
    text, i, start = text[order], i[order], start[order]
    edits, size = items.edits[i], items.size[i]
    # The passage starts within the edits of ``start``; those that overlap are verified as one.
    first = np.maximum(start - 2 * edits, bounds[text])
    last = np.minimum(start + size + 2 * edits, bounds[text + 1])
    new = np.r_[True, (i[1:] != i[:-1]) | (text[1:] != text[:-1]) | (first[1:] > last[:-1])][: len(i)]
    at = np.flatnonzero(new)
    if len(at):
        end = np.r_[at[1:], len(i)] - 1
        yield from zip(text[at].tolist(), i[at].tolist(), first[at].tolist(), last[end].tolist())


def find(items: Items, data: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], int]:
    """{(text, item): edits} for all texts of one buffer."""
    starts, ends, bounds = words(data, offsets)
    if not len(starts) or not items.ids:
        return {}
    h = word_hashes(data, starts, ends)
    out: dict[tuple[int, int], int] = {}
    for t, i, a, b in _regions(items, h, bounds):
        if out.get((t, i)) == 0:
            continue
        d, e = distance(items.words[i].tolist(), h[a:b].tolist()), int(items.edits[i])
        if d <= e and d < out.get((t, i), e + 1):
            out[t, i] = d
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Items]:
    """The items in blocks of at most ``BLOCK``."""
    ids, texts = [], []
    for r in benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        ids.append(r.i)
        texts.append(r.t)
        if len(ids) == BLOCK:
            yield Items(ids, texts)
            ids, texts = [], []
    if ids:
        yield Items(ids, texts)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(doc_id, item_id, edits, similarity): one row for each document and item found in it.

    Null or empty texts and items without words are in nothing; whole texts are
    searched, however long. Of several passages that hold an item (ties included)
    the least edits count. Repeated rows of a document or an item give one row.
    Empty tables give no rows; other columns are unused.
    """
    kind = benchmark.schema[item_col].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = None
    for items in _blocks(benchmark, item_col, "text"):
        block = docs.sparkSession.sparkContext.broadcast(items)

        def of(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for b in batches:
                data, offsets = _normal(b.column(1))
                for p, q in pieces(offsets):
                    got = find(block.value, data[offsets[p] : offsets[q]], offsets[p : q + 1] - offsets[p])
                    if not got:
                        continue
                    row = pa.array([p + t for t, _ in got])
                    size = np.array([block.value.size[i] for _, i in got])
                    edits = np.array(list(got.values()))
                    ids = pa.array([block.value.ids[i] for _, i in got], arrow)
                    yield pa.record_batch(
                        [b.column(0).take(row), ids, pa.array(edits.astype(np.int32)), pa.array(1 - edits / size)],
                        names=["doc_id", "item_id", "edits", "similarity"],
                    )

        part = source.mapInArrow(of, f"doc_id long, item_id {kind if arrow != pa.string() else 'string'}, edits int, similarity double")
        found = part if found is None else found.union(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"doc_id long, item_id {kind}, edits int, similarity double")
    return found.groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"), F.max("similarity").alias("similarity"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of ``docs`` without any item, with their own columns, repeated rows as often as they came in."""
    for items in _blocks(benchmark, item_col, "text"):
        block = docs.sparkSession.sparkContext.broadcast(items)

        def of(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for b in batches:
                data, offsets = _normal(b.column(text_col))
                bad = {
                    p + t
                    for p, q in pieces(offsets)
                    for t, _ in find(block.value, data[offsets[p] : offsets[q]], offsets[p : q + 1] - offsets[p])
                }
                yield b.take(pa.array([k for k in range(b.num_rows) if k not in bad], pa.int64()))

        docs = docs.mapInArrow(of, docs.schema)
    return docs
