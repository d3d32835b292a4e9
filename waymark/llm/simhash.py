"""SimHash fingerprints, near-duplicate links and their components.

Fingerprints that differ in at most ``DISTANCE`` = 4 of 64 bits link. Candidate
pairs come from pigeonring filtering: the bits form a ring of ``SEGMENTS`` = 5
segments, and for two linked fingerprints some chain of consecutive segments
keeps, for each of its prefixes of length l, the cumulative difference within
floor(4 * l / 5). Prefix 1 gives an equal segment, prefix 2 at most one
differing bit in the next; the join key is therefore one segment, the next
segment without one bit, and that bit's number (64 keys for a fingerprint).
Pairs that share a key must pass the whole chain before the full Hamming check.

Equal fingerprints are one node, so copies are never expanded. A group that
shares a key is a run of sorted rows; the runs are scanned in shifts, and in
long runs every row is first compared with pivots, so that a dense group of
near copies yields a star and not all its pairs. Only a spanning set of links
leaves a task. Components come from alternating large-star and small-star steps.

Null and empty texts have fingerprint zero. A row with a null id keeps its row
and fingerprint and takes the component of that fingerprint; a fingerprint met
only without an id links nothing, and its component is null. Rows repeated
entirely come out as often as they went in. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .. import tables as shared

DISTANCE, SEGMENTS = 4, 5
WIDTHS = (13, 13, 13, 13, 12)
_STARTS = tuple(sum(WIDTHS[:k]) for k in range(SEGMENTS))
_LANES = np.uint64(0x0101010101010101)
RUN = 64


def _bits(h: np.ndarray) -> int:
    """The bits set in over half of ``h``."""
    n, edges = len(h), np.arange(0, len(h), 255)
    out = 0
    for b in range(8):
        lanes = np.add.reduceat((h >> np.uint64(b)) & _LANES, edges)  # no lane passes 255
        counts = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for k in np.flatnonzero(2 * counts > n):
            out |= 1 << (8 * int(k) + b)
    return out


def fingerprint(text: str | None) -> int:
    """64 bits over the XXH64 (seed 42) of all 4-word shingles, repeats included."""
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    if len(ws) < 4:
        return xxhash.xxh64_intdigest(b" ".join(ws), 42)
    shingles = map(b" ".join, zip(ws, ws[1:], ws[2:], ws[3:]))
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64, len(ws) - 3)
    return _bits(h)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = np.fromiter((fingerprint(x.as_py()) for x in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.record_batch([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row for each row of ``docs``."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(_fingerprints, "doc_id long, fp long")


def _keys(fp: str = "fp") -> str:
    """SQL for the array of a fingerprint's join keys."""
    parts = []
    for i in range(SEGMENTS):
        j = (i + 1) % SEGMENTS
        a = f"(shiftrightunsigned({fp}, {_STARTS[i]}) & {(1 << WIDTHS[i]) - 1}L)"
        b = f"(shiftrightunsigned({fp}, {_STARTS[j]}) & {(1 << WIDTHS[j]) - 1}L)"
        for k in range(WIDTHS[j]):
            parts.append(f"{(i * 16 + k) << 32}L | shiftleft({a}, 13) | ({b} & {(1 << 13) - 1 - (1 << k)}L)")
    return f"array({', '.join(parts)})"


_MASKS = [np.uint64(((1 << WIDTHS[i]) - 1) << _STARTS[i]) for i in range(SEGMENTS)]


def _linked(x: np.ndarray, y: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether pairs pass the chain from segment ``start`` and then the Hamming check."""
    d = x ^ y
    good, total = np.ones(len(d), bool), np.zeros(len(d), np.int64)
    masks = np.array(_MASKS)
    for step in range(SEGMENTS):
        total += np.bitwise_count(d & masks[(start + step) % SEGMENTS])
        good &= total <= DISTANCE * (step + 1) // SEGMENTS
    return good & (np.bitwise_count(d) <= DISTANCE)


def _root(parent: dict[int, int], x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = x = parent[parent[x]]
    return x


def _long_run(fp: np.ndarray, node: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Links that connect a long run as all its links would.

    Rows within reach of a pivot are tied to it; two rows of one pivot need no
    link of their own, so afterwards only rows of different trees are compared.
    """
    parent: dict[int, int] = {}
    out: list[tuple[int, int]] = []
    tree = np.arange(len(fp))
    for k in range(len(fp)):
        # Rows after k that are not yet in k's tree.
        rest = k + 1 + np.flatnonzero(tree[k + 1 :] != tree[k])
        if not len(rest):
            continue
        near = rest[_linked(fp[rest], np.broadcast_to(fp[k], len(rest)), np.full(len(rest), start))]
        for t in np.unique(tree[near]):
            x = near[tree[near] == t][0]
            out.append((int(node[k]), int(node[x])))
            tree[tree == t] = tree[k]
        if (tree == tree[0]).all():
            break
    return out


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside runs of equal keys; the input is sorted by key within the partition."""
    seen_parent: dict[int, int] = {}

    def spanning(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        kept = []
        for a, b in pairs:
            ra, rb = _root(seen_parent, a), _root(seen_parent, b)
            if ra != rb:
                seen_parent[max(ra, rb)] = min(ra, rb)
                kept.append((a, b))
        if len(seen_parent) > 1_000_000:  # forgetting only lets some links out twice
            seen_parent.clear()
        a, b = zip(*kept) if kept else ((), ())
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def within(key: np.ndarray, fp: np.ndarray, node: np.ndarray) -> list[tuple[int, int]]:
        edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        size = np.diff(edge)
        out: list[tuple[int, int]] = []
        for k in np.flatnonzero(size > RUN):
            part = slice(edge[k], edge[k + 1])
            out += _long_run(fp[part], node[part], int(key[edge[k]] >> 36))
        short = np.repeat(size <= RUN, size) & np.repeat(size > 1, size)
        key, fp, node = key[short], fp[short], node[short]
        for s in range(1, min(RUN, len(key))):
            same = np.flatnonzero(key[s:] == key[:-s])
            if not len(same):
                break
            good = same[_linked(fp[same], fp[same + s], key[same] >> 36)]
            out += zip(node[good].tolist(), node[good + s].tolist())
        return out

    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for batch in batches:
        key = batch.column(0).to_numpy(zero_copy_only=False)
        fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        node = batch.column(2).to_numpy(zero_copy_only=False)
        if not len(key):
            continue
        held.append((key, fp, node))
        if key[0] == key[-1] and held[0][0][0] == key[0]:
            continue  # the run goes on
        key, fp, node = (np.concatenate(x) for x in zip(*held))
        cut = int(np.searchsorted(key, key[-1]))
        yield spanning(within(key[:cut], fp[:cut], node[:cut]) if cut else [])
        held = [(key[cut:], fp[cut:], node[cut:])]
    if held:
        yield spanning(within(*(np.concatenate(x) for x in zip(*held))))


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): a set of links between ``nodes`` (node, fp) with the components of all links."""
    keyed = nodes.select(F.explode(F.expr(_keys())).alias("key"), "fp", "node")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartition(parts, "key").sortWithinPartitions("key", "node")
    return dealt.mapInArrow(_links, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) reaches.

    Large-star ties the larger neighbours of every node to its smallest one,
    small-star does the same for the smaller ones; both are a grouped minimum
    and a join, so no neighbourhood is gathered. Every round is written to the
    shared folder, which cuts the lineage.
    """
    edges = shared.table(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        old, edges = edges, shared.table(small.where("u <> v").distinct(), "edges")
        shared.discard(old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
            ).distinct()
        before = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): one row for each row of ``docs``.

    ``component_id`` is the smallest id that links reach from the row, itself
    included; null where only rows without an id are in reach. Texts are taken
    whole, however long; rows with one id (ties) keep their own fingerprints;
    other columns are unused.
    """
    fps = shared.table(fingerprints(docs, id_col, text_col), "fingerprints")
    # A fingerprint's smallest id stands for it.
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = nodes.where("first is not null").select("fp", F.col("first").alias("node"))
    nodes = shared.table(named, "nodes")
    found = components(links(nodes))
    reach = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return fps.join(reach, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _marked(text_col: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(x.as_py()) for x in b.column(b.schema.names.index("row")).field(text_col)), np.uint64, b.num_rows)
            yield b.append_column("fp", pa.array(fp.view(np.int64)))

    return of


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with the columns of ``docs``.

    The row with the smallest id stays; rows without an id come after all others,
    and of rows with one id (repeated rows, or an id that stands on several texts
    of a component) any one stays. Null and empty texts are one component. An
    empty table gives no rows.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("at"))
    schema = T.StructType([*rows.schema.fields, T.StructField("fp", T.LongType())])
    rows = shared.table(rows.mapInArrow(_marked(text_col), schema), "marked")
    # A fingerprint's first row stands for it in the graph; what it is called does not matter.
    nodes = shared.table(rows.groupBy("fp").agg(F.min("at").alias("node")), "nodes")
    reach = nodes.join(components(links(nodes)), "node", "left").select("fp", F.coalesce("component", "node").alias("component"))
    best = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "at"))
    kept = rows.groupBy("fp").agg(best.alias("best")).join(reach, "fp").groupBy("component").agg(F.min("best").alias("best"))
    return rows.join(kept.select(F.col("best.at").alias("at")), "at", "left_semi").select("row.*")
