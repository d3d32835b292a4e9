"""Removal of long word passages that an earlier document already has.

A window is ``WINDOW`` consecutive words. A window's anchor is the leftmost
least hash among its runs of ``GRAM`` words, so equal windows have equal
anchors, and all windows of one anchor form one span of consecutive windows.

Pass 1 counts anchors in count-min sketches, one for each partition (saturated
at two, sparse), which merge by addition into a bitmap of the cells that were
counted twice or more. A sketch only overestimates, so every window that occurs
twice has an anchor estimated repeated. Pass 2 reads the texts again and sends
only the spans of such anchors on; anchors, and where an anchor has differing
spans its windows, are then grouped exactly (by 64-bit anchor hash together
with a 64-bit hash of the span or window). Estimates decide only what is sent.
Grouping is by minimum with partial sums before the shuffle, and the joins back
are plain sort-merge joins that adaptive execution splits, so an anchor of a
third of all rows does not meet in one task.

The sketch's size follows from the texts' bytes: some ``CELLS`` cells for each span
to be expected, at most 2**``MOST_BITS`` in each of two rows, which bounds what is
broadcast (64 MB). Beyond that it fills, more spans pass and the result stays the
same. Hashes stand for words throughout: what is removed agrees in 96 bits or more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .. import tables as shared
from .wordhash import Rolling, U, buffers, mix, pieces, word_hashes, words

WINDOW, GRAM = 50, 25
MOST_BITS, BLOCK, CELLS = 28, 16, 8
#: Bytes of text for each span, about: a word has some six, and anchors change every 13 words.
SPAN_BYTES = 80
_ROWS = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _cells(anchor: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(anchor ^ U(_ROWS[row])) >> U(64 - bits)).astype(np.int64)


class _Spans:
    """The spans of a piece of texts: anchor, text, first window, windows, and word hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
        starts, ends, bounds = words(data, offsets)
        size = np.diff(bounds)
        n = len(starts)
        last = np.repeat(bounds[1:], size)
        self.rolling = Rolling(word_hashes(data, starts, ends))
        windows = np.flatnonzero(np.arange(n) + window <= last)
        if not len(windows):
            self.first = self.count = self.text = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, U)
            return
        value = self.rolling.all(gram)
        place = np.arange(len(value))
        width, need = 1, window - gram + 1
        while width < need:
            step = min(width, need - width)
            left = value[:-step] <= value[step:]
            place = np.where(left, place[:-step], place[step:])
            value = np.minimum(value[:-step], value[step:])
            width += step
        place = place[windows]
        text = np.repeat(np.arange(len(size)), size)[windows]
        new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
        self.first, self.text = windows[new], text[new]
        self.count = np.diff(np.r_[new, len(windows)])
        self.anchor = value[windows[new]]
        self.local = self.first - bounds[self.text]


def _sketch(window: int, gram: int, bits: int) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[list[np.ndarray]] = [[], []]
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for a, b in pieces(offsets):
                spans = _Spans(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], window, gram)
                for row in range(2):
                    got[row].append(_cells(spans.anchor, row, bits).astype(np.uint32))
        yield from _sparse(got, 2)

    return of


def _sparse(got: list[list[np.ndarray]], most: int) -> Iterator[pa.RecordBatch]:
    """A partition's sketch, by row and block: the cells it counted, each up to ``most`` times."""
    for row, found in enumerate(got):
        cells = np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint32)
        cells = cells[np.r_[np.ones(most, bool), cells[most:] != cells[:-most]][: len(cells)]]
        block = (cells >> BLOCK).astype(np.int64)
        edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1]][: len(block)])
        low = (cells & ((1 << BLOCK) - 1)).astype(np.uint16)
        parts = [x.tobytes() for x in np.split(low, edge[1:])] if len(edge) else []
        yield pa.record_batch([pa.array((row << 32 | block[edge]).tolist(), pa.int64()), pa.array(parts, pa.binary())], names=["part", "cells"])


def _merge(least: int) -> Callable:
    def of(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The bitmap of one block's cells counted at least ``least`` times."""
        counts = np.zeros(1 << BLOCK, np.uint8)
        for pdf in parts:
            for cells in pdf["cells"]:
                found = np.bincount(np.frombuffer(cells, np.uint16), minlength=1 << BLOCK)
                counts = np.minimum(counts + np.minimum(found, 2), 2).astype(np.uint8)
        yield pd.DataFrame({"part": [key[0]], "cells": [np.packbits(counts >= least).tobytes()]})

    return of


def _bitmaps(sparse: DataFrame, rows: int, least: int, bits: int) -> list[np.ndarray]:
    """For each row of the merged sketches, the bitmap (2**bits / 8 bytes) of cells counted ``least`` times."""
    maps = [np.zeros(max(1 << bits, 1 << BLOCK) // 8, np.uint8) for _ in range(rows)]
    size = (1 << BLOCK) // 8
    merged = sparse.groupBy("part").applyInPandas(_merge(least), "part long, cells binary")
    for part, cells in merged.collect():  # rows * 2**bits / 8 bytes
        at = (part & 0xFFFFFFFF) * size
        maps[part >> 32][at : at + size] = np.frombuffer(cells, np.uint8)
    return maps


def repeated_cells(texts: DataFrame, window: int, gram: int, bits: int) -> list[np.ndarray]:
    """Both rows of the merged sketch: the cells counted twice."""
    return _bitmaps(texts.mapInArrow(_sketch(window, gram, bits), "part long, cells binary"), 2, 2, bits)


def _anchor_cells(anchors: DataFrame, bits: int) -> list[np.ndarray]:
    """A bitmap of the cells of ``anchors`` (anchor)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [_cells(b.column(0).to_numpy(zero_copy_only=False).view(U), 0, bits).astype(np.uint32) for b in batches]
        yield from _sparse([got], 1)

    return _bitmaps(anchors.mapInArrow(of, "part long, cells binary"), 1, 1, bits)


def _in(maps: list[np.ndarray], anchor: np.ndarray, bits: int) -> np.ndarray:
    """Which anchors have their cell set in every row."""
    keep = np.ones(len(anchor), bool)
    for row, bitmap in enumerate(maps):
        cell = _cells(anchor, row, bits)
        keep &= (bitmap[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
    return keep


def _spans(maps, window: int, gram: int, bits: int) -> Callable:
    names = ["anchor", "span", "doc_id", "tkey", "first", "hashes"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            ids, keys = batch.column(0), batch.column(1)
            for a, b in pieces(offsets):
                s = _Spans(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], window, gram)
                keep = np.flatnonzero(_in(maps.value, s.anchor, bits))
                if not len(keep):
                    continue
                first, count = s.first[keep], s.count[keep]
                span = s.rolling.at(first, first + count + window - 1) + count.astype(U)
                edge = np.r_[0, np.cumsum(count)]
                each = np.repeat(first - edge[:-1], count) + np.arange(edge[-1])
                hashes = s.rolling.at(each, each + window)
                row = pa.array(s.text[keep] + a)
                yield pa.record_batch(
                    [
                        pa.array(s.anchor[keep].view(np.int64)),
                        pa.array(span.view(np.int64)),
                        ids.take(row),
                        keys.take(row),
                        pa.array(s.local[keep].astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(hashes.view(np.int64))),
                    ],
                    names=names,
                )

    return of


def sketch_bits(texts: DataFrame) -> int:
    """The sketch's size for ``texts`` (text)."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(BLOCK, min(MOST_BITS, (size * CELLS // SPAN_BYTES).bit_length()))


def repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bits: int | None = None) -> DataFrame:
    """(doc_id, tkey, a, b): words a to b-1 of a text that windows of an earlier document cover.

    ``docs`` has doc_id, tkey (a hash of the text) and text.
    """
    spark = docs.sparkSession
    bits = bits or sketch_bits(docs)
    maps = spark.sparkContext.broadcast(repeated_cells(docs.select("text"), window, gram, bits))
    found = docs.where("doc_id is not null").select("doc_id", "tkey", "text")
    found = found.mapInArrow(
        _spans(maps, window, gram, bits), "anchor long, span long, doc_id long, tkey int, first int, hashes array<long>"
    )
    found = shared.table(found, "spans")
    anchors = found.groupBy("anchor").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), (F.min("span") == F.max("span")).alias("one")
    )
    anchors = shared.table(anchors.where("low < high").select("anchor", "low", "one"), "anchors")
    # All spans of an anchor are equal: the smallest document has every window.
    size = F.size("hashes").cast("int").alias("n")
    whole = found.select("anchor", "doc_id", "tkey", "first", size).join(anchors.where("one"), "anchor").where("doc_id > low")
    whole = whole.select("doc_id", "tkey", F.col("first").alias("a"), (F.col("first") + F.col("n") + window - 1).alias("b"))
    # Spans differ: the windows of such anchors (a bitmap may add a few others) are grouped one by one.
    mixed = spark.sparkContext.broadcast(_anchor_cells(anchors.where("not one").select("anchor"), bits))
    each = found.select("anchor", "doc_id", "tkey", "first", "hashes").mapInArrow(_mixed(mixed, bits), "w long, side int, doc_id long, tkey int, a int")
    least = each.groupBy("w", "side").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    # Written, so that the join below has plain exchanges on both sides, which can be split.
    least = shared.table(least.where("least < most").drop("most"), "windows")
    single = each.join(least, ["w", "side"]).where("doc_id > least")
    return whole.union(single.select("doc_id", "tkey", "a", (F.col("a") + window).alias("b")))


def _mixed(maps, bits: int) -> Callable:
    """The windows of spans whose anchor is in the bitmap; 32 bits of the anchor join the window's 64."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            anchor = b.column(0).to_numpy(zero_copy_only=False)
            keep = np.flatnonzero(_in(maps.value, anchor.view(U), bits))
            b = b.take(pa.array(keep))
            lists = b.column(4)
            n = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(n)), n)
            start = lists.offsets.to_numpy()[:-1].astype(np.int64)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            first = b.column(3).to_numpy(zero_copy_only=False)
            yield pa.record_batch(
                [
                    pa.array(lists.values.to_numpy(zero_copy_only=False)[start[row] + at]),
                    pa.array(anchor[keep][row].astype(np.int32)),
                    b.column(1).take(pa.array(row)),
                    b.column(2).take(pa.array(row)),
                    pa.array((first[row] + at).astype(np.int32)),
                ],
                names=["w", "side", "doc_id", "tkey", "a"],
            )

    return of


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the shuffle."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for b in batches:
        texts = pa.array([pack((x.as_py() or "").encode()) for x in b.column(2)], pa.binary())
        yield pa.record_batch([b.column(0), b.column(1), texts], names=["doc_id", "tkey", "packed"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        texts, spans = batch.column("packed"), batch.column("ranges")
        kept, removed, words_n = [], [], []
        for k in range(batch.num_rows):
            ws = unpack(texts[k].as_py()).split()
            out, at = [], 0
            for r in sorted((x["a"], x["b"]) for x in spans[k].as_py() or ()):
                out += ws[at : r[0]]
                at = max(at, r[1])
            out += ws[at:]
            words_n.append(len(ws))
            removed.append(len(ws) - len(out))
            kept.append(b" ".join(out).decode())
        yield pa.record_batch(
            [batch.column("row"), pa.array(words_n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            names=["row", "n_words", "n_removed", "kept"],
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, bits: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): one row for each row of ``docs``.

    ``kept`` holds the words that stay, joined by one space. Null text counts as
    empty. Texts are taken whole, however long. A row without an id neither
    removes nor loses words. Rows with equal id (ties) never remove each other's
    words; an entirely repeated row comes out as often as it went in. An empty
    table gives no rows. Other columns are unused.
    """
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tkey"), F.col(text_col).alias("text")
    ).withColumn("tkey", F.shiftright("tkey", 32).cast("int"))
    ranges = repeats(source, window, gram, bits)
    ranges = ranges.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    packed = source.mapInArrow(_packed, "doc_id long, tkey int, packed binary")
    joined = packed.join(ranges, ["doc_id", "tkey"], "left")
    out = joined.select(F.col("doc_id").alias("row"), "packed", "ranges").mapInArrow(_kept, "row long, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("row", "doc_id")


def kept_digest(kept: DataFrame) -> DataFrame:
    """The digest columns of the query: doc_id, n_words, n_removed, kept_sha256."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def kept_of(words_in: list[bytes], covered: list[bool]) -> str:
    """SHA-256 of the words that stay, for tests."""
    return hashlib.sha256(b" ".join(w for w, c in zip(words_in, covered) if not c)).hexdigest()
