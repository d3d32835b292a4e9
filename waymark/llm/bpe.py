"""Byte-level BPE, encoding and decoding.

Each short word (a match of the pre-tokenizer's pattern) is a contiguous row of
parts with a row of ranks, one for each pair of adjacent parts. While the
smallest rank of a row is finite, its leftmost boundary is deleted, the two
parts become one, and the ranks of the new part with its neighbours are looked
up again. Rows of similar length are handled together as NumPy matrices, so one
scan for the minimum serves thousands of words; results are kept in a bounded
cache for the words that follow.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

#: The pre-tokenizer's pattern; a fixed value of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE, CHUNK, LONG = 50_000, 1 << 19, 256
_NONE = np.int32(2**31 - 1)


def default_path() -> str:
    """The public vocabulary's place on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes: printable ones for themselves, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Codec:
    """The vocabulary of a tokenizer file, ready to encode and decode."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        letters = _byte_letters()
        vocab = model["model"]["vocab"]
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.piece = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if t not in special}
        self.piece |= {i: t.encode() for t, i in special.items()}
        self.special = special
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.words = regex.compile(PATTERN)
        self.of_byte = np.zeros(256, np.int32)
        for c, b in letters.items():
            self.of_byte[b] = vocab[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        pair = np.array([vocab[a] << 20 | vocab[b] for a, b in merges], np.int64)
        into = np.array([vocab[a + b] for a, b in merges], np.int32)
        order = np.argsort(pair)
        self.pair, self.rank, self.into = pair[order], order.astype(np.int32), into
        self.ids: dict[str, str] = {}
        self.bytes: dict[str, bytes] = {}

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``_NONE`` where there is none; negative parts are padding."""
        key = a.astype(np.int64) << 20 | b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[at] == key) & (a >= 0) & (b >= 0), self.rank[at], _NONE)

    def _merge(self, parts: np.ndarray, size: np.ndarray) -> None:
        """Merge all rows of ``parts`` in place; ``size`` is each row's number of parts."""
        width = parts.shape[1]
        live = np.flatnonzero(size > 1)
        if width < 2 or not len(live):
            return
        row = parts[live]
        ranks = np.full(row.shape, _NONE, np.int32)
        ranks[:, :-1] = self._ranks(row[:, :-1], row[:, 1:])
        place = np.arange(width)
        while True:
            at = ranks.argmin(axis=1)
            low = ranks[np.arange(len(at)), at]
            more = low < _NONE
            if not more.all():
                done = ~more
                parts[live[done]] = row[done]
                live, row, ranks, at, low = live[more], row[more], ranks[more], at[more], low[more]
                if not len(live):
                    return
            k = np.arange(len(live))
            row[k, at] = self.into[low]
            # Delete the boundary: everything right of it moves one place left.
            source = np.minimum(place + (place > at[:, None]), width - 1)
            row = np.take_along_axis(row, source, axis=1)
            row[:, -1] = -1
            ranks = np.take_along_axis(ranks, np.minimum(place + (place >= at[:, None]), width - 1), axis=1)
            ranks[:, -1] = _NONE
            size[live] -= 1
            # Refresh the ranks with both neighbours.
            right = np.minimum(at + 1, width - 1)
            ranks[k, at] = np.where(at + 1 < width, self._ranks(row[k, at], row[k, right]), _NONE)
            has = at > 0
            ranks[k[has], at[has] - 1] = self._ranks(row[k[has], at[has] - 1], row[k[has], at[has]])

    def _long(self, word: bytes) -> list[int]:
        """The ids of one long word: the same merges, with a heap instead of scans."""
        parts = self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        left, right = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        ranks = self._ranks(np.array(parts[:-1]), np.array(parts[1:]))
        heap = [(int(r), k, parts[k], parts[k + 1]) for k, r in enumerate(ranks) if r < _NONE]
        heapq.heapify(heap)
        while heap:
            r, k, a, b = heapq.heappop(heap)
            j = right[k]
            if j < 0 or parts[k] != a or parts[j] != b:
                continue  # one of the two was merged meanwhile
            parts[k], parts[j] = int(self.into[r]), -1
            right[k] = right[j]
            if right[k] >= 0:
                left[right[k]] = k
            for x, y in ((left[k], k), (k, right[k])):
                if x >= 0 and y >= 0:
                    r = int(self._ranks(np.array(parts[x : x + 1]), np.array(parts[y : y + 1]))[0])
                    if r < _NONE:
                        heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each short word."""
        length = np.array([len(w) for w in words], np.int64)
        out: list[list[int]] = [[]] * len(words)
        order = np.argsort(length, kind="stable")
        while len(order) and length[order[-1]] > LONG:
            out[order[-1]] = self._long(words[order[-1]])
            order = order[:-1]
        first = 0
        while first < len(order):
            low = max(8, int(length[order[first]]))
            last = int(np.searchsorted(length[order], low * 5 // 4, "right"))
            last = max(first + 1, min(last, first + max(1, (1 << 19) // low)))
            rows = order[first:last]
            width = int(length[rows[-1]])
            parts = np.full((len(rows), width), -1, np.int32)
            size = length[rows].copy()
            flat = self.of_byte[np.frombuffer(b"".join([words[k] for k in rows]), np.uint8)]
            parts[np.arange(width) < size[:, None]] = flat
            self._merge(parts, size)
            for k, ids, n in zip(rows.tolist(), parts.tolist(), size.tolist()):
                out[k] = ids[:n]
            first = last
        return out

    def _learn(self, seen: set[str]) -> None:
        if len(self.ids) > CACHE:
            keep = seen & self.ids.keys()
            self.ids = {w: self.ids[w] for w in keep}
            self.bytes = {w: self.bytes[w] for w in keep}
        new = [w for w in seen if w not in self.ids]
        piece = self.piece
        for w, ids in zip(new, self.encode_words([w.encode() for w in new])):
            self.ids[w] = ",".join(map(str, ids))
            self.bytes[w] = b"".join([piece[i] for i in ids])

    def _cut(self, text: str) -> list[str]:
        """Short words; special tokens stand alone, with a zero byte before that no word has there."""
        if self.split is None or not any(t in text for t in self.special):
            return self.words.findall(text)
        out: list[str] = []
        for part in self.split.split(text):
            if part in self.special:
                out.append("\0" + part)
                if out[-1] not in self.ids:
                    self.ids[out[-1]] = str(self.special[part])
                    self.bytes[out[-1]] = self.piece[self.special[part]]
            else:
                out += self.words.findall(part)
        return out

    def texts(self, texts: Iterable[str | None]) -> Iterator[tuple[str, bytes]]:
        """For each text, its ids as decimals joined by commas and the bytes of its decoded ids."""
        chunk: list[str] = []
        held = 0
        for text in texts:
            chunk.append(text or "")
            held += len(chunk[-1])
            if held >= CHUNK:
                yield from self._chunk(chunk)
                chunk, held = [], 0
        yield from self._chunk(chunk)

    def _chunk(self, chunk: list[str]) -> Iterator[tuple[str, bytes]]:
        cut = [self._cut(t) for t in chunk]
        specials = {"\0" + t for t in self.special}
        self._learn(set().union(*cut) - specials)
        for t, i in self.special.items():
            self.ids["\0" + t], self.bytes["\0" + t] = str(i), self.piece[i]
        for ws in cut:
            yield ",".join(map(self.ids.__getitem__, ws)), b"".join(map(self.bytes.__getitem__, ws))

    def encode(self, text: str) -> list[int]:
        ids, _ = next(self._chunk([text]))
        return [int(i) for i in ids.split(",")] if ids else []

    def decode(self, ids: Iterable[int]) -> str:
        """Ids outside the vocabulary are left out; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(self.piece.get(i, b"") for i in ids).decode("utf-8", "replace")


#: The codec of this process, by the digest of its file.
_codecs: dict[str, Codec] = {}


def _kept_codec(digest: str, spec) -> Codec:
    """This process's codec. A Python worker builds one and keeps it for all its tasks."""
    if digest not in _codecs:
        _codecs.clear()
        _codecs[digest] = Codec(spec.value)
    return _codecs[digest]


def _codec(docs: DataFrame, path: str | None):
    """The tokenizer file's text is read on the driver and sent out once (about 2 MB)."""
    with open(path or default_path(), encoding="utf-8") as f:
        text = f.read()
    spec = docs.sparkSession.sparkContext.broadcast(text)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return lambda: _kept_codec(digest, spec)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids): the ids of every text; null counts as empty."""
    codec = _codec(docs, path)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [[int(i) for i in s.split(",")] if s else [] for s, _ in codec().texts(x.as_py() for x in b.column(1))]
            yield pa.record_batch([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(of, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(doc_id, text): the text of every row of ids; null counts as empty."""
    codec = _codec(encoded, path)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [codec().decode(x.as_py() or ()) for x in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("t")).mapInArrow(of, "doc_id long, text string")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): one row for each row of ``docs``.

    Null text counts as empty; an empty text has no ids and both digests are of
    nothing. Texts are encoded whole, in one pass with their decoding. Ids and
    repeated rows pass unchanged, other columns are unused.
    """
    codec = _codec(docs, path)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, ids, back = [], [], []
            for s, raw in codec().texts(x.as_py() for x in b.column(1)):
                n.append(s.count(",") + 1 if s else 0)
                ids.append(hashlib.sha256(s.encode()).hexdigest())
                text = raw.decode("utf-8", "replace")
                back.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.record_batch(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(back)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return source.mapInArrow(of, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
