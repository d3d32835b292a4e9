"""Roles of chat turns, recovered from the transcript, and canonical turns.

A hidden Markov model has a state for each role. A turn is observed through its
speaker marker ("User:", "### Assistant", "<|im_start|>system", none), whether
it opens the conversation, and line features: length, lines, a closing question
mark. Start, transition and observation counts come from all turns whose given
role is known, as grouped counts over the whole table (add-one smoothed);
Viterbi then finds the best roles of every conversation without its given roles.

Conversations are cut into blocks of ``BLOCK`` turns by turn order. A block's
Viterbi pass from every entry state to every exit state is a small max-plus
matrix; these matrices are chained per conversation and each block is decoded
between its known ends, so a conversation with a third of all turns is spread
over many tasks and the path stays exactly the best one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .. import tables as shared

ROLES = ("system", "user", "assistant", "tool")
BLOCK = 256
#: Speaker names and their roles.
SPEAKERS = {
    "system": "system", "developer": "system", "context": "system", "instructions": "system",
    "user": "user", "human": "user", "prompter": "user", "customer": "user", "question": "user", "q": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "gpt": "assistant", "model": "assistant", "agent": "assistant", "answer": "assistant", "a": "assistant",
    "tool": "tool", "function": "tool", "observation": "tool",
}
_NAMES = "|".join(sorted(SPEAKERS, key=len, reverse=True))
_MARKER = re.compile(
    rf"\A\s*(?:<\|im_start\|>\s*(?P<a>{_NAMES})\s*\n|<\|(?P<b>{_NAMES})\|>|\[(?P<c>{_NAMES})\]\s*:?|#{{1,4}}\s*(?P<d>{_NAMES})\s*:?\s*(?:\n|\Z)|\*{{0,2}}(?P<e>{_NAMES})\*{{0,2}}\s*:\*{{0,2}})\s*",
    re.I,
)
_END = re.compile(r"\s*<\|(?:im_end|end)\|>\s*\Z")
_LENGTHS = (40, 120, 300, 700, 1500)
#: Observations: marker (none and the roles), length class, line class, question, opening.
SHAPE = (len(ROLES) + 1, len(_LENGTHS) + 1, 3, 2, 2)


def observe(text: str | None, opening: bool) -> tuple[tuple[int, ...], str]:
    """The observations of one turn, and its text without marker and surrounding space."""
    text = text or ""
    m = _MARKER.match(text)
    marker = 0
    if m:
        marker = 1 + ROLES.index(SPEAKERS[next(g for g in m.groups() if g).lower()])
        text = text[m.end() :]
    text = _END.sub("", text).strip()
    lines = text.count("\n")
    return (marker, sum(len(text) > n for n in _LENGTHS), min(lines, 2), int(text.endswith("?")), int(opening)), text


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        codes, roles, bodies = [], [], []
        for text, role, opening in zip(b.column("text").to_pylist(), b.column("role").to_pylist(), b.column("opening").to_pylist()):
            seen, body = observe(text, opening)
            codes.append(int(np.ravel_multi_index(seen, SHAPE)))
            known = SPEAKERS.get((role or "").strip().lower())
            roles.append(ROLES.index(known) if known else None)
            bodies.append(body)
        yield pa.record_batch(
            [b.column("conv_id"), b.column("turn"), b.column("place"), pa.array(codes, pa.int32()), pa.array(roles, pa.int32()), pa.array(bodies, pa.string())],
            names=["conv_id", "turn", "place", "code", "given", "body"],
        )


def train(turns: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probabilities: start (roles), transitions (roles x roles), observations (roles x codes).

    Features of a turn are taken as independent given the role.
    """
    k, codes = len(ROLES), int(np.prod(SHAPE))
    seen = np.zeros((k, codes))
    for r in turns.where("given is not null").groupBy("given", "code").agg(F.count("*").alias("n")).collect():
        seen[r.given, r.code] = r.n
    steps, start = np.ones((k, k)), np.ones(k)
    order = W.partitionBy("conv_id", "block").orderBy("place")
    inside = turns.withColumn("block", F.floor(F.col("place") / BLOCK)).withColumn("before", F.lag("given").over(order))
    for r in inside.where("given is not null and before is not null").groupBy("before", "given").agg(F.count("*").alias("n")).collect():
        steps[r.before, r.given] += r.n
    for r in turns.where("given is not null and place = 0").groupBy("given").agg(F.count("*").alias("n")).collect():
        start[r.given] += r.n
    emit = np.zeros((k, codes))
    index = np.array(np.unravel_index(np.arange(codes), SHAPE))
    for f, size in enumerate(SHAPE):
        count = np.stack([np.bincount(index[f], weights=seen[r], minlength=size) for r in range(k)]) + 1
        if f == 0:  # a marker names its role even where no training turn has one
            count += np.eye(k, size, 1) * (1 + 0.5 * seen.sum(axis=1, keepdims=True))
        emit += np.log(count / count.sum(axis=1, keepdims=True))[:, index[f]]
    return np.log(start / start.sum()), np.log(steps / steps.sum(axis=1, keepdims=True)), emit


def viterbi(scores: np.ndarray, steps: np.ndarray, last: int | None = None) -> list[int]:
    """The best path through ``scores`` (turns x roles, the entry already in the first), ending in ``last`` if given."""
    best, back = scores[0], []
    for s in scores[1:]:
        through = best[:, None] + steps
        back.append(through.argmax(axis=0))
        best = through.max(axis=0) + s
    path = [int(best.argmax()) if last is None else last]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def transfer(scores: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Best score from each role before a block to each role at its end (max-plus)."""
    best = steps + scores[0]
    for s in scores[1:]:
        best = (best[:, :, None] + steps[None]).max(axis=1) + s
    return best


def _matrices(model):
    def of(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, steps, emit = model.value
        scores = emit[:, pdf.sort_values(["place"])["code"].to_numpy()].T
        return pd.DataFrame({"conv_id": [key[0]], "block": [key[1]], "matrix": [transfer(scores, steps).ravel().tolist()]})

    return of


def _chained(model):
    def of(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        """The roles before each block and at its end on the best path of the whole conversation."""
        start, steps, _ = model.value
        k = len(start)
        pdf = pdf.sort_values("block")
        blocks = np.array(pdf["matrix"].tolist()).reshape(-1, k, k)
        # A virtual role before the first turn whose step to any role is the start probability.
        best, back = (start[:, None] - steps + blocks[0]).max(axis=0), []
        for m in blocks[1:]:
            through = best[:, None] + m
            back.append(through.argmax(axis=0))
            best = through.max(axis=0)
        ends = [int(best.argmax())]
        for b in reversed(back):
            ends.append(int(b[ends[-1]]))
        ends = ends[::-1]
        return pd.DataFrame({"conv_id": key[0], "block": pdf["block"], "entry": [-1, *ends[:-1]], "exit": ends})

    return of


def _decoded(model):
    """Roles of sorted turns; a run of equal (conv_id, block) is one block."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        start, steps, emit = model.value
        key = np.stack([table.column(c).fill_null(-1).to_numpy() for c in ("conv_id", "block")] + [table.column("conv_id").is_null().to_numpy()])
        code, entry, last = (table.column(c).fill_null(-2).to_numpy() for c in ("code", "entry", "exit"))
        edge = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0), True])
        scores = emit.T[code]
        found = np.zeros(len(code), np.int32)
        for x, y in zip(edge[:-1], edge[1:]):
            part = scores[x:y]
            part[0] += start if entry[x] < 0 else steps[entry[x]]
            found[x:y] = viterbi(part, steps, None if last[x] < 0 else int(last[x]))
        out = table.select(["conv_id", "turn", "place", "given", "body"]).append_column("found", pa.array(found))
        return out.combine_chunks().to_batches()[0]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            table = pa.Table.from_batches([b])
            table = table if held is None else pa.concat_tables([held, table])
            if not table.num_rows:
                continue
            ids, blocks = table.column("conv_id").to_pylist(), table.column("block").to_pylist()
            cut = table.num_rows - 1
            while cut and ids[cut - 1] == ids[-1] and blocks[cut - 1] == blocks[-1]:
                cut -= 1  # the last run may go on; it has at most BLOCK turns
            if cut:
                yield solve(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None and held.num_rows:
            yield solve(held)

    return of


def recover(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, place, given, role, rendered): one row for each turn.

    ``given`` is the role the table names, null where it names none that is
    known; ``role`` is Viterbi's, found without it. ``rendered`` is
    ``<|im_start|>role\\ntext<|im_end|>`` with the speaker marker removed. Null
    text counts as empty; rows with a null conversation or turn form a
    conversation, or come first in one. Turns with equal numbers, and repeated
    rows, follow each other by text and role. Other columns are unused.
    """
    spark = conversations.sparkSession
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    turns = _placed(turns)
    schema = "conv_id long, turn long, place long, code int, given int, body string"
    turns = shared.table(turns.withColumn("opening", F.col("place") == 0).mapInArrow(_observed, schema), "turns")
    model = spark.sparkContext.broadcast(train(turns))
    blocks = turns.withColumn("block", F.floor(F.col("place") / BLOCK).cast("long"))
    # Only conversations of several blocks need the blocks' matrices.
    long = blocks.where("block > 0").select(F.col("conv_id").alias("__c")).distinct()
    several = blocks.select("conv_id", "block", "place", "code").join(long, F.col("conv_id").eqNullSafe(F.col("__c")), "left_semi")
    matrices = several.groupBy("conv_id", "block").applyInPandas(_matrices(model), "conv_id long, block long, matrix array<double>")
    ends = matrices.groupBy("conv_id").applyInPandas(_chained(model), "conv_id long, block long, entry int, exit int")
    ends = ends.select(F.col("conv_id").alias("__c"), F.col("block").alias("__b"), "entry", "exit")
    joined = blocks.join(ends, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("block") == F.col("__b")), "left").drop("__c", "__b")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = joined.repartition(parts, "conv_id", "block").sortWithinPartitions("conv_id", "block", "place")
    found = joined.mapInArrow(_decoded(model), "conv_id long, turn long, place long, given int, body string, found int")
    names = F.array(*map(F.lit, ROLES))
    role = F.get(names, F.col("found"))
    rendered = F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), F.col("body"), F.lit("<|im_end|>"))
    return found.select("conv_id", "turn", "place", F.get(names, F.col("given")).alias("given"), role.alias("role"), rendered.alias("rendered"))


def _placed(turns: DataFrame) -> DataFrame:
    """``turns`` with place, a turn's number from 0 in its conversation.

    Counted without gathering a conversation: turns are dealt by conversation
    and range of turn numbers, numbered there, and moved by the ranges' sums.
    """
    spread = turns.withColumn("range", F.floor(F.col("turn") / BLOCK))
    order = W.partitionBy("conv_id", "range").orderBy("turn", "text", "role")
    numbered = spread.withColumn("place", (F.row_number().over(order) - 1).cast("long"))
    sizes = spread.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    before = W.partitionBy("conv_id").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    sizes = sizes.select(F.col("conv_id").alias("__c"), F.col("range").alias("__r"), "before")
    joined = numbered.join(sizes, F.col("conv_id").eqNullSafe(F.col("__c")) & F.col("range").eqNullSafe(F.col("__r")))
    return joined.withColumn("place", F.col("place") + F.col("before")).drop("range", "before", "__c", "__r")
