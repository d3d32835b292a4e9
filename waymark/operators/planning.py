"""Work plans: reasons, shards, assignment, jobs, resuming."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .. import tables

#: Rounds that are written at a time where one generator makes them all.
ROUNDS = 50_000


def first_reason(*tests: tuple[Column, str]) -> Column:
    """The name of the first test that holds, null if none does."""
    out = F.lit(None).cast("string")
    for test, name in reversed(tests):
        out = F.when(test, F.lit(name)).otherwise(out)
    return out


def numbered(df: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name): distinct keys in order, numbered from 0.

    Numbered within ranges of a sort and moved by the ranges' sizes, so no task
    sees all keys.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written, because the bounds of ranges are sampled anew whenever the plan runs.
    keys = df.select(key).distinct()
    dealt = tables.table(keys.repartitionByRange(parts, key).withColumn("__part", F.spark_partition_id()), "keys")
    local = dealt.withColumn("__k", F.row_number().over(W.partitionBy("__part").orderBy(key)) - 1)
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("__part", before.alias("__before"))  # one row for each range
    return local.join(F.broadcast(sizes), "__part").select(key, (F.col("__k") + F.col("__before")).cast("long").alias(name))


def shard(df: DataFrame, key: str, index: int, count: int) -> DataFrame:
    """Rows whose key has rank ``index`` (from 1) modulo ``count`` among the keys present."""
    mine = numbered(df, key, "__rank").where(F.col("__rank") % count == index - 1).select(key)
    return df.join(mine, key, "left_semi")


def slots(df: DataFrame, key: str, workers: int) -> DataFrame:
    """(key, slot): workers dealt in turn over the sorted keys, from 1."""
    return numbered(df, key, "__rank").select(key, (F.col("__rank") % workers + 1).alias("slot"))


def job_plans(assignments: DataFrame, keys: Sequence[str], label: str, ordinal: str) -> DataFrame:
    """One row for each job: labels sorted (repeats kept) and the assignment seen last."""
    return assignments.groupBy(*keys).agg(
        F.array_sort(F.collect_list(label)).alias("labels"), F.count("*").alias("n_labels"), F.max(ordinal).alias("last_ordinal")
    )


def deal(labels: DataFrame, key: str, actors: int) -> DataFrame:
    """(key, round, order): labels in order, ``actors`` to a round."""
    k = numbered(labels, key, "__k")
    return k.select(key, F.floor(F.col("__k") / actors).cast("long").alias("round"), (F.col("__k") % actors).alias("order"))


def round_order(actors: Sequence, seed: int, number: int) -> list:
    """The order of actors in one round, from a generator seeded by seed and round."""
    order = list(actors)
    random.Random(f"{seed}/{number}").shuffle(order)
    return order


def sequential_rounds(actors: Sequence, rounds: int, seed: int) -> Iterator[tuple[int, list]]:
    """Rounds in turn, one generator shuffling one list in place again and again."""
    rng, order = random.Random(seed), list(actors)
    for number in range(rounds):
        rng.shuffle(order)
        yield number, list(order)


def _actors(actors: list[str], seed: int) -> Callable[..., Column]:
    """The actor at a place of a round, as a column function."""

    def of(rounds, places):
        import pandas as pd

        orders = {r: round_order(actors, seed, r) for r in rounds.unique().tolist()}  # rows come in order, so few batches share a round
        return pd.Series([orders[r][k] for r, k in zip(rounds.tolist(), places.tolist())], dtype=object)

    return F.pandas_udf(of, "string")


def assign(labels: DataFrame, key: str, actors: Sequence, seed: int | None = None, sequential: bool = False) -> DataFrame:
    """(key, round, order, actor): actors dealt over the sorted labels, reshuffled each round with a seed.

    Every round's shuffle has a generator of its own, seeded by seed and round, so
    rounds are shuffled where their labels are and nothing is joined. ``sequential``
    gives the order of one generator that shuffles one list round after round; that
    runs on the driver, which writes ``ROUNDS`` rounds at a time and holds no more.
    """
    spark = labels.sparkSession
    names = [str(a) for a in actors]
    dealt = deal(labels, key, len(names))
    if seed is None:
        table = spark.createDataFrame(list(enumerate(names)), "order long, actor string")
        return dealt.join(F.broadcast(table), "order").select(key, "round", "order", "actor")
    if not sequential:
        return dealt.select(key, "round", "order", _actors(names, seed)("round", "order").alias("actor"))
    dealt = tables.table(dealt, "dealt")
    rounds = dealt.agg(F.max("round")).first()[0]
    turns, table = sequential_rounds(names, 0 if rounds is None else rounds + 1, seed), None
    schema = "round long, order long, actor string"
    while block := list(islice(turns, ROUNDS)):
        part = tables.table(spark.createDataFrame([(r, k, a) for r, row in block for k, a in enumerate(row)], schema), "rounds")
        table = part if table is None else table.union(part)
    table = spark.createDataFrame([], schema) if table is None else table
    return dealt.join(table, ["round", "order"]).select(key, "round", "order", "actor")


def holdout(df: DataFrame, key: str, every: int = 8) -> DataFrame:
    """(key, is_test): each ``every``-th of the sorted keys, the first included."""
    return numbered(df, key, "__k").select(key, (F.col("__k") % every == 0).alias("is_test"))


def resume_state(log: DataFrame, keys: Sequence[str], status: str = "status") -> DataFrame:
    """(keys, state): completed once any line says SUCCESS, else failed."""
    good = F.bool_or(F.col(status) == "SUCCESS")
    lines = log.where(F.col(status).isin("SUCCESS", "FAILED"))
    return lines.groupBy(*keys).agg(F.when(good, "completed").otherwise("failed").alias("state"))


#: A line of the run log.
LOG_LINE = r"\[(SUCCESS|FAILED)\]\s+scene=(\S+)\s+actor=(\S+)"


def parse_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """(status, scene, actor) of the lines that report a job."""
    got = lines.select(*(F.regexp_extract(column, LOG_LINE, k).alias(n) for k, n in enumerate(("status", "scene", "actor"), 1)))
    return got.where("status <> ''")


def pending(plans: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    return plans.join(state.where("state = 'completed'"), list(keys), "left_anti")


def resume_from(df: DataFrame, key: str, token: str) -> DataFrame:
    """Keys from the first whose leading number is ``token``'s on; all if none has it."""
    first = df.where(F.regexp_extract(key, r"^0*([0-9]+)", 1) == token.lstrip("0")).agg(F.min(key).alias("__first"))
    return df.crossJoin(F.broadcast(first)).where(f"__first is null or {key} >= __first").drop("__first")


def last_row(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """Of rows with equal keys the one with the largest ordinal."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordinal).alias("__r"))
    return best.select(*keys, "__r.*")


def normalise_ids(df: DataFrame, column: str) -> DataFrame:
    """Distinct ids of comma-separated text: trimmed, without blanks, comments and suffix."""
    one = df.select(F.explode(F.transform(F.split(column, ","), lambda v: F.trim(v))).alias("id"))
    return one.where("id <> '' and not startswith(id, '#')").select(F.regexp_replace("id", r"\.[^.]*$", "").alias("id")).distinct()
