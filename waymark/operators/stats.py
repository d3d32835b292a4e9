"""Descriptive statistics, histograms, counts, coverage, outcomes, progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import tables
from . import ranks

By = Sequence[str | Column]


def describe(df: DataFrame, value: str | Column, by: Sequence[str] = (), prefix: str = "", digits: tuple[int, int] | None = None) -> DataFrame:
    """count, min, max, mean, median, p10, p90 and population stddev (null for fewer than two) of each group.

    Nulls are left out, a group of nulls has count 0. Percentiles are exact and
    come from ranks, so no group's values meet in one task. ``digits`` rounds mean
    and stddev to its first and the percentiles to its second number of places.
    """
    v = F.col(value) if isinstance(value, str) else value
    n = F.count(v)
    sums = df.groupBy(*by).agg(n.alias("count"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.when(n > 1, F.stddev_pop(v)).alias("stddev"))
    shares = ranks.quantiles(df, by, v, {"median": 0.5, "p10": 0.1, "p90": 0.9})
    if by:
        shares = shares.select(*(F.col(c).alias(f"__k{k}") for k, c in enumerate(by)), "median", "p10", "p90")
        same = [F.col(c).eqNullSafe(F.col(f"__k{k}")) for k, c in enumerate(by)]
        out = sums.join(shares, same, "left")
    else:
        out = sums.crossJoin(F.broadcast(shares))  # one row each
    if digits:
        out = out.withColumns({c: F.round(c, digits[0]) for c in ("mean", "stddev")} | {c: F.round(c, digits[1]) for c in ("median", "p10", "p90")})
    return out.select(*by, *(F.col(c).alias(f"{prefix}{c}") for c in ("count", "min", "max", "mean", "median", "p10", "p90", "stddev")))


def threshold_counts(df: DataFrame, value: Column, limits: dict[str, float], by: By = ()) -> DataFrame:
    """How many values reach each limit."""
    return df.groupBy(*by).agg(*(F.count_if(value >= limit).alias(name) for name, limit in limits.items()))


def histogram(df: DataFrame, value: str, bins: int = 60) -> DataFrame:
    """(bin, n): equal widths from minimum to maximum, the last closed; empty bins are left out.

    Where all values are equal, the range is widened by one half to both sides.
    """
    df = tables.table(df.select(value), "binned")  # read for the ends and for the bins
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    ends = ends.select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    place = F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins) + 1
    # One row is joined to all.
    return df.where(F.col(value).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(F.least(place, F.lit(bins)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def top_counts(df: DataFrame, key: str, ordinal: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent keys; ties go to the one met first."""
    counted = df.groupBy(key).agg(F.count("*").alias("n"), F.min(ordinal).alias("first"))
    return counted.orderBy(F.desc("n"), "first", key).limit(n).select(key, "n")


def coverage(expected: DataFrame, actual: DataFrame, group: str, item: str) -> DataFrame:
    """Per group of ``expected``: sizes, shared, missing, extra, and shared over expected."""
    e = expected.select(group, item).distinct().withColumn("e", F.lit(1))
    a = actual.select(group, item).distinct().withColumn("a", F.lit(1))
    both = e.join(a, [group, item], "full")
    out = both.groupBy(group).agg(
        F.count("e").alias("expected"),
        F.count("a").alias("actual"),
        F.count(F.col("e") + F.col("a")).alias("shared"),
        F.count_if(F.col("a").isNull()).alias("missing"),
        F.count_if(F.col("e").isNull()).alias("extra"),
    )
    return out.withColumn("ratio", F.round(F.coalesce(F.try_divide(F.col("shared").cast("double"), F.nullif("expected", F.lit(0))), F.lit(1.0)), 6))


def difference_samples(left: DataFrame, right: DataFrame, group: str, item: str, n: int) -> DataFrame:
    """Per group, the first ``n`` items of ``left`` that ``right`` lacks, sorted and joined by commas."""
    gone = left.select(group, item).distinct().join(right.select(group, item).distinct(), [group, item], "left_anti")
    from pyspark.sql import Window as W

    first = gone.withColumn("r", F.row_number().over(W.partitionBy(group).orderBy(item))).where(F.col("r") <= n)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", item))), lambda s: s[item].cast("string")), ",")
    return first.groupBy(group).agg(joined.alias("items"))


def both_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): ``missing`` from the right, ``extra`` on it."""
    l, r = left.select(key).distinct(), right.select(key).distinct()
    return l.join(r, key, "left_anti").withColumn("side", F.lit("missing")).unionByName(r.join(l, key, "left_anti").withColumn("side", F.lit("extra")))


def outcome(size: Column, least: int) -> Column:
    """skipped without a file, success from ``least`` bytes on, failed below."""
    return F.when(size.isNull(), "skipped").when(size >= least, "success").otherwise("failed")


def bytes_of_mb(mb: float) -> int:
    return max(0, int(mb * 1024 * 1024))


OUTCOMES = ("success", "failed", "skipped")


def outcome_counts(df: DataFrame, by: By, column: str = "outcome") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("expected"), *(F.count_if(F.col(column) == o).alias(o) for o in OUTCOMES))


def flags(*tests: tuple[Column, str]) -> Column:
    """Names of the tests that hold, in order."""
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for test, name in tests)))


def stage_ratios(df: DataFrame, stage: str, seconds: str) -> DataFrame:
    """(stage, seconds, ratio): each stage's share of the time of all; 0 without any time."""
    from pyspark.sql import Window as W

    sums = df.groupBy(stage).agg(F.sum(seconds).alias("seconds"))
    share = F.coalesce(F.try_divide(F.col("seconds"), F.nullif(F.sum("seconds").over(W.partitionBy(F.lit(1))), F.lit(0.0))), F.lit(0.0))
    return sums.select(stage, F.round("seconds", 6).alias("seconds"), F.round(share, 6).alias("ratio"))


def progress(done: DataFrame, total_paths: int, paths: Column, seconds: Column) -> DataFrame:
    """One row: jobs and paths done, share, mean seconds a path, seconds left."""
    out = done.agg(F.count("*").alias("jobs"), F.coalesce(F.sum(paths), F.lit(0)).alias("paths"), F.coalesce(F.sum(seconds), F.lit(0.0)).alias("seconds"))
    mean = F.try_divide(F.col("seconds"), F.nullif("paths", F.lit(0)))
    return out.select(
        "jobs",
        "paths",
        F.round("seconds", 6).alias("seconds"),
        F.round(F.col("paths") / F.lit(float(total_paths)) if total_paths else F.lit(1.0), 6).alias("share"),
        F.round(mean, 6).alias("mean_seconds"),
        F.round(mean * F.greatest(F.lit(total_paths) - F.col("paths"), F.lit(0)), 6).alias("eta_seconds"),
    )
