"""Paths as rows of points: lengths, cleaning, sampling, alignment, positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import scalar as S
from . import ranks


def segments(points: DataFrame, path: Sequence[str], order: str = "i") -> DataFrame:
    """``points`` with seg, the distance to the point before (null at the first)."""
    w = W.partitionBy(*path).orderBy(order)
    return points.withColumn("seg", F.hypot(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)))


def metrics(points: DataFrame, path: Sequence[str], order: str = "i") -> DataFrame:
    """Length, displacement, tortuosity and estimated frames of paths with two usable points."""
    usable = points.where("x is not null and y is not null")
    ends = segments(usable, path, order).groupBy(*path).agg(
        F.count("*").alias("keypoints"),
        F.sum("seg").alias("length"),
        F.hypot(F.max_by("x", order) - F.min_by("x", order), F.max_by("y", order) - F.min_by("y", order)).alias("displacement"),
    )
    return ends.where("keypoints >= 2").select(
        *path,
        "keypoints",
        F.round("length", 6).alias("length"),
        F.round("displacement", 6).alias("displacement"),
        F.round(S.tortuosity("length", "displacement"), 6).alias("tortuosity"),
        F.round(S.estimated_frames("length"), 6).alias("frames"),
    )


def failures(points: DataFrame, path: Sequence[str]) -> DataFrame:
    """Paths with fewer than two usable points, with the reason."""
    usable = F.count_if(F.col("x").isNotNull() & F.col("y").isNotNull())
    counted = points.groupBy(*path).agg(usable.alias("usable"))
    return counted.where("usable < 2").withColumn("reason", F.lit("fewer than 2 usable points"))


def dedupe(points: DataFrame, path: Sequence[str], eps: float, order: str = "i") -> DataFrame:
    """Points further than ``eps`` from the last point kept; the first is always kept.

    The rule depends on what was kept, so each path is one fold over its
    ordered points; paths are independent and bounded by their own length.
    """
    row = F.struct(order, "x", "y")
    arrays = points.groupBy(*path).agg(F.array_sort(F.collect_list(row)).alias("__points"))
    far = lambda kept, p: F.hypot(p["x"] - F.element_at(kept, -1)["x"], p["y"] - F.element_at(kept, -1)["y"]) > eps
    kept = F.aggregate(
        F.slice("__points", 2, F.greatest(F.size("__points") - 1, F.lit(0))),
        F.slice("__points", 1, 1),
        lambda acc, p: F.when(far(acc, p), F.concat(acc, F.array(p))).otherwise(acc),
    )
    return arrays.select(*path, F.inline(kept).alias(order, "x", "y"))


def stride(points: DataFrame, path: Sequence[str], every: int, order: str = "i") -> DataFrame:
    """Every ``every``-th point and the last; all points of paths with two or fewer."""
    w = W.partitionBy(*path)
    numbered = points.withColumns({"k": F.row_number().over(w.orderBy(order)) - 1, "n": F.count("*").over(w)})
    keep = (F.col("k") % max(every, 1) == 0) | (F.col("k") == F.col("n") - 1) | (F.col("n") <= 2)
    return numbered.where(keep).drop("k", "n")


def uniform_sample(df: DataFrame, group: Sequence[str], order: str, k: int) -> DataFrame:
    """At most ``k`` rows of each group, evenly spaced from the first; all for k of 0 or beyond the size.

    Groups may be of any size; rows are counted over sort ranges. Null groups are left out.
    """
    if k <= 0:
        return df
    ranked = ranks.placed(df, group, [order], "r")
    sizes = ranked.groupBy(*group).agg(F.count("*").alias("n"))
    numbered = ranked.join(sizes, list(group))
    step = F.greatest(F.floor(F.col("n") / k), F.lit(1))
    return numbered.where((F.col("n") <= k) | ((F.col("r") % step == 0) & (F.col("r") / step < k))).drop("r", "n")


def affine_fit(points: DataFrame, path: Sequence[str], target_x: str, target_y: str) -> DataFrame:
    """Least squares target = a * x + b for both axes; identity for one point or no spread."""

    def fit(v: str, m: str) -> tuple:
        n, sv, sm = F.count("*"), F.sum(v), F.sum(m)
        denominator = n * F.sum(F.col(v) * F.col(v)) - sv * sv
        slope = (n * F.sum(F.col(v) * F.col(m)) - sv * sm) / F.when(F.abs(denominator) < 1e-8, F.lit(None)).otherwise(denominator)
        return slope, sm, sv, n

    (ax, mx, vx, n), (ay, my, vy, _) = fit("x", target_x), fit("y", target_y)
    df = points.groupBy(*path).agg(n.alias("n"), ax.alias("ax"), ((mx - ax * vx) / n).alias("bx"), ay.alias("ay"), ((my - ay * vy) / n).alias("by"))
    one, zero = F.lit(1.0), F.lit(0.0)
    alone = F.col("n") < 2
    pick = lambda slope, c, neutral: F.when(alone | F.col(slope).isNull(), neutral).otherwise(F.col(c))
    return df.select(*path, "n", pick("ax", "ax", one).alias("ax"), pick("ax", "bx", zero).alias("bx"), pick("ay", "ay", one).alias("ay"), pick("ay", "by", zero).alias("by"))


def cumulative(points: DataFrame, path: Sequence[str], order: str = "i", least: float = 1e-6) -> DataFrame:
    """``points`` with c, the length up to them; points no further than ``least`` from the one before are left out."""
    w = W.partitionBy(*path).orderBy(order)
    real = segments(points, path, order).where(f"seg is null or seg > {least}")
    total = F.sum(F.coalesce("seg", F.lit(0.0))).over(w.rowsBetween(W.unboundedPreceding, 0))
    return real.withColumn("c", total).drop("seg")


def position_at(points: DataFrame, wanted: DataFrame, path: Sequence[str], order: str = "i") -> DataFrame:
    """``wanted`` (path, d) with x and y at length d, extrapolated beyond both ends.

    Paths and distances meet in one equi-join on the path; each segment carries
    the range of distances it answers for, so a distance matches one segment.
    """
    c = cumulative(points, path, order)
    w = W.partitionBy(*path).orderBy("c")
    ahead = {f"{v}2": F.lead(v).over(w) for v in ("c", "x", "y")}
    seg = c.select(*path, "c", "x", "y").withColumns(ahead).where("c2 is not null")
    is_first, is_last = F.lag("c").over(w).isNull(), F.lead("c").over(w).isNull()
    seg = seg.withColumns(
        {"lo": F.when(is_first, F.lit(float("-inf"))).otherwise(F.col("c")), "hi": F.when(is_last, F.lit(float("inf"))).otherwise(F.col("c2"))}
    )
    t = (F.col("d") - F.col("c")) / (F.col("c2") - F.col("c"))
    met = wanted.join(seg, list(path)).where("d >= lo and d < hi")
    return met.select(*path, "d", (F.col("x") + t * (F.col("x2") - F.col("x"))).alias("x"), (F.col("y") + t * (F.col("y2") - F.col("y"))).alias("y"))
