"""Frame plans: camera and walker along a path, directions, animation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .paths import cumulative

TOLERANCE = 1e-6


def follow_plan(points: DataFrame, path: Sequence[str], follow: float, order: str = "i") -> DataFrame:
    """(path, frame, camera, person): distances of both; ends with the first frame whose camera is as far as it goes.

    The camera stays ``follow`` behind the path's end, the walker is ``follow``
    ahead of the camera and stops at the end.
    """
    w = W.partitionBy(*path)
    c = cumulative(points, path, order)
    c = c.withColumn("total", F.max("c").over(w))
    c = c.withColumn("most", F.greatest(F.col("total") - follow, F.lit(0.0)))
    c = c.withColumn("camera", F.least("c", "most")).withColumn("hit", (F.col("camera") >= F.col("most") - TOLERANCE).cast("int"))
    earlier = F.coalesce(F.sum("hit").over(w.orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    c = c.withColumn("earlier", earlier).withColumn("frame", F.row_number().over(w.orderBy(order)) - 1).where("earlier = 0")
    return c.select(*path, F.col("frame").cast("long").alias("frame"), "camera", F.least(F.col("camera") + follow, F.col("total")).alias("person"))


def frame_count(points: DataFrame, path: Sequence[str], follow: float, order: str = "i") -> DataFrame:
    return follow_plan(points, path, follow, order).groupBy(*path).agg(F.count("*").alias("frames"))


def lag_plan(points: DataFrame, path: Sequence[str], lag: int, order: str = "i") -> DataFrame:
    """(path, person, camera): the walker from point ``lag`` on, the camera ``lag`` points behind."""
    w = W.partitionBy(*path).orderBy(order)
    k = points.withColumn("person", (F.row_number().over(w) - 1).cast("long"))
    return k.where(F.col("person") >= lag).select(*path, "person", F.greatest(F.col("person") - lag, F.lit(0)).alias("camera"))


def lead_plan(points: DataFrame, path: Sequence[str], lead: int, order: str = "i") -> DataFrame:
    """(path, camera, person): a frame for each point, the walker ``lead`` points ahead, waiting at the last."""
    w = W.partitionBy(*path)
    k = points.withColumns({"camera": (F.row_number().over(w.orderBy(order)) - 1).cast("long"), "n": F.count("*").over(w)})
    return k.select(*path, "camera", F.least(F.col("camera") + lead, F.col("n") - 1).alias("person"))


def between_points(points: DataFrame, plan: DataFrame, path: Sequence[str], order: str = "i") -> DataFrame:
    """(path, frame, i): points strictly between camera and walker of each frame (by 1e-9 and 1e-6, for sums that differ in rounding).

    A path's distances are gathered once (bounded by the path) and each frame
    filters that array, so no frames-by-points join is made.
    """
    c = cumulative(points, path, order)
    arrays = c.groupBy(*path).agg(F.array_sort(F.collect_list(F.struct(F.col("c").alias("c"), F.col(order).alias("i")))).alias("__points"))
    joined = plan.join(arrays, list(path))
    some = F.filter("__points", lambda q: (q["c"] > F.col("camera") + 1e-9) & (q["c"] < F.col("person") - TOLERANCE))
    return joined.select(*path, "frame", F.explode(F.transform(some, lambda q: q["i"])).alias("i"))


def _neighbours(path: Sequence[str], order: str, k: int) -> tuple[Column, Column, Column, Column]:
    w = W.partitionBy(*path).orderBy(order)
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    first, last = (lambda c: F.first(c).over(whole)), (lambda c: F.last(c).over(whole))
    ahead = [F.coalesce(F.lead(c, k).over(w), last(c)) for c in ("x", "y")]
    behind = [F.coalesce(F.lag(c, k).over(w), first(c)) for c in ("x", "y")]
    return (*ahead, *behind)


def directions(points: DataFrame, path: Sequence[str], window: int, weighted: bool = False, order: str = "i") -> DataFrame:
    """``points`` with dx and dy, a unit direction from up to ``window`` neighbours to both sides.

    Neighbours beyond an end are the end itself. Steps no longer than 1e-6 do
    not count; without any the direction is (0, 1). Weighted: the k-th pair of
    neighbours counts k times.
    """
    df = points
    names = []
    for k in range(1, window + 1):
        ax, ay, bx, by = _neighbours(path, order, k)
        pairs = [(ax - bx, ay - by)] if weighted else [(ax - F.col("x"), ay - F.col("y")), (F.col("x") - bx, F.col("y") - by)]
        for s, (dx, dy) in enumerate(pairs):
            df = df.withColumns({f"__x{k}{s}": dx, f"__y{k}{s}": dy})
            names.append((k if weighted else 1, f"__x{k}{s}", f"__y{k}{s}"))
    unit = lambda c, a, b: F.when(F.hypot(F.col(a), F.col(b)) > 1e-6, F.try_divide(F.col(c), F.hypot(F.col(a), F.col(b)))).otherwise(0.0)
    sx = reduce(Column.__add__, (weight * unit(a, a, b) for weight, a, b in names))
    sy = reduce(Column.__add__, (weight * unit(b, a, b) for weight, a, b in names))
    df = df.withColumns({"__sx": sx, "__sy": sy}).withColumn("__n", F.hypot("__sx", "__sy"))
    small = F.col("__n") <= 1e-6
    df = df.withColumns(
        {"dx": F.when(small, 0.0).otherwise(F.try_divide(F.col("__sx"), F.col("__n"))), "dy": F.when(small, 1.0).otherwise(F.try_divide(F.col("__sy"), F.col("__n")))}
    )
    return df.drop(*(c for c in df.columns if c.startswith("__")))


def blend(points: DataFrame, path: Sequence[str], x: str, y: str, keep: float = 0.65, order: str = "i") -> DataFrame:
    """(path, order, bx, by): each direction blended with the result before it and normalised again.

    The recursion is one fold over a path's ordered directions; a blend of
    length zero keeps the direction before.
    """
    arrays = points.groupBy(*path).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("i"), F.col(x).alias("x"), F.col(y).alias("y")))).alias("__points"))

    def step(acc: Column, p: Column) -> Column:
        last = F.element_at(acc, -1)
        mx, my = keep * last["x"] + (1 - keep) * p["x"], keep * last["y"] + (1 - keep) * p["y"]
        n = F.hypot(mx, my)
        ok = n > 1e-9
        new = F.struct(p["i"].alias("i"), F.when(ok, F.try_divide(mx, n)).otherwise(last["x"]).alias("x"), F.when(ok, F.try_divide(my, n)).otherwise(last["y"]).alias("y"))
        return F.concat(acc, F.array(new))

    rest = F.slice("__points", 2, F.greatest(F.size("__points") - 1, F.lit(0)))
    return arrays.select(*path, F.inline(F.aggregate(rest, F.slice("__points", 1, 1), step)).alias(order, "bx", "by"))


def smoothed(df: DataFrame, group: Sequence[str], value: str, share: float, order: str) -> DataFrame:
    """(group, order, ema): share * value + (1 - share) * the result before, from 0."""
    arrays = df.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("i"), F.col(value).cast("double").alias("v")))).alias("__points"))
    zero = F.array().cast("array<struct<i:bigint,v:double>>")
    before = lambda acc: F.coalesce(F.get(acc, F.size(acc) - 1)["v"], F.lit(0.0))
    fold = F.aggregate("__points", zero, lambda acc, p: F.concat(acc, F.array(F.struct(p["i"].cast("bigint").alias("i"), (share * p["v"] + (1 - share) * before(acc)).alias("v")))))
    return arrays.select(*group, F.inline(fold).alias(order, "ema"))


def animation_index(frame: Column, n: Column, fps: float, rate: float, cycle: int, loop: bool) -> Column:
    """Which of ``n`` animation frames to show at output frame ``frame``."""
    at = F.floor(frame * (fps / rate * cycle)).cast("long")
    return F.pmod(at, n) if loop else F.least(at, n - 1)
