"""Point clouds: alignment, unions, masks, transforms, packed columns, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scalar as S
from . import ranks


def align(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the columns and types of ``like``: missing ones 0, others dropped."""
    have = set(df.columns)
    cols = []
    for f in like.schema.fields:
        zero = F.lit(0).cast(f.dataType)
        cols.append((F.coalesce(F.col(f.name).cast(f.dataType), zero) if f.name in have else zero).alias(f.name))
    return df.select(*cols)


def union_aligned(first: DataFrame, *others: DataFrame) -> DataFrame:
    """A bag union in the first cloud's schema."""
    for o in others:
        first = first.unionByName(align(o, first))
    return first


def replace_part(cloud: DataFrame, part: DataFrame, key: str) -> DataFrame:
    """``cloud`` with the rows of the parts named in ``part`` replaced by it."""
    return cloud.join(part.select(key).distinct(), key, "left_anti").unionByName(align(part, cloud))


def on_mask(points: DataFrame, pixels: DataFrame, keys: Sequence[str] = ("u", "v")) -> DataFrame:
    """Points whose pixel is in ``pixels``, a table of the pixels that are not white."""
    return points.join(pixels.select(*keys).distinct(), list(keys), "left_semi")


def not_white(pixels: DataFrame, limit: int = 250) -> DataFrame:
    return pixels.where(~((F.col("r") >= limit) & (F.col("g") >= limit) & (F.col("b") >= limit)))


def marked(points: DataFrame, red: int, green: int, blue: int) -> DataFrame:
    """x, y and z with one colour."""
    return points.select("x", "y", "z", *(F.lit(c).alias(n) for n, c in (("red", red), ("green", green), ("blue", blue))))


def transform_xyz(x: Column, y: Column, z: Column, matrix: list[list[float]]) -> list[Column]:
    """Row vectors times the rotation part divided by its scale, plus the translation.

    The scale is the mean length of the rotation part's columns. Positions are
    rotated by the transpose of the usual convention and not scaled, which is
    how the clouds this engine reads are made.
    """
    scale = sum((sum(matrix[i][j] ** 2 for i in range(3))) ** 0.5 for j in range(3)) / 3
    r = [[matrix[i][j] / scale for j in range(3)] for i in range(3)]
    return [x * F.lit(r[0][j]) + y * F.lit(r[1][j]) + z * F.lit(r[2][j]) + F.lit(matrix[j][3]) for j in range(3)]


def unpack_position(packed: Column, lo: Sequence[Column], hi: Sequence[Column]) -> list[Column]:
    """x, y and z of 11, 10 and 11 bits within a chunk's bounds."""
    fields = ((21, 11), (11, 10), (0, 11))
    return [S.between(S.unit(packed, low, width), a, b) for (low, width), a, b in zip(fields, lo, hi)]


def unpack_colour(packed: Column) -> list[Column]:
    """Four shares of 8 bits, the highest first."""
    return [S.unit(packed, low, 8) for low in (24, 16, 8, 0)]


def unpack_rotation(packed: Column) -> list[Column]:
    """A quaternion from the index of its largest part (2 bits) and the other three (10 bits each)."""
    norm = 2**0.5
    a, b, c = ((S.unit(packed, low, 10) - 0.5) * norm for low in (20, 10, 0))
    m = F.sqrt(F.greatest(1 - (a * a + b * b + c * c), F.lit(0.0)))
    which = S.bits(packed, 30, 2)
    order = {0: (m, a, b, c), 1: (a, m, b, c), 2: (a, b, m, c), 3: (a, b, c, m)}
    return [F.when(which == 0, order[0][k]).when(which == 1, order[1][k]).when(which == 2, order[2][k]).otherwise(order[3][k]) for k in range(4)]


def with_chunks(vertices: DataFrame, chunks: DataFrame, index: str = "i", size: int = 256) -> DataFrame:
    """Vertices with their chunk's columns; vertices past the last chunk use the last."""
    last = chunks.agg((F.count("*") - 1).alias("__last"))
    placed = vertices.crossJoin(F.broadcast(last)).withColumn("chunk", F.least(F.floor(F.col(index) / size), F.col("__last"))).drop("__last")
    return placed.join(chunks, "chunk")


def prune(points: DataFrame, least_opacity: float, extent: float, most_radius: float | None = None) -> DataFrame:
    """Points that are visible enough and not too large; opacity and scales are stored before activation."""
    largest = F.exp(F.greatest("s0", "s1", "s2"))
    drop = (S.sigmoid(F.col("opacity")) < least_opacity) | (largest > 0.1 * extent)
    if most_radius is not None:
        drop = drop | (F.col("radius") > most_radius)
    return points.where(~drop)


def densify(points: DataFrame, gradient: str, limit: float, share: float, extent: float, copies: int = 2) -> DataFrame:
    """``points`` with part and copy: small points of a steep gradient are cloned, large ones split into ``copies``."""
    steep = F.coalesce(F.nanvl(F.col(gradient), F.lit(0.0)), F.lit(0.0)) >= limit
    large = F.exp(F.greatest("s0", "s1", "s2")) > share * extent
    kind = F.when(steep & large, "split").when(steep, "clone").otherwise("keep")
    n = F.when(kind == "split", F.sequence(F.lit(1), F.lit(copies))).when(kind == "clone", F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return points.withColumn("part", kind).withColumn("copy", F.explode(n))


def box(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bounds, centre, size and count of each group."""
    aggs = [F.count("*").alias("n")]
    for c in ("x", "y", "z"):
        lo, hi = F.min(c), F.max(c)
        aggs += [lo.alias(f"{c}_min"), hi.alias(f"{c}_max"), ((lo + hi) / 2).alias(f"{c}_mid"), (hi - lo).alias(f"{c}_size")]
    return points.groupBy(*by).agg(*aggs)


def body_stats(points: DataFrame, by: Sequence[str], target: float, percentile: float) -> DataFrame:
    """Height, scale to ``target``, foot height (a percentile, held to 0..100) and hip height."""
    lo, hi = F.min("z"), F.max("z")
    share = min(max(percentile, 0.0), 100.0) / 100
    df = points.groupBy(*by).agg(lo.alias("z_min"), hi.alias("z_max")).join(ranks.quantiles(points, by, "z", {"foot": share}), list(by))
    height = F.col("z_max") - F.col("z_min")
    return df.select(
        *by, "z_min", "z_max", height.alias("height"), F.try_divide(F.lit(target), F.nullif(height, F.lit(0.0))).alias("scale"), "foot",
        (-F.col("foot")).alias("foot_offset"), (F.col("z_min") + 0.6 * height).alias("hip"),
    )


def ground_offsets(boxes: DataFrame) -> DataFrame:
    """One row: what lifts the frames' lowest points to 0 (mean, least, largest)."""
    return boxes.agg((-F.avg("z_min")).alias("offset_avg"), (-F.max("z_min")).alias("offset_min"), (-F.min("z_min")).alias("offset_max"))


def visible_stats(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Largest radius, summed gradient length, count and their ratio for each point."""
    df = rows.groupBy(*by).agg(F.max("radius").alias("radius"), F.sum(F.hypot("gx", "gy")).alias("gradient"), F.count("*").alias("n"))
    return df.withColumn("mean_gradient", F.coalesce(F.try_divide("gradient", "n"), F.lit(0.0)))


def scene_radius(cameras: DataFrame) -> DataFrame:
    """One row: mean centre and 1.1 times the largest distance from it."""
    centre = cameras.agg(*(F.avg(c).alias(f"c{c}") for c in ("x", "y", "z")))
    d = F.sqrt((F.col("x") - F.col("cx")) ** 2 + (F.col("y") - F.col("cy")) ** 2 + (F.col("z") - F.col("cz")) ** 2)
    return cameras.crossJoin(F.broadcast(centre)).agg(*(F.max(f"c{c}").alias(f"c{c}") for c in ("x", "y", "z")), (F.max(d) * 1.1).alias("radius"))


def top_down(points: DataFrame, pad: float = 0.02) -> DataFrame:
    """``points`` with px and py in 0..1: y flipped, padded, divided by the larger span."""
    ends = points.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    span = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) * (1 + 2 * pad)
    df = points.crossJoin(F.broadcast(ends.withColumn("span", F.nullif(span, F.lit(0.0)))))
    px = F.coalesce(F.try_divide(F.col("x") - F.col("x0"), F.col("span")), F.lit(0.0)) + pad
    py = F.coalesce(F.try_divide(F.col("y1") - F.col("y"), F.col("span")), F.lit(0.0)) + pad
    return df.withColumns({"px": px, "py": py}).drop("x0", "x1", "y0", "y1", "span")


def depth_alignment(df: DataFrame, by: Sequence[str], known: str, estimated: str, least: int = 10, spread: float = 1e-3) -> DataFrame:
    """Scale and offset that bring estimated to known inverse depths, by medians and mean absolute deviations.

    Both are 0 unless more than ``least`` values span more than ``spread``.
    """
    mid = df.groupBy(*by).agg(F.count("*").alias("n"), (F.max(known) - F.min(known)).alias("range"))
    for column, name in ((known, "mk"), (estimated, "me")):
        mid = mid.join(ranks.quantiles(df, by, column, {name: 0.5}), list(by), "left")
    dev = df.join(mid, list(by)).groupBy(*by).agg(
        F.avg(F.abs(F.col(known) - F.col("mk"))).alias("dk"), F.avg(F.abs(F.col(estimated) - F.col("me"))).alias("de"),
        F.max("mk").alias("mk"), F.max("me").alias("me"), F.max("n").alias("n"), F.max("range").alias("range"),
    )
    scale = F.try_divide(F.col("dk"), F.nullif("de", F.lit(0.0)))
    ok = (F.col("n") > least) & (F.col("range") > spread) & scale.isNotNull()
    return dev.select(*by, "n", F.when(ok, scale).otherwise(0.0).alias("scale"), F.when(ok, F.col("mk") - F.col("me") * scale).otherwise(0.0).alias("offset"))


def median_scale(calibration: DataFrame) -> DataFrame:
    """``calibration`` with med_scale, the median of positive scales (0 without any), and whether a row is reliable."""
    mid = ranks.quantiles(calibration.where("scale > 0"), [], "scale", {"med": 0.5}).agg(F.coalesce(F.max("med"), F.lit(0.0)).alias("med_scale"))
    df = calibration.crossJoin(F.broadcast(mid))
    return df.withColumn("reliable", (F.col("scale") > 0) & F.col("scale").between(0.2 * F.col("med_scale"), 5 * F.col("med_scale")))
