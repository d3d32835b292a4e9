"""Column functions: geometry, pixels, bit fields, formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

Num = Column | float | int

#: Metres that a walker moves in one frame.
STEP = 0.05


def col(x: Num | str) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def distance(x1: Num, y1: Num, x2: Num, y2: Num) -> Column:
    return F.hypot(col(x2) - col(x1), col(y2) - col(y1))


def polyline_length(points: Column) -> Column:
    """Length of an array of structs with x and y; 0 for fewer than two."""
    n = F.size(points)
    pairs = F.zip_with(
        F.slice(points, 2, F.greatest(n - 1, F.lit(0))),
        F.slice(points, 1, F.greatest(n - 1, F.lit(0))),
        lambda b, a: F.hypot(b["x"] - a["x"], b["y"] - a["y"]),
    )
    return F.when(n >= 2, F.aggregate(pairs, F.lit(0.0), lambda s, d: s + d)).otherwise(F.lit(0.0))


def usable_points(points: Column) -> Column:
    """Points with both coordinates, as doubles."""
    return F.transform(
        F.filter(points, lambda p: p["x"].isNotNull() & p["y"].isNotNull()),
        lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")),
    )


def tortuosity(length: Num, displacement: Num) -> Column:
    """Length over displacement, null for a closed path."""
    return F.try_divide(col(length), F.nullif(col(displacement), F.lit(0.0)))


def estimated_frames(length: Num) -> Column:
    return col(length) / STEP


def world_to_pixel(x: Num, y: Num, left: Num, top: Num, scale: Num) -> tuple[Column, Column]:
    """Column and row, rounded half to even; rows count down from the top."""
    return F.rint((col(x) - col(left)) / col(scale)).cast("int"), F.rint((col(top) - col(y)) / col(scale)).cast("int")


def world_to_pixel_mirrored(x: Num, y: Num, right: Num, bottom: Num, scale: Num) -> tuple[Column, Column]:
    return F.rint((col(right) - col(x)) / col(scale)).cast("int"), F.rint((col(y) - col(bottom)) / col(scale)).cast("int")


def pixel_to_world(u: Num, v: Num, left: Num, top: Num, scale: Num) -> tuple[Column, Column]:
    return col(left) + col(u) * col(scale), col(top) - col(v) * col(scale)


def inside(u: Num, v: Num, width: Num, height: Num) -> Column:
    return (col(u) >= 0) & (col(u) < col(width)) & (col(v) >= 0) & (col(v) < col(height))


def reflect(x: Num, lo: Num, hi: Num) -> Column:
    """``x`` mirrored about the middle of lo and hi."""
    return col(lo) + col(hi) - col(x)


def clip(x: Num, lo: Num, hi: Num) -> Column:
    return F.least(F.greatest(col(x), col(lo)), col(hi))


def sigmoid(x: Num) -> Column:
    return 1 / (1 + F.exp(-col(x)))


def logit(p: Num) -> Column:
    return F.ln(col(p) / (1 - col(p)))


def bits(x: Num, low: int, width: int) -> Column:
    """``width`` bits of ``x`` from bit ``low`` on."""
    return F.shiftrightunsigned(col(x), low).bitwiseAND(F.lit((1 << width) - 1))


def unit(x: Num, low: int, width: int) -> Column:
    """A bit field as a share of its largest value."""
    return bits(x, low, width) / F.lit(float((1 << width) - 1))


def between(share: Num, lo: Num, hi: Num) -> Column:
    return col(lo) + col(share) * (col(hi) - col(lo))


def quaternion_matrix(w: Num, x: Num, y: Num, z: Num) -> list[list[Column]]:
    """Rows of the rotation of a quaternion, which is normalised first."""
    w, x, y, z = (col(c) for c in (w, x, y, z))
    n = F.greatest(F.sqrt(w * w + x * x + y * y + z * z), F.lit(1e-12))
    w, x, y, z = w / n, x / n, y / n, z / n
    return [
        [1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)],
        [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)],
        [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)],
    ]


def covariance(scale: list[Column], quaternion: list[Column]) -> list[Column]:
    """Upper triangle of R S S R^T: xx, xy, xz, yy, yz, zz."""
    r = quaternion_matrix(*quaternion)
    entry = lambda i, j: reduce(Column.__add__, (r[i][k] * r[j][k] * scale[k] * scale[k] for k in range(3)))
    return [entry(i, j) for i in range(3) for j in range(i, 3)]


def yaw(dx: Num, dy: Num) -> Column:
    return F.atan2(col(dx), col(dy)) + F.pi()


def focal(fov: Num, pixels: Num) -> Column:
    return col(pixels) / (2 * F.tan(col(fov) / 2))


def field_of_view(focal_length: Num, pixels: Num) -> Column:
    return 2 * F.atan(col(pixels) / (2 * col(focal_length)))


def depth_mm(inverse: Num) -> Column:
    """Millimetres of an inverse depth in metres, 0 for none, truncated and held in 16 bits."""
    inverse = col(inverse)
    metres = F.when(inverse > 0, 1 / F.nullif(inverse, F.lit(0.0))).otherwise(F.lit(0.0))
    return F.floor(clip(metres * 1000, 0, 65535)).cast("int")


def psnr(mse: Num) -> Column:
    return 20 * F.log10(1 / F.nullif(F.sqrt(col(mse)), F.lit(0.0)))


def byte_text(n: Num) -> Column:
    """Bytes in the largest unit that leaves at least one, two decimals."""
    n = col(n).cast("double")
    out = F.format_string("%.2f B", n)
    for k, name in enumerate(("KB", "MB", "GB", "TB"), 1):
        out = F.when(n >= 1024.0**k, F.format_string(f"%.2f {name}", n / 1024.0**k)).otherwise(out)
    return out


def stem(path: Num | str) -> Column:
    """The last part of a path, without its last suffix."""
    return F.regexp_replace(F.regexp_extract(col(path), r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def natural_key(text: Num | str, width: int = 20) -> Column:
    """A string that sorts digit runs by number and letters without case."""
    runs = F.regexp_extract_all(F.lower(col(text)), F.lit(r"([0-9]+|[^0-9]+)"), 1)
    padded = F.transform(runs, lambda r: F.when(r.rlike("^[0-9]"), F.lpad(F.regexp_replace(r, "^0+(?=.)", ""), width, "0")).otherwise(r))
    return F.array_join(padded, "")


def truth(text: Num | str) -> Column:
    """Whether a text says yes: 1, true, yes, y or on."""
    return F.coalesce(F.lower(F.trim(col(text))).isin("1", "true", "yes", "y", "on"), F.lit(False))


def number(text: Num | str) -> Column:
    """A number, 0 where the text is none."""
    return F.coalesce(F.try_cast(col(text), "double") if hasattr(F, "try_cast") else col(text).try_cast("double"), F.lit(0.0))


def percent_colour(percent: Num) -> Column:
    """A colour from green (0) to red (100) as #rrggbb."""
    p = clip(percent, 0, 100) / 100
    red, green = F.floor(255 * p).cast("long"), F.floor(255 * (1 - p)).cast("long")
    return F.concat(F.lit("#"), *(F.lpad(F.lower(F.hex(c)), 2, "0") for c in (red, green)), F.lit("00"))


def learning_rate(step: Num, first: float, last: float, delay: int, factor: float, steps: int) -> Column:
    """Log-linear from ``first`` to ``last``, with a sine warm-up over ``delay`` steps."""
    t = clip(col(step) / steps, 0, 1)
    warm = F.lit(1.0)
    if delay > 0:
        warm = factor + (1 - factor) * F.sin(F.pi() / 2 * clip(col(step) / delay, 0, 1))
    return warm * F.exp(F.ln(F.lit(first)) * (1 - t) + F.ln(F.lit(last)) * t)


#: Basis constants of real spherical harmonics, degrees 0 and 1; fixed values.
SH_C0, SH_C1 = 0.28209479177387814, 0.4886025119029199


def sh_colour(coefficients: list[Column], x: Num, y: Num, z: Num) -> Column:
    """One channel's colour of degree 0 or 1 in direction (x, y, z), shifted by one half."""
    out = SH_C0 * coefficients[0]
    if len(coefficients) >= 4:
        out = out - SH_C1 * col(y) * coefficients[1] + SH_C1 * col(z) * coefficients[2] - SH_C1 * col(x) * coefficients[3]
    return out + 0.5


def rgb_to_sh(c: Num) -> Column:
    return (col(c) - 0.5) / SH_C0
