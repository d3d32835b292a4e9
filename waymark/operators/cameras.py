"""Cameras: view and projection matrices, calibration joins, correspondences, poses."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import scalar as S

Vector = Sequence[Column]


def cross(a: Vector, b: Vector) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def normal(a: Vector, floor: float = 1e-12) -> list[Column]:
    n = F.greatest(F.sqrt(dot(a, a)), F.lit(floor))
    return [c / n for c in a]


def look_at(eye: Vector, target: Vector, up: Vector) -> list[list[Column]]:
    """Rows of the 4 x 4 view matrix that looks from ``eye`` to ``target``.

    Without a direction it looks along y; where up is along the direction, x takes its place.
    """
    lit = lambda *v: [F.lit(float(x)) for x in v]
    ahead = [t - e for e, t in zip(eye, target)]
    short = F.sqrt(dot(ahead, ahead)) < 1e-6
    ahead = [F.when(short, d).otherwise(a) for a, d in zip(normal(ahead), lit(0, 1, 0))]
    right = cross(ahead, up)
    flat = F.sqrt(dot(right, right)) < 1e-6
    right = [F.when(flat, d).otherwise(r) for r, d in zip(normal(right), lit(1, 0, 0))]
    above = cross(right, ahead)
    rows = [right, above, [-c for c in ahead]]
    return [[*r, -dot(r, eye)] for r in rows] + [lit(0, 0, 0, 1)]


def perspective(near: float, far: float, fov_x: Column, fov_y: Column) -> list[list[Column]]:
    """Rows of a symmetric perspective projection with depths in 0..1 and z ahead."""
    zero, one = F.lit(0.0), F.lit(1.0)
    return [
        [1 / F.tan(fov_x / 2), zero, zero, zero],
        [zero, 1 / F.tan(fov_y / 2), zero, zero],
        [zero, zero, F.lit(far / (far - near)), F.lit(-far * near / (far - near))],
        [zero, zero, one, zero],
    ]


def orthographic(half_width: Column, half_height: Column, near: float, far: float) -> list[list[Column]]:
    zero, one = F.lit(0.0), F.lit(1.0)
    return [[1 / half_width, zero, zero, zero], [zero, 1 / half_height, zero, zero], [zero, zero, F.lit(1 / (far - near)), F.lit(-near / (far - near))], [zero, zero, zero, one]]


def transform_point(matrix: list[list[Column]], point: Vector) -> list[Column]:
    """x, y and z of a 4 x 4 matrix times a point, divided by w."""
    p = [*point, F.lit(1.0)]
    out = [sum((r[k] * p[k] for k in range(1, 4)), r[0] * p[0]) for r in matrix]
    return [F.try_divide(c, F.when(F.abs(out[3]) < 1e-7, F.lit(1e-7)).otherwise(out[3])) for c in out[:3]]


def intrinsics(fov_x: Column, fov_y: Column, width: Column, height: Column) -> dict[str, Column]:
    return {"fx": S.focal(fov_x, width), "fy": S.focal(fov_y, height), "cx": width / 2, "cy": height / 2, "fov_x_deg": F.degrees(fov_x), "fov_y_deg": F.degrees(fov_y)}


def image_width(width: Column, rule: int) -> Column:
    """The width an image is read at: 1, 2, 4 and 8 divide it, -1 caps it at 1600, others are the width."""
    if rule in (1, 2, 4, 8):
        return F.rint(width / rule).cast("long")
    if rule == -1:
        return F.when(width > 1600, F.lit(1600).cast("long")).otherwise(width.cast("long"))
    return F.lit(rule).cast("long")


def with_calibration(images: DataFrame, calibration: DataFrame, name: str = "name") -> DataFrame:
    """Images with scale and offset by their name without suffix, null where there are none."""
    keyed = images.withColumn("__stem", F.regexp_replace(name, r"\.[^.]*$", ""))
    return keyed.join(calibration.withColumnRenamed("image_name", "__stem"), "__stem", "left").drop("__stem")


def correspondences(observations: DataFrame, points: DataFrame, images: DataFrame, scale: float) -> DataFrame:
    """(image_id, point_id, u, v, inverse) of observations whose point exists, whose scaled pixel is in the image and whose inverse depth is positive.

    ``observations`` has image_id, point_id, x, y; ``points`` has point_id and
    depth; ``images`` has image_id, width and height.
    """
    df = observations.where("point_id >= 0").join(points, "point_id").join(images, "image_id")
    df = df.withColumns({"u": F.col("x") * scale, "v": F.col("y") * scale, "inverse": F.try_divide(F.lit(1.0), F.nullif(F.col("depth"), F.lit(0.0)))})
    return df.where(S.inside("u", "v", F.col("width") * scale, F.col("height") * scale) & (F.col("inverse") > 0)).select("image_id", "point_id", "u", "v", "inverse")


def pairs(renders: DataFrame, truth: DataFrame, name: str = "name") -> tuple[DataFrame, DataFrame]:
    """Renders with their ground truth, and renders without any."""
    return renders.join(truth, name), renders.join(truth, name, "left_anti")


def first_frame(points: DataFrame, path: Sequence[str], height: float, order: str = "i") -> DataFrame:
    """(path, eye, target): the first two points, ``height`` above the floor."""
    arrays = points.groupBy(*path).agg(F.min_by(F.struct("x", "y"), order).alias("a"), F.array_sort(F.collect_list(F.struct(F.col(order).alias("i"), "x", "y"))).alias("__points"))
    b = F.get("__points", 1)
    at = lambda p: F.array(p["x"], p["y"], F.lit(height))
    return arrays.where(F.size("__points") > 1).select(*path, at(F.col("a")).alias("eye"), at(b).alias("target"))


def walk(events: DataFrame, who: Sequence[str], order: str, step: float = 0.25, turn: float = 15.0) -> DataFrame:
    """(who, order, x, y, heading): poses after each event (forward, back, left, right), one fold over ordered events."""
    arrays = events.groupBy(*who).agg(F.array_sort(F.collect_list(F.struct(F.col(order).cast("bigint").alias("i"), "event"))).alias("__events"))
    start = F.expr("array(cast(named_struct('i', null, 'x', 0, 'y', 0, 'h', 0) as struct<i:bigint,x:double,y:double,h:double>))")

    def after(acc: Column, e: Column) -> Column:
        last = F.element_at(acc, -1)
        h = (last["h"] + F.when(e["event"] == "left", turn).when(e["event"] == "right", -turn).otherwise(0.0)).cast("double")
        go = F.when(e["event"] == "forward", step).when(e["event"] == "back", -step).otherwise(0.0)
        new = F.struct(e["i"].alias("i"), (last["x"] + go * F.cos(F.radians(h))).alias("x"), (last["y"] + go * F.sin(F.radians(h))).alias("y"), h.alias("h"))
        return F.concat(acc, F.array(new))

    folded = F.aggregate("__events", start, after)
    return arrays.select(*who, F.inline(F.slice(folded, 2, F.size("__events"))).alias(order, "x", "y", "heading"))


def _rotations(rows: pd.Series) -> np.ndarray:
    return np.array([np.asarray(r, float).reshape(3, 3) for r in rows]).reshape(-1, 3, 3)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def matrix_quaternion(flat: pd.Series) -> pd.Series:
    """w, x, y, z (w not negative) of rotations given as nine numbers."""
    out = []
    for m in _rotations(flat):
        k = np.array(
            [
                [m[0, 0] - m[1, 1] - m[2, 2], 0, 0, 0],
                [m[0, 1] + m[1, 0], m[1, 1] - m[0, 0] - m[2, 2], 0, 0],
                [m[0, 2] + m[2, 0], m[1, 2] + m[2, 1], m[2, 2] - m[0, 0] - m[1, 1], 0],
                [m[2, 1] - m[1, 2], m[0, 2] - m[2, 0], m[1, 0] - m[0, 1], m[0, 0] + m[1, 1] + m[2, 2]],
            ]
        )
        _, vectors = np.linalg.eigh(k / 3)
        x, y, z, w = vectors[:, -1]
        q = np.array([w, x, y, z])
        out.append((q if q[0] >= 0 else -q).tolist())
    return pd.Series(out, dtype=object)


def _harmonics(d: np.ndarray, degree: int = 3) -> np.ndarray:
    """Real spherical harmonics of degrees 1 to ``degree`` in unit directions (rows x 15 for 3), from associated Legendre recursions."""
    from math import factorial, pi, sqrt

    x, y, z = d.T
    out = []
    for l in range(1, degree + 1):
        for m in range(-l, l + 1):
            a = abs(m)
            # sin^m times the m-th Legendre derivative, without dividing by the sine.
            p = {a: np.full(len(d), float(np.prod(np.arange(1, 2 * a, 2))))}
            p[a + 1] = z * (2 * a + 1) * p[a]
            for n in range(a + 2, l + 1):
                p[n] = ((2 * n - 1) * z * p[n - 1] - (n + a - 1) * p[n - 2]) / (n - a)
            c = (x + 1j * y) ** a
            k = sqrt((2 * l + 1) / (4 * pi) * factorial(l - a) / factorial(l + a)) * (sqrt(2) if a else 1) * (-1) ** a
            out.append(k * p[l] * (c.imag if m < 0 else c.real))
    return np.stack(out, axis=1)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def rotate_harmonics(coefficients: pd.Series, rotation: pd.Series) -> pd.Series:
    """45 coefficients (15 for each channel) of a colour function turned by a rotation (nine numbers).

    Each channel is fitted by least squares in fixed directions, all 15 at once.
    """
    d = np.random.default_rng(1234).normal(size=(60, 3))
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    inverse = np.linalg.pinv(_harmonics(d))
    out = []
    for c, m in zip(coefficients, _rotations(rotation)):
        turned = _harmonics(d @ m)  # the turned function at d is the old one at the turned-back d
        out.append((inverse @ turned @ np.asarray(c, float).reshape(3, 15).T).T.ravel().tolist())
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def harmonic_colours(coefficients: pd.Series, direction: pd.Series) -> pd.Series:
    """Three channels of 1, 4, 9, 16 or 25 coefficients each (degree 0 to 4) in a direction, shifted by one half, not negative."""
    sizes = coefficients.map(len).to_numpy()
    out = np.empty(len(sizes), object)
    d = np.array([np.asarray(v, float) for v in direction]).reshape(-1, 3)
    d /= np.maximum(np.linalg.norm(d, axis=1, keepdims=True), 1e-12)
    for n in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == n)
        degree = round((n // 3) ** 0.5) - 1
        basis = np.c_[np.full(len(own), S.SH_C0), _harmonics(d[own], degree)] if degree else np.full((len(own), 1), S.SH_C0)
        values = np.array([np.asarray(coefficients.iloc[k], float) for k in own]).reshape(len(own), 3, -1)
        for k, v in zip(own, np.maximum(np.einsum("ncb,nb->nc", values, basis) + 0.5, 0)):
            out[k] = v.tolist()
    return pd.Series(out, dtype=object)


def orbit_rotation(pitch: Column, yaw: Column) -> list[list[Column]]:
    """Rows of the rotation by ``yaw`` about z after ``pitch`` about x, in degrees."""
    a, b = F.radians(pitch), F.radians(yaw)
    zero = F.lit(0.0)
    return [
        [F.cos(b), -F.sin(b) * F.cos(a), F.sin(b) * F.sin(a)],
        [F.sin(b), F.cos(b) * F.cos(a), -F.cos(b) * F.sin(a)],
        [zero, F.sin(a), F.cos(a)],
    ]


def principal_projection(near: float, far: float, fx: Column, fy: Column, cx: Column, cy: Column, width: Column, height: Column) -> list[list[Column]]:
    """Rows of a perspective projection whose axis meets the image at (cx, cy) pixels."""
    zero, one = F.lit(0.0), F.lit(1.0)
    return [
        [2 * fx / width, zero, 2 * cx / width - 1, zero],
        [zero, 2 * fy / height, 2 * cy / height - 1, zero],
        [zero, zero, F.lit(far / (far - near)), F.lit(-far * near / (far - near))],
        [zero, zero, one, zero],
    ]


def json_cameras(documents: DataFrame) -> DataFrame:
    """(file, k, image, view) of transform documents: y and z axes of each pose turned, then inverted.

    ``documents`` has file and frames: an array of structs with file_path and transform_matrix.
    """
    from .imaging import inverse_4x4

    f = documents.select("file", F.posexplode("frames").alias("k", "f"))
    sign = F.array(F.lit(1.0), F.lit(-1.0), F.lit(-1.0), F.lit(1.0))
    rows = F.transform("f.transform_matrix", lambda r, i: F.when(i < 3, F.zip_with(r, sign, lambda v, s: v * s)).otherwise(r))
    return f.select("file", "k", F.col("f.file_path").alias("image"), inverse_4x4(F.flatten(rows)).alias("view"))


def marker(x: float, y: float, floor: float, hip: float) -> dict[str, Column]:
    """Columns of one red marker point at hip height."""
    red = [(c - 0.5) / S.SH_C0 for c in (1.0, 0.0, 0.0)]
    return {
        "x": F.lit(x), "y": F.lit(y), "z": F.lit(floor + hip), "f_dc": F.array(*map(F.lit, red)), "opacity": S.logit(F.lit(0.95)),
        "scale": F.array_repeat(F.ln(F.lit(0.1)), 3), "rot": F.array(*map(F.lit, (1.0, 0.0, 0.0, 0.0))),
    }


def fit_length(values: Column, n: int) -> Column:
    """An array cut or filled with zeros to ``n`` values."""
    return F.slice(F.concat(values, F.array_repeat(F.lit(0.0), n)), 1, n)
