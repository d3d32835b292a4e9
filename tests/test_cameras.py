"""Camera kernels."""

import math

import numpy as np
from pyspark.sql import functions as F

from waymark.operators import cameras, points


def rotation(seed):
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(3, 3)))
    q *= np.sign(np.diag(r))
    return q if np.linalg.det(q) > 0 else -q


def test_degree_one_matches_the_constants():
    d = np.array([[0.6, 0.0, 0.8], [0.0, 1.0, 0.0]])
    c = 0.4886025119029199
    assert np.allclose(np.abs(cameras._harmonics(d)[:, :3]), np.abs(c * d[:, [1, 2, 0]]))


def test_harmonics_are_orthonormal():
    rng = np.random.default_rng(2)
    d = rng.normal(size=(200_000, 3))
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    b = cameras._harmonics(d)
    assert np.allclose(4 * math.pi * b.T @ b / len(d), np.eye(15), atol=0.05)


def test_turned_coefficients_give_the_turned_function(spark):
    m, rng = rotation(3), np.random.default_rng(4)
    c = rng.normal(size=45)
    df = spark.createDataFrame([(c.tolist(), m.ravel().tolist())], "c array<double>, m array<double>")
    got = np.array(df.select(cameras.rotate_harmonics("c", "m").alias("t")).first().t).reshape(3, 15)
    d = rng.normal(size=(20, 3))
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    assert np.allclose(cameras._harmonics(d @ m.T) @ got.T, cameras._harmonics(d) @ c.reshape(3, 15).T)


def test_quaternions_come_back(spark):
    m = rotation(5)
    df = spark.createDataFrame([(m.ravel().tolist(),)], "m array<double>")
    w, x, y, z = df.select(cameras.matrix_quaternion("m").alias("q")).first().q
    back = [[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)], [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)], [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]]
    assert np.allclose(back, m)


def test_look_at_degenerate(spark):
    zero, up = [F.lit(0.0)] * 3, [F.lit(0.0), F.lit(1.0), F.lit(0.0)]
    m = cameras.look_at(zero, zero, up)
    r = spark.range(1).select(*(m[i][j].alias(f"m{i}{j}") for i in range(3) for j in range(3))).first()
    assert (r.m00, r.m01, r.m02) == (1, 0, 0) and (abs(r.m20), r.m21) == (0, -1)


def test_json_cameras(spark):
    pose = [[1.0, 0.0, 0.0, 2.0], [0.0, 1.0, 0.0, 3.0], [0.0, 0.0, 1.0, 4.0], [0.0, 0.0, 0.0, 1.0]]
    df = spark.createDataFrame([("f", [("a", pose)])], "file string, frames array<struct<file_path:string,transform_matrix:array<array<double>>>>")
    view = np.array(cameras.json_cameras(df).first().view).reshape(4, 4)
    turned = np.array(pose)
    turned[:3, 1:3] *= -1
    assert np.allclose(view @ turned, np.eye(4))


def test_marker_and_orthographic(spark):
    r = spark.range(1).select(*(c.alias(n) for n, c in cameras.marker(1.0, 2.0, 0.5, 0.4).items())).first()
    assert r.z == 0.9 and math.isclose(1 / (1 + math.exp(-r.opacity)), 0.95) and math.isclose(math.exp(r.scale[0]), 0.1)
    m = cameras.orthographic(F.lit(2.0), F.lit(4.0), 1.0, 3.0)
    u, v, d = cameras.transform_point(m, [F.lit(1.0), F.lit(1.0), F.lit(2.0)])
    assert tuple(spark.range(1).select(u, v, d).first()) == (0.5, 0.25, 0.5)


def test_harmonic_colours_are_not_negative(spark):
    df = spark.createDataFrame([([-9.0] + [0.0] * 47, [0.0, 0.0, 1.0])], "c array<double>, d array<double>")
    assert df.select(cameras.harmonic_colours("c", "d").alias("v")).first().v == [0.0, 0.5, 0.5]


def test_transform_is_transposed_and_unscaled(spark):
    m = [[0.0, -2.0, 0.0, 1.0], [2.0, 0.0, 0.0, 2.0], [0.0, 0.0, 2.0, 3.0], [0.0, 0.0, 0.0, 1.0]]
    x, y, z = points.transform_xyz(F.lit(1.0), F.lit(0.0), F.lit(5.0), m)
    assert tuple(spark.range(1).select(x, y, z).first()) == (1.0, 1.0, 8.0)
