"""Image quality over pixel arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import scalar as S


def errors(a: Column, b: Column) -> tuple[Column, Column]:
    """Mean squared and mean absolute difference of two equally long arrays."""
    n = F.size(a)
    total = lambda f: F.aggregate(F.zip_with(a, b, f), F.lit(0.0), lambda s, d: s + d)
    square = total(lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return square / n, total(lambda x, y: F.abs(x.cast("double") - y.cast("double"))) / n


def quality(pairs: DataFrame, a: str, b: str) -> DataFrame:
    mse, l1 = errors(F.col(a), F.col(b))
    return pairs.withColumns({"mse": mse, "l1": l1}).withColumn("psnr", S.psnr("mse"))


def _window(size: int = 11, sigma: float = 1.5) -> np.ndarray:
    g = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * sigma**2))
    return g / g.sum()


def _spread(n: int) -> np.ndarray:
    """The blur along an axis of ``n`` places as a matrix; beyond the border is zero."""
    g = _window()
    k = np.arange(n)
    off = k[:, None] - k[None, :] + len(g) // 2
    return np.where((off >= 0) & (off < len(g)), g[np.clip(off, 0, len(g) - 1)], 0.0)


def _blur(images: np.ndarray) -> np.ndarray:
    """Separable Gaussian blur of images (any x height x width) with zeros beyond the border."""
    return _spread(images.shape[-2]) @ images @ _spread(images.shape[-1]).T


def structural_similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """SSIM of grey images in 0..1 (any x height x width): 11 x 11 Gaussian window, sigma 1.5."""
    c1, c2 = 0.01**2, 0.03**2
    ma, mb = _blur(a), _blur(b)
    va, vb, cov = _blur(a * a) - ma * ma, _blur(b * b) - mb * mb, _blur(a * b) - ma * mb
    score = ((2 * ma * mb + c1) * (2 * cov + c2)) / ((ma * ma + mb * mb + c1) * (va + vb + c2))
    return score.mean(axis=(-2, -1))


@F.pandas_udf(T.DoubleType())
def ssim(a: pd.Series, b: pd.Series, width: pd.Series) -> pd.Series:
    """SSIM of images given as flat arrays with a width; images of one size are handled together."""
    shape = pd.Series(list(zip(a.map(len), width.astype(int))))
    out = np.empty(len(shape))
    for (n, w), rows in shape.groupby(shape).groups.items():
        own = np.asarray(rows)
        x, y = (np.array([np.asarray(v.iloc[k], float) for k in own]).reshape(len(own), n // w, w) for v in (a, b))
        out[own] = structural_similarity(x, y)
    return pd.Series(out)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def inverse_4x4(flat: pd.Series) -> pd.Series:
    """Inverses of matrices given as 16 numbers, all at once; null for a singular one."""
    out = np.empty(len(flat), object)
    if len(flat):
        m = np.array([np.asarray(v, float) for v in flat]).reshape(-1, 4, 4)
        good = np.flatnonzero(np.abs(np.linalg.det(m)) >= 1e-12)
        for k, v in zip(good, np.linalg.inv(m[good]).reshape(-1, 16).tolist()):
            out[k] = v
    return pd.Series(out, dtype=object)


def mirrored(image: Column, width: int, columns: bool = True) -> Column:
    """A flat image with its columns, else its rows, in reverse order."""
    n = F.size(image)
    at = lambda k: (F.floor(k / width) * width + (width - 1 - k % width)) if columns else ((n / width - 1 - F.floor(k / width)) * width + k % width)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.get(image, at(k).cast("int")))
