"""Least squares from moment sums.

Spark computes the cross products of a regressor vector (grouped sums, or
running sums per row for rolling origins); only the small k x k solves run in
numpy inside Arrow-batched pandas functions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .layout import CHUNK, OWN, SeriesLayout


def tri_pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def cross_products(cols: list[Column], target: Column) -> list[Column]:
    """Upper triangle of v v' for v = cols + [target] (row-level products)."""
    v = list(cols) + [target]
    return [v[i] * v[j] for i, j in tri_pairs(len(v))]


def unpack(S: np.ndarray, k: int):
    """Packed sums (B, (k+1)(k+2)/2) -> X'X (B,k,k), X'y (B,k), y'y (B,)."""
    B = S.shape[0]
    full = np.zeros((B, k + 1, k + 1))
    for idx, (i, j) in enumerate(tri_pairs(k + 1)):
        full[:, i, j] = S[:, idx]
        full[:, j, i] = S[:, idx]
    return full[:, :k, :k], full[:, :k, k], full[:, k, k]


def solve(xtx: np.ndarray, xty: np.ndarray, rcond: float = 1e-12) -> np.ndarray:
    """Batched solve; rows whose system is singular (or not finite) get NaN."""
    B, k = xty.shape
    out = np.full((B, k), np.nan)
    ok = np.isfinite(xtx).all(axis=(1, 2)) & np.isfinite(xty).all(axis=1)
    if not ok.any():
        return out
    A, b = xtx[ok], xty[ok]
    # Scale to unit diagonal for conditioning, then solve.
    d = np.sqrt(np.abs(np.einsum("bii->bi", A)))
    d[d == 0] = 1.0
    As = A / d[:, :, None] / d[:, None, :]
    bs = b / d
    try:
        x = np.linalg.solve(As, bs[..., None])[..., 0]
        cond_ok = np.linalg.cond(As) < 1.0 / rcond
        x[~cond_ok] = np.nan
    except np.linalg.LinAlgError:
        x = np.full_like(bs, np.nan)
        for i in range(As.shape[0]):
            try:
                if np.linalg.cond(As[i]) < 1.0 / rcond:
                    x[i] = np.linalg.solve(As[i], bs[i])
            except np.linalg.LinAlgError:
                pass
    out[ok] = x / d
    return out


def ssr(beta: np.ndarray, xtx: np.ndarray, xty: np.ndarray, yty: np.ndarray) -> np.ndarray:
    """Residual sum of squares y'y - 2 b'X'y + b'X'X b."""
    return yty - 2 * np.einsum("bi,bi->b", beta, xty) + np.einsum("bi,bij,bj->b", beta, xtx, beta)


def expanding_sums(lay: SeriesLayout, df: DataFrame, exprs: dict[str, Column], upto: int = 0) -> DataFrame:
    """Running sums per series in layout order: value at a row = sum over the
    series' rows up to ``upto`` (0 = this row, -1 = the previous row).

    Plain layout: one unbounded-preceding window. Halo layout: running sum over
    the chunk's own rows + the total of all earlier chunks (a prefix over the
    small per-chunk totals table), so no task holds a whole series."""
    w = lay.window().rowsBetween(Window.unboundedPreceding, upto)
    if not lay.halo:
        return df.select("*", *[F.sum(e).over(w).alias(n) for n, e in exprs.items()])
    own = F.col(OWN)
    local = df.select("*", *[F.sum(F.when(own, e)).over(w).alias(n) for n, e in exprs.items()])
    tot = df.where(own).groupBy(lay.series, CHUNK).agg(*[F.sum(e).alias(f"_t_{n}") for n, e in exprs.items()])
    cw = Window.partitionBy(lay.series).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = tot.select(lay.series, CHUNK, *[F.sum(f"_t_{n}").over(cw).alias(f"_c_{n}") for n in exprs])
    j = local.join(carry, [lay.series, CHUNK], "left")

    def add(a, b):  # SQL sum semantics: NULL only when no input was non-null
        return F.when(a.isNull() & b.isNull(), F.lit(None).cast("double")).otherwise(
            F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0)))

    return j.select(*[c for c in local.columns if c not in exprs],
                    *[add(F.col(n), F.col(f"_c_{n}")).alias(n) for n in exprs])
