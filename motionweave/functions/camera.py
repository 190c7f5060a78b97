"""Pinhole camera expressions. Intrinsics are 9-entry row-major arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vec as v

DEPTH_EPS = 1e-9


def pixel(u: Column, w: Column) -> Column:
    return F.struct(u.alias("u"), w.alias("v"))


def project(k: Column, point: Column, front_only: bool = False, eps: float = DEPTH_EPS) -> Column:
    """Pixel of a camera-frame point.

    NULL closer to the camera plane than ``eps``. Points behind it project too, unless
    ``front_only`` drops them.
    """
    z = point["z"]
    seen = (z > eps) if front_only else (F.abs(z) >= eps)
    h = v.mul_vec(k, point)
    return F.when(seen, pixel(h["x"] / z, h["y"] / z))


def ray(k: Column, u: Column, w: Column) -> Column:
    """Viewing ray with z = 1, for intrinsics with zero last row except the final 1."""
    fx, skew, cx = v.at(k, 0, 0), v.at(k, 0, 1), v.at(k, 0, 2)
    fy, cy = v.at(k, 1, 1), v.at(k, 1, 2)
    y = (w - cy) / fy
    return v.vec((u - cx - skew * y) / fx, y, F.lit(1.0))


def unproject(k: Column, u: Column, w: Column, depth: Column) -> Column:
    return v.scale(ray(k, u, w), depth)


def rescale(k: Column, source_wh: tuple, target_wh: tuple) -> Column:
    """Intrinsics for another image size; sizes may be numbers or columns."""
    sw, sh, tw, th = (F.lit(float(s)) if isinstance(s, (int, float)) else s.cast("double")
                      for s in (*source_wh, *target_wh))
    fx, fy = tw / sw, th / sh
    return F.when(F.least(sw, sh, tw, th) > 0, v.mat(*[
        v.at(k, i, j) * f for i, f in ((0, fx), (1, fy), (2, F.lit(1.0))) for j in range(3)
    ]))


def pixel_to_point(k: Column, row: Column, col: Column, depth: Column) -> Column:
    """Camera-frame point of a depth sample. A zero focal length is an error."""
    fx, fy = v.at(k, 0, 0), v.at(k, 1, 1)
    bad = (fx == 0.0) | (fy == 0.0)
    fx = F.when(bad, F.raise_error(F.lit("intrinsics have a zero focal length")).cast("double")).otherwise(fx)
    return v.vec((col - v.at(k, 0, 2)) / fx * depth, (row - v.at(k, 1, 2)) / fy * depth, depth)


def rounded_pixel(p: Column) -> Column:
    return F.struct(F.bround(p["u"]).cast("int").alias("u"), F.bround(p["v"]).cast("int").alias("v"))
