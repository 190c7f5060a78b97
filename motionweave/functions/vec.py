"""3-vectors (struct x, y, z) and 3x3 matrices (array of 9, row-major) as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

IDENTITY = (1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0)


def vec(x, y, z) -> Column:
    x, y, z = (F.lit(float(c)) if isinstance(c, (int, float)) else c for c in (x, y, z))
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def mat(*entries) -> Column:
    return F.array(*[F.lit(float(e)) if isinstance(e, (int, float)) else e for e in entries])


def identity() -> Column:
    return mat(*IDENTITY)


def xyz(v: Column) -> tuple[Column, Column, Column]:
    return v["x"], v["y"], v["z"]


def at(m: Column, row: int, col: int) -> Column:
    return m[3 * row + col]


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once inside a lambda and hand it to ``body``."""
    return F.transform(F.array(value), body)[0]


def add(a: Column, b: Column) -> Column:
    return vec(*[p + q for p, q in zip(xyz(a), xyz(b))])


def sub(a: Column, b: Column) -> Column:
    return vec(*[p - q for p, q in zip(xyz(a), xyz(b))])


def scale(a: Column, s) -> Column:
    return vec(*[p * s for p in xyz(a)])


def lerp(a: Column, b: Column, w: Column) -> Column:
    return vec(*[(1.0 - w) * p + w * q for p, q in zip(xyz(a), xyz(b))])


def dot(a: Column, b: Column) -> Column:
    (ax, ay, az), (bx, by, bz) = xyz(a), xyz(b)
    return ax * bx + ay * by + az * bz


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(sum((p - q) * (p - q) for p, q in zip(xyz(a), xyz(b))))


def finite(v: Column) -> Column:
    """All three coordinates present and finite."""
    ok = v.isNotNull()
    for c in xyz(v):
        ok = ok & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))
    return ok


def all_finite(joints: Column) -> Column:
    return joints.isNotNull() & F.coalesce(F.forall(joints, finite), F.lit(False))


def mul_vec(m: Column, v: Column) -> Column:
    x, y, z = xyz(v)
    return vec(*[at(m, i, 0) * x + at(m, i, 1) * y + at(m, i, 2) * z for i in range(3)])


def tmul_vec(m: Column, v: Column) -> Column:
    """Transpose of ``m`` times ``v``."""
    x, y, z = xyz(v)
    return vec(*[at(m, 0, i) * x + at(m, 1, i) * y + at(m, 2, i) * z for i in range(3)])


def mul(a: Column, b: Column) -> Column:
    return mat(*[
        at(a, i, 0) * at(b, 0, j) + at(a, i, 1) * at(b, 1, j) + at(a, i, 2) * at(b, 2, j)
        for i in range(3) for j in range(3)
    ])


def tmul(a: Column, b: Column) -> Column:
    """Transpose of ``a`` times ``b``."""
    return mat(*[
        at(a, 0, i) * at(b, 0, j) + at(a, 1, i) * at(b, 1, j) + at(a, 2, i) * at(b, 2, j)
        for i in range(3) for j in range(3)
    ])


def mul_t(a: Column, b: Column) -> Column:
    """``a`` times the transpose of ``b``."""
    return mat(*[
        at(a, i, 0) * at(b, j, 0) + at(a, i, 1) * at(b, j, 1) + at(a, i, 2) * at(b, j, 2)
        for i in range(3) for j in range(3)
    ])


def transpose(m: Column) -> Column:
    return mat(*[at(m, j, i) for i in range(3) for j in range(3)])


def det(m: Column) -> Column:
    return (
        at(m, 0, 0) * (at(m, 1, 1) * at(m, 2, 2) - at(m, 1, 2) * at(m, 2, 1))
        - at(m, 0, 1) * (at(m, 1, 0) * at(m, 2, 2) - at(m, 1, 2) * at(m, 2, 0))
        + at(m, 0, 2) * (at(m, 1, 0) * at(m, 2, 1) - at(m, 1, 1) * at(m, 2, 0))
    )


def trace(m: Column) -> Column:
    return at(m, 0, 0) + at(m, 1, 1) + at(m, 2, 2)


def yaw(angle: Column) -> Column:
    """Rotation about the y axis."""
    c, s = F.cos(angle), F.sin(angle)
    return mat(c, 0.0, s, 0.0, 1.0, 0.0, -s, 0.0, c)


def clamp(value: Column, low, high) -> Column:
    """NULL and NaN have no place in the range: they become NULL."""
    return F.when(value.isNotNull() & ~F.isnan(value), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def vec_nan_to_null(v: Column) -> Column:
    return F.when(finite(v), v)
