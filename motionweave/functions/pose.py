"""Rigid poses, rotations, quaternions and similarity transforms as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vec as v

ROTATION_TOLERANCE = 1e-4
NEAR_ZERO_ANGLE = 1e-6


# ---------------------------------------------------------------- rigid poses
def to_world(rot: Column, trans: Column, point: Column) -> Column:
    return F.when(point.isNotNull(), v.add(v.mul_vec(rot, point), trans))


def to_camera(rot: Column, trans: Column, point: Column) -> Column:
    return F.when(point.isNotNull(), v.tmul_vec(rot, v.sub(point, trans)))


def joints_to_world(rot: Column, trans: Column, joints: Column) -> Column:
    return F.transform(joints, lambda p: to_world(rot, trans, p))


def joints_to_camera(rot: Column, trans: Column, joints: Column) -> Column:
    return F.transform(joints, lambda p: to_camera(rot, trans, p))


def invert(rot: Column, trans: Column) -> tuple[Column, Column]:
    moved = v.tmul_vec(rot, trans)
    return v.transpose(rot), v.scale(moved, -1.0)


def world_to_camera_rows(rot_w2c: Column, trans_w2c: Column, joints: Column, tracked: Column,
                         trusted: Column) -> Column:
    """Camera-space joints from a world-to-camera pose; NULL unless both masks agree."""
    keep = tracked & (trusted > 0.5)
    return F.when(keep, joints_to_world(rot_w2c, trans_w2c, joints))


def is_rotation(m: Column, tolerance: float = ROTATION_TOLERANCE) -> Column:
    return F.coalesce((F.size(m) == 9) & (F.abs(v.det(m) - 1.0) <= tolerance), F.lit(False))


def angle(m: Column) -> Column:
    return F.acos(v.clamp((v.trace(m) - 1.0) / 2.0, -1.0, 1.0))


def pose_to_matrix(rot: Column, trans: Column) -> Column:
    """16 entries, row-major, homogeneous."""
    x, y, z = v.xyz(trans)
    r = [v.at(rot, i, j) for i in range(3) for j in range(3)]
    return F.array(*r[0:3], x, *r[3:6], y, *r[6:9], z,
                   *[F.lit(float(c)) for c in (0, 0, 0, 1)])


def matrix_to_pose(m: Column) -> tuple[Column, Column]:
    rot = F.concat(F.slice(m, 1, 3), F.slice(m, 5, 3), F.slice(m, 9, 3))
    return rot, v.vec(m[3], m[7], m[11])


def is_homogeneous(m: Column, tolerance: float = 1e-6) -> Column:
    ok = F.size(m) == 16
    for i, want in zip(range(12, 16), (0.0, 0.0, 0.0, 1.0)):
        ok = ok & (F.abs(m[i] - want) <= tolerance)
    return F.coalesce(ok, F.lit(False))


def mirror(m: Column) -> Column:
    """Conjugate by diag(-1, 1, 1): entries that mix x with y or z change sign."""
    return v.mat(*[
        -v.at(m, i, j) if (i == 0) != (j == 0) else v.at(m, i, j)
        for i in range(3) for j in range(3)
    ])


# ----------------------------------------------------------------- quaternions
def quat_to_matrix(w: Column, x: Column, y: Column, z: Column) -> Column:
    n = w * w + x * x + y * y + z * z
    s = F.lit(2.0) / n
    return v.mat(
        1.0 - s * (y * y + z * z), s * (x * y - z * w), s * (x * z + y * w),
        s * (x * y + z * w), 1.0 - s * (x * x + z * z), s * (y * z - x * w),
        s * (x * z - y * w), s * (y * z + x * w), 1.0 - s * (x * x + y * y),
    )


def matrix_to_quat(m: Column) -> Column:
    """Unit quaternion (x, y, z, w) as an array, built around its largest component."""
    e = lambda i, j: v.at(m, i, j)
    xx, yy, zz = e(0, 0), e(1, 1), e(2, 2)
    tr = xx + yy + zz
    top = F.greatest(tr, xx, yy, zz)

    def unit(x, y, z, w):
        q = F.array(x, y, z, w)
        length = F.sqrt(x * x + y * y + z * z + w * w)
        return F.transform(q, lambda c: c / length)

    return (
        F.when(top == tr, unit(e(2, 1) - e(1, 2), e(0, 2) - e(2, 0), e(1, 0) - e(0, 1), 1.0 + tr))
        .when(top == xx, unit(1.0 + 2.0 * xx - tr, e(0, 1) + e(1, 0), e(0, 2) + e(2, 0), e(2, 1) - e(1, 2)))
        .when(top == yy, unit(e(0, 1) + e(1, 0), 1.0 + 2.0 * yy - tr, e(1, 2) + e(2, 1), e(0, 2) - e(2, 0)))
        .otherwise(unit(e(0, 2) + e(2, 0), e(1, 2) + e(2, 1), 1.0 + 2.0 * zz - tr, e(1, 0) - e(0, 1)))
    )


# ----------------------------------------------------------------------- SLERP
def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def slerp(a: Column | str, b: Column | str, alpha: Column | str) -> Column:
    """Shortest-path SLERP between two 9-entry rotations, a straight line when they are nearly parallel; NULL when an input is."""
    a, b, alpha = (F.col(c) if isinstance(c, str) else c for c in (a, b, alpha))

    def turned(x: Column) -> Column:
        cosine = sum((x["a"][i] * x["b"][i] for i in range(1, 4)), x["a"][0] * x["b"][0])
        theta = F.acos(F.least(F.abs(cosine), F.lit(1.0)))
        return F.struct(x["a"].alias("a"), x["b"].alias("b"), x["w"].alias("w"), F.when(cosine < 0, -1.0).otherwise(1.0).alias("sign"),
                        theta.alias("theta"), F.sin(theta).alias("sine"))

    def weighed(x: Column) -> Column:
        flat = x["sine"] < NEAR_ZERO_ANGLE
        wa = F.when(flat, 1.0 - x["w"]).otherwise(F.sin((1.0 - x["w"]) * x["theta"]) / x["sine"])
        wb = F.when(flat, x["w"]).otherwise(F.sin(x["w"] * x["theta"]) / x["sine"])
        return F.struct(x["a"].alias("a"), x["b"].alias("b"), wa.alias("wa"), (x["sign"] * wb).alias("wb"))

    mixed = lambda x: F.zip_with(x["a"], x["b"], lambda p, q: x["wa"] * p + x["wb"] * q)
    both = F.struct(matrix_to_quat(a).alias("a"), matrix_to_quat(b).alias("b"), alpha.cast("double").alias("w"))
    # The matrix does not depend on the length of its quaternion.
    out = _let(_let(_let(_let(both, turned), weighed), mixed), lambda q: quat_to_matrix(q[3], q[0], q[1], q[2]))
    return F.when(a.isNotNull() & b.isNotNull() & alpha.isNotNull(), out)


# ---------------------------------------------------------- similarity (Sim3)
def sim3(s: Column, rot: Column, trans: Column) -> Column:
    return F.struct(s.alias("scale"), rot.alias("rot"), trans.alias("trans"))


def sim3_identity() -> Column:
    return sim3(F.lit(1.0), v.identity(), v.vec(0.0, 0.0, 0.0))


def sim3_apply(t: Column, point: Column) -> Column:
    return v.add(v.scale(v.mul_vec(t["rot"], point), t["scale"]), t["trans"])


def sim3_inverse(t: Column) -> Column:
    s = F.lit(1.0) / t["scale"]
    return sim3(s, v.transpose(t["rot"]), v.scale(v.tmul_vec(t["rot"], t["trans"]), -s))


def sim3_compose(outer: Column, inner: Column) -> Column:
    """Apply ``inner`` first, then ``outer``."""
    return sim3(outer["scale"] * inner["scale"], v.mul(outer["rot"], inner["rot"]),
                sim3_apply(outer, inner["trans"]))


def sim3_pose(t: Column, rot: Column, trans: Column) -> tuple[Column, Column]:
    """Carry a camera pose into the destination frame."""
    return v.mul(t["rot"], rot), sim3_apply(t, trans)


def sim3_to_matrix(t: Column) -> Column:
    return pose_to_matrix(F.transform(t["rot"], lambda e: e * t["scale"]), t["trans"])


def sim3_from_matrix(m: Column) -> Column:
    """Scale is the cube root of the determinant; NULL unless it is positive."""
    linear, trans = matrix_to_pose(m)
    s = F.cbrt(v.det(linear))
    usable = is_homogeneous(m, 1e-9) & (s > 0)
    return F.when(usable, sim3(s, F.transform(linear, lambda e: e / s), trans))
