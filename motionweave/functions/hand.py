"""Hand-skeleton expressions over a 21-joint array column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import BONES, MIDDLE_TIP
from . import vec as v


def bone_lengths(joints: Column) -> Column:
    """20 lengths, in child-joint order."""
    return F.array(*[v.distance(joints[c], joints[p]) for p, c in BONES])


def span(joints: Column) -> Column:
    """Wrist to middle fingertip."""
    return v.distance(joints[MIDDLE_TIP], joints[0])


def lerp_joints(a: Column, b: Column, w: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: v.lerp(p, q, w))


def shift_joints(joints: Column, delta: Column) -> Column:
    return F.transform(joints, lambda p: F.when(p.isNotNull(), v.add(p, delta)))
