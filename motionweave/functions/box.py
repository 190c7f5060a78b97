"""Axis-aligned boxes (struct x1, y1, x2, y2) as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

CORNERS = ("x1", "y1", "x2", "y2")


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(*[c.alias(n) for c, n in zip((x1, y1, x2, y2), CORNERS)])


def area(b: Column) -> Column:
    zero = F.lit(0.0)
    return F.greatest(zero, b["x2"] - b["x1"]) * F.greatest(zero, b["y2"] - b["y1"])


def iou(a: Column, b: Column) -> Column:
    """Intersection over union, 0 when the boxes do not overlap."""
    zero = F.lit(0.0)
    w = F.greatest(zero, F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    h = F.greatest(zero, F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    inter = w * h
    return F.coalesce(F.try_divide(inter, area(a) + area(b) - inter), zero)


def lerp(a: Column, b: Column, w: Column) -> Column:
    return box(*[(1.0 - w) * a[c] + w * b[c] for c in CORNERS])


def problem(b: Column, side: Column, conf: Column) -> Column:
    """First rule a detection breaks, or NULL when it is sound."""
    inf = F.lit(math.inf)
    loose = F.lit(False)
    for c in CORNERS:
        loose = loose | b[c].isNull() | F.isnan(b[c]) | (F.abs(b[c]) == inf)
    return (
        F.when(F.coalesce(loose, F.lit(True)), F.lit("non-finite box"))
        .when((b["x2"] < b["x1"]) | (b["y2"] < b["y1"]), F.lit("negative extent"))
        .when(side.isNull() | ~side.isin(0, 1), F.lit("unknown side"))
        .when(conf.isNull() | F.isnan(conf) | (conf < 0) | (conf > 1), F.lit("confidence out of range"))
    )
