"""Blending of overlapping windows: an ordered fold per (clip, frame[, side]).

A fold group holds the few windows that cover one frame, so it never grows with the
clip. The ramp against the previous window is read off the neighbour in the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pose, vec as v
from .windows import overlap_ramp


def ramped(df: DataFrame, keys: tuple, fields: tuple, blend: bool = True) -> DataFrame:
    """Contributors of each key in window order, each with its blend weight.

    ``df`` has one row per window and covered frame with win, start, end. Every window
    must carry a row for every frame it covers, valid or not.
    """
    item = F.struct("start", "win", "end", *fields)
    rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_all"))

    def weigh(x: Column, i: Column) -> Column:
        prev = F.get(F.col("_all"), i - 1)
        stop = F.least(prev["end"], x["end"])
        adjacent = prev["win"] == x["win"] - 1
        frame = F.col("frame")
        ramp = F.when(adjacent, overlap_ramp(frame, x["start"], stop)).otherwise(1.0)
        alpha = F.coalesce(ramp, F.lit(1.0)) if blend else F.lit(1.0)
        return F.struct(alpha.alias("alpha"), *[x[f].alias(f) for f in fields])

    return rows.withColumn("contrib", F.transform("_all", weigh)).drop("_all")


def fold(contrib: Column, field: str, mix, kind: str) -> Column:
    """Left fold: the first value stands, later ones are mixed in with their weight."""
    start = F.struct(F.lit(None).cast(kind).alias("value"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        value = (
            F.when(acc["n"] == 0, x[field])
            .when(x["alpha"] <= 0, acc["value"])
            .otherwise(mix(acc["value"], x[field], x["alpha"]))
        )
        return F.struct(value.alias("value"), (acc["n"] + 1).alias("n"))

    return F.aggregate(contrib, start, step, lambda acc: acc["value"])


def mix_points(a: Column, b: Column, w: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: v.lerp(p, q, w))


def mix_numbers(a: Column, b: Column, w: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: (1.0 - w) * p + w * q)


def fold_rotations(contrib: Column, field: str) -> Column:
    """Left fold by SLERP: the first rotation stands, later ones turn it by their weight."""
    return fold(contrib, field, pose.slerp, "array<double>")


def blend_hands(windows: DataFrame) -> DataFrame:
    """Hand windows -> one row per (clip, frame, side).

    A window counts where it is valid and its joints are complete. Confidence is the
    largest of the counted windows, ``weight`` their number. Joints and vertices are
    mixed linearly, root rotations by SLERP.
    """
    optional = tuple(c for c in ("root_rot", "vertices", "betas") if c in windows.columns)
    rows = ramped(windows, ("clip", "frame", "side"), ("valid", "conf", "joints", *optional))
    used = F.filter("contrib", lambda x: F.coalesce(x["valid"], F.lit(False)) & v.all_finite(x["joints"]))
    rows = rows.withColumn("used", used)
    points = "array<struct<x:double,y:double,z:double>>"
    out = [
        "clip", "frame", "side",
        fold(F.col("used"), "joints", mix_points, points).alias("joints"),
        (F.size("used") > 0).alias("valid"),
        F.coalesce(F.array_max(F.col("used")["conf"]), F.lit(0.0)).alias("conf"),
        F.size("used").alias("weight"),
    ]
    if "betas" in optional:
        out.append(fold(F.col("used"), "betas", mix_numbers, "array<double>").alias("betas"))
    if "vertices" in optional:
        meshed = F.filter("used", lambda x: x["vertices"].isNotNull())
        out.append(fold(meshed, "vertices", mix_points, points).alias("vertices"))
    if "root_rot" in optional:
        rows = rows.withColumn("_turned", F.filter("used", lambda x: x["root_rot"].isNotNull()))
        out.append(fold_rotations(F.col("_turned"), "root_rot").alias("root_rot"))
    return rows.select(*out)
