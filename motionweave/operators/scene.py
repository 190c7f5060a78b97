"""Scene-level reports: ground plane, bounds, projected wrists and skeletons."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import camera, pose, vec as v
from ..schemas import BONES
from .blocks import exact_quantiles


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _flattest(cov: pd.Series) -> pd.Series:
    """Unit eigenvector of the smallest eigenvalue of each 3x3 covariance."""
    m = np.stack(cov.to_numpy()).astype(float).reshape(-1, 3, 3)
    _, vectors = np.linalg.eigh(m)
    return pd.Series(list(vectors[:, :, 0]))


def ground_plane(points: DataFrame, cameras: DataFrame, min_points: int = 1000) -> DataFrame:
    """Plane normal, camera height over it and a plausibility flag per clip.

    Two aggregations (centroid, then centred covariance) and one eigenvector per clip.
    Clips with ``min_points`` points or fewer keep their count and have no plane (NULL).
    """
    centre = points.groupBy("clip").agg(
        F.struct(*[F.avg(F.col("point")[a]).alias(a) for a in "xyz"]).alias("c"), F.count(F.lit(1)).alias("n"))
    counts = centre.select("clip", "n")
    centre = centre.filter(F.col("n") > min_points)
    d = points.join(centre, "clip").withColumn("d", v.sub(F.col("point"), F.col("c")))
    pairs = [(a, b) for a in "xyz" for b in "xyz"]
    cov = d.groupBy("clip").agg(*[F.sum(F.col("d")[a] * F.col("d")[b]).alias(f"s{a}{b}") for a, b in pairs])
    normal = cov.select("clip", _flattest(F.array(*[F.col(f"s{a}{b}") for a, b in pairs])).alias("nv"))
    plane = centre.join(normal, "clip").select(
        "clip", "n", "c", v.vec(F.col("nv")[0], F.col("nv")[1], F.col("nv")[2]).alias("normal"))
    h = cameras.join(plane.select("clip", "c", "normal"), "clip").select(
        "clip", F.abs(v.dot(F.col("normal"), v.sub(F.col("trans"), F.col("c")))).alias("h"))
    med = exact_quantiles(h, ["clip"], "h", {"height_median": 0.5}).drop("n")
    rng = h.groupBy("clip").agg(F.min("h").alias("height_min"), F.max("h").alias("height_max"))
    out = counts.join(plane.drop("n"), "clip", "left").join(med, "clip", "left").join(rng, "clip", "left")
    return out.select("clip", "n", "normal", "height_median", "height_min", "height_max",
                      ((F.col("height_median") > 0.1) & (F.col("height_median") < 2.5)).alias("plausible"))


def bounds(traj: DataFrame, scale: float = 100.0, min_span: float = 0.3, min_half: float = 0.25) -> DataFrame:
    """Axis limits around all valid joints and all camera centres, in scaled units."""
    joints = traj.filter(F.col("valid") & F.col("joints_world").isNotNull()).select("clip", F.explode("joints_world").alias("p"))
    points = joints.unionByName(traj.select("clip", F.col("trans").alias("p"))).filter(v.finite(F.col("p")))
    agg = points.groupBy("clip").agg(*[f(F.col("p")[a] * scale).alias(f"{n}_{a}")
                                       for a in "xyz" for n, f in (("lo", F.min), ("hi", F.max))])
    out = ["clip"]
    for a in "xyz":
        lo, hi = F.col(f"lo_{a}"), F.col(f"hi_{a}")
        half = F.greatest(F.greatest(hi - lo, F.lit(min_span)) / 2, F.lit(min_half))
        mid = (hi + lo) / 2
        out += [(mid - half).alias(f"{a}_min"), (mid + half).alias(f"{a}_max")]
    return agg.select(*out)


def wrist_pixels(traj: DataFrame) -> DataFrame:
    """Wrist pixel per hand-frame, NULL when missing or not in front of the camera."""
    wrist = F.col("joints_world")[0]
    cam = pose.to_camera(F.col("rot"), F.col("trans"), wrist)
    px = camera.rounded_pixel(camera.project(F.col("k"), F.col("cam"), front_only=True, eps=1e-6))
    return traj.withColumn("cam", F.when(v.finite(wrist), cam)).select("clip", "frame", "side", px.alias("pixel"))


def skeleton_edges(hands: DataFrame) -> DataFrame:
    """Pixel ends of the 20 bones of every drawable hand.

    A hand is drawn when it is valid and every joint projects."""
    px = F.transform("joints", lambda p: camera.project(F.col("k"), p, front_only=False))
    rows = hands.filter(F.col("valid") & v.all_finite(F.col("joints"))).withColumn("px", px)
    rows = rows.filter(F.forall("px", lambda p: p.isNotNull()))
    edges = F.array(*[F.struct(F.lit(i).alias("bone"), F.lit(p).alias("parent"), F.lit(c).alias("child"))
                      for i, (p, c) in enumerate(BONES)])
    e = rows.select("clip", "frame", "side", "px", F.explode(edges).alias("e"))
    return e.select("clip", "frame", "side", F.col("e")["bone"].alias("bone"),
                    camera.rounded_pixel(F.get(F.col("px"), F.col("e")["parent"])).alias("a"),
                    camera.rounded_pixel(F.get(F.col("px"), F.col("e")["child"])).alias("b"))


def stills(clips: DataFrame, stride: int, count: int, length: str = "num_frames") -> DataFrame:
    """Every stride-th frame of each clip, with evenly spaced ones marked as stills."""
    n = F.col(length)
    rows = clips.select("clip", F.col(length), F.explode(F.sequence(F.lit(0), n - 1, F.lit(stride))).alias("frame"),
                        F.ceil(n / F.lit(stride)).cast("int").alias("kept"))
    if not count:
        return rows.select("clip", F.col("frame").cast("int").alias("frame"), F.lit(False).alias("still"))
    step = (F.col("frame") / F.lit(stride)).cast("int")
    gap = F.greatest(F.lit(1), F.floor(F.greatest(F.lit(1), F.col("kept")) / F.lit(max(1, count))).cast("int"))
    even = (step % gap == 0) & (step / gap < count)
    # More stills than frames: the surplus falls on the last kept frame.
    tail = (step == F.col("kept") - 1) & (F.lit(count - 1) * gap >= F.col("kept") - 1)
    return rows.select("clip", F.col("frame").cast("int").alias("frame"), (even | tail).alias("still"))
