"""Depth samples to world points, and point pairs between neighbouring windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import camera, pose


def usable_depth(depth: Column, conf: Column | None, min_depth: float, max_depth: float | None,
                 min_confidence: float | None) -> Column:
    ok = ~F.isnan(depth) & (depth > min_depth) & (depth < F.lit(max_depth if max_depth is not None else float("inf")))
    if min_confidence is not None and conf is not None:
        ok = ok & ~F.isnan(conf) & (conf >= min_confidence)
    return ok


def world_points(samples: DataFrame, cameras: DataFrame, stride: int = 8, min_depth: float = 1e-3,
                 max_depth: float | None = None, min_confidence: float | None = None,
                 rows: tuple | None = None, by_frame: bool = False) -> DataFrame:
    """Back-project strided, usable samples. The pixel and depth filters come before the
    join, so they reach the scan. ``rows`` keeps an image band [first, stop).

    ``by_frame`` joins on (clip, frame) with the few window poses of a frame as a list.
    Samples are then already partitioned the way ``correspondences`` pairs them, and the
    largest table is shuffled once instead of twice.
    """
    if stride <= 0:
        raise ValueError("stride must be positive")
    first, stop = rows if rows is not None else (0, None)
    keep = ((F.col("row") - first) % stride == 0) & (F.col("col") % stride == 0) & (F.col("row") >= first)
    if stop is not None:
        keep = keep & (F.col("row") < stop)
    conf = F.col("depth_conf") if "depth_conf" in samples.columns else None
    picked = samples.filter(keep & usable_depth(F.col("depth"), conf, min_depth, max_depth, min_confidence))
    extra = ["depth_conf"] if conf is not None else []
    local = camera.pixel_to_point(F.col("k"), F.col("row"), F.col("col"), F.col("depth"))
    if by_frame:
        poses = cameras.groupBy("clip", "frame").agg(F.collect_list(F.struct("win", "rot", "trans", "k")).alias("_cams"))
        own = F.explode(F.filter("_cams", lambda c: c["win"] == F.col("win")))
        posed = picked.join(poses, ["clip", "frame"]).withColumn("_c", own).withColumns(
            {c: F.col("_c")[c] for c in ("rot", "trans", "k")})
    else:
        posed = picked.join(cameras.select("clip", "win", "frame", "rot", "trans", "k"), ["clip", "win", "frame"])
    return posed.select("clip", "win", "frame", "row", "col", "depth", *extra,
                        pose.to_world(F.col("rot"), F.col("trans"), local).alias("point"))


def row_band(height: int, low: float, high: float) -> tuple[int, int]:
    """Image rows of a fractional band, at least one row."""
    first = round(low * height)
    return first, max(first + 1, round(high * height))


def collect_clouds(samples: DataFrame, cameras: DataFrame, height: int, stride: int = 3,
                   depth_range: tuple = (0.1, 8.0), ground_rows: tuple = (0.72, 1.0)) -> DataFrame:
    """Whole cloud and low-row ground candidates of every window, tagged by ``kind``."""
    near, far = depth_range
    full = world_points(samples, cameras, stride, near, far).withColumn("kind", F.lit("scene"))
    low = world_points(samples, cameras, max(2, stride), near, far, rows=row_band(height, *ground_rows))
    return full.unionByName(low.withColumn("kind", F.lit("ground")))


def correspondences(points: DataFrame, window: int | None = None, overlap: int | None = None,
                    weighted: bool = False) -> DataFrame:
    """Pair the same (frame, row, col) of window w (source) and w-1 (destination).

    The pair key is the pixel itself, so no partition holds more than the windows that
    see one pixel. With the schedule given, frames outside every overlap are dropped
    before the shuffle. Every shared pixel is a pair; none is left out.
    """
    if window is not None and overlap is not None:
        start = F.col("win") * (window - overlap)
        shared = ((F.col("win") > 0) & (F.col("frame") < start + overlap)) | (F.col("frame") >= start + window - overlap)
        points = points.filter(shared)
    pixel = Window.partitionBy("clip", "frame", "row", "col").orderBy("win")
    seen = points.withColumn("_prev", F.lag(F.struct("win", "point")).over(pixel))
    weight = F.greatest(F.lit(1e-3), F.col("depth_conf")) if weighted else F.lit(1.0)
    return seen.filter(F.col("_prev")["win"] == F.col("win") - 1).select(
        "clip", "win", "frame", "row", "col", F.col("point").alias("src"), F.col("_prev")["point"].alias("dst"),
        weight.alias("weight"))


def missing_pairs(windows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Windows that share no depth sample with their predecessor."""
    return windows.filter("win > 0").join(pairs.select("clip", "win").distinct(), ["clip", "win"], "left_anti")


def decode_camera_output(rows: DataFrame, image_wh: tuple, grid_wh: tuple) -> DataFrame:
    """Camera-model output rows (12- or 16-entry world-to-camera matrix, k) to the contract.

    The pose is inverted and the intrinsics follow the depth grid. A matrix of another
    length is an error.
    """
    sized = F.when(F.size("extrinsics").isin(12, 16), F.col("extrinsics")).otherwise(
        F.raise_error(F.lit("extrinsics must have 12 or 16 entries")).cast("array<double>"))
    rows = rows.withColumn("_e", sized)
    w2c, t = pose.matrix_to_pose(F.col("_e"))
    rows = rows.withColumn("_r", w2c).withColumn("_t", t)
    rot, trans = pose.invert(F.col("_r"), F.col("_t"))
    return rows.withColumns({"rot": rot, "trans": trans, "k": camera.rescale(F.col("k"), image_wh, grid_wh)}).drop(
        "_e", "_r", "_t", "extrinsics")


def view_count_problems(cameras: DataFrame, samples: DataFrame) -> DataFrame:
    """Window frames that have a camera but no depth, or depth but no camera."""
    keys = ["clip", "win", "frame"]
    cams = cameras.select(*keys, F.lit(True).alias("_cam"))
    maps = samples.select(*keys).distinct().withColumn("_map", F.lit(True))
    both = cams.join(maps, keys, "full")
    what = F.when(F.col("_map").isNull(), F.lit("camera without depth")).when(F.col("_cam").isNull(), F.lit("depth without camera"))
    return both.select(*keys, what.alias("problem")).filter("problem is not null")
