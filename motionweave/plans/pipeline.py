"""Clip programs composed from the operators; every step can be left out.

Alignment and the wrist-depth solve write intermediate tables, so building these plans runs jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blend, fusion, refine, stitch, tracking, windows


def refine_trajectory(traj: DataFrame, cameras: DataFrame, max_gap: int | None = refine.MAX_GAP,
                      filter_passes: int | None = 1, bone_bound: float | None = refine.BONE_BOUND,
                      bone_reference: str = "mean", wrist_lambda: float | None = refine.DEPTH_LAMBDA,
                      max_depth_change: float | None = None, anchor: bool = True) -> DataFrame:
    """Gap fill, camera filter, bone lengths, wrist depth, world again, World-0.

    ``None`` switches a step off. ``cameras`` has one row per frame: rot, trans, valid.
    """
    rows = traj.drop("interpolated", "rot", "trans").withColumnRenamed("joints_camera", "joints")
    if max_gap is not None:
        rows = refine.fill_gaps(rows, max_gap)
    else:
        rows = rows.withColumn("interpolated", F.lit(False))
    cams = cameras.select("clip", "frame", "rot", "trans", "valid")
    if filter_passes is not None:
        cams = windows.filter_translation(cams, "valid", filter_passes)
    if anchor and filter_passes is not None:
        cams = windows.to_world0(cams, F.col("valid")).drop("anchor")
    if bone_bound is not None:
        rows = refine.scale_bones(rows, bone_bound, bone_reference)
    if wrist_lambda is not None:
        rows = refine.smooth_wrist_depth(rows, wrist_lambda, max_depth_change).drop("depth_before", "depth_after", "weight")
    rows = rows.withColumnRenamed("joints", "joints_camera").join(cams.select("clip", "frame", "rot", "trans"), ["clip", "frame"], "left")
    rows = rows.withColumn("rot", fusion.need(F.col("rot"), "array<double>", "no camera"))
    return fusion.refuse_world(rows)


def raw_trajectory(dets: DataFrame, hand_windows: DataFrame, depth: DataFrame, camera_windows: DataFrame,
                   clips: DataFrame, schedule: DataFrame, window: int, overlap: int, fps: float | DataFrame,
                   smooth_passes: int = 0, **stitch_options) -> DataFrame:
    """Detections, hand windows and camera windows to a fused trajectory; ``fps`` is one rate or a table (clip, fps)."""
    tracks = tracking.track(dets, clips)
    hands = windows.smooth_hands(blend.blend_hands(hand_windows), smooth_passes)
    cameras = stitch.stitch(depth, camera_windows, schedule, window, overlap, **stitch_options)
    return fusion.fuse(hands, cameras, tracks, fps)
