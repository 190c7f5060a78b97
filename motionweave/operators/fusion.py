"""Hands, cameras and boxes joined into world-frame trajectory rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pose, vec as v
from ..schemas import CAMERA_CONVENTION, HAND_REPRESENTATION, UNITS


def need(value, kind: str, message: str):
    return F.coalesce(value, F.raise_error(F.concat(F.lit(message + " at frame "), F.col("frame").cast("string"))).cast(kind))


def with_fps(rows: DataFrame, fps: float | DataFrame) -> DataFrame:
    """Rows with the frame rate of their clip: one number, or a table (clip, fps) that knows every clip."""
    if not isinstance(fps, DataFrame):
        if fps <= 0:
            raise ValueError("fps must be positive")
        return rows.withColumn("fps", F.lit(float(fps)))
    lost = F.raise_error(F.concat(F.lit("no positive fps for clip "), F.col("clip").cast("string"))).cast("double")
    return rows.join(fps.select("clip", F.col("fps").cast("double").alias("fps")), "clip", "left").withColumn(
        "fps", F.when(F.col("fps") > 0, F.col("fps")).otherwise(lost))


def fuse(hands: DataFrame, cameras: DataFrame, tracks: DataFrame | None = None, fps: float | DataFrame = 30.0) -> DataFrame:
    """World joints p = R p_c + t for valid hand-frames, plus every contract field.

    ``fps`` is one rate for all clips or a table (clip, fps).

    All joins are on (clip, frame[, side]), keys that no single row group dominates.
    A hand frame without a camera or without intrinsics is an error.
    """
    cam = cameras.select("clip", "frame", "rot", "trans", "k")
    rows = with_fps(hands.drop("fps"), fps).join(cam.hint("merge"), ["clip", "frame"], "left").withColumns({
        "rot": need(F.col("rot"), "array<double>", "no camera"),
        "k": need(F.col("k"), "array<double>", "no intrinsics"),
    })
    if tracks is not None:
        rows = rows.join(tracks.select("clip", "frame", "side", "box", "track_id"), ["clip", "frame", "side"], "left")
    else:
        rows = rows.withColumn("box", F.lit(None).cast("struct<x1:double,y1:double,x2:double,y2:double>"))
        rows = rows.withColumn("track_id", F.lit(-1).cast("bigint"))
    have = set(hands.columns)
    ident = v.identity()
    return rows.select(
        "clip", "frame", "side", (F.col("frame") / F.col("fps")).alias("ts"),
        F.when(F.col("valid"), pose.joints_to_world(F.col("rot"), F.col("trans"), F.col("joints"))).alias("joints_world"),
        F.col("joints").alias("joints_camera"), "valid", "conf", F.lit(False).alias("interpolated"),
        "rot", "trans", "k", "box", F.coalesce("track_id", F.lit(-1)).cast("bigint").alias("track_id"),
        (F.coalesce("root_rot", ident) if "root_rot" in have else ident).alias("root_rot"),
        (F.col("hand_pose") if "hand_pose" in have else F.array_repeat(ident, 15)).alias("hand_pose"),
        (F.col("betas") if "betas" in have else F.array_repeat(F.lit(0.0), 10)).alias("betas"),
        (F.col("postprocess_valid") if "postprocess_valid" in have else F.col("valid")).alias("postprocess_valid"),
    )


def refuse_world(traj: DataFrame) -> DataFrame:
    """Recompute world joints after the camera or the camera-space joints changed."""
    return traj.withColumn("joints_world", F.when(
        F.col("valid"), pose.joints_to_world(F.col("rot"), F.col("trans"), F.col("joints_camera"))))


def metadata(traj: DataFrame, fps: float | DataFrame) -> DataFrame:
    """One metadata row per clip. ``fps`` is one rate for all clips or a table (clip, fps)."""
    rows = traj.groupBy("clip").agg(
        (F.max("frame") + 1).alias("num_frames"),
        F.avg(F.when(F.col("side") == 0, F.col("valid").cast("double"))).alias("coverage_left"),
        F.avg(F.when(F.col("side") == 1, F.col("valid").cast("double"))).alias("coverage_right"),
    )
    return with_fps(rows, fps).select(
        "clip", "fps", F.lit(0).alias("world_frame"),
        F.lit(HAND_REPRESENTATION).alias("hand_representation"), F.lit(CAMERA_CONVENTION).alias("camera_convention"),
        F.lit(UNITS).alias("units"), "num_frames", "coverage_left", "coverage_right")


def resolve_focal(clips: DataFrame, windows: DataFrame, reference: DataFrame) -> DataFrame:
    """Focal length per clip: configured, else first usable window, else reference median.

    clips: clip, width, height, focal (nullable). windows: clip, win, k, grid_w, grid_h.
    reference: clip, frame, k.
    """
    from ..functions import camera
    from .blocks import exact_quantiles

    good = lambda c: F.when(c.isNotNull() & ~F.isnan(c) & (c > 0) & (c < float("inf")), c)
    sized = windows.join(clips.select("clip", "width", "height"), "clip")
    fx = good(camera.rescale(F.col("k"), (F.col("grid_w"), F.col("grid_h")), (F.col("width"), F.col("height")))[0])
    from_win = sized.withColumn("_fx", fx).filter("_fx is not null").groupBy("clip").agg(
        F.min_by("_fx", "win").alias("_window"))
    ref = exact_quantiles(reference.select("clip", F.col("k")[0].alias("_fx")), ["clip"], "_fx", {"_ref": 0.5})
    rows = clips.join(from_win, "clip", "left").join(ref.drop("n"), "clip", "left")
    picks = [("config", good(F.col("focal"))), ("camera windows", F.col("_window")), ("reference", good(F.col("_ref")))]
    source = F.lit("unavailable")
    for name, value in reversed(picks):
        source = F.when(value.isNotNull(), F.lit(name)).otherwise(source)
    return rows.select("clip", F.coalesce(*[p for _, p in picks]).alias("focal"), source.alias("source"))


def camera_path(windows: DataFrame, frames: DataFrame, last_wins: bool = True) -> DataFrame:
    """One pose per frame of a range from camera windows, the later window winning.

    Frames no window covers get the identity pose and ``covered = false``; the
    quaternion is (x, y, z, w).
    """
    pick = F.max if last_wins else F.min
    chosen = windows.groupBy("clip", "frame").agg(pick(F.struct("win", "rot", "trans")).alias("p"))
    rows = frames.select("clip", "frame").join(chosen, ["clip", "frame"], "left")
    rot = F.coalesce(F.col("p")["rot"], v.identity())
    trans = F.coalesce(F.col("p")["trans"], v.vec(0.0, 0.0, 0.0))
    return rows.select("clip", "frame", F.col("p").isNotNull().alias("covered"), trans.alias("trans"),
                       pose.matrix_to_quat(rot).alias("quat"))
