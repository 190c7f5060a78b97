"""Camera windows into one World-0 trajectory per clip."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pose, vec as v
from ..session import cut_lineage, settle
from .blend import fold, fold_rotations, mix_numbers, ramped
from .blocks import previous, running_compose
from .depth import correspondences, world_points
from .similarity import robust_fit
from .windows import to_world0

STATE = "scale double, rot array<double>, tx double, ty double, tz double"
STATE_COLS = ("scale", "rot", "tx", "ty", "tz")


def diagnostics(fits: DataFrame, windows: DataFrame) -> DataFrame:
    """Per-pair quality row: counts, inliers, scale, angle, offset, shared frames."""
    bounds = windows.select("clip", "win", "start", "end").hint("merge")  # Spark judges a schedule by its clips
    prev = bounds.select("clip", (F.col("win") + 1).alias("win"), F.col("start").alias("_ps"), F.col("end").alias("_pe"))
    rows = fits.join(bounds, ["clip", "win"]).join(prev, ["clip", "win"])
    f = F.col("fit")
    return rows.select(
        "clip", "win", F.col("n").alias("num_correspondences"), "inlier_ratio", F.col("rmse").alias("inlier_rmse"),
        "threshold", f["scale"].alias("scale"), F.degrees(pose.angle(f["rot"])).alias("rotation_deg"),
        v.norm(f["trans"]).alias("translation_norm"),
        (F.least("end", "_pe") - F.greatest("start", "_ps")).alias("overlap_frames"))


def align(samples: DataFrame, cameras: DataFrame, window: int, overlap: int, stride: int = 8,
          min_depth: float = 1e-3, max_depth: float | None = None, min_confidence: float | None = None,
          **fit_options) -> DataFrame:
    """Robust similarity from every window to its predecessor."""
    points = world_points(samples, cameras, stride, min_depth, max_depth, min_confidence, by_frame=True)
    weighted = min_confidence is not None and "depth_conf" in samples.columns
    pairs = correspondences(points, window, overlap, weighted)
    return robust_fit(pairs, weighted=weighted, **fit_options)


def _prefix(rows: pd.DataFrame, carried: pd.DataFrame | None):
    """Running composition of local similarities down the rows."""
    s, r, t = 1.0, np.eye(3), np.zeros(3)
    if carried is not None:
        c = carried.iloc[0]
        s, r = float(c["scale"]), np.array(c["rot"], dtype=float).reshape(3, 3)
        t = np.array([c["tx"], c["ty"], c["tz"]], dtype=float)
    out = []
    for ls, lr, x, y, z in zip(*[rows[c] for c in STATE_COLS]):
        t = s * (r @ np.array([x, y, z], dtype=float)) + t
        r = r @ np.array(lr, dtype=float).reshape(3, 3)
        s = s * float(ls)
        out.append((s, r.ravel().tolist(), *t.tolist()))
    run = rows.copy()
    table = pd.DataFrame(out, columns=list(STATE_COLS))
    for c in STATE_COLS:
        run[c] = table[c].to_numpy()
    return run, table.iloc[-1:]


def chain(fits: DataFrame, windows: DataFrame, block: int = 1024) -> DataFrame:
    """Window -> World-0 transforms: the running product of the local fits.

    Window 0 is the identity. A window without an accepted fit is an error.
    """
    rows = windows.select("clip", "win").join(fits.select("clip", "win", "fit"), ["clip", "win"], "left")
    lost = F.raise_error(F.concat(F.lit("window cannot be aligned: "), F.col("win").cast("string")))
    f = F.when(F.col("win") == 0, pose.sim3_identity()).when(F.col("fit").isNotNull(), F.col("fit")).otherwise(
        lost.cast("struct<scale:double,rot:array<double>,trans:struct<x:double,y:double,z:double>>"))
    flat = rows.withColumn("_f", f).select(
        "clip", "win", F.col("_f")["scale"].alias("scale"), F.col("_f")["rot"].alias("rot"),
        *[F.col("_f")["trans"][a].alias(f"t{a}") for a in "xyz"])
    kind = windows.schema["clip"].dataType.simpleString()
    done = running_compose(flat, ["clip"], "win", f"clip {kind}, win int, {STATE}",
                           _prefix,
                           STATE_COLS, STATE, block)
    return done.select("clip", "win", pose.sim3(F.col("scale"), F.col("rot"), v.vec(
        F.col("tx"), F.col("ty"), F.col("tz"))).alias("sim3"))


def merge(cameras: DataFrame, transforms: DataFrame, blend: bool = True, normalize: bool = True) -> DataFrame:
    """Place every window's poses in World-0 and blend the shared frames."""
    rows = cameras.join(transforms, ["clip", "win"])
    rot, trans = pose.sim3_pose(F.col("sim3"), F.col("rot"), F.col("trans"))
    rows = rows.select("clip", "win", "start", "end", "frame", rot.alias("rot"), F.array(
        trans["x"], trans["y"], trans["z"]).alias("t"), "k")
    rows = ramped(rows, ("clip", "frame"), ("rot", "t", "k"), blend)
    t = fold(F.col("contrib"), "t", mix_numbers, "array<double>")
    out = rows.select(
        "clip", "frame", fold_rotations(F.col("contrib"), "rot").alias("rot"), t.alias("t"),
        fold(F.col("contrib"), "k", mix_numbers, "array<double>").alias("k"),
        F.size("contrib").cast("double").alias("weight"))
    out = out.select("clip", "frame", "rot", v.vec(*[F.col("t")[i] for i in range(3)]).alias("trans"), "k", "weight",
                     F.lit(True).alias("valid"))
    if not normalize:
        return out
    # The anchor is read from the blended poses and joined back to them.
    out = cut_lineage(out)
    settle(out.sparkSession)
    return to_world0(out).drop("anchor")


def ordered_windows_check(windows: DataFrame) -> DataFrame:
    """Windows that start before their predecessor; no rows means temporal order."""
    rows = previous(windows.select("clip", "win", "start", "end"), ["clip"], F.struct("start"), "_prev", "win")
    return rows.filter(F.col("_prev")["start"] > F.col("start")).drop("_prev")


def stitch(samples: DataFrame, cameras: DataFrame, windows: DataFrame, window: int, overlap: int,
           blend: bool = True, normalize: bool = True, **options) -> DataFrame:
    """Align, chain, blend, anchor. Frames no window covers are simply absent."""
    # One row per pair is written, so that the chain does not read the points again and their shuffle files can go.
    fits = cut_lineage(align(samples, cameras, window, overlap, **options).select("clip", "win", "fit"))
    settle(fits.sparkSession)
    return merge(cameras, chain(fits, windows), blend, normalize)
