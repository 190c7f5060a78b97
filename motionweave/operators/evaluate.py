"""Scoring of predicted trajectories against reference trajectories.

Action error: for each start frame, both trajectories are expressed in their own camera
at that start, and joints of the next ``chunk`` frames are compared. With
A = Rp Rg^T and c = tp - A tg the error of one term is |p - A g - c|, so a start is 12
numbers and a frame meets its starts through a bounded window, without a range join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vec as v
from ..schemas import NUM_JOINTS
from ..session import cut_lineage
from . import fusion
from .blocks import BLOCK, exact_quantiles, over_halo

KEY = ["clip", "frame", "side"]
MM = 1000.0
SLICE = 1 << 16  # terms by joint that a task holds at once


def load(traj: DataFrame, meta: DataFrame | None = None, fps: float | None = None) -> DataFrame:
    """The columns scoring needs; fps from the argument, else the clip metadata, else an error."""
    inter = F.coalesce("interpolated", F.lit(False)) if "interpolated" in traj.columns else F.lit(False)
    rows = traj.select(*KEY, "joints_world", "valid", inter.alias("interpolated"), "rot", "trans")
    if fps is not None:
        return rows.withColumn("fps", F.lit(float(fps)))
    if meta is None:
        raise ValueError("fps is unknown: give fps or a metadata table")
    lost = F.raise_error(F.concat(F.lit("no fps for clip "), F.col("clip").cast("string"))).cast("double")
    return rows.join(meta.select("clip", "fps"), "clip", "left").withColumn("fps", F.coalesce("fps", lost))


def paired(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """Prediction and reference side by side on (clip, frame, side); a row absent on one side is not valid there."""
    def tagged(df: DataFrame, tag: str, inter: bool) -> DataFrame:
        return df.select(*KEY, *[F.col(c).alias(f"{tag}_{c}") for c in ("joints_world", "valid", "rot", "trans")],
                         *([F.coalesce("interpolated", F.lit(False)).alias("interpolated")] if inter else []))

    inter = "interpolated" in pred.columns
    rows = tagged(pred, "p", inter).join(tagged(ref, "g", False), KEY, "full")
    known = F.coalesce("interpolated", F.lit(False)) if inter else F.lit(False)
    return rows.withColumns({"p_valid": F.coalesce("p_valid", F.lit(False)), "g_valid": F.coalesce("g_valid", F.lit(False)),
                             "interpolated": known})


def clip_lengths(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """Frames per clip on both sides, and how many of them have rows; a clip present on one side only is kept."""
    def size(df: DataFrame, name: str, present: str) -> DataFrame:
        return df.groupBy("clip").agg((F.max("frame") + 1).alias(name), F.count_distinct("frame").alias(present))

    return size(pred, "num_frames", "present").join(size(ref, "ref_frames", "ref_present"), "clip", "full")


def _differ() -> Column:
    same = F.col("num_frames").eqNullSafe(F.col("ref_frames"))
    whole = (F.col("present") == F.col("num_frames")) & (F.col("ref_present") == F.col("ref_frames"))
    return ~(same & F.coalesce(whole, F.lit(False)))


def length_mismatch(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """Clips whose sides have different lengths, or frames without rows."""
    return clip_lengths(pred, ref).filter(_differ())


def _usable(p: Column, g: Column) -> Column:
    return v.finite(p) & v.finite(g)


def terms(pred: DataFrame, ref: DataFrame, chunk: int, step: int = 1, strict: bool = True,
          block: int = BLOCK) -> DataFrame:
    """Error sums per (clip, side, joint) and per (clip, start), in one pass.

    ``joint`` is NULL in start rows and ``start`` is NULL in joint rows. ``sum_real``
    and ``n_real`` leave out interpolated frames. Sums combine map-side.
    """
    sizes = clip_lengths(pred, ref).withColumn("chunk", F.lit(chunk))
    return _terms(paired(pred, ref), sizes, chunk, step, strict, block)


def _joints(col: pa.Array) -> np.ndarray:
    """Lists of points as [rows, joints, 3]; what is missing is NaN, points beyond the last joint are left out."""
    n = pc.list_value_length(col).to_numpy(zero_copy_only=False).astype(int)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    points = np.column_stack([pc.struct_field(col.flatten(), i).to_numpy(zero_copy_only=False) for i in range(3)])
    out = np.full((len(n), NUM_JOINTS, 3), np.nan)
    out[row[at < NUM_JOINTS], at[at < NUM_JOINTS]] = points[at < NUM_JOINTS]
    return out


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Error sums of a batch: per (clip, side, joint) over all starts, and per (clip, start) over all joints.

    A missing or non-finite point gives no term.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = batch.column("_starts")
        count = pc.list_value_length(starts).to_numpy(zero_copy_only=False).astype(int)
        gauge = starts.flatten()
        turn = pc.list_flatten(pc.struct_field(gauge, 1)).to_numpy(zero_copy_only=False).reshape(-1, 3, 3)
        shift = np.column_stack([pc.struct_field(pc.struct_field(gauge, 2), i).to_numpy(zero_copy_only=False) for i in range(3)])
        first = pc.struct_field(gauge, 0).to_numpy(zero_copy_only=False)
        p, g = _joints(batch.column("p_joints")), _joints(batch.column("g_joints"))
        keys = pd.DataFrame({c: batch.column(c).to_pandas() for c in ("clip", "side", "interpolated")})
        row = np.repeat(np.arange(len(keys)), count)
        total, used = np.zeros((len(row), NUM_JOINTS)), np.zeros((len(row), NUM_JOINTS), bool)
        for a in range(0, len(row), SLICE):
            b = slice(a, a + SLICE)
            far = p[row[b]] - g[row[b]] @ turn[b].transpose(0, 2, 1) - shift[b][:, None]
            d = np.sqrt((far * far).sum(axis=2))
            used[b] = np.isfinite(d)
            total[b] = np.where(used[b], d, 0.0)
        ends = np.cumsum(count)[:-1]
        by_row = [np.add.reduceat(x, [0, *ends], axis=0) for x in (total, used.astype(np.int64))]
        joints = pd.concat([keys] * NUM_JOINTS, ignore_index=True).assign(
            joint=np.repeat(np.arange(NUM_JOINTS), len(keys)), s=by_row[0].T.ravel(), n=by_row[1].T.ravel())
        joints = joints.groupby(["clip", "side", "interpolated", "joint"], as_index=False, sort=False, dropna=False).sum()
        chunks = keys.iloc[row][["clip", "interpolated"]].assign(start=first, s=total.sum(axis=1), n=used.sum(axis=1))
        chunks = chunks.groupby(["clip", "interpolated", "start"], as_index=False, sort=False, dropna=False).sum()
        out = pd.concat([joints, chunks], ignore_index=True)
        kinds = {"clip": batch.schema.field("clip").type, "interpolated": pa.bool_(), "side": pa.int32(), "joint": pa.int32(), "start": pa.int32(),
                 "s": pa.float64(), "n": pa.int64()}
        whole = {c: out[c].astype("Int32") if t == pa.int32() else out[c] for c, t in kinds.items()}
        yield pa.RecordBatch.from_arrays([pa.array(whole[c], t, from_pandas=True) for c, t in kinds.items()], names=list(kinds))


def _terms(rows: DataFrame, sizes: DataFrame, longest: int, step: int, strict: bool, block: int) -> DataFrame:
    """``sizes`` has the chunk of every clip; ``longest`` is the largest of them."""
    a = v.mul_t(F.col("p_rot"), F.col("g_rot"))
    rows = rows.withColumn("_A", a).withColumn("_c", v.sub(F.col("p_trans"), v.mul_vec(F.col("_A"), F.col("g_trans"))))
    both = F.col("p_valid") & F.col("g_valid")
    rows = rows.select(
        *KEY, "interpolated", F.struct(F.col("frame").alias("start"), "_A", "_c").alias("_gauge"),
        F.when(both, F.col("p_joints_world")).alias("p_joints"), F.when(both, F.col("g_joints_world")).alias("g_joints"))

    def body(r, asc, _):
        # A frame starts a chunk when the clip is long enough for the chunk's last frame.
        # Both sides of a frame carry the same gauge, so a set holds each start once.
        open_ = (F.col("frame") % step == 0) & (F.col("frame") + F.col("chunk") <= F.col("num_frames")) & F.col("_gauge")["_A"].isNotNull()
        r = r.withColumn("_gauge", F.when(open_, F.col("_gauge")))
        near = F.collect_set("_gauge").over(asc.rangeBetween(-(longest - 1), 0))
        return r.withColumn("_starts", F.filter(near, lambda g: g["start"] > F.col("frame") - F.col("chunk")))

    rows = rows.join(sizes.select("clip", "chunk", "num_frames"), "clip")
    rows = over_halo(rows, ["clip"], longest - 1, 0, body, block=block).drop("_gauge")
    each = rows.filter(F.col("p_joints").isNotNull() & F.col("g_joints").isNotNull() & (F.size("_starts") > 0)).select(
        "clip", "side", "interpolated", "p_joints", "g_joints", "_starts")
    kind = each.schema["clip"].dataType.simpleString()
    flat = each.mapInArrow(_folded, f"clip {kind}, interpolated boolean, side int, joint int, start int, s double, n bigint")
    real = ~F.col("interpolated")
    sums = flat.groupBy("clip", "side", "joint", "start").agg(
        F.sum("s").alias("sum"), F.sum("n").alias("n"), F.sum(F.when(real, F.col("s"))).alias("sum_real"),
        F.coalesce(F.sum(F.when(real, F.col("n"))), F.lit(0)).alias("n_real"))
    if not strict:
        return sums
    # The length check meets the sums, which are small, rather than the frames.
    stop = lambda text: F.raise_error(F.concat(F.lit(text), F.col("clip").cast("string"))).cast("int")
    checked = sizes.withColumn("_t", F.when(
        ~F.col("num_frames").eqNullSafe(F.col("ref_frames")), stop("frame counts differ in clip ")).when(
        _differ(), stop("frames are absent in clip ")).when(
        F.col("num_frames") < F.col("chunk"), stop("chunk is longer than clip ")).otherwise(F.col("num_frames")))
    return checked.filter("_t > 0").select("clip").join(sums, "clip", "left")


def _mean(total: Column, n: Column) -> Column:
    return MM * total / F.nullif(n, F.lit(0))


def by_joint(parts: DataFrame) -> DataFrame:
    rows = parts.filter("joint is not null").groupBy("clip", "joint").agg(F.sum("sum").alias("s"), F.sum("n").alias("n"))
    return rows.select("clip", "joint", _mean(F.col("s"), F.col("n")).alias("error_mm"), "n")


def by_hand(parts: DataFrame) -> DataFrame:
    rows = parts.filter("joint is not null").groupBy("clip", "side").agg(F.sum("sum").alias("s"), F.sum("n").alias("n"))
    return rows.select("clip", "side", _mean(F.col("s"), F.col("n")).alias("error_mm"), "n")


def by_chunk(parts: DataFrame) -> DataFrame:
    return parts.filter("start is not null").select("clip", "start", _mean(F.col("sum"), F.col("n")).alias("error_mm"), "n")


def action_error(parts: DataFrame) -> DataFrame:
    """Per clip: overall, per hand, wrist, and predicted-only error in mm."""
    def part(cond: Column, s: str, n: str) -> Column:
        return _mean(F.sum(F.when(cond, F.col(s))), F.sum(F.when(cond, F.col(n))))

    joint = parts.filter("joint is not null")
    every = F.lit(True)
    return joint.groupBy("clip").agg(
        part(every, "sum", "n").alias("action_mpjpe_mm"),
        F.sum("n").alias("num_terms"),
        part(F.col("side") == 0, "sum", "n").alias("left_mm"),
        part(F.col("side") == 1, "sum", "n").alias("right_mm"),
        part(F.col("joint") == 0, "sum", "n").alias("wrist_mm"),
        part(every, "sum_real", "n_real").alias("action_mpjpe_predicted_only_mm"))


def _depth_and_joint_coverage(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    j = F.explode(F.arrays_zip(F.col("p_joints_world").alias("p"), F.col("g_joints_world").alias("g"))).alias("j")
    ok = F.col("p_valid") & F.col("g_valid")
    used = rows.filter(ok).select("clip", j).filter(_usable(F.col("j")["p"], F.col("j")["g"]))
    sums = used.groupBy("clip").agg(
        (MM * F.avg(F.abs(F.col("j")["p"]["z"] - F.col("j")["g"]["z"]))).alias("world_z_error_mm"),
        F.count(F.lit(1)).alias("_n"))
    total = sizes.select("clip", (F.col("num_frames") * 42).alias("_all"))
    return total.join(sums, "clip", "left").select(
        "clip", "world_z_error_mm", (F.coalesce("_n", F.lit(0)) / F.col("_all")).alias("joint_coverage"))


def _camera_error(rows: DataFrame) -> DataFrame:
    per_frame = rows.groupBy("clip", "frame").agg(
        (F.bool_or("p_valid") & F.bool_or("g_valid")).alias("ok"),
        F.first(v.distance(F.col("p_trans"), F.col("g_trans"))).alias("d"))
    return per_frame.groupBy("clip").agg((MM * F.avg(F.when(F.col("ok"), F.col("d")))).alias("camera_error_mm"))


def coverage_report(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """Shares of hand-frames: usable on both sides, predicted only, interpolated.

    The interpolated share looks at the prediction alone, the others at both sides.
    """
    return _coverage_report(paired(pred, ref), clip_lengths(pred, ref))


def _coverage_report(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Both hands of every frame of the clip count, whether a row exists or not."""
    both = F.col("p_valid") & F.col("g_valid")
    share = lambda c: F.sum(c.cast("double")) / (2 * F.first("_all"))
    total = sizes.select("clip", F.greatest("num_frames", "ref_frames").alias("_all"))
    return rows.join(total, "clip").groupBy("clip").agg(
        share(both).alias("coverage"),
        share(both & ~F.col("interpolated")).alias("coverage_predicted_only"),
        share(F.col("p_valid") & F.col("interpolated")).alias("coverage_interpolated"))


def coverage(df: DataFrame, keys=("clip",)) -> DataFrame:
    """Share of valid hand-frames overall and per side (``side`` NULL = both)."""
    return df.groupingSets([[F.col("clip"), F.col("side")], [F.col("clip")]], F.col("clip"), F.col("side")).agg(
        F.avg(F.col("valid").cast("double")).alias("coverage"))


def wrist_error(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """Mean, exact median and 90th percentile of wrist distance (mm) per clip."""
    rows = paired(pred, ref).filter(F.col("p_valid") & F.col("g_valid"))
    p, g = F.col("p_joints_world")[0], F.col("g_joints_world")[0]
    rows = rows.filter(_usable(p, g)).select("clip", (MM * v.distance(p, g)).alias("d"))
    mean = rows.groupBy("clip").agg(F.avg("d").alias("mean_mm"))
    return exact_quantiles(rows, ["clip"], "d", {"median_mm": 0.5, "p90_mm": 0.9}).join(mean, "clip")


def measured_fps(num_frames: Column, seconds: Column) -> Column:
    return F.when((seconds > 0) & (num_frames >= 0), num_frames / F.nullif(seconds, F.lit(0.0))).otherwise(
        F.raise_error(F.lit("elapsed seconds must be positive")).cast("double"))


def report(pred: DataFrame, ref: DataFrame, fps: float | DataFrame, chunk_seconds: float = 1.0, step: int = 1,
           strict: bool = True, block: int = BLOCK, chunk: int | None = None) -> DataFrame:
    """One evaluation row per clip. ``fps`` is one rate for all clips or a table (clip, fps).

    A chunk is ``chunk_seconds`` long at the clip's own rate, unless its frames are given.
    """
    lengths = fusion.with_fps(clip_lengths(pred, ref), fps)
    frames = F.greatest(F.lit(1), F.bround(F.col("fps") * F.lit(chunk_seconds)).cast("int")) if chunk is None else F.lit(chunk)
    # Both sides are joined once; every measure then reads the columns it needs.
    rows, lengths = cut_lineage(paired(pred, ref)), cut_lineage(lengths.withColumn("chunk", frames))
    longest = lengths.agg(F.max("chunk")).first()[0] or 1
    parts = _terms(rows, lengths, longest, step, strict, block)
    out = lengths.select(
        "clip", "fps", "num_frames", (F.floor((F.col("num_frames") - F.col("chunk")) / F.lit(step)) + 1).cast("int").alias("num_chunks"))
    for piece in (action_error(parts), _depth_and_joint_coverage(rows, lengths), _camera_error(rows), _coverage_report(rows, lengths)):
        out = out.join(piece, "clip", "left")
    if strict:
        none = F.raise_error(F.concat(F.lit("no comparable term in clip "), F.col("clip").cast("string"))).cast("double")
        out = out.withColumn("action_mpjpe_mm", F.coalesce("action_mpjpe_mm", none))
    return out


def ablation(variants: dict[str, DataFrame]) -> DataFrame:
    """Rows (pipeline, clip, mpjpe_mm, coverage, fps) of several evaluation reports."""
    rows = None
    for name, rep in variants.items():
        part = rep.select(F.lit(name).alias("pipeline"), "clip", F.col("action_mpjpe_mm").alias("mpjpe_mm"), "coverage",
                          F.col("fps") if "fps" in rep.columns else F.lit(None).cast("double").alias("fps"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def scorable(ref: DataFrame, meta: DataFrame) -> DataFrame:
    """Drop clips whose reference wrist is declared unvalidated."""
    good = meta.filter(F.coalesce("wrist_validated", F.lit(True))).select("clip")
    return ref.join(good, "clip", "left_semi")
