"""Dataset frames converted to reference trajectories in the World-0 contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pose, vec as v
from ..operators.handmodel import HandModel, add_landmarks
from ..operators.windows import first_camera

# Numbers per hand in the state vector and where its shape starts.
STATE_PER_HAND = 61
SHAPE_AT = 51
SIDES = ("left", "right")


def _only_wrist(wrist):
    """21 joints of which only the wrist is known."""
    return F.when(wrist.isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(20)), lambda j: F.when(j == 0, wrist)))


def _contract(rows: DataFrame) -> DataFrame:
    """Common tail: camera-space joints and default fields."""
    return rows.select(
        "clip", "frame", "side", "ts", F.col("joints").alias("joints_world"),
        pose.joints_to_camera(F.col("rot"), F.col("trans"), F.col("joints")).alias("joints_camera"),
        "valid", F.when(F.col("valid"), 1.0).otherwise(0.0).alias("conf"), F.lit(False).alias("interpolated"),
        "rot", "trans", "k", F.lit(None).cast("struct<x1:double,y1:double,x2:double,y2:double>").alias("box"),
        F.when(F.col("valid"), 0).otherwise(-1).cast("bigint").alias("track_id"),
        "root_rot", "hand_pose", "betas", F.col("valid").alias("postprocess_valid"))


def from_lerobot(frames: DataFrame, fps: float, models: dict[int, HandModel] | None = None) -> DataFrame:
    """Decoded LeRobot frames -> reference rows.

    Extrinsics are inverted and re-anchored on the first frame; wrists and root
    rotations move with them. A hand is valid where the state mask and the optional
    kept flag agree. Malformed extrinsics or rotations are errors.
    """
    ext = F.when(pose.is_homogeneous(F.col("extrinsics_w2c")), F.col("extrinsics_w2c")).otherwise(
        F.raise_error(F.lit("extrinsics are not homogeneous matrices")).cast("array<double>"))
    w2c, t = pose.matrix_to_pose(F.col("_ext"))
    base = frames.withColumn("_ext", ext)
    base = base.withColumn("_r", w2c).withColumn("_t", t)
    rot, trans = pose.invert(F.col("_r"), F.col("_t"))
    base = base.withColumn("rot", rot).withColumn("trans", trans).withColumnRenamed("episode_index", "clip")
    base = base.withColumn("frame", F.col("frame_index").cast("int"))
    base = base.join(first_camera(base), "clip")
    a_rot, a_t = F.col("anchor")["rot"], F.col("anchor")["trans"]

    def rotation(c, what):
        return F.when(pose.is_rotation(c), c).otherwise(
            F.raise_error(F.lit(f"{what} holds a matrix that is not a rotation")).cast("array<double>"))

    hands = []
    for i, side in enumerate(SIDES):
        kept = F.col(f"{side}_kept").cast("boolean") if f"{side}_kept" in frames.columns else F.lit(True)
        wrist = F.col(f"{side}_transl_world")
        pieces = F.array(*[rotation(F.slice(F.col(f"{side}_hand_pose"), 9 * j + 1, 9), f"{side}_hand_pose") for j in range(15)])
        hands.append(F.struct(
            F.lit(i).alias("side"), F.coalesce(F.col("state_mask")[i].cast("boolean") & kept, F.lit(False)).alias("valid"),
            v.vec(wrist[0], wrist[1], wrist[2]).alias("wrist"),
            rotation(F.col(f"{side}_orient_world"), f"{side}_orient_world").alias("root"),
            pieces.alias("hand_pose"),
            F.slice("`observation.state`", i * STATE_PER_HAND + SHAPE_AT + 1, 10).alias("betas")))
    rows = base.withColumn("h", F.explode(F.array(*hands)))
    h = F.col("h")
    rows = rows.select(
        "clip", "frame", h["side"].alias("side"), (F.col("frame") / F.lit(float(fps))).alias("ts"), h["valid"].alias("valid"),
        v.tmul(a_rot, F.col("rot")).alias("rot"), v.tmul_vec(a_rot, v.sub(F.col("trans"), a_t)).alias("trans"),
        F.col("intrinsics").alias("k"), pose.to_camera(a_rot, a_t, h["wrist"]).alias("wrist"),
        v.tmul(a_rot, h["root"]).alias("root_rot"), h["hand_pose"].alias("hand_pose"), h["betas"].alias("betas"))
    rows = rows.withColumn("wrist", F.when(F.col("valid"), F.col("wrist"))).withColumn("joints", _only_wrist(F.col("wrist")))
    return _contract(add_landmarks(rows, models) if models else rows)


def from_clips(frames: DataFrame) -> DataFrame:
    """Decoded clip JSON -> wrist-only reference rows without intrinsics.

    Timestamps count from the first frame. The wrist reference of this source is not
    validated; ``clip_metadata`` says so and scoring leaves it out by default.
    """
    head = frames.groupBy("clip").agg(F.min_by("ts_ns", "frame").alias("_t0"))
    base = frames.join(first_camera(frames), "clip").join(head, "clip")
    a_rot, a_t = F.col("anchor")["rot"], F.col("anchor")["trans"]
    rows = base.withColumn("h", F.explode(F.array(*[
        F.struct(F.lit(i).alias("side"), F.col(f"wrist_{s}").alias("wrist")) for i, s in enumerate(SIDES)])))
    wrist = F.col("h")["wrist"]
    ident = v.identity()
    rows = rows.select(
        "clip", "frame", F.col("h")["side"].alias("side"), ((F.col("ts_ns") - F.col("_t0")) / 1e9).alias("ts"),
        wrist.isNotNull().alias("valid"), v.tmul(a_rot, F.col("rot")).alias("rot"),
        v.tmul_vec(a_rot, v.sub(F.col("trans"), a_t)).alias("trans"), F.lit(None).cast("array<double>").alias("k"),
        _only_wrist(pose.to_camera(a_rot, a_t, wrist)).alias("joints"), ident.alias("root_rot"),
        F.array_repeat(ident, 15).alias("hand_pose"), F.array_repeat(F.lit(0.0), 10).alias("betas"))
    return _contract(rows)


def clip_metadata(rows: DataFrame, fps: DataFrame, wrist_validated: bool) -> DataFrame:
    out = rows.groupBy("clip").agg((F.max("frame") + 1).alias("num_frames"))
    return out.join(fps, "clip", "left").withColumn("hand_joints", F.lit("wrist_only")).withColumn(
        "wrist_validated", F.lit(wrist_validated))
