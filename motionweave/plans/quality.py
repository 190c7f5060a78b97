"""Contract checks that return problems as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pose, vec as v
from ..schemas import TRAJECTORY, TRAJECTORY_LENGTHS


def missing_fields(df: DataFrame, strict: bool = True) -> list[str]:
    return sorted({f.name for f in TRAJECTORY} - set(df.columns)) if strict else []


def row_checks(traj: DataFrame, strict: bool = True) -> dict[tuple[str, str], Column]:
    """(field, problem) -> whether a row has it: array lengths, sides, and complete joints of valid hand-frames."""
    lost = missing_fields(traj, strict)
    if lost:
        raise ValueError(f"missing fields: {lost}")
    checks = {}
    for name, size in TRAJECTORY_LENGTHS.items():
        if name in traj.columns:
            checks[(name, f"length is not {size}")] = F.col(name).isNotNull() & (F.size(name) != size)
    if "hand_pose" in traj.columns:
        checks[("hand_pose", "element length is not 9")] = F.coalesce(F.exists("hand_pose", lambda m: F.size(m) != 9), F.lit(False))
    checks[("side", "unknown side")] = F.col("side").isNull() | ~F.col("side").isin(0, 1)
    # A wrist-only reference is complete when its wrist is.
    checks[("joints_world", "valid without joints")] = F.col("valid") & ~F.coalesce(
        v.finite(F.col("joints_world")[0]), F.lit(False))
    return checks


FRAMES = ("frame", "frames are not 0..T-1 for both sides")


def _per_clip(traj: DataFrame, checks: dict[tuple[str, str], Column]) -> DataFrame:
    counted = traj.groupBy("clip").agg(
        *[F.count_if(c).alias(f"c{i}") for i, c in enumerate(checks.values())],
        F.count(F.lit(1)).alias("_rows"), (F.max("frame") + 1).alias("_t"), F.count_if(F.col("frame") < 0).alias("_neg"))
    # Every (frame, side) exactly once: distinct keys and total both equal 2 T.
    keys = traj.select("clip", "frame", "side").distinct().groupBy("clip").agg(F.count(F.lit(1)).alias("_keys"))
    both = counted.join(keys, "clip")
    frame_bad = (F.col("_rows") != 2 * F.col("_t")) | (F.col("_keys") != F.col("_rows")) | (F.col("_neg") > 0)
    items = [F.struct(F.lit(f).alias("field"), F.lit(p).alias("problem"), F.col(f"c{i}").alias("rows"))
             for i, (f, p) in enumerate(checks)]
    items.append(F.struct(F.lit(FRAMES[0]).alias("field"), F.lit(FRAMES[1]).alias("problem"),
                          F.when(frame_bad, F.col("_rows")).otherwise(F.lit(0)).cast("bigint").alias("rows")))
    return both.select("clip", F.explode(F.array(*items)).alias("i")).select("clip", "i.*").filter("rows > 0")


def trajectory_problems(traj: DataFrame, strict: bool = True) -> DataFrame:
    """(clip, field, problem, rows): empty means the trajectory keeps its contract.

    Checks array lengths, that both hands of every frame 0..T-1 are present once, and
    that a valid hand-frame has complete joints.
    """
    return _per_clip(traj, row_checks(traj, strict))


def frame_problems(traj: DataFrame) -> DataFrame:
    """The part of ``trajectory_problems`` that looks at clip, frame and side only."""
    return _per_clip(traj.select("clip", "frame", "side"), {})


def camera_window_problems(rows: DataFrame) -> DataFrame:
    """Camera windows: one row per frame of [start, end), proper rotations, 9 intrinsics."""
    checks = {
        "rotation": ~pose.is_rotation(F.col("rot")),
        "translation": ~v.finite(F.col("trans")),
        "intrinsics": F.col("k").isNull() | (F.size("k") != 9),
        "frame outside window": (F.col("frame") < F.col("start")) | (F.col("frame") >= F.col("end")),
    }
    return _window_problems(rows, checks, 1)


def hand_window_problems(rows: DataFrame) -> DataFrame:
    """Hand windows: two rows per frame, 21 joints, valid rows with joints, sound confidence."""
    checks = {
        "joints": F.col("joints").isNotNull() & (F.size("joints") != 21),
        "valid without joints": F.col("valid") & F.col("joints").isNull(),
        "frame outside window": (F.col("frame") < F.col("start")) | (F.col("frame") >= F.col("end")),
    }
    if "root_rot" in rows.columns:
        checks["root rotation"] = F.col("root_rot").isNotNull() & ~pose.is_rotation(F.col("root_rot"))
    return _window_problems(rows, checks, 2)


def _window_problems(rows: DataFrame, checks: dict, per_frame: int) -> DataFrame:
    agg = rows.groupBy("clip", "win").agg(
        *[F.count_if(F.coalesce(c, F.lit(True))).alias(f"c{i}") for i, c in enumerate(checks.values())],
        F.count(F.lit(1)).alias("_n"), F.min("start").alias("_s"), F.max("end").alias("_e"))
    items = [F.struct(F.lit(n).alias("problem"), F.col(f"c{i}").alias("rows")) for i, n in enumerate(checks)]
    short = F.when(F.col("_n") != per_frame * (F.col("_e") - F.col("_s")), F.col("_n")).otherwise(F.lit(0)).cast("bigint")
    items.append(F.struct(F.lit("row count differs from window length").alias("problem"), short.alias("rows")))
    return agg.select("clip", "win", F.explode(F.array(*items)).alias("i")).select("clip", "win", "i.*").filter("rows > 0")
