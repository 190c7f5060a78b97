"""Table schemas and fixed domain values.

Rows are keyed by ``clip`` and ``frame`` (and ``side`` for hands: 0 left, 1 right).
``frame`` is a 32-bit integer, which bounds the number of frame blocks of one clip.
Missing values are NULL, never NaN.
"""

from __future__ import annotations

from pyspark.sql import types as T

DOUBLE3 = T.StructType([T.StructField(n, T.DoubleType()) for n in ("x", "y", "z")])
BOX = T.StructType([T.StructField(n, T.DoubleType()) for n in ("x1", "y1", "x2", "y2")])
MAT3 = T.ArrayType(T.DoubleType())
JOINTS = T.ArrayType(DOUBLE3)

NUM_JOINTS = 21
MIDDLE_TIP = 12
# Five chains of four joints, each hanging off the wrist.
PARENT = tuple(-1 if j == 0 else (0 if j % 4 == 1 else j - 1) for j in range(NUM_JOINTS))
BONES = tuple((PARENT[j], j) for j in range(1, NUM_JOINTS))

# World conventions written into every trajectory's metadata.
HAND_REPRESENTATION = "21_joints_metric_xyz"
CAMERA_CONVENTION = "c2w"
UNITS = "meter"

# The stages of a clip, in order, with the window settings of the
# two stages that run per window.
STAGES = ("preprocess", "detection", "hand", "camera", "stitch", "fusion", "refine")
STAGE_WINDOWS = {"hand": (16, 8), "camera": (200, 40)}


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])

TRAJECTORY = _struct(
    ("clip", T.LongType()), ("frame", T.IntegerType()), ("side", T.IntegerType()),
    ("ts", T.DoubleType()),
    ("joints_world", JOINTS), ("joints_camera", JOINTS),
    ("valid", T.BooleanType()), ("conf", T.DoubleType()), ("interpolated", T.BooleanType()),
    ("rot", MAT3), ("trans", DOUBLE3), ("k", MAT3),
    ("box", BOX), ("track_id", T.LongType()),
    ("root_rot", MAT3), ("hand_pose", T.ArrayType(MAT3)), ("betas", T.ArrayType(T.DoubleType())),
    ("postprocess_valid", T.BooleanType()),
)

# Declared length of every array column of a trajectory row.
TRAJECTORY_LENGTHS = {
    "joints_world": 21, "joints_camera": 21, "rot": 9, "k": 9,
    "root_rot": 9, "hand_pose": 15, "betas": 10,
}

LEDGER = _struct(
    ("clip", T.StringType()), ("stage", T.StringType()), ("unit", T.StringType()),
    ("params_hash", T.StringType()), ("outputs", T.ArrayType(T.StringType())),
    ("inputs", T.MapType(T.StringType(), T.StringType())), ("status", T.StringType()),
    ("host", T.StringType()), ("backend_mode", T.StringType()),
    ("wall_time_seconds", T.DoubleType()), ("detail", T.StringType()),
)
