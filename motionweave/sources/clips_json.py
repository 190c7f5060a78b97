"""Clip folders of JSON documents: header, per-frame camera, per-frame hand poses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pose, vec as v

POSE = "struct<translation_xyz:array<double>,quaternion_wxyz:array<double>>"
INFO = ("sequence_name string, clip_index int, clip_length int, "
        "frames array<struct<frame_idx:int,timestamp_ns:bigint>>")
CAMERA = f"map<string,{POSE}>"
HAND = f"struct<T_world_from_wrist:{POSE}>"
HANDS = f"map<string,struct<left:{HAND},right:{HAND}>>"
# Parts of the path <root>/<split>/<sequence>/clip-<n>/<file>.
PATH = r"([^/]+)/([^/]+)/clip-(\d+)/[^/]+$"


def read_texts(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One row per clip folder: split, sequence, clip number and the document text."""
    rows = spark.read.text(f"{root}/*/*/clip-*/{name}", wholetext=True)
    return located(rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def located(rows: DataFrame) -> DataFrame:
    part = lambda i: F.regexp_extract("path", PATH, i)
    return rows.select("path", "text", part(1).alias("split"), part(2).alias("sequence"), part(3).cast("int").alias("number"))


def discover(rows: DataFrame, split: str | None = None, sequence: str | None = None) -> DataFrame:
    """Clips, optionally of one split or sequence."""
    if split is not None:
        rows = rows.filter(F.col("split") == split)
    if sequence is not None:
        rows = rows.filter(F.col("sequence") == sequence)
    return rows


def decode(info: DataFrame, camera: DataFrame, hands: DataFrame) -> DataFrame:
    """Frame rows (clip, frame, ts_ns, rot, trans, wrist_left, wrist_right).

    Inputs are (clip, text). A frame without a camera entry, or a clip whose length
    disagrees with its frame list, is an error; an incomplete wrist is missing.
    """
    head = info.withColumn("i", F.from_json("text", INFO))
    size = F.size(F.col("i")["frames"])
    bad = F.raise_error(F.concat(F.lit("clip length differs from its frame list: "), F.col("clip").cast("string")))
    frames = head.select(
        "clip", F.when(F.coalesce(F.col("i")["clip_length"], size) == size, F.col("i")["frames"]).otherwise(
            bad.cast("array<struct<frame_idx:int,timestamp_ns:bigint>>")).alias("f"))
    frames = frames.select("clip", F.explode("f").alias("f")).select(
        "clip", F.col("f")["frame_idx"].alias("frame"), F.col("f")["timestamp_ns"].alias("ts_ns"))

    def entries(df: DataFrame, kind: str, name: str) -> DataFrame:
        out = df.select("clip", F.explode(F.from_json("text", kind)).alias("_k", name))
        return out.select("clip", F.col("_k").cast("int").alias("frame"), name)

    rows = frames.join(entries(camera, CAMERA, "cam"), ["clip", "frame"], "left")
    rows = rows.join(entries(hands, HANDS, "hand"), ["clip", "frame"], "left")
    t, q = F.col("cam")["translation_xyz"], F.col("cam")["quaternion_wxyz"]
    whole = F.coalesce((F.size(t) == 3) & (F.size(q) == 4), F.lit(False))
    lost = F.raise_error(F.concat(F.lit("no camera entry for frame "), F.col("frame").cast("string")))
    wrist = lambda side: v.vec_nan_to_null(F.when(
        F.size(F.col("hand")[side]["T_world_from_wrist"]["translation_xyz"]) == 3,
        v.vec(*[F.col("hand")[side]["T_world_from_wrist"]["translation_xyz"][i] for i in range(3)])))
    return rows.select(
        "clip", "frame", "ts_ns",
        F.when(whole, pose.quat_to_matrix(q[0], q[1], q[2], q[3])).otherwise(lost.cast("array<double>")).alias("rot"),
        v.vec(t[0], t[1], t[2]).alias("trans"), wrist("left").alias("wrist_left"), wrist("right").alias("wrist_right"))


def read(spark: SparkSession, root: str, split: str | None = None, sequence: str | None = None) -> DataFrame:
    picked = discover(read_texts(spark, root, "clip_info.json"), split, sequence)
    name = F.regexp_replace("path", r"/[^/]+$", "").alias("clip")
    keys = picked.select(name)
    docs = [read_texts(spark, root, n).select(name, "text") for n in ("clip_info.json", "camera.json", "hands_pose.json")]
    return decode(*[d.join(keys, "clip", "left_semi") for d in docs])
