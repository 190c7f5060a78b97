"""Detections: ingest shapes, handedness, votes, best candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import box as bx

RIGHT_CLASS = 1


def split_sound(df: DataFrame) -> DataFrame:
    """Add ``problem``: NULL for a usable detection, else the rule it breaks."""
    return df.withColumn("problem", bx.problem(F.col("box"), F.col("side"), F.col("conf")))


def unpack_slots(df: DataFrame) -> DataFrame:
    """One row per frame with slot arrays -> one row per real detection.

    Columns: boxes array<box>, confs array<double>, optional right/left score arrays
    and ``count``; without a count every slot is real, without scores they are 0.
    """
    n = F.size("boxes")
    count = F.coalesce(F.col("count"), n) if "count" in df.columns else n
    out = df.filter(F.size("boxes") > 0).select(
        *[c for c in df.columns if c not in ("boxes", "confs", "right_scores", "left_scores", "count")],
        *[c for c in ("confs", "right_scores", "left_scores") if c in df.columns],
        count.alias("_count"), F.posexplode("boxes").alias("slot", "box"))
    out = out.filter(F.col("slot") < F.col("_count"))

    def score(name):
        return F.coalesce(F.get(F.col(name), F.col("slot")), F.lit(0.0)) if name in df.columns else F.lit(0.0)

    return out.withColumn("conf", F.get(F.col("confs"), F.col("slot"))).withColumn(
        "right_score", score("right_scores")).withColumn("left_score", score("left_scores")).drop(
        "_count", "confs", "right_scores", "left_scores")


def pack_slots(dets: DataFrame, frames: DataFrame) -> DataFrame:
    """Detections back to one row per frame with slot arrays; empty frames keep count 0.

    A detection outside the frame table is an error, not a silent drop. The frame table is never broadcast, as it is often
    spread from clips, by whose size Spark would judge it.
    """
    lists = dets.groupBy("clip", "frame").agg(F.array_sort(F.collect_list(F.struct(
        "slot", "box", "conf", "right_score", "left_score"))).alias("d"))
    both = frames.select("clip", "frame", F.lit(True).alias("_known")).hint("merge").join(lists, ["clip", "frame"], "full")
    d = F.col("d")
    stray = F.raise_error(F.concat(F.lit("detection outside the clip at frame "), F.col("frame").cast("string")))
    return both.withColumn("_known", F.coalesce("_known", stray.cast("boolean"))).filter("_known").select(
        "clip", "frame",
        F.coalesce(d["box"], F.array()).alias("boxes"), F.coalesce(d["conf"], F.array()).alias("confs"),
        F.coalesce(d["right_score"], F.array()).alias("right_scores"),
        F.coalesce(d["left_score"], F.array()).alias("left_scores"),
        F.coalesce(F.size("d"), F.lit(0)).alias("count"))


# The field names under which a detector may return its output.
BOX_NAMES = ("boxes", "pred_boxes", "det_boxes")
SCORE_NAMES = ("scores", "conf", "pred_scores", "box_scores")
LEFT_NAMES = ("left", "left_scores", "is_left")
RIGHT_NAMES = ("right", "right_scores", "is_right")


def from_predictions(df: DataFrame) -> DataFrame:
    """Detector rows with any known field names -> slot-array rows for ``unpack_slots``."""
    def first(names: Sequence[str]) -> str | None:
        return next((n for n in names if n in df.columns), None)

    boxes, scores = first(BOX_NAMES), first(SCORE_NAMES)
    if boxes is None or scores is None:
        raise ValueError(f"no box or score field among {sorted(df.columns)}")
    left, right = first(LEFT_NAMES), first(RIGHT_NAMES)
    named = set(BOX_NAMES + SCORE_NAMES + LEFT_NAMES + RIGHT_NAMES)
    out = df.select(
        *[c for c in df.columns if c not in named],
        F.transform(F.col(boxes), lambda b: bx.box(b[0], b[1], b[2], b[3])).alias("boxes"),
        F.col(scores).cast("array<double>").alias("confs"),
        *([F.col(right).cast("array<double>").alias("right_scores")] if right else []),
        *([F.col(left).cast("array<double>").alias("left_scores")] if left else []))
    return unpack_slots(out)


def class_scores(df: DataFrame, cls: str = "cls", right_class: int = RIGHT_CLASS) -> DataFrame:
    """Class id -> right and left score (1 or 0)."""
    right = F.col(cls).cast("int") == right_class
    return df.withColumn("right_score", F.when(right, 1.0).otherwise(0.0)).withColumn(
        "left_score", F.when(right, 0.0).otherwise(1.0))


def handedness(right: Column, left: Column | None = None, threshold: float = 0.0) -> Column:
    margin = right if left is None else right - left
    return F.when(margin > threshold, F.lit(1)).otherwise(F.lit(0))


def flip(side: Column) -> Column:
    return F.when(side.isin(0, 1), 1 - side).otherwise(
        F.raise_error(F.lit("handedness labels must be 0 or 1")).cast("int"))


def majority(df: DataFrame, keys: Sequence[str], label: str = "side", weight: str | None = None) -> DataFrame:
    """Weighted majority label per key; a tie goes to 0."""
    w = F.lit(1.0) if weight is None else F.col(weight)
    votes = lambda s: F.sum(F.when(F.col(label) == s, w).otherwise(0.0))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.when(votes(1) > votes(0), 1).otherwise(0).alias("majority"))


def majority_or_none(keys_table: DataFrame, votes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Majority for every listed key; -1 where nobody voted."""
    return keys_table.join(votes, list(keys), "left").withColumn("majority", F.coalesce("majority", F.lit(-1)))


def enforce_side(df: DataFrame, keys: Sequence[str], label: str = "side", weight: str | None = None,
                 min_frames: int = 5) -> DataFrame:
    """Give a sequence of at least ``min_frames`` rows its majority label."""
    votes = majority(df, keys, label, weight)
    return df.join(votes, list(keys)).withColumn(
        label, F.when(F.col("n") >= min_frames, F.col("majority")).otherwise(F.col(label))).drop("n", "majority")


def best_per_side(df: DataFrame) -> DataFrame:
    """Best candidate per (clip, frame, side): confidence, then area, then lowest slot.

    An aggregate, not a window: candidates combine before the shuffle.
    """
    best = F.max(F.struct("conf", bx.area(F.col("box")).alias("area"), (-F.col("slot")).alias("_o"),
                          "slot", "box")).alias("b")
    return df.groupBy("clip", "frame", "side").agg(best).select(
        "clip", "frame", "side", "b.slot", "b.conf", "b.area", "b.box")
