"""Window schedules over clips: layout, coverage, selection, partition proof, slicing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import STAGES, STAGE_WINDOWS
from .blocks import BLOCK

OWNER_BLOCK = 128  # frames whose windows are listed together


def _check(window: int, overlap: int) -> None:
    if window <= 0 or overlap < 0 or overlap >= window:
        raise ValueError(f"need 0 <= overlap < window, got window={window} overlap={overlap}")


def window_count(num_frames: Column, window, overlap) -> Column:
    """Windows of a clip: a trailing window that adds no new frame does not count."""
    w, o = (F.lit(p) if isinstance(p, int) else p for p in (window, overlap))
    return F.greatest(F.lit(1), F.ceil((num_frames - o) / (w - o))).cast("int")


def windows(clips: DataFrame, window: int = 200, overlap: int = 40, length: str = "num_frames") -> DataFrame:
    """One row per (clip, win): half-open range and name. Fails on an empty clip."""
    _check(window, overlap)
    stride = window - overlap
    n = F.when(F.col(length) > 0, F.col(length)).otherwise(
        F.raise_error(F.lit("a clip must have at least one frame")).cast("int"))
    start = (F.col("win") * stride).cast("int")
    out = _spread(clips.withColumn("_n", n), window_count(F.col("_n"), window, overlap), "win", 256)
    return (
        out.withColumn("start", start)
        .withColumn("end", F.least(start + window, F.col("_n")).cast("int"))
        .withColumn("name", window_name("start", "end"))
        .drop("_n")
    )


def window_name(start: str, end: str) -> Column:
    return F.format_string("%06d_%06d", F.col(start), F.col(end) - 1)


def overlap_with_previous(df: DataFrame, window: int, overlap: int) -> DataFrame:
    """Range shared with the previous window; NULL for the first one.

    The previous window follows from the schedule, so no look-back is needed.
    """
    stride = window - overlap
    has = (F.col("win") > 0) & (F.col("end") > F.col("start"))
    prev_end = F.col("start") - stride + window
    stop = F.least(F.col("end"), prev_end)
    shared = has & (stop > F.col("start"))
    return df.withColumn("ov_start", F.when(shared, F.col("start"))).withColumn("ov_end", F.when(shared, stop))


def frames(clips: DataFrame, length: str = "num_frames") -> DataFrame:
    """Every (clip, frame). A long clip is cut into blocks first and the blocks are spread,
    so neither one array nor one task has to hold all its frames."""
    rows = _spread(clips.select("clip", F.col(length).alias("_n")), F.col("_n"), "frame", BLOCK)
    return rows.select("clip", "frame")


def _spread(rows: DataFrame, count: Column, out: str, block: int) -> DataFrame:
    """Number each row's items 0..count-1 as new rows, in pieces of ``block`` items.

    The partition number is given: adaptive execution would otherwise merge the tiny
    pieces by their size and expand all of them in one task.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = rows.withColumn("_count", count).withColumn(
        "_at", F.explode(F.sequence(F.lit(0), F.col("_count") - 1, F.lit(block)))).repartition(n, "clip", "_at")
    last = F.least(F.col("_at") + block, F.col("_count")) - 1
    return pieces.withColumn(out, F.explode(F.sequence(F.col("_at"), last))).drop("_count", "_at")


def to_frames(win: DataFrame) -> DataFrame:
    """Explode windows to their frames: interval membership becomes an equi-join key."""
    return win.withColumn("frame", F.explode(F.sequence(F.col("start"), F.col("end") - 1)))


def window_of_frame(frame: Column, num_frames: Column, window: int, overlap: int) -> Column:
    """All windows that contain a frame, straight from the schedule (no join)."""
    stride = window - overlap
    last = window_count(num_frames, window, overlap) - 1
    first = F.greatest(F.lit(0), F.ceil((frame - window + 1) / F.lit(stride))).cast("int")
    upto = F.least(last, F.floor(frame / F.lit(stride)).cast("int"))
    return F.sequence(F.least(first, upto), upto)


def coverage(win: DataFrame) -> DataFrame:
    """How many windows cover each frame."""
    return to_frames(win).groupBy("clip", "frame").agg(F.count(F.lit(1)).alias("windows"))


def owner_window(frames: DataFrame, win: DataFrame, last: bool = True) -> DataFrame:
    """The window a frame belongs to when the last (or the first) one wins.

    Windows are listed per block of frames that they reach into, so a frame looks its owner up in a short list, and
    windows are never spread over their frames. The lists unfold to far more than their shuffled size, hence the hint.
    """
    block = lambda c: F.floor(c / F.lit(OWNER_BLOCK)).cast("int")
    spans = win.filter(F.col("end") > F.col("start")).select("clip", F.struct("win", "start", "end").alias("_w"), F.explode(
        F.sequence(block(F.col("start")), block(F.col("end") - 1))).alias("_block"))
    lists = spans.groupBy("clip", "_block").agg(F.sort_array(F.collect_set("_w"), asc=not last).alias("_ws"))
    holds = lambda w: (w["start"] <= F.col("frame")) & (F.col("frame") < w["end"])
    rows = frames.withColumn("_block", block(F.col("frame"))).join(lists.hint("merge"), ["clip", "_block"], "left")
    return rows.withColumn("_w", F.get(F.filter("_ws", holds), F.lit(0))).select(
        "clip", "frame", *[c for c in frames.columns if c not in ("clip", "frame")], "_w.*")


def select_windows(win: DataFrame, index: int = 0, count: int = 1, start: int | None = None,
                   end: int | None = None) -> DataFrame:
    """One shard of the schedule: ordinals in [start, end) with ordinal % count == index."""
    if count < 1 or not 0 <= index < count:
        raise ValueError(f"shard {index}/{count} is not valid")
    if (start is None) != (end is None) or (start is not None and not 0 <= start < end):
        raise ValueError("a window range needs 0 <= start < end")
    out = win.filter(F.pmod(F.col("win"), F.lit(count)) == index) if count > 1 else win
    return out if start is None else out.filter((F.col("win") >= start) & (F.col("win") < end))


def partition_check(schedule: DataFrame, selected: DataFrame) -> DataFrame:
    """Windows that the shards dropped or took twice; no rows means an exact partition."""
    owned = selected.groupBy("clip", "win").agg(F.count(F.lit(1)).alias("owners"))
    both = schedule.select("clip", "win", F.lit(True).alias("planned")).join(owned, ["clip", "win"], "full")
    problem = (
        F.when(F.col("owners").isNull(), F.lit("missing"))
        .when(F.col("planned").isNull(), F.lit("not in schedule"))
        .when(F.col("owners") > 1, F.lit("duplicated"))
    )
    return both.select("clip", "win", problem.alias("problem")).filter(F.col("problem").isNotNull())


def missing_windows(schedule: DataFrame, present: DataFrame) -> DataFrame:
    return schedule.join(present.select("clip", "win").distinct(), ["clip", "win"], "left_anti")


def cut_hands(hands: DataFrame, clips: DataFrame, window: int = 16, overlap: int = 8) -> DataFrame:
    """Cut whole-clip hand rows into windows; an invalid row carries no joints.

    Needs the clip length only to know the last window, so the join is one row per clip.
    """
    _check(window, overlap)
    sized = hands.join(clips.select("clip", "num_frames"), "clip")
    stride = window - overlap
    out = sized.withColumn("win", F.explode(window_of_frame(F.col("frame"), F.col("num_frames"), window, overlap)))
    out = out.withColumn("start", (F.col("win") * stride).cast("int")).withColumn(
        "end", F.least(F.col("start") + window, F.col("num_frames")).cast("int"))
    out = out.withColumn("joints", F.when(F.col("valid"), F.col("joints")))
    if "vertices" in hands.columns:
        out = out.withColumn("vertices", F.when(F.col("valid"), F.col("vertices")))
    return out.drop("num_frames")


def frame_slices(clips: DataFrame, size: int, context: int, length: str = "num_frames") -> DataFrame:
    """Cut clips into frame ranges plus context, clamped to the clip."""
    if size <= 0 or context < 0:
        raise ValueError("size must be positive and context not negative")
    n = F.col(length)
    parts = clips.withColumn("part", F.explode(F.sequence(F.lit(0), F.ceil(n / F.lit(size)).cast("int") - 1)))
    start = (F.col("part") * size).cast("int")
    end = F.least(start + size, n).cast("int")
    return parts.select(
        "clip", "part", start.alias("start"), end.alias("end"),
        F.greatest(F.lit(0), start - context).alias("from_frame"),
        F.least(end + context, n).cast("int").alias("to_frame"),
    )


def widen(rows: DataFrame, size: int, context: int) -> DataFrame:
    """Copy rows into each frame slice that needs them; ``inner`` marks the owned ones."""
    f = F.col("frame")
    part = F.explode(F.sequence(F.greatest(F.lit(0), F.floor((f - context) / F.lit(size))).cast("int"),
                                F.floor((f + context) / F.lit(size)).cast("int")))
    return rows.withColumn("part", part).withColumn("inner", F.col("part") == F.floor(f / F.lit(size)))


def work_list(manifest: DataFrame, shards: int = 1, stages: tuple = STAGES,
              settings: dict | None = None) -> DataFrame:
    """One row per (clip, stage, shard), with the window count and the joining unit.

    A stage that runs per window is split into ``shards``; when it is split, one more
    whole-clip unit joins the pieces. A clip may start at a later stage.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    sizes = {**STAGE_WINDOWS, **(settings or {})}
    order = F.create_map(*[p for i, s in enumerate(STAGES) for p in (F.lit(s), F.lit(i))])
    rows = manifest.withColumn("stage", F.explode(F.array(*[F.lit(s) for s in stages])))
    rows = rows.withColumn("pos", order[F.col("stage")]).filter(
        F.col("pos") >= F.coalesce(order[F.coalesce(F.col("from_stage"), F.lit(STAGES[0]))], F.lit(0)))
    total = F.lit(1)
    split = F.lit(False)
    for stage, (w, o) in sizes.items():
        here = F.col("stage") == stage
        n = F.when(F.col("num_frames") > 0, F.col("num_frames")).otherwise(
            F.raise_error(F.concat(F.lit("clip length is unknown: "), F.col("clip").cast("string"))).cast("int"))
        total = F.when(here, window_count(n, w, o)).otherwise(total)
        split = split | here
    rows = rows.withColumn("num_windows", total.cast("int")).withColumn("_split", split)
    if shards > 1:
        uneven = F.col("_split") & (F.col("num_windows") % shards != 0)
        rows = rows.withColumn("num_windows", F.when(uneven, F.raise_error(
            F.lit(f"window count does not divide into {shards} shards")).cast("int")).otherwise(F.col("num_windows")))
    pieces = F.when(F.col("_split"), F.lit(shards)).otherwise(F.lit(1))
    # Shard -1 is the unit that joins the pieces of a split stage.
    units = F.concat(F.sequence(F.lit(0), pieces - 1), F.when(pieces > 1, F.array(F.lit(-1))).otherwise(
        F.array().cast("array<int>")))
    return rows.withColumn("shard", F.explode(units)).withColumn("shards", pieces).select(
        "clip", "stage", "pos", "shard", "shards", "num_windows", "num_frames")
