"""Frame-ordered operators: filters, runs, ramps, anchoring, displacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pose, vec as v
from .blocks import BLOCK, bracket, exact_quantiles, over_halo, over_rows, previous


def _tap(x: Column, before: Column, after: Column) -> Column:
    return 0.25 * before + 0.5 * x + 0.25 * after


def binomial_filter(df: DataFrame, cols: Sequence[str], passes: int = 1, keys: Sequence[str] = ("clip",),
                    block: int = BLOCK) -> DataFrame:
    """3-tap [1/4, 1/2, 1/4] filter over the rows of a clip in order; the edge value is repeated."""
    if passes < 1:
        raise ValueError("passes must be positive")

    def body(rows, asc, _):
        for _pass in range(passes):
            rows = rows.withColumns({
                c: _tap(F.col(c), F.coalesce(F.lag(c).over(asc), F.col(c)), F.coalesce(F.lead(c).over(asc), F.col(c)))
                for c in cols
            })
        return rows

    return over_rows(df, keys, passes, passes, body, block=block)


def filter_translation(df: DataFrame, valid: str = "valid", passes: int = 1, trans: str = "trans",
                       keys: Sequence[str] = ("clip",), block: int = BLOCK) -> DataFrame:
    """Filter camera translation. Invalid frames are bridged linearly for the filter
    only (ends hold the nearest valid value) and get their own value back afterwards."""
    ok = F.coalesce(F.col(valid), F.lit(False))
    rows = bracket(df, keys, ok, F.struct("frame", F.col(trans).alias("t")), "_prev", "_next", block=block)
    p, n = F.col("_prev"), F.col("_next")
    w = F.when(n["frame"] > p["frame"], (F.col("frame") - p["frame"]) / (n["frame"] - p["frame"])).otherwise(0.0)
    line = v.lerp(F.coalesce(p, n)["t"], F.coalesce(n, p)["t"], w)
    rows = rows.withColumn("_s", F.when(ok, F.col(trans)).otherwise(line))
    for a in "xyz":
        rows = rows.withColumn(f"_{a}", F.col("_s")[a])
    rows = binomial_filter(rows.drop("_prev", "_next", "_s"), ["_x", "_y", "_z"], passes, keys, block)
    return rows.withColumn(trans, F.when(ok, v.vec(F.col("_x"), F.col("_y"), F.col("_z"))).otherwise(F.col(trans))
                           ).drop("_x", "_y", "_z")


def smooth_hands(df: DataFrame, passes: int = 1, keys: Sequence[str] = ("clip", "side"),
                 cols: Sequence[str] = ("joints",), block: int = BLOCK) -> DataFrame:
    """3-tap smoothing where this frame and both neighbours are valid and complete.

    Run edges and gaps keep their values. Joints and vertices are judged separately.
    """
    if passes < 0:
        raise ValueError("passes must not be negative")
    if passes == 0:
        return df

    def body(rows, asc, _):
        trio_ok = (
            F.col("valid") & F.lag("valid").over(asc) & F.lead("valid").over(asc)
            & (F.lag("frame").over(asc) == F.col("frame") - 1) & (F.lead("frame").over(asc) == F.col("frame") + 1)
        )
        for _pass in range(passes):
            rows = rows.withColumn("_ok", F.coalesce(trio_ok, F.lit(False)))
            for c in cols:
                rows = rows.withColumn("_b", F.lag(c).over(asc)).withColumn("_e", F.lead(c).over(asc))
                usable = F.col("_ok") & v.all_finite(F.col(c)) & v.all_finite(F.col("_b")) & v.all_finite(F.col("_e"))
                sides = F.zip_with("_b", "_e", lambda p, q: v.vec(*[0.25 * (p[a] + q[a]) for a in "xyz"]))
                mixed = F.zip_with(F.col(c), sides, lambda p, q: v.vec(*[0.5 * p[a] + q[a] for a in "xyz"]))
                rows = rows.withColumn(c, F.when(usable, mixed).otherwise(F.col(c)))
        return rows.drop("_ok", "_b", "_e")

    return over_halo(df, keys, passes, passes, body, block=block)


def runs(df: DataFrame, flag: Column, keys: Sequence[str] = ("clip", "side"), block: int = BLOCK) -> DataFrame:
    """Add ``run_start`` and ``run_end`` (inclusive) of the contiguous run of ``flag``
    that holds the row; rows outside any run are dropped."""
    rows = df.withColumn("_f", F.coalesce(flag, F.lit(False)))

    def edges(r, asc, _):
        before = F.coalesce(F.lag("_f").over(asc) & (F.lag("frame").over(asc) == F.col("frame") - 1), F.lit(False))
        after = F.coalesce(F.lead("_f").over(asc) & (F.lead("frame").over(asc) == F.col("frame") + 1), F.lit(False))
        return r.withColumn("_s", F.col("_f") & ~before).withColumn("_e", F.col("_f") & ~after)

    rows = over_halo(rows, keys, 1, 1, edges, block=block).filter("_f")
    rows = bracket(rows, keys, F.col("_s"), F.struct(F.col("frame").alias("frame")), "_rs", "_re", block=block,
                   next_anchor=F.col("_e"))
    return rows.withColumn("run_start", F.col("_rs")["frame"]).withColumn(
        "run_end", F.col("_re")["frame"]).drop("_f", "_s", "_e", "_rs", "_re")


def run_table(df: DataFrame, flag: Column, keys: Sequence[str] = ("clip", "side"), block: int = BLOCK) -> DataFrame:
    """One row per run: [start, stop). Each run is read off its two edge rows."""
    rows = runs(df, flag, keys, block)
    return rows.filter(F.col("frame") == F.col("run_start")).select(
        *keys, F.col("run_start").alias("start"), (F.col("run_end") + 1).alias("stop"),
        (F.col("run_end") - F.col("run_start") + 1).alias("frames"))


def overlap_ramp(frame: Column, ov_start: Column, ov_end: Column) -> Column:
    """Blend weight: 0 -> 1 across the frames shared with the previous window, else 1.

    A single shared frame gets weight 1."""
    n = ov_end - ov_start
    inside = (frame >= ov_start) & (frame < ov_end) & (n > 1)
    return F.coalesce(F.when(inside, (frame - ov_start) / F.nullif((n - 1).cast("double"), F.lit(0.0))), F.lit(1.0))


def first_camera(df: DataFrame, valid: Column | None = None, keys: Sequence[str] = ("clip",)) -> DataFrame:
    """Pose of the first valid frame per clip (map-side combined, one row per clip)."""
    ok = F.lit(True) if valid is None else valid
    return df.filter(ok).groupBy(*keys).agg(
        F.min_by(F.struct("rot", "trans", "frame"), "frame").alias("anchor"))


def to_world0(df: DataFrame, valid: Column | None = None, keys: Sequence[str] = ("clip",),
              points: Sequence[str] = (), joints: Sequence[str] = (), rotations: Sequence[str] = ()) -> DataFrame:
    """Re-express poses (and points, joint arrays, rotations) in the first valid camera.

    A clip without a valid camera is an error.
    """
    out = df.join(first_camera(df, valid, keys), list(keys), "left").withColumn(
        "anchor", F.coalesce("anchor", F.raise_error(F.lit("no valid camera to anchor on")).cast(
            "struct<rot:array<double>,trans:struct<x:double,y:double,z:double>,frame:int>")))
    r, t = F.col("anchor")["rot"], F.col("anchor")["trans"]
    new = {"rot": v.tmul(r, F.col("rot")), "trans": v.tmul_vec(r, v.sub(F.col("trans"), t))}
    new |= {c: pose.to_camera(r, t, F.col(c)) for c in points}
    new |= {c: pose.joints_to_camera(r, t, F.col(c)) for c in joints}
    new |= {c: F.when(F.col(c).isNotNull(), v.tmul(r, F.col(c))) for c in rotations}
    return out.withColumns(new)


def displacement(df: DataFrame, keys: Sequence[str] = ("clip",), block: int = BLOCK) -> DataFrame:
    """Camera-centre step length from the previous row; NULL on the first row."""
    rows = previous(df, keys, F.struct("trans"), "_prev", block=block)
    return rows.withColumn("step", v.distance(F.col("trans"), F.col("_prev")["trans"])).drop("_prev")


def fps_from_timestamps(df: DataFrame, ts: str = "ts_ns", keys: Sequence[str] = ("clip",), snap: float = 0.005,
                        block: int = BLOCK) -> DataFrame:
    """1e9 / median positive step, snapped to a whole rate when within ``snap``.

    Steps of a clip take few distinct values, so they are counted before the median.
    """
    steps = previous(df, keys, F.struct(F.col(ts).alias("ts")), "_prev", block=block).withColumn(
        "_d", F.col(ts) - F.col("_prev")["ts"]).filter("_d > 0")
    med = exact_quantiles(steps, keys, "_d", {"step_ns": 0.5})
    fps = F.lit(1e9) / F.col("step_ns")
    near = F.bround(fps)
    return med.select(*keys, F.when((near > 0) & (F.abs(fps - near) / F.nullif(near, F.lit(0.0)) < snap), near)
                      .otherwise(fps).alias("fps"))
