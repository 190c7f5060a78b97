"""Window schedules over clips whose lengths come from the orders table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import schedule as sc, windows as w
from ..schemas import STAGES
from . import views as vw
from .views import r, rnd

W, O = 16, 8
BASE = f"WITH {vw.CLIPS_SQL}, {vw.schedule_sql(W, O)}"


def _win(spark, sf):
    return sc.windows(vw.clips(spark, sf), W, O)


def window_schedule(spark, sf):
    return _win(spark, sf).select("clip", "win", "start", "end", "name")


SCHEDULE = BASE + """ SELECT clip, win, "start", "end", printf('%06d_%06d', "start", "end" - 1) AS name FROM win"""


def window_coverage(spark, sf):
    return sc.coverage(_win(spark, sf))


FRAMES = """, wf AS (SELECT clip, win, "start", "end", CAST(unnest(range("start", "end")) AS INTEGER) AS frame FROM win)"""
COVERAGE = BASE + FRAMES + " SELECT clip, frame, count(*) AS windows FROM wf GROUP BY clip, frame"


def shard_selection(spark, sf):
    rows = sc.select_windows(_win(spark, sf), 1, 4, 0, 20)
    return rows.groupBy("clip").agg(F.count(F.lit(1)).alias("windows"), F.min("win").alias("first"), F.max("win").alias("last"))


SELECTION = BASE + ' SELECT clip, count(*) AS windows, min(win) AS "first", max(win) AS "last" FROM win WHERE win % 4 = 1 AND win < 20 GROUP BY clip'


def shard_partition(spark, sf):
    """Three of four shards plus one taken twice: dropped and doubled windows show up."""
    win = _win(spark, sf)
    taken = [sc.select_windows(win, i, 4) for i in (0, 1, 1, 2)]
    rows = taken[0]
    for t in taken[1:]:
        rows = rows.unionByName(t)
    return sc.partition_check(win, rows).groupBy("clip", "problem").agg(F.count(F.lit(1)).alias("windows"))


PARTITION = BASE + """, p AS (SELECT clip, CASE win % 4 WHEN 1 THEN 'duplicated' WHEN 3 THEN 'missing' END AS problem FROM win)
SELECT clip, problem, count(*) AS windows FROM p WHERE problem IS NOT NULL GROUP BY clip, problem"""


def missing_windows(spark, sf):
    win = _win(spark, sf)
    return sc.missing_windows(win, win.filter("win % 7 <> 3")).select("clip", "win", "start", "end")


MISSING = BASE + ' SELECT clip, win, "start", "end" FROM win WHERE win % 7 = 3'


def overlap_ramp(spark, sf):
    """Blend weight of every window frame against the previous window."""
    rows = sc.to_frames(sc.overlap_with_previous(_win(spark, sf), W, O))
    a = w.overlap_ramp(F.col("frame"), F.col("ov_start"), F.col("ov_end"))
    return rows.groupBy("clip", "win").agg(rnd(F.sum(a)).alias("total"), rnd(F.min(a)).alias("low"), F.count(F.lit(1)).alias("frames"))


RAMP = BASE + FRAMES + f""", lagged AS (SELECT clip, win, "start", "end", lag("end") OVER (PARTITION BY clip ORDER BY win) AS pe FROM win),
al AS (SELECT wf.clip, wf.win, CASE WHEN l.pe IS NULL OR wf.frame >= least(l.pe, l."end") OR least(l.pe, l."end") - l."start" <= 1 THEN 1
  ELSE (wf.frame - l."start") / CAST(least(l.pe, l."end") - l."start" - 1 AS DOUBLE) END AS a FROM wf JOIN lagged l ON l.clip = wf.clip AND l.win = wf.win)
SELECT clip, win, {r('sum(a)')} AS total, {r('min(a)')} AS low, count(*) AS frames FROM al GROUP BY clip, win"""


def owner_window(spark, sf):
    """First and last window that holds each frame."""
    win = _win(spark, sf)
    frames = sc.frames(vw.clips(spark, sf).filter("clip is not null")).withColumn("frame", F.col("frame").cast("int"))
    last = sc.owner_window(frames, win, True).select("clip", "frame", F.col("win").alias("last_win"))
    return sc.owner_window(last, win, False).select("clip", "frame", "last_win", F.col("win").alias("first_win"))


OWNER = BASE + FRAMES + " SELECT clip, frame, max(win) AS last_win, min(win) AS first_win FROM wf GROUP BY clip, frame"


def frame_slices(spark, sf):
    return sc.frame_slices(vw.clips(spark, sf), 50, 6)


SLICES = f"""WITH {vw.CLIPS_SQL}, p AS (SELECT clip, num_frames, CAST(unnest(range(CAST(ceil(num_frames / 50.0) AS BIGINT))) AS INTEGER) AS part FROM c)
SELECT clip, part, part * 50 AS "start", least(part * 50 + 50, num_frames) AS "end", greatest(0, part * 50 - 6) AS from_frame,
       least(least(part * 50 + 50, num_frames) + 6, num_frames) AS to_frame FROM p"""


def work_list(spark, sf):
    """Whole-clip units, every fourth clip starting at fusion."""
    m = vw.clips(spark, sf).withColumn("from_stage", F.when(F.col("clip") % 4 == 0, F.lit("fusion")))
    return sc.work_list(m, 1).select("clip", "stage", "pos", "shard", "shards", "num_windows")


def sharded_work(spark, sf):
    """Two shards per window stage, for clips whose windows divide evenly, plus the joining unit."""
    c = vw.clips(spark, sf)
    even = lambda s: sc.window_count(F.col("num_frames"), *s) % 2 == 0
    m = c.filter(even((16, 8)) & even((200, 40))).withColumn("from_stage", F.lit(None).cast("string"))
    return sc.work_list(m, 2, ("hand", "camera", "stitch")).select("clip", "stage", "pos", "shard", "shards", "num_windows")


def _n(w_, o):
    return f"CAST(greatest(1, ceil((num_frames - {o}) / {w_ - o}.0)) AS INTEGER)"


_STAGES = ", ".join(f"('{s}', {i})" for i, s in enumerate(STAGES))
_WIN_OF = f"CASE stage WHEN 'hand' THEN {_n(16, 8)} WHEN 'camera' THEN {_n(200, 40)} ELSE 1 END"
WORK = f"""WITH {vw.CLIPS_SQL}, st(stage, pos) AS (VALUES {_STAGES})
SELECT clip, stage, pos, 0 AS shard, 1 AS shards, {_WIN_OF} AS num_windows FROM c, st WHERE clip % 4 <> 0 OR pos >= 5"""
SHARDED = f"""WITH {vw.CLIPS_SQL}, st(stage, pos) AS (VALUES ('hand', 2), ('camera', 3), ('stitch', 4)), sh(shard) AS (VALUES (-1), (0), (1))
SELECT clip, stage, pos, shard, CASE WHEN stage = 'stitch' THEN 1 ELSE 2 END AS shards, {_WIN_OF} AS num_windows
FROM c, st, sh WHERE {_n(16, 8)} % 2 = 0 AND {_n(200, 40)} % 2 = 0 AND (stage <> 'stitch' OR shard = 0)"""

QUERIES = {
    "window_schedule": (window_schedule, SCHEDULE),
    "window_coverage": (window_coverage, COVERAGE),
    "missing_windows": (missing_windows, MISSING),
    "overlap_ramp": (overlap_ramp, RAMP),
    "owner_window": (owner_window, OWNER),
    "frame_slices": (frame_slices, SLICES),
}
