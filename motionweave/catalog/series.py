"""Frame-ordered operators on event series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import pose, vec as v
from ..operators import blocks, evaluate, windows as w
from . import views as vw
from .views import r, rnd


def binomial_filter(spark, sf):
    rows = vw.series(spark, sf).select("clip", "frame", F.col("raw").alias("v"))
    return w.binomial_filter(rows, ["v"], 2).select("clip", "frame", rnd(F.col("v")).alias("v"))


def _tap_sql(src: str, dst: str) -> str:
    return f"""
{dst} AS (
  SELECT clip, frame, 0.25 * coalesce(lag(v) OVER o, v) + 0.5 * v + 0.25 * coalesce(lead(v) OVER o, v) AS v
  FROM {src} WINDOW o AS (PARTITION BY clip ORDER BY frame))"""


BINOMIAL = f"WITH {vw.SERIES_SQL}, s0 AS (SELECT clip, frame, raw AS v FROM series), {_tap_sql('s0', 's1')}, {_tap_sql('s1', 's2')} SELECT clip, frame, {r('v')} AS v FROM s2"

_BRACKET = """
br AS (
  SELECT *, last_value(CASE WHEN valid THEN frame END IGNORE NULLS) OVER (PARTITION BY clip ORDER BY frame ROWS UNBOUNDED PRECEDING) AS pf,
         first_value(CASE WHEN valid THEN frame END IGNORE NULLS) OVER (PARTITION BY clip ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nf
  FROM {src})"""


def anchor_bracket(spark, sf):
    rows = blocks.bracket(vw.series(spark, sf), ["clip"], F.col("valid"), F.struct("frame", "v"))
    return rows.select("clip", "frame", F.col("prev")["frame"].alias("prev_frame"), F.col("prev")["v"].alias("prev_v"),
                       F.col("next")["frame"].alias("next_frame"), F.col("next")["v"].alias("next_v"))


BRACKET = f"""WITH {vw.SERIES_SQL}, {_BRACKET.format(src='series')}
SELECT b.clip, b.frame, b.pf AS prev_frame, p.v AS prev_v, b.nf AS next_frame, n.v AS next_v
FROM br b LEFT JOIN series p ON p.clip = b.clip AND p.frame = b.pf LEFT JOIN series n ON n.clip = b.clip AND n.frame = b.nf"""


def valid_runs(spark, sf):
    return w.run_table(vw.series(spark, sf), F.col("valid"), ["clip"]).withColumn("kind", F.lit("valid"))


def missing_runs(spark, sf):
    return w.run_table(vw.series(spark, sf), ~F.col("valid"), ["clip"]).withColumn("kind", F.lit("missing"))


def _runs_sql(cond: str, kind: str) -> str:
    return f"""WITH {vw.SERIES_SQL}, g AS (
  SELECT clip, frame, frame - row_number() OVER (PARTITION BY clip ORDER BY frame) AS island FROM series WHERE {cond})
SELECT clip, min(frame) AS "start", max(frame) + 1 AS stop, max(frame) + 1 - min(frame) AS frames, '{kind}' AS kind
FROM g GROUP BY clip, island"""


def coverage(spark, sf):
    rows = vw.series(spark, sf).withColumn("side", F.col("frame") % 2)
    return evaluate.coverage(rows).select("clip", "side", rnd(F.col("coverage")).alias("coverage"))


COVERAGE = f"""WITH {vw.SERIES_SQL}, s AS (SELECT clip, frame % 2 AS side, CAST(valid AS INTEGER) AS ok FROM series)
SELECT clip, side, {r('avg(ok)')} AS coverage FROM s GROUP BY GROUPING SETS ((clip, side), (clip))"""


def camera_filter(spark, sf):
    rows = w.filter_translation(vw.camera_series(spark, sf), "valid", 1)
    return rows.select("clip", "frame", *vw.xyz_cols(F.col("trans")))


def _masked(axis: str) -> str:
    return f"""CASE WHEN c.valid THEN c.{axis} WHEN c.pf IS NULL THEN n.{axis} WHEN c.nf IS NULL THEN p.{axis}
    ELSE p.{axis} + (n.{axis} - p.{axis}) * (c.frame - c.pf) / CAST(c.nf - c.pf AS DOUBLE) END AS {axis}"""


def _filtered(axis: str) -> str:
    return f"CASE WHEN valid THEN 0.25 * coalesce(lag({axis}) OVER o, {axis}) + 0.5 * {axis} + 0.25 * coalesce(lead({axis}) OVER o, {axis}) END AS {axis}"


CAMERA_FILTER = f"""WITH {vw.CAMERA_SERIES_SQL}, {_BRACKET.format(src='cam')},
filled AS (
  SELECT c.clip, c.frame, c.valid, {', '.join(_masked(a) for a in 'xyz')}
  FROM br c LEFT JOIN cam p ON p.clip = c.clip AND p.frame = c.pf LEFT JOIN cam n ON n.clip = c.clip AND n.frame = c.nf),
filt AS (SELECT clip, frame, valid, {', '.join(_filtered(a) for a in 'xyz')} FROM filled WINDOW o AS (PARTITION BY clip ORDER BY frame))
SELECT f.clip, f.frame, {', '.join(f'{r(f"coalesce(f.{a}, cam.{a})")} AS {a}' for a in 'xyz')}
FROM filt f JOIN cam ON cam.clip = f.clip AND cam.frame = f.frame"""


def camera_step(spark, sf):
    return w.displacement(vw.camera_series(spark, sf)).select("clip", "frame", rnd(F.col("step")).alias("step"))


CAMERA_STEP = f"""WITH {vw.CAMERA_SERIES_SQL} SELECT clip, frame, {r('sqrt(pow(x - lag(x) OVER o, 2) + pow(y - lag(y) OVER o, 2) + pow(z - lag(z) OVER o, 2))')} AS step
FROM cam WINDOW o AS (PARTITION BY clip ORDER BY frame)"""


def world0(spark, sf):
    rows = vw.camera_series(spark, sf).filter("valid").withColumn("p", v.vec(1.0, 2.0, 3.0))
    rows = w.to_world0(rows, F.col("valid"), points=["p"])
    return rows.select("clip", "frame", F.col("anchor")["frame"].alias("anchor_frame"), *vw.xyz_cols(F.col("trans")),
                       *vw.xyz_cols(F.col("p"), "p"), rnd(pose.angle(F.col("rot"))).alias("angle"))


def _turn(px: str, pz: str) -> tuple[str, str]:
    """Transpose of the yaw rotation by angle a.yaw."""
    return f"cos(a.yaw) * ({px}) - sin(a.yaw) * ({pz})", f"sin(a.yaw) * ({px}) + cos(a.yaw) * ({pz})"


_tx, _tz = _turn("c.x - a.x", "c.z - a.z")
_px, _pz = _turn("1 - a.x", "3 - a.z")
WORLD0 = f"""WITH {vw.CAMERA_SERIES_SQL}, ok AS (SELECT * FROM cam WHERE valid),
a AS (SELECT * FROM ok QUALIFY row_number() OVER (PARTITION BY clip ORDER BY frame) = 1)
SELECT c.clip, c.frame, a.frame AS anchor_frame, {r(_tx)} AS x, {r('c.y - a.y')} AS y, {r(_tz)} AS z,
       {r(_px)} AS px, {r('2 - a.y')} AS py, {r(_pz)} AS pz, {r('acos(greatest(-1, least(1, cos(c.yaw - a.yaw))))')} AS angle
FROM ok c JOIN a ON a.clip = c.clip"""


def frame_rate(spark, sf):
    rows = vw.series(spark, sf).withColumn("ts_ns", F.col("ts_us") * 1000)
    return w.fps_from_timestamps(rows).select("clip", F.round(F.col("fps") * 1e6, 3).alias("micro_fps"))


FRAME_RATE = f"""WITH {vw.SERIES_SQL}, d AS (SELECT clip, (ts_us - lag(ts_us) OVER (PARTITION BY clip ORDER BY frame)) * 1000 AS d FROM series),
m AS (SELECT clip, 1e9 / median(d) AS fps FROM d WHERE d > 0 GROUP BY clip)
SELECT clip, round(1e6 * CASE WHEN round_even(fps, 0) > 0 AND abs(fps - round_even(fps, 0)) / nullif(round_even(fps, 0), 0) < 0.005
  THEN round_even(fps, 0) ELSE fps END, 3) + 0 AS micro_fps FROM m"""


def quantiles(spark, sf):
    q = blocks.exact_quantiles(vw.series(spark, sf), ["clip"], "v", {"q25": 0.25, "median": 0.5, "p90": 0.9})
    return q.select("clip", "n", *[rnd(F.col(c)).alias(c) for c in ("q25", "median", "p90")])


QUANTILES = f"""WITH {vw.SERIES_SQL} SELECT clip, count(v) AS n, {r('quantile_cont(v, 0.25)')} AS q25, {r('median(v)')} AS median,
{r('quantile_cont(v, 0.9)')} AS p90 FROM series GROUP BY clip"""

QUERIES = {
    "binomial_filter": (binomial_filter, BINOMIAL),
    "anchor_bracket": (anchor_bracket, BRACKET),
    "valid_runs": (valid_runs, _runs_sql("valid", "valid")),
    "missing_runs": (missing_runs, _runs_sql("NOT valid", "missing")),
    "coverage": (coverage, COVERAGE),
    "camera_filter": (camera_filter, CAMERA_FILTER),
    "camera_step": (camera_step, CAMERA_STEP),
    "world0_anchor": (world0, WORLD0),
    "frame_rate": (frame_rate, FRAME_RATE),
    "exact_quantiles": (quantiles, QUANTILES),
}
