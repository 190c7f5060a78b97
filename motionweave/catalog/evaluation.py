"""Scoring a prediction against a reference with another camera and a known offset."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import box as bx, hand, vec as v
from ..operators import evaluate as ev, fusion, scene, schedule as sc
from ..plans import pipeline, quality
from . import camera, hands, views as vw
from .views import r, rnd

CHUNK = 10


def prediction(spark, sf):
    rows = fusion.fuse(vw.hands(spark, sf), vw.poses(spark, sf))
    return rows.withColumn("interpolated", F.col("frame") % 6 == 4)


def reference(spark, sf, yaw: float = vw.YAW_REF):
    """The same hands moved by (0, 3, 4) cm, other cameras, every seventh frame missing."""
    world = prediction(spark, sf).select("clip", "frame", "side", "joints_world", (F.col("frame") % 7 != 3).alias("valid"))
    moved = hand.shift_joints(F.col("joints_world"), v.vec(0.0, 0.03, 0.04))
    cam = vw.poses(spark, sf, yaw).select("clip", "frame", "rot", v.add(F.col("trans"), v.vec(0.0, 0.0, 0.001 * F.col("frame"))).alias("trans"))
    return world.withColumn("joints_world", moved).join(cam, ["clip", "frame"])


def _rates(spark, sf):
    """Odd clips run at 7 frames a second, even ones at 10."""
    return vw.sizes(spark, sf).select("clip", F.when(F.col("clip") % 2 == 1, 7.0).otherwise(10.0).alias("fps"))


RATE = "CASE WHEN {c}.clip % 2 = 1 THEN 7 ELSE 10 END"


def _ev_sql(chunk: str) -> str:
    return vw.WORLD_SQL + f""",
pr AS (SELECT clip, frame, side, joint, x, y, z, y + 0.03 AS gy, z + 0.04 AS gz, frame % 6 = 4 AS interp, valid AS pv, frame % 7 <> 3 AS gv FROM w),
both_ok AS (SELECT * FROM pr WHERE pv AND gv),
st AS (SELECT clip, n, CAST(unnest(range(n - {chunk.format(c='len')} + 1)) AS INTEGER) AS s FROM len),
er AS (
  SELECT b.clip, b.side, b.joint, b.interp, st.s AS "start",
    sqrt(pow((cos({vw.YAW} * st.s) * (b.x - 0.02 * st.s) - sin({vw.YAW} * st.s) * b.z)
           - (cos({vw.YAW_REF} * st.s) * (b.x - 0.02 * st.s) - sin({vw.YAW_REF} * st.s) * (b.gz - 0.001 * st.s)), 2)
       + pow(b.y - b.gy, 2)
       + pow((sin({vw.YAW} * st.s) * (b.x - 0.02 * st.s) + cos({vw.YAW} * st.s) * b.z)
           - (sin({vw.YAW_REF} * st.s) * (b.x - 0.02 * st.s) + cos({vw.YAW_REF} * st.s) * (b.gz - 0.001 * st.s)), 2)) AS err
  FROM both_ok b JOIN st ON st.clip = b.clip AND b.frame >= st.s AND b.frame < st.s + {chunk.format(c='b')})"""


EV_SQL = _ev_sql(str(CHUNK))


def _parts(spark, sf):
    return ev.terms(prediction(spark, sf), reference(spark, sf), CHUNK)


def action_by_joint(spark, sf):
    return ev.by_joint(_parts(spark, sf)).select("clip", "joint", rnd(F.col("error_mm")).alias("error_mm"), "n")


def action_by_hand(spark, sf):
    return ev.by_hand(_parts(spark, sf)).select("clip", "side", rnd(F.col("error_mm")).alias("error_mm"), "n")


def action_by_chunk(spark, sf):
    return ev.by_chunk(_parts(spark, sf)).select("clip", "start", rnd(F.col("error_mm")).alias("error_mm"), "n")


def _by(key: str) -> str:
    return f'WITH {EV_SQL} SELECT clip, {key}, {r("1000 * avg(err)")} AS error_mm, count(err) AS n FROM er GROUP BY clip, {key}'


def action_report(spark, sf):
    """Everything a clip is scored on, one row per clip."""
    rep = ev.report(prediction(spark, sf), reference(spark, sf), _rates(spark, sf))
    keep = {"clip", "fps", "num_frames", "num_chunks", "num_terms"}
    return rep.select(*[F.col(c) if c in keep else rnd(F.col(c)).alias(c) for c in rep.columns])


REPORT = f"""WITH {_ev_sql(RATE)}, a AS (SELECT clip, avg(err) AS e, count(err) AS num_terms, avg(err) FILTER (WHERE side = 0) AS l, avg(err) FILTER (WHERE side = 1) AS rt,
  avg(err) FILTER (WHERE joint = 0) AS wr, avg(err) FILTER (WHERE NOT interp) AS po FROM er GROUP BY clip),
d AS (SELECT clip, avg(abs(z - gz)) AS dz, count(*) AS ok FROM both_ok GROUP BY clip),
fr AS (SELECT clip, frame, bool_or(pv) AND bool_or(gv) AS ok FROM pr WHERE joint = 0 GROUP BY clip, frame),
ce AS (SELECT clip, avg(CASE WHEN ok THEN 0.001 * frame END) AS ce FROM fr GROUP BY clip),
cv AS (SELECT pr.clip, sum(CAST(pv AND gv AS INTEGER)) / (2.0 * max(len.n)) AS c, sum(CAST(pv AND gv AND NOT interp AS INTEGER)) / (2.0 * max(len.n)) AS cp,
  sum(CAST(pv AND interp AS INTEGER)) / (2.0 * max(len.n)) AS ci FROM pr JOIN len ON len.clip = pr.clip WHERE joint = 0 GROUP BY pr.clip)
SELECT len.clip, CAST({RATE.format(c='len')} AS DOUBLE) AS fps, len.n AS num_frames, len.n - {RATE.format(c='len')} + 1 AS num_chunks, {r('1000 * a.e')} AS action_mpjpe_mm, a.num_terms, {r('1000 * a.l')} AS left_mm, {r('1000 * a.rt')} AS right_mm,
{r('1000 * a.wr')} AS wrist_mm, {r('1000 * a.po')} AS action_mpjpe_predicted_only_mm, {r('1000 * d.dz')} AS world_z_error_mm, {r('d.ok / (42.0 * len.n)')} AS joint_coverage,
{r('1000 * ce.ce')} AS camera_error_mm, {r('cv.c')} AS coverage, {r('cv.cp')} AS coverage_predicted_only, {r('cv.ci')} AS coverage_interpolated
FROM len JOIN a ON a.clip = len.clip JOIN d ON d.clip = len.clip JOIN ce ON ce.clip = len.clip JOIN cv ON cv.clip = len.clip"""


def shifted_copy(spark, sf):
    """Same cameras on both sides: the error is the length of the offset, 50 mm."""
    pred = prediction(spark, sf)
    moved = pred.withColumn("joints_world", hand.shift_joints(F.col("joints_world"), v.vec(0.0, 0.03, 0.04)))
    rep = ev.action_error(ev.terms(pred, moved, CHUNK))
    return rep.select("clip", "num_terms", rnd(F.col("action_mpjpe_mm")).alias("action_mpjpe_mm"), rnd(F.col("wrist_mm")).alias("wrist_mm"))


SHIFTED = f"""WITH {EV_SQL} SELECT p.clip, count(*) AS num_terms, 50.0 AS action_mpjpe_mm, 50.0 AS wrist_mm
FROM pr p JOIN st ON st.clip = p.clip AND p.frame >= st.s AND p.frame < st.s + {CHUNK} WHERE p.pv GROUP BY p.clip"""


def ablation(spark, sf):
    """Two variants of the prediction under the same reference."""
    pred, ref = prediction(spark, sf), reference(spark, sf)
    real = pred.withColumn("valid", F.col("valid") & ~F.col("interpolated"))
    rows = ev.ablation({name: ev.action_error(ev.terms(p, ref, CHUNK)).join(ev.coverage_report(p, ref), "clip").join(_rates(spark, sf), "clip")
                        for name, p in (("all frames", pred), ("measured frames", real))})
    return rows.select("pipeline", "clip", "fps", rnd(F.col("mpjpe_mm")).alias("mpjpe_mm"), rnd(F.col("coverage")).alias("coverage"))


ABLATION = f"""WITH {EV_SQL}, c AS (SELECT pr.clip, sum(CAST(pv AND gv AS INTEGER)) / (2.0 * max(len.n)) AS a, sum(CAST(pv AND gv AND NOT interp AS INTEGER)) / (2.0 * max(len.n)) AS m
  FROM pr JOIN len ON len.clip = pr.clip WHERE joint = 0 GROUP BY pr.clip),
e AS (SELECT clip, avg(err) AS a, avg(err) FILTER (WHERE NOT interp) AS m FROM er GROUP BY clip)
SELECT 'all frames' AS pipeline, e.clip, CAST({RATE.format(c='e')} AS DOUBLE) AS fps, {r('1000 * e.a')} AS mpjpe_mm, {r('c.a')} AS coverage FROM e JOIN c ON c.clip = e.clip
UNION ALL SELECT 'measured frames', e.clip, CAST({RATE.format(c='e')} AS DOUBLE), {r('1000 * e.m')}, {r('c.m')} FROM e JOIN c ON c.clip = e.clip"""


def wrist_error(spark, sf):
    """The reference drifts with the frame here, so the quantiles differ."""
    ref = reference(spark, sf)
    drift = hand.shift_joints(F.col("joints_world"), v.vec(0.001 * F.col("frame"), F.lit(0.0), F.lit(0.0)))
    rows = ev.wrist_error(prediction(spark, sf), ref.withColumn("joints_world", drift))
    return rows.select("clip", "n", *[rnd(F.col(c)).alias(c) for c in ("mean_mm", "median_mm", "p90_mm")])


WRIST = f"""WITH {EV_SQL}, d AS (SELECT clip, 1000 * sqrt(0.0025 + pow(0.001 * frame, 2)) AS d FROM both_ok WHERE joint = 0)
SELECT clip, count(*) AS n, {r('avg(d)')} AS mean_mm, {r('median(d)')} AS median_mm, {r('quantile_cont(d, 0.9)')} AS p90_mm FROM d GROUP BY clip"""


def length_mismatch(spark, sf):
    """Reference cut short in even clips, missing in clip 9, and without its middle frames 3 and 4 in clip 7."""
    ref = reference(spark, sf).filter("clip <> 9 and (clip % 2 = 1 or frame < 5) and (clip <> 7 or frame not in (3, 4))")
    return ev.length_mismatch(prediction(spark, sf), ref)


MISMATCH = f"""WITH {vw.HANDS_SQL} SELECT clip, n AS num_frames, n AS present, CASE WHEN clip = 7 THEN n WHEN clip <> 9 THEN 5 END AS ref_frames,
CASE WHEN clip = 7 THEN n - 2 WHEN clip <> 9 THEN 5 END AS ref_present FROM len WHERE clip % 2 = 0 OR clip IN (7, 9)"""


def action_with_holes(spark, sf):
    """Middle frames absent on one side and the other, not strict: absent rows are unusable, frames and terms are not lost."""
    pred = prediction(spark, sf).filter("frame <> 5")
    ref = reference(spark, sf).filter("frame not in (8, 9)")
    rep = ev.action_error(ev.terms(pred, ref, CHUNK, strict=False)).join(ev.coverage_report(pred, ref), "clip")
    return rep.select("clip", "num_terms", rnd(F.col("action_mpjpe_mm")).alias("action_mpjpe_mm"), rnd(F.col("coverage")).alias("coverage"))


HOLES = f"""WITH {EV_SQL}, k AS (SELECT b.clip, b.frame, st.s, b.x, b.y, b.z, b.gy, b.gz FROM both_ok b JOIN st ON st.clip = b.clip AND b.frame >= st.s AND b.frame < st.s + {CHUNK}
  WHERE b.frame NOT IN (5, 8, 9) AND st.s NOT IN (5, 8, 9)),
d AS (SELECT clip, sqrt(pow((cos({vw.YAW} * s) * (x - 0.02 * s) - sin({vw.YAW} * s) * z)
           - (cos({vw.YAW_REF} * s) * (x - 0.02 * s) - sin({vw.YAW_REF} * s) * (gz - 0.001 * s)), 2) + pow(y - gy, 2)
       + pow((sin({vw.YAW} * s) * (x - 0.02 * s) + cos({vw.YAW} * s) * z)
           - (sin({vw.YAW_REF} * s) * (x - 0.02 * s) + cos({vw.YAW_REF} * s) * (gz - 0.001 * s)), 2)) AS err FROM k),
c AS (SELECT pr.clip, sum(CASE WHEN pv AND gv AND frame NOT IN (5, 8, 9) THEN 1 ELSE 0 END) / (2.0 * max(len.n)) AS coverage FROM pr JOIN len ON len.clip = pr.clip WHERE joint = 0 GROUP BY pr.clip)
SELECT d.clip, count(*) AS num_terms, {r('1000 * avg(err)')} AS action_mpjpe_mm, {r('max(c.coverage)')} AS coverage FROM d JOIN c ON c.clip = d.clip GROUP BY d.clip"""


def scored_rows(spark, sf):
    """Trajectory rows with the frame rate of their clip; unvalidated references left out."""
    pred = prediction(spark, sf)
    meta = pred.groupBy("clip").agg(F.max("frame").alias("m")).select(
        "clip", (F.lit(20.0) + F.col("clip")).alias("fps"), (F.col("clip") % 3 != 0).alias("wrist_validated"))
    rows = ev.scorable(ev.load(pred, meta), meta)
    return rows.groupBy("clip", "fps").agg(F.count(F.lit(1)).alias("rows"), F.count_if("interpolated").alias("interpolated"))


SCORED = f"WITH {vw.HANDS_SQL} SELECT clip, 20.0 + clip AS fps, count(*) AS rows, count(*) FILTER (WHERE frame % 6 = 4) AS interpolated FROM h WHERE clip % 3 <> 0 GROUP BY clip"


def throughput(spark, sf):
    """Frames per second from frame counts and elapsed seconds."""
    c = vw.clips(spark, sf)
    return c.select("clip", rnd(ev.measured_fps(F.col("num_frames"), F.lit(1.5) + F.col("clip") % 7)).alias("fps"))


THROUGHPUT = f"WITH {vw.CLIPS_SQL} SELECT clip, {r('num_frames / (1.5 + clip % 7)')} AS fps FROM c"


def trajectory_metadata(spark, sf):
    m = fusion.metadata(prediction(spark, sf), _rates(spark, sf))
    return m.withColumn("coverage_left", rnd(F.col("coverage_left"))).withColumn("coverage_right", rnd(F.col("coverage_right")))


METADATA = f"""WITH {vw.HANDS_SQL} SELECT clip, CAST({RATE.format(c='h')} AS DOUBLE) AS fps, 0 AS world_frame, '21_joints_metric_xyz' AS hand_representation, 'c2w' AS camera_convention,
'meter' AS units, max(frame) + 1 AS num_frames, {r('avg(CASE WHEN side = 0 THEN CAST(valid AS INTEGER) END)')} AS coverage_left,
{r('avg(CASE WHEN side = 1 THEN CAST(valid AS INTEGER) END)')} AS coverage_right FROM h GROUP BY clip"""


def broken(spark, sf):
    """Contract breaks: short arrays, valid rows without joints, an unpaired last frame."""
    t = prediction(spark, sf)
    t = t.withColumn("betas", F.when(F.col("frame") % 8 == 1, F.slice("betas", 1, 9)).otherwise(F.col("betas")))
    return t.withColumn("joints_world", F.when(F.col("frame") % 9 != 2, F.col("joints_world")))


def trajectory_problems(spark, sf):
    return quality.trajectory_problems(broken(spark, sf))


PROBLEMS = f"""WITH {vw.HANDS_SQL}, g AS (SELECT clip, count(*) FILTER (WHERE frame % 8 = 1) AS b, count(*) FILTER (WHERE valid AND frame % 9 = 2) AS v, count(*) AS n,
  max(frame) + 1 AS t FROM h GROUP BY clip), u AS (
  SELECT clip, 'betas' AS field, 'length is not 10' AS problem, b AS rows FROM g UNION ALL SELECT clip, 'joints_world', 'valid without joints', v FROM g
  UNION ALL SELECT clip, 'frame', 'frames are not 0..T-1 for both sides', CASE WHEN n <> 2 * t THEN n ELSE 0 END FROM g) SELECT * FROM u WHERE rows > 0"""


def scene_bounds(spark, sf):
    rows = scene.bounds(prediction(spark, sf))
    return rows.select("clip", *[rnd(F.col(c)).alias(c) for c in rows.columns if c != "clip"])


def _axis(a: str) -> str:
    half = f"greatest(greatest(max({a}) - min({a}), 0.3) / 2, 0.25)"
    mid = f"(max({a}) + min({a})) / 2"
    return f"{r(f'{mid} - {half}')} AS {a}_min, {r(f'{mid} + {half}')} AS {a}_max"


BOUNDS = f"""WITH {vw.WORLD_SQL}, p AS (SELECT clip, 100 * x AS x, 100 * y AS y, 100 * z AS z FROM w WHERE valid
  UNION ALL SELECT clip, 2.0 * frame, 1.0 * frame, 0 FROM h) SELECT clip, {', '.join(_axis(a) for a in 'xyz')} FROM p GROUP BY clip"""


def wrist_pixels(spark, sf):
    rows = scene.wrist_pixels(prediction(spark, sf))
    return rows.select("clip", "frame", "side", F.col("pixel")["u"].alias("u"), F.col("pixel")["v"].alias("v"))


PIXELS = f"""WITH {vw.HANDS_SQL} SELECT clip, frame, side, CASE WHEN valid AND z > 1e-6 THEN CAST(round_even(500 * x / z + 320, 0) AS INTEGER) END AS u,
CASE WHEN valid AND z > 1e-6 THEN CAST(round_even(480 * y / z + 240, 0) AS INTEGER) END AS v FROM j WHERE joint = 0"""


def skeleton_edges(spark, sf):
    rows = vw.hands(spark, sf).withColumn("k", v.mat(*vw.K))
    e = scene.skeleton_edges(rows)
    return e.select("clip", "frame", "side", "bone", F.col("a")["u"].alias("au"), F.col("a")["v"].alias("av"),
                    F.col("b")["u"].alias("bu"), F.col("b")["v"].alias("bv"))


def _px(t: str, name: str) -> str:
    return f"CAST(round_even(500 * {t}.x / {t}.z + 320, 0) AS INTEGER) AS {name}u, CAST(round_even(480 * {t}.y / {t}.z + 240, 0) AS INTEGER) AS {name}v"


def _edges_sql() -> str:
    from .hands import BONES_SQL

    return f"""WITH {vw.HANDS_SQL}, {BONES_SQL} SELECT c.clip, c.frame, c.side, b.bone, {_px('p', 'a')}, {_px('c', 'b')}
FROM bones b JOIN j c ON c.joint = b.child JOIN j p ON p.joint = b.parent AND p.clip = c.clip AND p.side = c.side AND p.frame = c.frame WHERE c.valid"""


def stills(spark, sf):
    return scene.stills(vw.clips(spark, sf), 5, 4)


# Stills fall on kept frames 0, g, 2g, 3g with g = max(1, kept // 4), clipped to the last one.
STILLS = f"""WITH {vw.CLIPS_SQL}, k AS (SELECT clip, CAST(ceil(num_frames / 5.0) AS INTEGER) AS kept FROM c),
s AS (SELECT clip, kept, CAST(unnest(range(kept)) AS INTEGER) AS i FROM k),
t AS (SELECT DISTINCT clip, least(kept - 1, q * greatest(1, kept // 4)) AS i FROM (SELECT clip, kept, unnest(range(4)) AS q FROM k))
SELECT s.clip, s.i * 5 AS frame, t.i IS NOT NULL AS still FROM s LEFT JOIN t ON t.clip = s.clip AND t.i = s.i"""


def refined_trajectory(spark, sf):
    """All refinement steps in order: gaps, camera filter, bone lengths, wrist depth, world."""
    traj = prediction(spark, sf)
    rows = pipeline.refine_trajectory(traj, vw.poses(spark, sf), 2)
    return vw.long_joints(rows.filter("valid"), "joints_world", extra=("interpolated",))


def filtered_world(spark, sf):
    """Refinement with only the camera filter on: world joints under the filtered, re-anchored camera."""
    rows = pipeline.refine_trajectory(prediction(spark, sf), vw.poses(spark, sf), None, 1, None, wrist_lambda=None)
    return vw.long_joints(rows.filter("valid"), "joints_world")


# The path is straight, so filtering moves its two ends by a quarter step only.
FILTERED = f"""WITH {vw.HANDS_SQL}, q AS (SELECT j.*, frame + CASE WHEN frame = 0 THEN 0.25 WHEN frame = n - 1 THEN -0.25 ELSE 0 END - 0.25 AS m
  FROM j JOIN len ON len.clip = j.clip WHERE valid)
SELECT clip, frame, side, joint, {r(f'cos({vw.YAW} * frame) * x + sin({vw.YAW} * frame) * z + 0.02 * m')} AS x, {r('y + 0.01 * m')} AS y,
{r(f'-sin({vw.YAW} * frame) * x + cos({vw.YAW} * frame) * z')} AS z FROM q"""


# Bones are corrected on the filled joints, and the solve sees the corrected wrists.
_BONES_OF_FILLED = hands.BS_SQL.removeprefix(vw.HANDS_SQL).replace("JOIN j ", "JOIN fj ").replace("FROM j ", "FROM fj ")
REFINED = f"""WITH RECURSIVE {hands.FILL_SQL},
fj AS (SELECT f.clip, f.frame, f.side, f.interpolated, f.conf, true AS valid, p.joint,
  {', '.join(f"CASE WHEN f.interpolated THEN (1 - f.wt) * p.{a} + f.wt * n.{a} ELSE p.{a} END AS {a}" for a in 'xyz')}
  FROM filled f JOIN j p ON p.clip = f.clip AND p.side = f.side AND p.frame = f.pf
  JOIN j n ON n.clip = f.clip AND n.side = f.side AND n.frame = f.nf AND n.joint = p.joint WHERE f.valid){_BONES_OF_FILLED},
c0 AS (SELECT clip, frame, side, valid, conf, interpolated, x / z AS rx, y / z AS ry, z FROM fj WHERE joint = 0),{hands.SOLVE_SQL},
w AS (SELECT c0.*, coalesce(up.x - c0.z, 0) AS step FROM c0 LEFT JOIN s ON s.clip = c0.clip AND s.side = c0.side AND s.frame = c0.frame
  LEFT JOIN up ON up.run = s.run AND up.i = s.i),
out AS (SELECT fx.clip, fx.frame, fx.side, fx.joint, w.interpolated, fx.x + w.step * w.rx AS x, fx.y + w.step * w.ry AS y, fx.z + w.step AS z,
  fx.frame + CASE WHEN fx.frame = 0 THEN 0.25 WHEN fx.frame = n - 1 THEN -0.25 ELSE 0 END - 0.25 AS m
  FROM fixed fx JOIN w ON w.clip = fx.clip AND w.side = fx.side AND w.frame = fx.frame JOIN len ON len.clip = fx.clip)
SELECT clip, frame, side, joint, interpolated, {r(f'cos({vw.YAW} * frame) * x + sin({vw.YAW} * frame) * z + 0.02 * m')} AS x, {r('y + 0.01 * m')} AS y,
{r(f'-sin({vw.YAW} * frame) * x + cos({vw.YAW} * frame) * z')} AS z FROM out"""


def full_pipeline(spark, sf):
    """Detections, hand windows, camera windows and depth all the way to world joints.

    The windows are cut from known hands and cameras, so the fused result is known too.
    """
    h, clips = vw.hands(spark, sf), vw.sizes(spark, sf)
    wrist = F.col("joints")[0]
    corner = lambda d: 100.0 * wrist["x"] + d, lambda d: 100.0 * wrist["y"] + d
    dets = h.filter("valid").select("clip", "frame", F.col("side").alias("slot"), bx.box(
        corner[0](0), corner[1](0), corner[0](50), corner[1](50)).alias("box"), F.lit(0.9).alias("conf"), "side")
    rows = pipeline.raw_trajectory(
        dets, sc.cut_hands(h, clips, 8, 4), camera.depth_samples(spark, sf), camera.camera_windows(spark, sf), clips,
        camera.schedule(spark, sf), camera.W, camera.O, 30.0, stride=1)
    rows = rows.withColumn("boxed", F.col("box").isNotNull())
    return vw.long_joints(rows.filter("valid"), "joints_world", extra=("track_id", "boxed"))


PIPELINE = f"""WITH {vw.WORLD_SQL} SELECT clip, frame, side, joint, 0 AS track_id, true AS boxed, {r('x')} AS x, {r('y')} AS y, {r('z')} AS z FROM w WHERE valid"""

QUERIES = {
    "full_pipeline": (full_pipeline, PIPELINE),
    "action_report": (action_report, REPORT),
    "action_by_joint": (action_by_joint, _by("joint")),
    "action_by_hand": (action_by_hand, _by("side")),
    "action_by_chunk": (action_by_chunk, _by('"start"')),
    "shifted_copy": (shifted_copy, SHIFTED),
    "ablation": (ablation, ABLATION),
    "wrist_error": (wrist_error, WRIST),
    "length_mismatch": (length_mismatch, MISMATCH),
    "action_with_holes": (action_with_holes, HOLES),
    "scored_rows": (scored_rows, SCORED),
    "throughput": (throughput, THROUGHPUT),
    "trajectory_metadata": (trajectory_metadata, METADATA),
    "trajectory_problems": (trajectory_problems, PROBLEMS),
    "scene_bounds": (scene_bounds, BOUNDS),
    "wrist_pixels": (wrist_pixels, PIXELS),
    "skeleton_edges": (skeleton_edges, _edges_sql()),
    "stills": (stills, STILLS),
    "refined_trajectory": (refined_trajectory, REFINED),
    "filtered_world": (filtered_world, FILTERED),
}
