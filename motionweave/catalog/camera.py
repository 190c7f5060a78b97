"""Depth, alignment and stitching on windows that differ by known similarities.

Window w sees the world through scale 1 + (w % 3) / 10, a turn of w / 10 about y and an
offset, so the right fits and the stitched camera are known in closed form. In every
second window some samples are 30 % too deep: they are the outliers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import pose, vec as v
from ..operators import depth as dp, fusion, scene, schedule as sc, similarity as sim, stitch as st
from . import views as vw
from .views import r, rnd

W, O = 12, 4
GRID = 8
HEIGHT = 2 * GRID  # one vector of a frame above the other
GK = (6.0, 0.0, 3.5, 0.0, 6.0, 3.5, 0.0, 0.0, 1.0)


def _sim_of(win):
    return pose.sim3(1.0 + 0.1 * (win % 3), v.yaw(0.1 * win), v.vec(0.2 * win, -0.1 * win, 0.05 * win))


def schedule(spark, sf):
    return sc.windows(vw.sizes(spark, sf), W, O).select("clip", "win", "start", "end")


def _windowed(rows, spark, sf):
    rows = rows.join(vw.sizes(spark, sf), "clip")
    rows = rows.withColumn("win", F.explode(sc.window_of_frame(F.col("frame"), F.col("num_frames"), W, O)))
    return rows.withColumn("start", F.col("win") * (W - O)).withColumn(
        "end", F.least(F.col("start") + W, F.col("num_frames")).cast("int")).withColumn("_w", F.col("win").cast("double"))


def camera_windows(spark, sf):
    rows = _windowed(vw.poses(spark, sf), spark, sf).withColumn("_s", _sim_of(F.col("_w"))).withColumn(
        "_i", pose.sim3_inverse(F.col("_s")))
    rot, trans = pose.sim3_pose(F.col("_i"), F.col("rot"), F.col("trans"))
    return rows.select("clip", "win", "start", "end", "frame", rot.alias("rot"), trans.alias("trans"), v.mat(*GK).alias("k"))


def depth_samples(spark, sf):
    rows = _windowed(vw.embedding_frames(spark, sf).select("clip", "frame", "side", "embedding"), spark, sf)
    rows = rows.select("clip", "win", "_w", "frame", "side", F.posexplode("embedding").alias("i", "e"))
    row, col = (GRID * F.col("side") + F.floor(F.col("i") / GRID)).cast("int"), (F.col("i") % GRID).cast("int")
    rows = rows.withColumn("row", row).withColumn("col", col)
    off = ((F.col("row") + F.col("col") + F.col("frame")) % 11 == 0) & (F.col("win") % 2 == 1)
    d = (1.5 + F.col("e").cast("double")) * F.when(off, 1.3).otherwise(1.0) / (1.0 + 0.1 * (F.col("_w") % 3))
    return rows.select("clip", "win", "frame", "row", "col", d.alias("depth"), (0.5 + 0.05 * F.col("row")).alias("depth_conf"))


POSES_SQL = vw.HANDS_SQL + ", src AS (SELECT clip, n AS num_frames FROM len)," + vw.schedule_sql(W, O, "src") + f""",
cw AS (
  SELECT win.clip, win.win, win."start", win."end", h.frame, 1 + 0.1 * (win.win % 3) AS s, 0.1 * win.win AS a,
         {vw.YAW} * h.frame AS yaw, 0.02 * h.frame - 0.2 * win.win AS dx, 0.01 * h.frame + 0.1 * win.win AS dy, -0.05 * win.win AS dz
  FROM win JOIN (SELECT DISTINCT clip, frame FROM h) h ON h.clip = win.clip AND h.frame >= win."start" AND h.frame < win."end"),
cam AS (SELECT clip, win, "start", "end", frame, s, a, yaw - a AS turn, (cos(a) * dx - sin(a) * dz) / s AS tx, dy / s AS ty,
         (sin(a) * dx + cos(a) * dz) / s AS tz FROM cw),
pix AS (SELECT *, CAST(side * {GRID} + floor(i / {GRID}) AS INTEGER) AS "row", CAST(i % {GRID} AS INTEGER) AS col FROM (
  SELECT cam.*, h.side, h.e, unnest(range(64)) AS i FROM cam JOIN h ON h.clip = cam.clip AND h.frame = cam.frame)),
ds AS (SELECT *, (1.5 + CAST(e[i + 1] AS DOUBLE)) * CASE WHEN ("row" + col + frame) % 11 = 0 AND win % 2 = 1 THEN 1.3 ELSE 1 END / s AS depth FROM pix),
lp AS (SELECT *, (col - 3.5) / 6 * depth AS px, ("row" - 3.5) / 6 * depth AS py FROM ds),
pts AS (SELECT clip, win, frame, "row", col, depth, cos(turn) * px + sin(turn) * depth + tx AS x, py + ty AS y, -sin(turn) * px + cos(turn) * depth + tz AS z FROM lp)"""


def window_poses(spark, sf):
    return camera_windows(spark, sf).select("clip", "win", "frame", rnd(F.col("rot")[2]).alias("turn"), *vw.xyz_cols(F.col("trans")))


WINDOW_POSES = f"WITH {POSES_SQL} SELECT clip, win, frame, {r('sin(turn)')} AS turn, {r('tx')} AS x, {r('ty')} AS y, {r('tz')} AS z FROM cam"


def depth_points(spark, sf):
    rows = dp.world_points(depth_samples(spark, sf), camera_windows(spark, sf), 2, 0.9, 1.6, 0.55)
    return rows.select("clip", "win", "frame", "row", "col", *vw.xyz_cols(F.col("point")))


POINTS = f"""WITH {POSES_SQL} SELECT clip, win, frame, "row", col, {r('x')} AS x, {r('y')} AS y, {r('z')} AS z FROM pts
WHERE "row" % 2 = 0 AND col % 2 = 0 AND depth > 0.9 AND depth < 1.6 AND "row" >= 1"""


def point_clouds(spark, sf):
    rows = dp.collect_clouds(depth_samples(spark, sf), camera_windows(spark, sf), HEIGHT, 3, (1.0, 1.8))
    return rows.groupBy("clip", "kind").agg(F.count(F.lit(1)).alias("points"), rnd(F.avg(F.col("point")["y"])).alias("mean_y"))


CLOUDS = f"""WITH {POSES_SQL}, k AS (
  SELECT clip, 'scene' AS kind, y FROM pts WHERE "row" % 3 = 0 AND col % 3 = 0 AND depth > 1.0 AND depth < 1.8
  UNION ALL SELECT clip, 'ground', y FROM pts WHERE "row" IN (12, 15) AND col % 3 = 0 AND depth > 1.0 AND depth < 1.8)
SELECT clip, kind, count(*) AS points, {r('avg(y)')} AS mean_y FROM k GROUP BY clip, kind"""


def _points(spark, sf, stride=1):
    return dp.world_points(depth_samples(spark, sf), camera_windows(spark, sf), stride, by_frame=True)


def depth_pairs(spark, sf):
    rows = dp.correspondences(_points(spark, sf, 2), W, O, True)
    return rows.select("clip", "win", "frame", "row", "col", *vw.xyz_cols(F.col("src"), "s"), *vw.xyz_cols(F.col("dst"), "d"),
                       rnd(F.col("weight")).alias("weight"))


PAIR_SQL = POSES_SQL + """,
pr AS (SELECT s.clip, s.win, s.frame, s."row", s.col, s.x AS sx, s.y AS sy, s.z AS sz, d.x AS dx, d.y AS dy, d.z AS dz, 0.5 + 0.05 * s."row" AS weight
  FROM pts s JOIN pts d ON d.clip = s.clip AND d.frame = s.frame AND d."row" = s."row" AND d.col = s.col AND d.win = s.win - 1)"""
PAIRS = f"""WITH {PAIR_SQL} SELECT clip, win, frame, "row", col, {', '.join(f'{r(c)} AS {c}' for c in ('sx', 'sy', 'sz', 'dx', 'dy', 'dz', 'weight'))}
FROM pr WHERE "row" % 2 = 0 AND col % 2 = 0"""


def windows_without_pairs(spark, sf):
    """Depth removed from every third window: those windows and their successors lack pairs."""
    pts = _points(spark, sf).filter("win % 3 <> 2")
    return dp.missing_pairs(schedule(spark, sf), dp.correspondences(pts, W, O)).select("clip", "win")


NO_PAIRS = f"WITH {POSES_SQL} SELECT clip, win FROM win WHERE win > 0 AND (win % 3 = 2 OR win % 3 = 0)"


def _fit_cols(f):
    return [rnd(f["scale"]).alias("scale"), rnd(pose.angle(f["rot"])).alias("angle"), *vw.xyz_cols(f["trans"])]


def _clean_pairs(spark, sf):
    pairs = dp.correspondences(_points(spark, sf), W, O, True)
    return pairs.filter((F.col("row") + F.col("col") + F.col("frame")) % 11 != 0)


def similarity_fit(spark, sf):
    """Plain weighted fit of clean pairs: recovers the known transform."""
    fits = sim.fit(sim.with_origin(_clean_pairs(spark, sf)))
    return fits.select("clip", "win", *_fit_cols(F.col("fit")))


_PREV = "(win - 1)"
_PS = f"(1 + 0.1 * ({_PREV} % 3))"
FIT_COLS = f"""{r(f'(1 + 0.1 * (win % 3)) / {_PS}')} AS scale, {r('0.1')} AS angle,
{r(f'(cos(0.1 * {_PREV}) * 0.2 - sin(0.1 * {_PREV}) * 0.05) / {_PS}')} AS x, {r(f'-0.1 / {_PS}')} AS y,
{r(f'(sin(0.1 * {_PREV}) * 0.2 + cos(0.1 * {_PREV}) * 0.05) / {_PS}')} AS z"""
SIM_FIT = f"WITH {POSES_SQL} SELECT clip, win, {FIT_COLS} FROM win WHERE win > 0"


def fit_residuals(spark, sf):
    """Largest residual of the clean fit per pair: nothing is left over."""
    pairs = sim.with_origin(_clean_pairs(spark, sf))
    rows = sim.residuals(pairs, sim.fit(pairs))
    return rows.groupBy("clip", "win").agg(F.count(F.lit(1)).alias("points"), rnd(F.max("residual")).alias("worst"))


RESIDUALS = f"""WITH {PAIR_SQL} SELECT clip, win, count(*) AS points, 0.0 AS worst FROM pr WHERE ("row" + col + frame) % 11 <> 0 GROUP BY clip, win"""


def robust_alignment(spark, sf):
    """Robust fit with outliers present: transform, counts, inlier share, overlap."""
    fits = st.align(depth_samples(spark, sf), camera_windows(spark, sf), W, O, 1)
    d = st.diagnostics(fits, schedule(spark, sf))
    return d.select("clip", "win", "num_correspondences", rnd(F.col("inlier_ratio")).alias("inlier_ratio"),
                    rnd(F.col("inlier_rmse")).alias("inlier_rmse"), rnd(F.col("scale")).alias("scale"),
                    rnd(F.col("rotation_deg")).alias("rotation_deg"), rnd(F.col("translation_norm")).alias("translation_norm"), "overlap_frames")


ROBUST = f"""WITH {PAIR_SQL}, g AS (SELECT clip, win, count(*) AS n, count(*) FILTER (WHERE ("row" + col + frame) % 11 <> 0) AS ok,
  count(DISTINCT frame) AS frames FROM pr GROUP BY clip, win)
SELECT clip, win, n AS num_correspondences, {r('CAST(ok AS DOUBLE) / n')} AS inlier_ratio, 0.0 AS inlier_rmse,
{r(f'(1 + 0.1 * (win % 3)) / {_PS}')} AS scale, {r('degrees(0.1)')} AS rotation_deg, {r(f'sqrt(0.2 * 0.2 + 0.1 * 0.1 + 0.05 * 0.05) / {_PS}')} AS translation_norm,
frames AS overlap_frames FROM g"""


def stitched_camera(spark, sf):
    """All windows stitched: the world camera comes back, from local windows alone."""
    rows = st.stitch(depth_samples(spark, sf), camera_windows(spark, sf), schedule(spark, sf), W, O, stride=1)
    return rows.select("clip", "frame", rnd(F.col("rot")[0]).alias("r00"), rnd(F.col("rot")[2]).alias("r02"),
                       *vw.xyz_cols(F.col("trans")), rnd(F.col("weight")).alias("weight"), rnd(F.col("k")[0]).alias("fx"))


STITCHED = f"""WITH {POSES_SQL} SELECT clip, frame, {r(f'cos({vw.YAW} * frame)')} AS r00, {r(f'sin({vw.YAW} * frame)')} AS r02,
{r('0.02 * frame')} AS x, {r('0.01 * frame')} AS y, 0.0 AS z, CAST(count(*) AS DOUBLE) AS weight, 6.0 AS fx FROM cam GROUP BY clip, frame"""


def window_order(spark, sf):
    """Every fourth window moved to frame 0: it now starts before its predecessor."""
    win = schedule(spark, sf).withColumn("start", F.when(F.col("win") % 4 == 2, F.lit(0)).otherwise(F.col("start")))
    return st.ordered_windows_check(win).select("clip", "win", "start")


ORDER = f'WITH {POSES_SQL} SELECT clip, win, 0 AS "start" FROM win WHERE win % 4 = 2'


def camera_path(spark, sf):
    """One pose per frame, the later window winning; two frames per clip stay uncovered."""
    frames = vw.sizes(spark, sf).select("clip", F.explode(F.sequence(F.lit(0), F.col("num_frames") + 1)).alias("frame"))
    rows = fusion.camera_path(camera_windows(spark, sf), frames)
    return rows.select("clip", "frame", "covered", *vw.xyz_cols(F.col("trans")), rnd(F.abs(F.col("quat")[1])).alias("qy"),
                       rnd(F.abs(F.col("quat")[3])).alias("qw"))


PATH = f"""WITH {POSES_SQL}, fr AS (SELECT clip, CAST(unnest(range(n + 2)) AS INTEGER) AS frame FROM len),
l AS (SELECT * FROM cam QUALIFY row_number() OVER (PARTITION BY clip, frame ORDER BY win DESC) = 1)
SELECT fr.clip, fr.frame, l.win IS NOT NULL AS covered, {r('coalesce(tx, 0)')} AS x, {r('coalesce(ty, 0)')} AS y, {r('coalesce(tz, 0)')} AS z,
{r('abs(sin(coalesce(turn, 0) / 2))')} AS qy, {r('abs(cos(coalesce(turn, 0) / 2))')} AS qw FROM fr LEFT JOIN l ON l.clip = fr.clip AND l.frame = fr.frame"""


def camera_output(spark, sf):
    """World-to-camera model output decoded back to camera poses on the depth grid."""
    p = vw.poses(spark, sf)
    rot, trans = pose.invert(F.col("rot"), F.col("trans"))
    p = p.withColumn("r", rot).withColumn("t", trans)
    p = p.select("clip", "frame", F.slice(pose.pose_to_matrix(F.col("r"), F.col("t")), 1, 12).alias("extrinsics"), "k")
    rows = dp.decode_camera_output(p, (640, 480), (64, 24))
    return rows.select("clip", "frame", rnd(F.col("rot")[2]).alias("r02"), *vw.xyz_cols(F.col("trans")),
                       *[rnd(F.col("k")[i]).alias(n) for i, n in ((0, "fx"), (4, "fy"), (5, "cy"))])


OUTPUT = f"{'WITH ' + vw.HANDS_SQL} SELECT clip, frame, {r(f'sin({vw.YAW} * frame)')} AS r02, {r('0.02 * frame')} AS x, {r('0.01 * frame')} AS y, 0.0 AS z, 50.0 AS fx, 24.0 AS fy, 12.0 AS cy FROM h WHERE side = 0"


def view_counts(spark, sf):
    """Cameras without a depth map and the other way round."""
    cams = camera_windows(spark, sf).filter("frame % 7 <> 3")
    maps = depth_samples(spark, sf).filter("frame % 5 <> 2")
    return dp.view_count_problems(cams, maps).groupBy("clip", "win", "problem").agg(F.count(F.lit(1)).alias("frames"))


VIEWS = f"""WITH {POSES_SQL}, p AS (SELECT clip, win, CASE WHEN frame % 5 = 2 AND frame % 7 <> 3 THEN 'camera without depth'
  WHEN frame % 7 = 3 AND frame % 5 <> 2 THEN 'depth without camera' END AS problem FROM cam)
SELECT clip, win, problem, count(*) AS frames FROM p WHERE problem IS NOT NULL GROUP BY clip, win, problem"""


def focal_length(spark, sf):
    """Configured, from windows, from the reference, or unavailable, by clip number."""
    c = vw.sizes(spark, sf).select("clip", F.lit(640).alias("width"), F.lit(480).alias("height"),
                                F.when(F.col("clip") % 4 == 0, 600.0).alias("focal"))
    win = camera_windows(spark, sf).filter("clip % 4 = 1 and frame = start").select(
        "clip", "win", "k", F.lit(GRID).alias("grid_w"), F.lit(GRID).alias("grid_h"))
    win = win.withColumn("k", F.when(F.col("win") == 0, v.mat(*([float("nan")] * 9))).otherwise(F.col("k")))
    ref = vw.poses(spark, sf).filter("clip % 4 = 2").select("clip", "frame", F.array((500.0 + F.col("frame"))).alias("k"))
    return fusion.resolve_focal(c, win, ref).select("clip", rnd(F.col("focal")).alias("focal"), "source")


FOCAL = f"""WITH {vw.HANDS_SQL} SELECT clip, {r('CASE clip % 4 WHEN 0 THEN 600 WHEN 1 THEN 480 WHEN 2 THEN 500 + (n - 1) / 2.0 END')} AS focal,
CASE clip % 4 WHEN 0 THEN 'config' WHEN 1 THEN 'camera windows' WHEN 2 THEN 'reference' ELSE 'unavailable' END AS source FROM len"""


def ground_plane(spark, sf):
    """Points of the plane y = 1.5 + x / 10 per supplier: normal and heights are known."""
    li = vw.table(spark, sf, "lineitem")
    x = F.col("l_quantity") / 10.0
    pts = li.select(F.col("l_suppkey").alias("clip"), v.vec(x, 1.5 + 0.1 * x, 50.0 * F.col("l_discount")).alias("point"))
    cams = vw.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("clip"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("frame"))
    cams = cams.withColumn("trans", v.vec(0.1 * F.col("frame"), 0.05 * F.col("frame"), F.lit(0.0)))
    out = scene.ground_plane(pts, cams, 620)
    return out.select("clip", "n", rnd(F.abs(F.col("normal")["x"])).alias("nx"), rnd(F.abs(F.col("normal")["y"])).alias("ny"),
                      *[rnd(F.col(c)).alias(c) for c in ("height_median", "height_min", "height_max")], "plausible")


def _enough(value: str) -> str:
    return f"CASE WHEN count(*) > 620 THEN {value} END"


GROUND = f"""SELECT l_suppkey AS clip, count(*) AS n, {_enough(r('0.1 / sqrt(1.01)'))} AS nx, {_enough(r('1 / sqrt(1.01)'))} AS ny,
{_enough(r('1.32 / sqrt(1.01)'))} AS height_median, {_enough(r('1.14 / sqrt(1.01)'))} AS height_min, {_enough(r('1.5 / sqrt(1.01)'))} AS height_max,
{_enough('true')} AS plausible FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_suppkey"""

QUERIES = {
    "window_poses": (window_poses, WINDOW_POSES),
    "depth_points": (depth_points, POINTS),
    "point_clouds": (point_clouds, CLOUDS),
    "depth_pairs": (depth_pairs, PAIRS),
    "windows_without_pairs": (windows_without_pairs, NO_PAIRS),
    "similarity_fit": (similarity_fit, SIM_FIT),
    "fit_residuals": (fit_residuals, RESIDUALS),
    "robust_alignment": (robust_alignment, ROBUST),
    "stitched_camera": (stitched_camera, STITCHED),
    "window_order": (window_order, ORDER),
    "camera_path": (camera_path, PATH),
    "camera_output": (camera_output, OUTPUT),
    "view_counts": (view_counts, VIEWS),
    "focal_length": (focal_length, FOCAL),
    "ground_plane": (ground_plane, GROUND),
}
