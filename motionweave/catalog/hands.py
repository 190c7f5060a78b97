"""Hand-skeleton operators on joints taken from the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import camera, hand, pose, vec as v
from ..operators import blend, fusion, refine, schedule as sc, windows as w
from ..schemas import BONES
from . import views as vw
from .views import r, rnd

HW = f"WITH {vw.HANDS_SQL}"
_BONE_ROWS = ", ".join(f"({c - 1}, {p}, {c})" for p, c in BONES)
BONES_SQL = f"bones(bone, parent, child) AS (VALUES {_BONE_ROWS})"




# ------------------------------------------------------------------ gap filling
MAX_GAP = 2


def _filled(spark, sf):
    return refine.fill_gaps(vw.hands(spark, sf), MAX_GAP)


def gap_fill(spark, sf):
    rows = _filled(spark, sf).filter("valid")
    return vw.long_joints(rows, extra=("interpolated", rnd(F.col("conf")).alias("conf")))


FILL_SQL = vw.HANDS_SQL + """,
a AS (
  SELECT clip, frame, side, valid, conf,
    last_value(CASE WHEN valid THEN frame END IGNORE NULLS) OVER (PARTITION BY clip, side ORDER BY frame ROWS UNBOUNDED PRECEDING) AS pf,
    first_value(CASE WHEN valid THEN frame END IGNORE NULLS) OVER (PARTITION BY clip, side ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nf
  FROM h),
f AS (SELECT *, NOT valid AND pf IS NOT NULL AND nf IS NOT NULL AND nf - pf - 1 <= 2 AS fill,
        (frame - pf) / CAST(nullif(nf - pf, 0) AS DOUBLE) AS wt FROM a),
filled AS (
  SELECT f.clip, f.frame, f.side, f.fill AS interpolated, f.valid OR f.fill AS valid,
    CASE WHEN f.fill THEN (1 - f.wt) * hp.conf + f.wt * hn.conf ELSE f.conf END AS conf, f.pf, f.nf, f.wt
  FROM f LEFT JOIN h hp ON hp.clip = f.clip AND hp.side = f.side AND hp.frame = f.pf
         LEFT JOIN h hn ON hn.clip = f.clip AND hn.side = f.side AND hn.frame = f.nf)"""
GAP_FILL = f"""WITH {FILL_SQL}
SELECT f.clip, f.frame, f.side, f.interpolated, {r('f.conf')} AS conf, p.joint,
  {', '.join(f"{r(f'CASE WHEN f.interpolated THEN (1 - f.wt) * p.{a} + f.wt * n.{a} ELSE p.{a} END')} AS {a}" for a in 'xyz')}
FROM filled f JOIN j p ON p.clip = f.clip AND p.side = f.side AND p.frame = f.pf
JOIN j n ON n.clip = f.clip AND n.side = f.side AND n.frame = f.nf AND n.joint = p.joint WHERE f.valid"""


def gap_report(spark, sf):
    return refine.gap_report(_filled(spark, sf))


GAP_REPORT = f"""WITH {FILL_SQL}, st AS (SELECT *, interpolated AND NOT coalesce(lag(interpolated) OVER (PARTITION BY clip, side ORDER BY frame), false) AS s FROM filled)
SELECT clip, count(*) FILTER (WHERE s) AS gaps_filled, count(*) FILTER (WHERE interpolated) AS frames_filled,
       count(*) FILTER (WHERE NOT valid) AS frames_left_missing FROM st GROUP BY clip"""


def hand_smoothing(spark, sf):
    rows = vw.hands(spark, sf)
    rows = rows.withColumn("joints", F.when(F.col("valid"), F.col("joints")))
    return vw.long_joints(w.smooth_hands(rows, 1))


def _sm(a: str) -> str:
    return r(f"CASE WHEN ok THEN 0.25 * lag({a}) OVER o + 0.5 * {a} + 0.25 * lead({a}) OVER o ELSE {a} END") + f" AS {a}"


SMOOTH = f"""{HW}, t AS (SELECT *, coalesce(valid AND lag(valid) OVER o AND lead(valid) OVER o, false) AS ok FROM j
  WINDOW o AS (PARTITION BY clip, side, joint ORDER BY frame)),
s AS (SELECT clip, frame, side, joint, valid, {', '.join(_sm(a) for a in 'xyz')} FROM t WINDOW o AS (PARTITION BY clip, side, joint ORDER BY frame))
SELECT clip, frame, side, joint, x, y, z FROM s WHERE valid"""


# ----------------------------------------------------------------------- bones
def bone_lengths(spark, sf):
    rows = refine.bone_rows(vw.hands(spark, sf))
    return rows.select("clip", "side", "frame", "bone", rnd(F.col("length")).alias("length"))


BL_SQL = vw.HANDS_SQL + f""", {BONES_SQL},
bl AS (SELECT c.clip, c.side, c.frame, b.bone, b.parent, b.child, c.x - p.x AS dx, c.y - p.y AS dy, c.z - p.z AS dz,
         sqrt(pow(c.x - p.x, 2) + pow(c.y - p.y, 2) + pow(c.z - p.z, 2)) AS length
       FROM bones b JOIN j c ON c.joint = b.child JOIN j p ON p.joint = b.parent AND p.clip = c.clip AND p.side = c.side AND p.frame = c.frame
       WHERE c.valid)"""
BONE_LENGTHS = f"WITH {BL_SQL} SELECT clip, side, frame, bone, {r('length')} AS length FROM bl"


def hand_span(spark, sf):
    return vw.hands(spark, sf).select("clip", "frame", "side", rnd(hand.span(F.col("joints"))).alias("span"))


SPAN = f"""{HW} SELECT a.clip, a.frame, a.side, {r('sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2))')} AS span
FROM j a JOIN j b ON a.clip = b.clip AND a.frame = b.frame AND a.side = b.side WHERE a.joint = 12 AND b.joint = 0"""


def bone_reference(spark, sf):
    h = vw.hands(spark, sf)
    mean = refine.bone_reference(h, "mean").withColumnRenamed("ref", "mean_ref")
    med = refine.bone_reference(h, "median").withColumnRenamed("ref", "median_ref")
    return mean.join(med, ["clip", "side", "bone"]).select(
        "clip", "side", "bone", rnd(F.col("mean_ref")).alias("mean_ref"), rnd(F.col("median_ref")).alias("median_ref"))


BONE_REF = f"WITH {BL_SQL} SELECT clip, side, bone, {r('avg(length)')} AS mean_ref, {r('median(length)')} AS median_ref FROM bl GROUP BY clip, side, bone"


def bone_scale(spark, sf):
    rows = refine.scale_bones(vw.hands(spark, sf))
    return vw.long_joints(rows.filter("valid"))


# A finger's corrected position is the wrist plus its corrected bones so far.
BS_SQL = BL_SQL + """,
ref AS (SELECT clip, side, bone, avg(length) AS ref FROM bl GROUP BY clip, side, bone),
sc AS (SELECT bl.*, CAST(floor((bl.child - 1) / 4) AS INTEGER) AS finger, greatest(0.965, least(1.035, ref.ref / bl.length)) AS ratio
       FROM bl JOIN ref ON ref.clip = bl.clip AND ref.side = bl.side AND ref.bone = bl.bone),
fixed AS (
  SELECT s.clip, s.frame, s.side, s.child AS joint, wr.x + sum(s.ratio * s.dx) OVER o AS x, wr.y + sum(s.ratio * s.dy) OVER o AS y,
         wr.z + sum(s.ratio * s.dz) OVER o AS z
  FROM sc s JOIN j wr ON wr.joint = 0 AND wr.clip = s.clip AND wr.side = s.side AND wr.frame = s.frame
  WINDOW o AS (PARTITION BY s.clip, s.frame, s.side, s.finger ORDER BY s.child)
  UNION ALL SELECT clip, frame, side, 0, x, y, z FROM j WHERE joint = 0 AND valid)"""
BONE_SCALE = f"WITH {BS_SQL} SELECT clip, frame, side, joint, {r('x')} AS x, {r('y')} AS y, {r('z')} AS z FROM fixed"


def bone_deviation(spark, sf):
    h = vw.hands(spark, sf)
    ref = refine.bone_reference(h)
    before = refine.bone_deviation(h, ref, "before")
    after = refine.bone_deviation(refine.scale_bones(h), ref, "after")
    return before.join(after, ["clip", "side", "bone"]).select(
        "clip", "side", "bone", rnd(F.col("before")).alias("before"), rnd(F.col("after")).alias("after"))


BONE_DEV = f"""WITH {BS_SQL} SELECT sc.clip, sc.side, sc.bone, {r('max(abs(sc.length / ref.ref - 1))')} AS "before",
{r('max(abs(sc.ratio * sc.length / ref.ref - 1))')} AS "after"
FROM sc JOIN ref ON ref.clip = sc.clip AND ref.side = sc.side AND ref.bone = sc.bone GROUP BY sc.clip, sc.side, sc.bone"""


# ----------------------------------------------------------------- wrist depth
def confidence_weights(spark, sf):
    """Some confidences are missing or not a number: those frames have no weight."""
    lost = F.when(F.col("frame") % 7 == 3, F.lit(None).cast("double")).when(F.col("frame") % 7 == 5, F.lit(float("nan")))
    rows = vw.hands(spark, sf).withColumn("conf", F.when(F.col("frame") % 7 == 3, lost).when(F.col("frame") % 7 == 5, lost).otherwise(F.col("conf")))
    rows = refine.confidence_weights(rows)
    return rows.select("clip", "frame", "side", rnd(F.col("weight")).alias("weight"))


WEIGHTS = f"""{HW}, w AS (SELECT clip, frame, side, valid, CASE WHEN frame % 7 NOT IN (3, 5) THEN conf END AS conf FROM h),
m AS (SELECT clip, median(conf) AS med FROM w WHERE valid AND conf > 0 GROUP BY clip)
SELECT w.clip, w.frame, w.side, CASE WHEN m.med IS NULL THEN 1.0 WHEN w.conf IS NOT NULL THEN {r('pow(greatest(0.5, least(1.5, w.conf / m.med)), 8)')} END AS weight
FROM w LEFT JOIN m ON m.clip = w.clip"""


# Second differences within each run (first differences at its ends), their normal equations, and elimination of the
# two bands above the diagonal down and up the run.
SOLVE_SQL = f"""
m AS (SELECT clip, median(conf) AS med FROM c0 WHERE valid AND conf > 0 GROUP BY clip),
v AS (SELECT c0.*, CASE WHEN m.med IS NULL THEN 1.0 WHEN conf IS NOT NULL THEN pow(greatest(0.5, least(1.5, conf / m.med)), 8) END AS w,
  c0.frame - row_number() OVER (PARTITION BY c0.clip, c0.side ORDER BY c0.frame) AS island FROM c0 LEFT JOIN m ON m.clip = c0.clip WHERE valid),
q AS (SELECT *, clip || '/' || side || '/' || island AS run, row_number() OVER (PARTITION BY clip, side, island ORDER BY frame) - 1 AS i,
  count(*) OVER (PARTITION BY clip, side, island) AS n, count(w) OVER (PARTITION BY clip, side, island) AS known FROM v),
s AS (SELECT * FROM q WHERE n > 1 AND known = n),
dd AS (SELECT run, i AS k, i + o AS col, CASE WHEN i = 0 THEN CASE o WHEN 0 THEN -1.0 WHEN 1 THEN 1.0 END
    WHEN i = n - 1 THEN CASE o WHEN -1 THEN -1.0 WHEN 0 THEN 1.0 END ELSE CASE o WHEN 0 THEN -2.0 ELSE 1.0 END END AS v FROM s, (VALUES (-1), (0), (1)) t(o)),
g AS (SELECT a.run, a.col AS i, b.col - a.col AS o, CAST(sum(a.v * b.v) AS DOUBLE) AS g FROM dd a JOIN dd b ON b.run = a.run AND b.k = a.k AND b.col >= a.col
  WHERE a.v IS NOT NULL AND b.v IS NOT NULL GROUP BY ALL),
e AS (SELECT s.run, s.i, s.n, s.w * s.z AS r, s.w + {refine.DEPTH_LAMBDA} * g0.g * (s.rx * s.rx + s.ry * s.ry + 1) AS a,
    coalesce({refine.DEPTH_LAMBDA} * g1.g * (s.rx * s1.rx + s.ry * s1.ry + 1), 0) AS b, coalesce({refine.DEPTH_LAMBDA} * g2.g * (s.rx * s2.rx + s.ry * s2.ry + 1), 0) AS c
  FROM s JOIN g g0 ON g0.run = s.run AND g0.i = s.i AND g0.o = 0
  LEFT JOIN s s1 ON s1.run = s.run AND s1.i = s.i + 1 LEFT JOIN g g1 ON g1.run = s.run AND g1.i = s.i AND g1.o = 1
  LEFT JOIN s s2 ON s2.run = s.run AND s2.i = s.i + 2 LEFT JOIN g g2 ON g2.run = s.run AND g2.i = s.i AND g2.o = 2),
down AS (SELECT run, i, n, a AS d, b AS u1, c AS u2, b / a AS l1, c / a AS l2, r AS y, CAST(0 AS DOUBLE) AS pl2, CAST(0 AS DOUBLE) AS pu2, CAST(0 AS DOUBLE) AS py FROM e WHERE i = 0
  UNION ALL SELECT run, i, n, d, u1, u2, u1 / d, u2 / d, y, pl2, pu2, py FROM (
    SELECT e.run, e.i, e.n, e.a - p.l1 * p.u1 - p.pl2 * p.pu2 AS d, e.b - p.l1 * p.u2 AS u1, e.c AS u2, e.r - p.l1 * p.y - p.pl2 * p.py AS y,
      p.l2 AS pl2, p.u2 AS pu2, p.y AS py FROM down p JOIN e ON e.run = p.run AND e.i = p.i + 1)),
up AS (SELECT run, i, y / d AS x, CAST(0 AS DOUBLE) AS x1 FROM down WHERE i = n - 1
  UNION ALL SELECT d.run, d.i, d.y / d.d - d.l1 * p.x - d.l2 * p.x1, p.x FROM up p JOIN down d ON d.run = p.run AND d.i = p.i - 1)"""
DEPTH = f"""WITH RECURSIVE {vw.HANDS_SQL},
c0 AS (SELECT clip, frame, side, valid, CASE WHEN frame % 40 <> 7 THEN conf END AS conf, x / z AS rx, y / z AS ry, z FROM j WHERE joint = 0),{SOLVE_SQL}
SELECT c0.clip, c0.frame, c0.side, CASE WHEN up.x IS NOT NULL THEN {r('c0.z')} END AS depth_before, {r('up.x')} AS depth_after
FROM c0 LEFT JOIN s ON s.clip = c0.clip AND s.side = c0.side AND s.frame = c0.frame LEFT JOIN up ON up.run = s.run AND up.i = s.i"""


def with_intrinsics(rows):
    return rows.withColumn("k", v.mat(*vw.K))


def wrist_depth(spark, sf):
    """A banded linear system per run. Some confidences are missing: their runs keep their depth."""
    rows = vw.hands(spark, sf).withColumn("conf", F.when(F.col("frame") % 40 != 7, F.col("conf")))
    rows = refine.smooth_wrist_depth(with_intrinsics(rows))
    return rows.select("clip", "frame", "side", rnd(F.col("depth_before")).alias("depth_before"),
                       rnd(F.col("depth_after")).alias("depth_after"))


# ---------------------------------------------------------- frames of reference
def world_fusion(spark, sf):
    rate = vw.sizes(spark, sf).select("clip", F.when(F.col("clip") % 2 == 1, 25.0).otherwise(30.0).alias("fps"))
    rows = fusion.fuse(vw.hands(spark, sf), vw.poses(spark, sf), fps=rate)
    return vw.long_joints(rows, "joints_world", extra=("valid", rnd(F.col("ts")).alias("ts")))


FUSION = f"WITH {vw.WORLD_SQL} SELECT clip, frame, side, valid, {r('frame / CASE WHEN clip % 2 = 1 THEN 25.0 ELSE 30.0 END')} AS ts, joint, {r('x')} AS x, {r('y')} AS y, {r('z')} AS z FROM w WHERE valid"


def camera_frame(spark, sf):
    """World joints seen from the reference camera of the same frame."""
    rows = fusion.fuse(vw.hands(spark, sf), vw.poses(spark, sf)).select("clip", "frame", "side", "joints_world")
    rows = rows.join(vw.poses(spark, sf, vw.YAW_REF).select("clip", "frame", "rot", "trans"), ["clip", "frame"])
    rows = rows.withColumn("joints", pose.joints_to_camera(F.col("rot"), F.col("trans"), F.col("joints_world")))
    return vw.long_joints(rows)


_C, _S = f"cos({vw.YAW_REF} * frame)", f"sin({vw.YAW_REF} * frame)"
CAMERA_FRAME = f"""WITH {vw.WORLD_SQL} SELECT clip, frame, side, joint, {r(f'{_C} * (x - 0.02 * frame) - {_S} * z')} AS x,
{r('y - 0.01 * frame')} AS y, {r(f'{_S} * (x - 0.02 * frame) + {_C} * z')} AS z FROM w WHERE valid"""


def masked_camera_rows(spark, sf):
    """World landmarks with a world-to-camera pose and two validity masks."""
    rows = vw.hands(spark, sf).join(vw.poses(spark, sf).select("clip", "frame", "rot", "trans"), ["clip", "frame"])
    w2c, t = pose.invert(F.col("rot"), F.col("trans"))
    rows = rows.withColumn("r_w2c", w2c).withColumn("t_w2c", t)
    out = pose.world_to_camera_rows(F.col("r_w2c"), F.col("t_w2c"), F.col("joints"), F.col("valid"), F.col("conf"))
    return vw.long_joints(rows.withColumn("joints", out))


_C0, _S0 = f"cos({vw.YAW} * frame)", f"sin({vw.YAW} * frame)"
MASKED = f"""{HW} SELECT clip, frame, side, joint, {r(f'{_C0} * (x - 0.02 * frame) - {_S0} * z')} AS x, {r('y - 0.01 * frame')} AS y,
{r(f'{_S0} * (x - 0.02 * frame) + {_C0} * z')} AS z FROM j WHERE valid AND conf > 0.5"""


def project_joints(spark, sf):
    rows = with_intrinsics(vw.hands(spark, sf)).select("clip", "frame", "side", "k", F.posexplode("joints").alias("joint", "p"))
    rows = rows.withColumn("p", v.vec(F.col("p")["x"], F.col("p")["y"], F.col("p")["z"] * F.when(F.col("frame") % 3 == 1, -1.0).otherwise(1.0)))
    px = camera.project(F.col("k"), F.col("p"))
    back = camera.unproject(F.col("k"), F.col("px")["u"], F.col("px")["v"], F.col("p")["z"])
    rows = rows.withColumn("px", px).withColumn("back", back)
    return rows.select("clip", "frame", "side", "joint", rnd(F.col("px")["u"]).alias("u"), rnd(F.col("px")["v"]).alias("v"),
                       *vw.xyz_cols(F.col("back")))


PROJECT = f"""{HW}, b AS (SELECT clip, frame, side, joint, x, y, CASE WHEN frame % 3 = 1 THEN -z ELSE z END AS z FROM j)
SELECT clip, frame, side, joint, {r('500 * x / z + 320')} AS u, {r('480 * y / z + 240')} AS v, {r('x')} AS x, {r('y')} AS y, {r('z')} AS z FROM b"""


def intrinsics_rescale(spark, sf):
    """Intrinsics carried from a frame-dependent image size to 640 x 480."""
    rows = with_intrinsics(vw.hands(spark, sf))
    k = camera.rescale(F.col("k"), (320 + F.col("frame"), 240 + F.col("frame")), (640, 480))
    rows = rows.withColumn("k2", k)
    return rows.select("clip", "frame", "side", *[rnd(F.col("k2")[i]).alias(n) for i, n in ((0, "fx"), (2, "cx"), (4, "fy"), (5, "cy"), (8, "one"))])


RESCALE = f"{HW} SELECT clip, frame, side, {r('500 * 640 / (320.0 + frame)')} AS fx, {r('320 * 640 / (320.0 + frame)')} AS cx, {r('480 * 480 / (240.0 + frame)')} AS fy, {r('240 * 480 / (240.0 + frame)')} AS cy, 1.0 AS one FROM h"


def rotation_algebra(spark, sf):
    """Angle, determinant test, quaternion, mirror and inverse of every camera pose."""
    p = vw.poses(spark, sf)
    inv_r, inv_t = pose.invert(F.col("rot"), F.col("trans"))
    m = pose.pose_to_matrix(F.col("rot"), F.col("trans"))
    p = p.withColumn("q", pose.matrix_to_quat(F.col("rot"))).withColumn("mir", pose.mirror(F.col("rot"))).withColumn(
        "ir", inv_r).withColumn("it", inv_t).withColumn("m", m)
    q = F.col("q")
    p = p.withColumn("back", pose.quat_to_matrix(q[3], q[0], q[1], q[2]))
    br, bt = pose.matrix_to_pose(F.col("m"))
    return p.select(
        "clip", "frame", pose.is_rotation(F.col("rot")).alias("proper"), rnd(pose.angle(F.col("rot"))).alias("angle"),
        rnd(F.abs(q[1])).alias("qy"), rnd(F.abs(q[3])).alias("qw"), rnd(F.col("mir")[2]).alias("mirrored"),
        rnd(F.col("back")[2]).alias("from_quat"), *vw.xyz_cols(F.col("it"), "inv_"), rnd(F.col("ir")[2]).alias("inv_rot"),
        rnd(br[2]).alias("mat_rot"), rnd(bt["x"]).alias("mat_x"))


_Y = f"{vw.YAW} * frame"
ALGEBRA = f"""{HW} SELECT clip, frame, true AS proper, {r(f'acos(greatest(-1, least(1, cos({_Y}))))')} AS angle, {r(f'abs(sin({_Y} / 2))')} AS qy,
{r(f'abs(cos({_Y} / 2))')} AS qw, {r(f'-sin({_Y})')} AS mirrored, {r(f'sin({_Y})')} AS from_quat, {r(f'-cos({_Y}) * 0.02 * frame')} AS inv_x,
{r('-0.01 * frame')} AS inv_y, {r(f'-sin({_Y}) * 0.02 * frame')} AS inv_z, {r(f'-sin({_Y})')} AS inv_rot, {r(f'sin({_Y})')} AS mat_rot, {r('0.02 * frame')} AS mat_x FROM h WHERE side = 0"""


def pose_interpolation(spark, sf):
    """Halfway-style pose between two cameras of a frame; the angle between them is known."""
    a = vw.poses(spark, sf).select("clip", "frame", F.col("rot").alias("ra"), F.col("trans").alias("ta"))
    b = vw.poses(spark, sf, vw.YAW_REF).select("clip", "frame", F.col("rot").alias("rb"), v.scale(F.col("trans"), 3.0).alias("tb"))
    rows = a.join(b, ["clip", "frame"]).withColumn("w", (F.col("frame") % 5) / 4.0)
    rows = rows.withColumn("rot", pose.slerp("ra", "rb", "w")).withColumn("t", v.lerp(F.col("ta"), F.col("tb"), F.col("w")))
    return rows.select("clip", "frame", rnd(F.col("rot")[0]).alias("r00"), rnd(F.col("rot")[2]).alias("r02"), *vw.xyz_cols(F.col("t")))


_W = "((frame % 5) / 4.0)"
_A = f"(((1 - {_W}) * {vw.YAW} + {_W} * {vw.YAW_REF}) * frame)"
INTERPOLATE = f"""{HW} SELECT clip, frame, {r(f'cos({_A})')} AS r00, {r(f'sin({_A})')} AS r02, {r(f'(1 + 2 * {_W}) * 0.02 * frame')} AS x,
{r(f'(1 + 2 * {_W}) * 0.01 * frame')} AS y, 0.0 AS z FROM h WHERE side = 0"""


def similarity_algebra(spark, sf):
    """Sim(3) applied, inverted, composed with itself and packed into a matrix."""
    p = vw.poses(spark, sf).join(vw.hands(spark, sf).select("clip", "frame", "side", "joints"), ["clip", "frame"])
    p = p.withColumn("s", pose.sim3(1.0 + 0.01 * F.col("frame"), F.col("rot"), F.col("trans"))).withColumn("w", F.col("joints")[0])
    s = F.col("s")
    p = p.withColumn("img", pose.sim3_apply(s, F.col("w"))).withColumn("twice", pose.sim3_compose(s, s))
    p = p.withColumn("back", pose.sim3_apply(pose.sim3_inverse(s), F.col("img"))).withColumn("m", pose.sim3_to_matrix(s))
    p = p.withColumn("u", pose.sim3_from_matrix(F.col("m")))
    rot, t = pose.sim3_pose(s, F.col("rot"), F.col("trans"))
    p = p.withColumn("pr", rot).withColumn("pt", t)
    return p.select("clip", "frame", "side", *vw.xyz_cols(F.col("img")), *vw.xyz_cols(F.col("back"), "b"), rnd(F.col("twice")["scale"]).alias("scale2"),
                    rnd(F.col("u")["scale"]).alias("scale1"), rnd(F.col("pr")[2]).alias("pose_rot"), *vw.xyz_cols(F.col("pt"), "p"))


_S1 = "(1 + 0.01 * frame)"
SIM3 = f"""{HW} SELECT clip, frame, side, {r(f'{_S1} * ({_C0} * x + {_S0} * z) + 0.02 * frame')} AS x, {r(f'{_S1} * y + 0.01 * frame')} AS y,
{r(f'{_S1} * ({_C0} * z - {_S0} * x)')} AS z, {r('x')} AS bx, {r('y')} AS by, {r('z')} AS bz, {r(f'{_S1} * {_S1}')} AS scale2, {r(_S1)} AS scale1,
{r(f'sin(2 * {_Y})')} AS pose_rot, {r(f'{_S1} * {_C0} * 0.02 * frame + 0.02 * frame')} AS px, {r(f'{_S1} * 0.01 * frame + 0.01 * frame')} AS py,
{r(f'-{_S1} * {_S0} * 0.02 * frame')} AS pz FROM j WHERE joint = 0"""


# -------------------------------------------------------------------- blending
BW, BO = 8, 4


def hand_windows(spark, sf):
    """Hand windows that differ by a known offset and turn per window."""
    h = vw.hands(spark, sf)
    rows = sc.cut_hands(h, vw.sizes(spark, sf), BW, BO)
    moved = F.transform("joints", lambda p: v.vec(p["x"] + 0.01 * F.col("win"), p["y"], p["z"]))
    turn = v.yaw(0.05 * F.col("frame") + 0.02 * F.col("win"))
    return rows.withColumn("joints", moved).withColumn("root_rot", turn).withColumn(
        "betas", F.array_repeat(F.col("win").cast("double"), 10))


def window_slices(spark, sf):
    return hand_windows(spark, sf).select("clip", "win", "start", "end", "frame", "side", "valid", F.col("joints").isNull().alias("empty"))


HWIN_SQL = vw.HANDS_SQL + ", src AS (SELECT clip, n AS num_frames FROM len)," + vw.schedule_sql(BW, BO, "src") + """,
hw AS (SELECT win.clip, win.win, win."start", win."end", h.frame, h.side, h.valid, h.conf,
         CASE WHEN win.win > 0 AND h.frame < win."start" + 4 THEN (h.frame - win."start") / 3.0 ELSE 1 END AS alpha
       FROM win JOIN h ON h.clip = win.clip AND h.frame >= win."start" AND h.frame < win."end")"""
SLICES = f'WITH {HWIN_SQL} SELECT clip, win, "start", "end", frame, side, valid, NOT valid AS empty FROM hw'


def hand_blend(spark, sf):
    """At most two windows meet in a frame here, so SQL can say the fold as one mix."""
    rows = blend.blend_hands(hand_windows(spark, sf)).filter("valid")
    keys = ("clip", "frame", "side")
    return rows.select(*keys, "weight", rnd(F.col("conf")).alias("conf"), *vw.xyz_cols(F.col("joints")[7]),
                       rnd(F.col("root_rot")[2]).alias("turn"), rnd(F.col("betas")[3]).alias("beta"))


BLEND = f"""WITH {HWIN_SQL}, m AS (SELECT clip, frame, side, count(*) AS weight, max(conf) AS conf, min(win) AS w0, max(win) AS w1,
  max_by(alpha, win) AS a FROM hw WHERE valid GROUP BY clip, frame, side),
k AS (SELECT *, CASE WHEN w1 > w0 THEN w0 + a * (w1 - w0) ELSE w0 END AS mix FROM m)
SELECT k.clip, k.frame, k.side, k.weight, {r('k.conf')} AS conf, {r('j.x + 0.01 * k.mix')} AS x, {r('j.y')} AS y, {r('j.z')} AS z,
{r('sin(0.05 * k.frame + 0.02 * k.mix)')} AS turn, {r('k.mix')} AS beta
FROM k JOIN j ON j.clip = k.clip AND j.frame = k.frame AND j.side = k.side AND j.joint = 7"""

QUERIES = {
    "gap_fill": (gap_fill, GAP_FILL),
    "gap_report": (gap_report, GAP_REPORT),
    "hand_smoothing": (hand_smoothing, SMOOTH),
    "bone_lengths": (bone_lengths, BONE_LENGTHS),
    "hand_span": (hand_span, SPAN),
    "bone_reference": (bone_reference, BONE_REF),
    "bone_scale": (bone_scale, BONE_SCALE),
    "bone_deviation": (bone_deviation, BONE_DEV),
    "confidence_weights": (confidence_weights, WEIGHTS),
    "wrist_depth": (wrist_depth, DEPTH),
    "world_fusion": (world_fusion, FUSION),
    "camera_frame": (camera_frame, CAMERA_FRAME),
    "masked_camera_rows": (masked_camera_rows, MASKED),
    "project_joints": (project_joints, PROJECT),
    "intrinsics_rescale": (intrinsics_rescale, RESCALE),
    "rotation_algebra": (rotation_algebra, ALGEBRA),
    "pose_interpolation": (pose_interpolation, INTERPOLATE),
    "similarity_algebra": (similarity_algebra, SIM3),
    "window_slices": (window_slices, SLICES),
    "hand_blend": (hand_blend, BLEND),
}
