"""Detections and tracks: orders are frames, their lines are the boxes seen in them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import box as bx
from ..operators import detection as det, tracking as tr
from ..session import cut_lineage
from . import views as vw
from .views import FRAMES_PER_CLIP, r, rnd

BW = f"WITH {vw.BOXES_SQL}"


def _area(b: str) -> str:
    return f"greatest(0, {b}x2 - {b}x1) * greatest(0, {b}y2 - {b}y1)"


def _iou(a: str, b: str) -> str:
    w = f"greatest(0, least({a}x2, {b}x2) - greatest({a}x1, {b}x1))"
    h = f"greatest(0, least({a}y2, {b}y2) - greatest({a}y1, {b}y1))"
    inter = f"({w} * {h})"
    return f"CASE WHEN {inter} > 0 THEN {inter} / ({_area(a)} + {_area(b)} - {inter}) ELSE 0 END"


def box_cols(c: str = "box") -> list:
    return [rnd(F.col(c)[n]).alias(n) for n in bx.CORNERS]


def clips_of(spark, sf):
    """Clip lengths: every clip has FRAMES_PER_CLIP frames, the last one maybe fewer."""
    o = vw.table(spark, sf, "orders").select((F.col("o_orderkey")).alias("k"))
    return o.groupBy(F.floor(F.col("k") / FRAMES_PER_CLIP).cast("bigint").alias("clip")).agg(
        (F.max(F.col("k") % FRAMES_PER_CLIP) + 1).cast("int").alias("num_frames"))


CLIPS_OF = f"""co AS (SELECT CAST(floor(o_orderkey / {FRAMES_PER_CLIP}) AS BIGINT) AS clip, CAST(max(o_orderkey % {FRAMES_PER_CLIP}) + 1 AS INTEGER) AS num_frames
FROM orders GROUP BY 1)"""


def detection_problems(spark, sf):
    """Boxes bent on purpose in three ways, counted by the rule they break."""
    b = vw.boxes(spark, sf)
    x2 = F.when(F.col("slot") == 3, F.col("box")["x1"] - 1).otherwise(F.col("box")["x2"])
    y2 = F.when(F.col("slot") == 4, F.lit(float("nan"))).otherwise(F.col("box")["y2"])
    b = b.withColumn("box", bx.box(F.col("box")["x1"], F.col("box")["y1"], x2, y2)).withColumn(
        "conf", F.when(F.col("slot") == 5, 1.5).otherwise(F.col("conf")))
    return det.split_sound(b).groupBy("clip", "problem").agg(F.count(F.lit(1)).alias("rows"))


PROBLEMS = f"""{BW}, p AS (SELECT clip, CASE slot WHEN 4 THEN 'non-finite box' WHEN 3 THEN 'negative extent' WHEN 5 THEN 'confidence out of range' END AS problem FROM b)
SELECT clip, problem, count(*) AS rows FROM p GROUP BY clip, problem"""


def box_overlap(spark, sf):
    """IoU and midpoint box of neighbouring slots of a frame."""
    b = vw.boxes(spark, sf)
    nxt = b.select("clip", "frame", (F.col("slot") - 1).alias("slot"), F.col("box").alias("other"))
    j = b.join(nxt, ["clip", "frame", "slot"])
    return j.withColumn("mid", bx.lerp(F.col("box"), F.col("other"), F.lit(0.25))).select(
        "clip", "frame", "slot", rnd(bx.iou(F.col("box"), F.col("other"))).alias("iou"), rnd(bx.area(F.col("box"))).alias("area"),
        *box_cols("mid"))


OVERLAP = f"""{BW} SELECT a.clip, a.frame, a.slot, {r(_iou('a.', 'o.'))} AS iou, {r(_area('a.'))} AS area,
{', '.join(f"{r(f'0.75 * a.{c} + 0.25 * o.{c}')} AS {c}" for c in bx.CORNERS)}
FROM b a JOIN b o ON o.clip = a.clip AND o.frame = a.frame AND o.slot = a.slot + 1"""


def best_per_side(spark, sf):
    return det.best_per_side(vw.boxes(spark, sf)).select("clip", "frame", "side", "slot", "conf", rnd(F.col("area")).alias("area"))


BEST_SQL = vw.BOXES_SQL + f""", best AS (SELECT *, {_area('')} AS area FROM b
  QUALIFY row_number() OVER (PARTITION BY clip, frame, side ORDER BY conf DESC, {_area('')} DESC, slot) = 1)"""
BEST = f"WITH {BEST_SQL} SELECT clip, frame, side, slot, conf, {r('area')} AS area FROM best"


def handedness(spark, sf):
    """Side from right and left scores, and its flip."""
    b = vw.boxes(spark, sf).withColumn("right", F.col("conf")).withColumn("left", F.lit(0.85))
    s = det.handedness(F.col("right"), F.col("left"), 0.01)
    return b.select("clip", "frame", "slot", s.alias("label"), det.flip(s).alias("flipped"))


HANDEDNESS = f"{BW} SELECT clip, frame, slot, CASE WHEN conf - CAST(0.85 AS DOUBLE) > CAST(0.01 AS DOUBLE) THEN 1 ELSE 0 END AS label, CASE WHEN conf - CAST(0.85 AS DOUBLE) > CAST(0.01 AS DOUBLE) THEN 0 ELSE 1 END AS flipped FROM b"


def _cents(df):
    """Whole-number votes, so that the order of summing cannot decide a tie."""
    return df.withColumn("votes", F.round(F.col("conf") * 100).cast("bigint"))


def majority_side(spark, sf):
    votes = det.majority(_cents(vw.boxes(spark, sf)), ["clip", "slot"], "side", "votes")
    keys = clips_of(spark, sf).select("clip", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("slot"))
    return det.majority_or_none(keys, votes, ["clip", "slot"]).select("clip", "slot", "majority")


_MAJ = """mj AS (SELECT clip, slot, count(*) AS n, CASE WHEN sum(CASE WHEN side = 1 THEN CAST(round(conf * 100) AS BIGINT) ELSE 0 END) >
  sum(CASE WHEN side = 0 THEN CAST(round(conf * 100) AS BIGINT) ELSE 0 END) THEN 1 ELSE 0 END AS majority FROM b GROUP BY clip, slot)"""
MAJORITY = f"""{BW}, {CLIPS_OF}, {_MAJ}, k AS (SELECT clip, CAST(unnest(range(8)) AS INTEGER) AS slot FROM co)
SELECT k.clip, k.slot, coalesce(mj.majority, -1) AS majority FROM k LEFT JOIN mj ON mj.clip = k.clip AND mj.slot = k.slot"""


def side_consistency(spark, sf):
    rows = det.enforce_side(_cents(vw.boxes(spark, sf)), ["clip", "slot"], "side", "votes", 100)
    return rows.select("clip", "frame", "slot", "side")


CONSISTENT = f"""{BW}, {_MAJ} SELECT b.clip, b.frame, b.slot, CASE WHEN n >= 100 THEN majority ELSE side END AS side
FROM b JOIN mj ON mj.clip = b.clip AND mj.slot = b.slot"""


def _scored(spark, sf):
    return vw.boxes(spark, sf).withColumn("right_score", F.col("side") * F.col("conf")).withColumn(
        "left_score", (1 - F.col("side")) * F.col("conf"))


def pack_detections(spark, sf):
    """Slot arrays per frame; frames without a detection are kept with count 0."""
    frames = tr.dense_frames(clips_of(spark, sf), (0,)).select("clip", "frame")
    p = det.pack_slots(_scored(spark, sf), frames)
    return p.select("clip", "frame", "count", rnd(F.aggregate("confs", F.lit(0.0), lambda a, x: a + x)).alias("conf_sum"),
                    rnd(F.get(F.col("boxes"), F.lit(0))["x1"]).alias("first_x1"))


PACK = f"""{BW}, {CLIPS_OF}, fr AS (SELECT clip, CAST(unnest(range(num_frames)) AS INTEGER) AS frame FROM co)
SELECT fr.clip, fr.frame, count(b.slot) AS "count", {r('coalesce(sum(b.conf), 0)')} AS conf_sum, {r('max(CASE WHEN b.slot = 0 THEN b.x1 END)')} AS first_x1
FROM fr LEFT JOIN b ON b.clip = fr.clip AND b.frame = fr.frame GROUP BY fr.clip, fr.frame"""


def unpack_detections(spark, sf):
    """Packed and unpacked again: every real slot comes back once."""
    frames = tr.dense_frames(clips_of(spark, sf), (0,)).select("clip", "frame")
    rows = det.unpack_slots(det.pack_slots(_scored(spark, sf), frames))
    return rows.select("clip", "frame", "slot", *box_cols(), "conf", rnd(F.col("right_score")).alias("right_score"),
                       rnd(F.col("left_score")).alias("left_score"))


UNPACK = f"{BW} SELECT clip, frame, slot, {', '.join(f'{r(c)} AS {c}' for c in bx.CORNERS)}, conf, {r('side * conf')} AS right_score, {r('(1 - side) * conf')} AS left_score FROM b"


def detector_output(spark, sf):
    """Detector rows under their own field names, then a class-id detector."""
    b = vw.boxes(spark, sf)
    raw = b.groupBy("clip", "frame").agg(F.array_sort(F.collect_list(F.struct("slot", "box", "conf", "side"))).alias("d"))
    raw = raw.select("clip", "frame", F.transform("d", lambda x: F.array(*[x["box"][c] for c in bx.CORNERS])).alias("pred_boxes"),
                     F.col("d")["conf"].alias("box_scores"), F.transform("d", lambda x: x["side"].cast("double")).alias("is_right"))
    a = det.from_predictions(raw).select("clip", "frame", "slot", "conf", "right_score", "left_score", F.lit("scores").alias("kind"))
    c = det.class_scores(b, "side").select("clip", "frame", "slot", "conf", "right_score", "left_score", F.lit("classes").alias("kind"))
    return a.unionByName(c)


OUTPUT = f"""{BW} SELECT clip, frame, slot, conf, CAST(side AS DOUBLE) AS right_score, 0.0 AS left_score, 'scores' AS kind FROM b
UNION ALL SELECT clip, frame, slot, conf, CAST(side AS DOUBLE), CAST(1 - side AS DOUBLE), 'classes' FROM b"""


def anchor_recovery(spark, sf):
    """Anchors and recovered weak candidates among the label picks."""
    rows = tr.recover(det.best_per_side(vw.boxes(spark, sf)))
    return rows.select("clip", "frame", "side", "slot", "conf", "recovered")


def _lerp(c: str) -> str:
    return f"(1 - wt) * p{c} + wt * n{c}"


RECOVER_SQL = f"""a AS (SELECT *, conf >= 0.75 AS anchor,
  last_value(CASE WHEN conf >= 0.75 THEN frame END IGNORE NULLS) OVER (PARTITION BY clip, side ORDER BY frame ROWS UNBOUNDED PRECEDING) AS pf,
  first_value(CASE WHEN conf >= 0.75 THEN frame END IGNORE NULLS) OVER (PARTITION BY clip, side ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nf FROM best),
g AS (SELECT a.*, (a.frame - pf) / CAST(nullif(nf - pf, 0) AS DOUBLE) AS wt, {', '.join(f'p.{c} AS p{c}, n.{c} AS n{c}' for c in bx.CORNERS)}
  FROM a LEFT JOIN best p ON p.clip = a.clip AND p.side = a.side AND p.frame = a.pf LEFT JOIN best n ON n.clip = a.clip AND n.side = a.side AND n.frame = a.nf),
q AS (SELECT *, {', '.join(f'{_lerp(c)} AS e{c}' for c in bx.CORNERS)} FROM g),
z AS (SELECT *, NOT anchor AND coalesce(nf - pf - 1 BETWEEN 1 AND 4 AND {_iou('', 'e')} >= 0.2, false) AS recovered FROM q)"""
RECOVER = f"""WITH {BEST_SQL}, {RECOVER_SQL}
SELECT clip, frame, side, slot, conf, recovered FROM z WHERE anchor OR recovered"""


def slot_selection(spark, sf):
    """One detection per side and frame, with the boxes held so far as state."""
    return tr.select_slots(vw.boxes(spark, sf)).select("clip", "frame", "side", "slot", "conf")


_DET = "STRUCT(frame INTEGER, slot INTEGER, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE, conf DOUBLE, side INTEGER, area DOUBLE)"


def _held_iou(d: str, h: str) -> str:
    w, t = f"(least({d}.x2, {h}.x2) - greatest({d}.x1, {h}.x1))", f"(least({d}.y2, {h}.y2) - greatest({d}.y1, {h}.y1))"
    return f"CASE WHEN {w} <= 0 OR {t} <= 0 THEN 0.0 ELSE {w} * {t} / ({d}.area + {h}.area - {w} * {t}) END"


def _top(rows: str, *order: str) -> str:
    """Slot of the row that comes first by the given descending values, then by slot."""
    keys = ", ".join(f"'k{i}': -({o})" for i, o in enumerate(order))
    return f"list_sort(list_transform({rows}, lambda d: {{{keys}, 's': d.slot}}))[1].s"


def _adopted(s: int, other: str) -> str:
    near = f"list_filter(dets, lambda d: d.slot IS DISTINCT FROM {other} AND {_held_iou('d', f'h{s}')} >= {tr.IOU_FLOOR})"
    return f"CASE WHEN a{s} IS NULL AND h{s} IS NOT NULL THEN {_top(near, 'd.conf', 'd.area')} ELSE a{s} END"


def _better(s: int) -> str:
    follow = _held_iou("d", f"h{s}")
    return _top(f"list_filter(dets, lambda d: {follow} > f{s})", follow, "d.conf")


def _det(slot: str) -> str:
    return f"list_filter(dets, lambda d: d.slot = {slot})[1]"


# One row per frame of a clip in order; each step takes the held boxes of the step before.
SELECT_SQL = f"""WITH RECURSIVE {vw.BOXES_SQL},
fr AS (SELECT clip, frame, row_number() OVER (PARTITION BY clip ORDER BY frame) AS step, list(CAST({{'frame': frame, 'slot': slot, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2,
    'conf': conf, 'side': side, 'area': greatest(0, x2 - x1) * greatest(0, y2 - y1)}} AS {_DET}) ORDER BY slot) AS dets FROM b GROUP BY clip, frame),
rec AS (
  SELECT DISTINCT clip, CAST(0 AS BIGINT) AS step, CAST(NULL AS INTEGER) AS frame, CAST(NULL AS {_DET}) AS k0, CAST(NULL AS {_DET}) AS k1,
    CAST(NULL AS {_DET}) AS p0, CAST(NULL AS {_DET}) AS p1 FROM fr
  UNION ALL
  SELECT clip, step, frame, coalesce(p0, k0), coalesce(p1, k1), p0, p1 FROM (
    SELECT clip, step, frame, k0, k1, {_det('c0')} AS p0, {_det('c1')} AS p1 FROM (
      SELECT *, CASE WHEN w0 AND w1 THEN b1 WHEN w0 AND t0 IS NOT NULL THEN t0 WHEN w1 AND t1 = b0 THEN b1 ELSE b0 END AS c0,
        CASE WHEN w0 AND w1 THEN b0 WHEN w1 AND t1 IS NOT NULL THEN t1 WHEN w0 AND t0 = b1 THEN b0 ELSE b1 END AS c1 FROM (
        SELECT *, CASE WHEN w0 AND NOT w1 THEN {_better(0)} END AS t0, CASE WHEN w1 AND NOT w0 THEN {_better(1)} END AS t1 FROM (
          SELECT *, f0 >= 0 AND f0 < {tr.IOU_FLOOR} AS w0, f1 >= 0 AND f1 < {tr.IOU_FLOOR} AS w1 FROM (
            SELECT *, CASE WHEN h0 IS NULL OR b0 IS NULL THEN -1.0 ELSE {_held_iou('d0', 'h0')} END AS f0,
              CASE WHEN h1 IS NULL OR b1 IS NULL THEN -1.0 ELSE {_held_iou('d1', 'h1')} END AS f1 FROM (
              SELECT *, {_det('b0')} AS d0, {_det('b1')} AS d1 FROM (
                SELECT *, {_adopted(1, 'b0')} AS b1 FROM (
                  SELECT *, {_adopted(0, 'a1')} AS b0 FROM (
                    SELECT fr.clip, fr.step, fr.frame, fr.dets, rec.k0, rec.k1, CASE WHEN fr.frame - rec.k0.frame <= 4 THEN rec.k0 END AS h0,
                      CASE WHEN fr.frame - rec.k1.frame <= 4 THEN rec.k1 END AS h1,
                      {_top('list_filter(fr.dets, lambda d: d.side = 0)', 'd.conf', 'd.area')} AS a0, {_top('list_filter(fr.dets, lambda d: d.side = 1)', 'd.conf', 'd.area')} AS a1
                    FROM rec JOIN fr ON fr.clip = rec.clip AND fr.step = rec.step + 1))))))))))"""
SELECTED = f"""{SELECT_SQL}
SELECT clip, frame, 0 AS side, p0.slot AS slot, p0.conf AS conf FROM rec WHERE p0 IS NOT NULL UNION ALL SELECT clip, frame, 1, p1.slot, p1.conf FROM rec WHERE p1 IS NOT NULL"""


def hand_tracks(spark, sf):
    """Selection, anchors and recovery, one row per frame and side."""
    rows = tr.track(vw.boxes(spark, sf), clips_of(spark, sf))
    return rows.select("clip", "frame", "side", "valid", "recovered", "track_id", rnd(F.col("conf")).alias("conf"))


# Selected boxes with their anchors: z holds every candidate, kept where it is an anchor or recovered.
KEPT_SQL = f"""{SELECT_SQL},
best AS (SELECT clip, frame, 0 AS side, {', '.join(f'p0.{c} AS {c}' for c in ('slot', 'conf', *bx.CORNERS))} FROM rec WHERE p0 IS NOT NULL
  UNION ALL SELECT clip, frame, 1, {', '.join(f'p1.{c}' for c in ('slot', 'conf', *bx.CORNERS))} FROM rec WHERE p1 IS NOT NULL), {RECOVER_SQL}"""
TRACKS = f"""{KEPT_SQL},
o AS (SELECT CAST(floor(o_orderkey / {vw.FRAMES_PER_CLIP}) AS BIGINT) AS clip, max(o_orderkey % {vw.FRAMES_PER_CLIP}) + 1 AS n FROM orders GROUP BY ALL),
every AS (SELECT clip, frame, side FROM (SELECT clip, CAST(unnest(range(n)) AS INTEGER) AS frame FROM o), (VALUES (0), (1)) t(side))
SELECT every.clip, every.frame, every.side, z.slot IS NOT NULL AS valid, coalesce(z.recovered, false) AS recovered, CASE WHEN z.slot IS NOT NULL THEN 0 ELSE -1 END AS track_id,
{r('coalesce(z.conf, 0)')} AS conf FROM every LEFT JOIN (SELECT * FROM z WHERE anchor OR recovered) z ON z.clip = every.clip AND z.frame = every.frame AND z.side = every.side"""


def request_rows(spark, sf):
    """Rows asked of a reconstruction model: every valid hand-frame of the tracks with its box and confidence, both sides
    stacked, and beside them how many rows its clip and side ask for, from which frame to which.

    A clip is as long as its orders or its detections reach, so that no detection lies outside the frames.
    """
    dets = vw.boxes(spark, sf)
    seen = dets.groupBy("clip").agg((F.max("frame") + 1).alias("num_frames"))
    clips = clips_of(spark, sf).unionByName(seen).groupBy("clip").agg(F.max("num_frames").alias("num_frames"))
    kept = cut_lineage(tr.recover(tr.select_slots(dets)).select("clip", "frame", "side", "box", "conf"))
    full = tr.dense_frames(clips).join(kept, ["clip", "frame", "side"], "left").withColumn(
        "valid", F.col("box").isNotNull())
    sides = [full.filter(F.col("side") == s).drop("side") for s in (0, 1)]
    rows = tr.request_rows(tr.stack_sides(*sides))
    asked = rows.groupBy("clip", "side").agg(F.count(F.lit(1)).alias("rows"), F.min("frame").alias("first"), F.max("frame").alias("last"))
    return rows.join(asked, ["clip", "side"]).select("clip", "side", "frame", *box_cols(), rnd(F.col("conf")).alias("conf"), "det", "rows", "first", "last")


REQUEST = f"""{KEPT_SQL}
SELECT clip, side, frame, {', '.join(f'{r(c)} AS {c}' for c in bx.CORNERS)}, {r('conf')} AS conf, true AS det, count(*) OVER req AS rows,
  min(frame) OVER req AS "first", max(frame) OVER req AS "last" FROM z WHERE anchor OR recovered WINDOW req AS (PARTITION BY clip, side)"""

QUERIES = {
    "detection_problems": (detection_problems, PROBLEMS),
    "box_overlap": (box_overlap, OVERLAP),
    "best_per_side": (best_per_side, BEST),
    "handedness": (handedness, HANDEDNESS),
    "majority_side": (majority_side, MAJORITY),
    "side_consistency": (side_consistency, CONSISTENT),
    "pack_detections": (pack_detections, PACK),
    "unpack_detections": (unpack_detections, UNPACK),
    "detector_output": (detector_output, OUTPUT),
    "anchor_recovery": (anchor_recovery, RECOVER),
    "slot_selection": (slot_selection, SELECTED),
    "hand_tracks": (hand_tracks, TRACKS),
    "request_rows": (request_rows, REQUEST),
}
