"""Readers, decoders, identity and ledger tables on texts built from the given tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import pose, vec as v
from ..operators import handmodel, infer, schedule as sc
from ..plans import ledger as lg, quality
from ..schemas import STAGES
from ..session import cut_lineage, scratch_path
from ..sources import clips_json, files, ground_truth, lerobot, npz
from . import camera, evaluation, views as vw
from . import hands as hq
from .views import r, rnd, table


# ------------------------------------------------------------------ probe, files
def probe_metadata(spark, sf):
    """Probe documents per order: fractional rates, missing counts, fallbacks."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    k = F.col("o_orderkey")
    avg = F.when(k % 3 == 0, "30000/1001").when(k % 3 == 1, "0/0").otherwise("25")
    count = F.when(k % 2 == 0, (F.col("o_custkey") + 10).cast("string")).otherwise("N/A")
    text = F.format_string(
        '{"streams":[{"avg_frame_rate":"%s","r_frame_rate":"50/1","nb_frames":"%s","width":%d,"height":480,"codec_name":"h264"}],"format":{"duration":"%d.5"}}',
        avg, count, 320 + k % 10, 2 + k % 7)
    rows = files.decode_probe(o.select(k.alias("clip"), text.alias("text")))
    return rows.withColumn("fps", rnd(F.col("fps"))).withColumn("duration", rnd(F.col("duration")))


PROBE = f"""WITH p AS (SELECT o_orderkey AS clip, o_custkey, CASE o_orderkey % 3 WHEN 0 THEN 30000 / 1001.0 WHEN 1 THEN 50.0 ELSE 25.0 END AS fps FROM orders)
SELECT clip, {r('fps')} AS fps, 320 + clip % 10 AS width, 480 AS height,
CASE WHEN clip % 2 = 0 THEN o_custkey + 10 ELSE CAST(round_even((2.5 + clip % 7) * fps, 0) AS BIGINT) END AS num_frames,
{r('2.5 + clip % 7')} AS duration, 'h264' AS codec FROM p"""


def frame_inventory(spark, sf):
    """Frame files of every clip, listed in no order, ranked by name; odd clips have unpadded numbers."""
    c = vw.clips(spark, sf)
    name = F.when(F.col("clip") % 2 == 0, F.format_string("%06d", F.col("frame") * 2)).otherwise(F.concat(F.lit("f_"), F.col("frame")))
    paths = sc.frames(c).select("clip", F.concat(F.lit("/data/"), F.col("clip"), F.lit("/frames/"), name, F.lit(".jpg")).alias("path"))
    rows = files.frame_inventory(paths, c.select("clip", F.lit(25.0).alias("fps")))
    return rows.select("clip", "frame", "path", rnd(F.col("ts")).alias("ts"))


INVENTORY = f"""WITH {vw.CLIPS_SQL}, f AS (SELECT clip, unnest(range(num_frames)) AS i FROM c),
p AS (SELECT clip, '/data/' || clip || '/frames/' || CASE WHEN clip % 2 = 0 THEN printf('%06d', i * 2) ELSE 'f_' || i END || '.jpg' AS path FROM f),
o AS (SELECT clip, path, row_number() OVER (PARTITION BY clip ORDER BY path) - 1 AS i FROM p)
SELECT clip, CAST(i AS INTEGER) AS frame, path, {r('i / 25.0')} AS ts FROM o"""


def manifest(spark, sf):
    """Manifest documents with names and objects."""
    c = table(spark, sf, "customer").select("c_custkey")
    text = F.format_string('{"clips": ["a%d", {"clip": "b%d", "num_frames": %d, "from_stage": "fusion"}]}',
                           "c_custkey", "c_custkey", F.col("c_custkey") % 90 + 1)
    return files.decode_manifest(c.select(text.alias("text")))


MANIFEST = """SELECT 'a' || c_custkey AS clip, NULL AS video, NULL AS num_frames, NULL AS from_stage, '' AS notes FROM customer
UNION ALL SELECT 'b' || c_custkey, NULL, c_custkey % 90 + 1, 'fusion', '' FROM customer"""


def manifest_lines(spark, sf):
    return files.manifest_lines(vw.clips(spark, sf))


LINES = f"""WITH {vw.CLIPS_SQL} SELECT clip, '{{"clip":' || clip || ',"num_frames":' || num_frames || '}}' AS entry FROM c"""


def sorted_json(spark, sf):
    p = table(spark, sf, "part").select("p_size", "p_partkey", "p_brand")
    return p.select("p_partkey", files.sorted_json(*p.columns).alias("doc"))


SORTED = """SELECT p_partkey, '{"p_brand":"' || p_brand || '","p_partkey":' || p_partkey || ',"p_size":' || p_size || '}' AS doc FROM part"""


def log_summary(spark, sf):
    """The last JSON line of a log text."""
    e = table(spark, sf, "events")
    text = F.concat(F.lit('{"k": -1}\nstarted\n'), F.when(F.col("event_id") % 3 != 0, F.col("props")).otherwise("no summary"), F.lit("\n{broken\ndone "), F.col("event_type"))
    rows = files.last_summary(e.select("event_id", text.alias("text")))
    return rows.select("event_id", F.get_json_object("summary", "$.k").cast("int").alias("k"))


LOGS = "SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) ELSE -1 END AS k FROM events"


def clip_names(spark, sf):
    """Path parts of clip folders, and the stem of a page's last path part."""
    e = table(spark, sf, "events").select("event_id", "user_id")
    path = F.format_string("/root/%s/seq-%d/clip-%06d/clip_info.json", F.when(F.col("user_id") % 2 == 0, "train").otherwise("test"), "user_id", "event_id")
    rows = clips_json.discover(clips_json.located(e.select(path.alias("path"), F.lit("").alias("text"))), "train")
    return rows.select("path", "split", "sequence", "number", files.clip_name(F.col("path")).alias("stem"))


NAMES = """SELECT printf('/root/train/seq-%d/clip-%06d/clip_info.json', user_id, event_id) AS path, 'train' AS split, 'seq-' || user_id AS sequence,
event_id AS number, 'clip_info' AS stem FROM events WHERE user_id % 2 = 0"""


# --------------------------------------------------------------------- episodes
INFO = {
    "fps": 30, "video_path": "videos/{video_key}/chunk-{chunk_index:03d}/file-{file_index:03d}.mp4",
    "features": {"view": {"dtype": "video", "shape": [480, 640, 3]}, "vector": {"dtype": "float32", "shape": [64]},
                 "flag": {"dtype": "bool", "shape": [1]}, "label": {"dtype": "int64", "shape": [1]}},
}


def episode_frames(spark, sf):
    """Frame labels decoded by the declared shapes."""
    e = table(spark, sf, "embeddings")
    rows = e.select("vec_id", F.col("embedding").alias("vector"), F.array(F.col("vec_id") % 2 == 0).alias("flag"), F.array("label").alias("label"))
    rows = lerobot.decode_frames(rows, lerobot.checked_info(INFO))
    return rows.select("vec_id", F.size("vector").alias("n"), rnd(F.col("vector")[5]).alias("v5"), "flag", "label")


FRAMES = f"SELECT vec_id, 64 AS n, {r('embedding[6]')} AS v5, vec_id % 2 = 0 AS flag, CAST(label AS DOUBLE) AS label FROM embeddings"


def episodes(spark, sf):
    """Latest metadata row per episode, with its task and file locations."""
    e = table(spark, sf, "events")
    rows = e.select(F.col("user_id").alias("episode_index"), (F.col("event_id") % 5).cast("int").alias("task_index"),
                    (F.col("event_id") % 40).cast("int").alias("data/file_index"), (F.col("user_id") % 7).cast("int").alias("videos/view/chunk_index"),
                    F.format_string("%09d.parquet", "event_id").alias("_path"))
    tasks = table(spark, sf, "region").select(F.col("r_regionkey").alias("task_index"), F.col("r_name").alias("task"))
    out = lerobot.file_locations(lerobot.with_task(lerobot.latest_episodes(rows), tasks), INFO, "/root")
    return out.select("episode_index", "task_index", "task", "data_file", "video_file")


EPISODES = """WITH l AS (SELECT user_id, max(event_id) AS e FROM events GROUP BY user_id)
SELECT user_id AS episode_index, e % 5 AS task_index, r_name AS task, printf('/root/data/chunk-000/file-%03d.parquet', e % 40) AS data_file,
printf('/root/videos/view/chunk-%03d/file-000.mp4', user_id % 7) AS video_file FROM l LEFT JOIN region ON r_regionkey = e % 5"""


def episode_lengths(spark, sf):
    """Episodes whose stored length is off: here every third says one too many."""
    fr = table(spark, sf, "embeddings").select(F.col("label").alias("episode_index"))
    ep = fr.groupBy("episode_index").agg(F.count(F.lit(1)).alias("length")).withColumn(
        "length", F.col("length") + F.when(F.col("episode_index") % 3 == 0, 1).otherwise(0))
    return lerobot.length_check(fr, ep)


LENGTHS = "SELECT label AS episode_index, count(*) + 1 AS length, count(*) AS rows FROM embeddings WHERE label % 3 = 0 GROUP BY label"

YAW0, STEP = 0.3, 0.05


def dataset_frames(spark, sf):
    """Episode frames whose camera starts turned and away from the origin; each hand has the vector of its side.

    A last frame without a second vector has the first for both.
    """
    own = lambda side, c: F.max_by(c, F.when(F.col("side") == side, 1))
    rows = vw.embedding_frames(spark, sf).groupBy("clip", "frame").agg(
        own(0, "vec_id").alias("vec_id"), own(0, "embedding").alias("left"), own(1, "embedding").alias("right"))
    rows = rows.withColumn("right", F.coalesce("right", "left"))
    f = F.col("frame").cast("double")
    rows = rows.withColumn("_r", v.yaw(YAW0 + STEP * f)).withColumn("_t", v.vec(1.0 + 0.1 * f, F.lit(2.0), 0.5 * f))
    w2c, t = pose.invert(F.col("_r"), F.col("_t"))
    rows = rows.withColumn("_w", w2c).withColumn("_wt", t)
    e = lambda i: F.col("left" if i < 3 else "right")[i].cast("double")
    turn = F.col("_r")
    state = F.transform(F.sequence(F.lit(0), F.lit(121)), lambda i: i.cast("double") + F.col("frame"))
    return rows.select(
        F.col("clip").alias("episode_index"), F.col("frame").alias("frame_index"),
        pose.pose_to_matrix(F.col("_w"), F.col("_wt")).alias("extrinsics_w2c"), v.mat(*vw.K).alias("intrinsics"),
        F.array(F.col("vec_id") % 4 != 1, F.col("vec_id") % 3 != 1).alias("state_mask"), (F.col("vec_id") % 5 != 0).alias("left_kept"),
        F.array(e(0), e(1), e(2)).alias("left_transl_world"), F.array(e(3), e(4), e(5)).alias("right_transl_world"),
        turn.alias("left_orient_world"), turn.alias("right_orient_world"),
        F.flatten(F.array_repeat(turn, 15)).alias("left_hand_pose"), F.flatten(F.array_repeat(turn, 15)).alias("right_hand_pose"),
        state.alias("observation.state"))


def episode_reference(spark, sf):
    """Reference trajectories in World-0: wrists, root turns, shape numbers, masks."""
    t = ground_truth.from_lerobot(dataset_frames(spark, sf), 30.0)
    return t.select("clip", "frame", "side", "valid", *vw.xyz_cols(F.col("joints_world")[0]), *vw.xyz_cols(F.col("joints_camera")[0], "c"),
                    rnd(F.col("root_rot")[2]).alias("root"), rnd(F.col("rot")[2]).alias("turn"), rnd(F.col("betas")[0]).alias("beta0"),
                    rnd(F.col("trans")["x"]).alias("tx"), "track_id")


_A0 = f"(CAST({YAW0} AS DOUBLE))"
_AF = f"({YAW0} + {STEP} * frame)"
_W0 = f"(wx - 1.0)", "(wy - 2.0)", "wz"
_WF = "(wx - 1.0 - 0.1 * frame)", "(wy - 2.0)", "(wz - 0.5 * frame)"


def _rt(angle: str, p) -> tuple:
    return f"cos({angle}) * {p[0]} - sin({angle}) * {p[2]}", p[1], f"sin({angle}) * {p[0]} + cos({angle}) * {p[2]}"


# Frames with the vectors of both sides.
_BOTH = vw.HANDS_SQL + """,
f AS (SELECT a.clip, a.frame, a.vec_id, a.e AS e0, coalesce(b.e, a.e) AS e1 FROM h a LEFT JOIN h b ON b.clip = a.clip AND b.frame = a.frame AND b.side = 1
  WHERE a.side = 0)"""
_E = "(CASE {} WHEN 0 THEN e0 ELSE e1 END)"
EPISODE_REF = f"""WITH {_BOTH}, b AS (
  SELECT clip, frame, vec_id, CAST(s AS INTEGER) AS side, CASE s WHEN 0 THEN vec_id % 4 <> 1 AND vec_id % 5 <> 0 ELSE vec_id % 3 <> 1 END AS valid,
    {', '.join(f"CAST({_E.format('s')}[3 * s + {i + 1}] AS DOUBLE) AS w{a}" for i, a in enumerate('xyz'))}
  FROM (SELECT *, unnest(range(2)) AS s FROM f))
SELECT clip, frame, side, valid, {', '.join(f'CASE WHEN valid THEN {r(e)} END AS {a}' for e, a in zip(_rt(_A0, _W0), 'xyz'))},
{', '.join(f'CASE WHEN valid THEN {r(e)} END AS c{a}' for e, a in zip(_rt(_AF, _WF), 'xyz'))},
{r(f'sin({STEP} * frame)')} AS root, {r(f'sin({STEP} * frame)')} AS turn, {r('61 * side + 51 + frame')} AS beta0,
{r(f'cos({_A0}) * 0.1 * frame - sin({_A0}) * 0.5 * frame')} AS tx, CASE WHEN valid THEN 0 ELSE -1 END AS track_id FROM b"""

PART = 8


def clip_documents(spark, sf):
    """Clip folders as JSON documents: one clip per eight frames."""
    rows = dataset_frames(spark, sf).withColumn("clip", F.col("episode_index") * 1000 + F.floor(F.col("frame_index") / PART))
    rows = rows.withColumn("i", F.col("frame_index") % PART).withColumn("q", pose.matrix_to_quat(v.yaw(YAW0 + STEP * F.col("frame_index"))))
    q = F.col("q")
    f = F.col("frame_index").cast("double")
    cam = F.struct(F.array(1.0 + 0.1 * f, F.lit(2.0), 0.5 * f).alias("translation_xyz"), F.array(q[3], q[0], q[1], q[2]).alias("quaternion_wxyz"))
    left = F.struct(F.struct(F.col("left_transl_world").alias("translation_xyz")).alias("T_world_from_wrist"))
    right = F.when(F.col("state_mask")[1], F.struct(F.struct(F.col("right_transl_world").alias("translation_xyz")).alias("T_world_from_wrist")))
    key = F.col("i").cast("string")

    def as_map(value):
        return F.to_json(F.map_from_entries(F.collect_list(F.struct(key.alias("k"), value.alias("v")))))

    docs = rows.groupBy("clip").agg(
        F.to_json(F.struct(F.count(F.lit(1)).alias("clip_length"), F.array_sort(F.collect_list(F.struct(
            F.col("i").alias("frame_idx"), (F.lit(5000000000) + F.col("i") * 33333333).alias("timestamp_ns")))).alias("frames"))).alias("info"),
        as_map(cam).alias("camera"), as_map(F.struct(left.alias("left"), right.alias("right"))).alias("hands"))
    return [docs.select("clip", F.col(c).alias("text")) for c in ("info", "camera", "hands")]


def clip_frames(spark, sf):
    """Decoded documents: poses, timestamps and wrists per frame."""
    t = clips_json.decode(*clip_documents(spark, sf))
    return t.select("clip", "frame", "ts_ns", rnd(F.col("rot")[2]).alias("turn"), *vw.xyz_cols(F.col("trans")),
                    rnd(F.col("wrist_left")["x"]).alias("left_x"), rnd(F.col("wrist_right")["x"]).alias("right_x"))


_CL = f"""WITH {_BOTH}, d AS (SELECT clip * 1000 + CAST(floor(frame / {PART}) AS INTEGER) AS cl, frame % {PART} AS i, frame, vec_id, e0, e1 FROM f)"""
CLIP_FRAMES = f"""{_CL} SELECT cl AS clip, i AS frame, 5000000000 + i * 33333333 AS ts_ns, {r(f'sin({_AF})')} AS turn, {r('1 + 0.1 * frame')} AS x, 2.0 AS y, {r('0.5 * frame')} AS z,
{r('e0[1]')} AS left_x, CASE WHEN vec_id % 3 <> 1 THEN {r('e1[4]')} END AS right_x FROM d"""


def clip_reference(spark, sf):
    """Wrist-only reference of the decoded clips, anchored on their first camera."""
    t = ground_truth.from_clips(clips_json.decode(*clip_documents(spark, sf)))
    return t.select("clip", "frame", "side", "valid", rnd(F.col("ts")).alias("ts"), *vw.xyz_cols(F.col("joints_world")[0]),
                    F.col("joints_world")[1].isNull().alias("fingers_missing"), F.col("k").isNull().alias("k_missing"))


_F0 = f"({YAW0} + {STEP} * f0)"
_WA = "(wx - 1.0 - 0.1 * f0)", "(wy - 2.0)", "(wz - 0.5 * f0)"
CLIP_REF = f"""{_CL}, s AS (SELECT cl, i, frame - i AS f0, CAST(unnest(range(2)) AS INTEGER) AS side, vec_id, e0, e1 FROM d),
p AS (SELECT *, side = 0 OR vec_id % 3 <> 1 AS valid, {', '.join(f"CAST({_E.format('side')}[3 * side + {i + 1}] AS DOUBLE) AS w{a}" for i, a in enumerate('xyz'))} FROM s)
SELECT cl AS clip, i AS frame, side, valid, {r('i * 33333333 / 1e9')} AS ts, {', '.join(f'CASE WHEN valid THEN {r(e)} END AS {a}' for e, a in zip(_rt(_F0, _WA), 'xyz'))},
true AS fingers_missing, true AS k_missing FROM p"""


# ------------------------------------------------------------- identity, ledger
def content_hash(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", lg.content_hash(F.col("text")).alias("sha"))


HASH = "SELECT doc_id, sha256(text) AS sha FROM documents"


def file_hashes(spark, sf):
    """Digests of files: the name of every supplier, written as a text file of its own."""
    root = scratch_path(spark)
    # Writing so many files takes long, though they are small: the partition number is given, and tasks move their own files.
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name").repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "s_suppkey")
    rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("s_suppkey").text(root)
    rows = lg.file_hashes(spark, f"{root}/*/*.txt")
    return rows.select(F.regexp_extract("path", r"s_suppkey=(\d+)", 1).cast("long").alias("s_suppkey"), "size", "sha")


FILE_HASH = "SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, strlen(s_name) + 1 AS size, sha256(s_name || chr(10)) AS sha FROM supplier"


def checked_sink(spark, sf):
    """A broken trajectory handed to the checked sink: what it counts while it stages the rows, and that nothing is published."""
    root = scratch_path(spark)
    traj = evaluation.broken(spark, sf)
    bad = files.write_checked(traj, root, quality.row_checks(traj), quality.frame_problems, "clip")
    return spark.createDataFrame([(f, p, n) for (f, p), n in bad.items()], "field string, problem string, rows long")


CHECKED = f"SELECT field, problem, CAST(sum(rows) AS BIGINT) AS rows FROM ({evaluation.PROBLEMS}) GROUP BY ALL"


def params_hash(spark, sf):
    c = table(spark, sf, "customer")
    inputs = F.array(F.struct(F.lit("video").alias("name"), F.col("c_name").alias("sha")))
    h = lg.params_hash(F.lit("hand"), {"window": F.lit(16), "overlap": F.lit(8), "clip": F.col("c_custkey")}, inputs,
                       F.lit(0), F.lit(4), {"mode": F.col("c_mktsegment")})
    return c.select("c_custkey", h.alias("identity"))


PARAMS = """SELECT c_custkey, sha256('{"extra":{"mode":"' || c_mktsegment || '"},"inputs":[{"name":"video","sha":"' || c_name || '"}],"params":{"clip":' || c_custkey ||
',"overlap":8,"window":16},"selection":{"count":4,"index":0},"stage":"hand"}') AS identity FROM customer"""

PATHS = ("video/a.mp4", "metadata.json", "detection/detection.npz", "camera/windows/000000_000199.npz", "camera/windows/000160_000299.npz",
         "hand/hand_camera.npz", "camera/stitched_camera.npz", "trajectory/trajectory_raw.npz", "trajectory/trajectory.npz")


def stage_inputs(spark, sf):
    """Which files each stage of a clip consumes; nothing consumes the final trajectory."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("clip"), F.explode(F.array(*[F.lit(p) for p in PATHS])).alias("path"))
    c = c.withColumn("sha", F.sha2(F.concat(F.col("clip").cast("string"), "path"), 256))
    return lg.inputs_per_stage(c)


_PAT = ", ".join(f"('{s}', '{p}')" for s, p in lg.STAGE_INPUTS.items())
_PATH_ROWS = ", ".join(f"('{p}')" for p in PATHS)
INPUTS = f"""WITH pat(stage, re) AS (VALUES {_PAT}), p(path) AS (VALUES {_PATH_ROWS}),
f AS (SELECT c_custkey AS clip, stage, split_part(path, '/', -1) AS name, sha256(CAST(c_custkey AS VARCHAR) || path) AS sha
  FROM customer, p, pat WHERE regexp_matches(path, re)),
b AS (SELECT clip, stage, substr(sha256(name), 1, 3) AS bucket, sha256(string_agg(name || ':' || sha, ';' ORDER BY name || ':' || sha)) AS part,
  count(*) AS n, min(name) AS low FROM f GROUP BY ALL)
SELECT clip, stage, CAST(sum(n) AS BIGINT) AS files, min(low) AS first_name, sha256(string_agg(bucket || '=' || part, ';' ORDER BY bucket || '=' || part)) AS digest
FROM b GROUP BY clip, stage"""


def _markers(spark, sf):
    """One marker text per order; some are broken, some lack their hash."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    k = F.col("o_orderkey")
    stage = F.element_at(F.array(*[F.lit(s) for s in STAGES]), (k % 7 + 1).cast("int"))
    status = F.when(F.col("o_orderstatus") == "F", "failed").otherwise("ok")
    good = F.format_string('{"stage":"%s","unit":"u%d","params_hash":"h%d","outputs":["out%d.npz"],"inputs":{"a":"b"},"status":"%s","detail":"d%06d"}',
                           stage, k, k % 5, k, status, k)
    text = F.when(k % 10 == 3, F.lit('{"stage": "hand", "unit": "x"}')).when(k % 10 == 4, F.lit("{broken")).otherwise(good)
    return o.select(F.col("o_custkey").alias("clip"), k.alias("finished_at"), text.alias("text"))


def markers(spark, sf):
    rows = lg.decode_markers(_markers(spark, sf))
    return rows.select("clip", "finished_at", "stage", "unit", "params_hash", "status", F.col("outputs")[0].alias("output"))


_ST = "CASE o_orderkey % 7 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(STAGES)) + " END"
MARK_SQL = f"""mk AS (SELECT o_custkey AS clip, o_orderkey AS finished_at, {_ST} AS stage, 'u' || o_orderkey AS unit, 'h' || o_orderkey % 5 AS params_hash,
  CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'ok' END AS status, 'out' || o_orderkey || '.npz' AS output, printf('d%06d', o_orderkey) AS detail,
  o_orderkey % 7 AS pos FROM orders WHERE o_orderkey % 10 NOT IN (3, 4))"""
MARKERS = f"WITH {MARK_SQL} SELECT clip, finished_at, stage, unit, params_hash, status, output FROM mk"


def _with_pos(rows):
    return rows.withColumn("pos", F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("stage")).cast("int") - 1)


def pending_units(spark, sf):
    """Work whose identity changed or whose output is gone is still to do."""
    # The texts are parsed once; work, ledger and outputs are read off the written rows.
    done = cut_lineage(lg.decode_markers(_markers(spark, sf)).select("clip", "stage", "unit", "params_hash", "outputs", "finished_at"))
    work = done.select("clip", "stage", "unit", F.when(F.col("finished_at") % 6 == 0, F.lit("new")).otherwise(F.col("params_hash")).alias("params_hash"))
    outs = done.filter("finished_at % 4 <> 1").select("clip", F.col("outputs")[0].alias("name"))
    return lg.pending(work, done, outs)


PENDING = f"""WITH {MARK_SQL} SELECT clip, stage, unit, CASE WHEN finished_at % 6 = 0 THEN 'new' ELSE params_hash END AS params_hash FROM mk
WHERE finished_at % 6 = 0 OR finished_at % 4 = 1"""


def runnable_units(spark, sf):
    """Stages behind a failed stage of the same clip are left out."""
    done = _with_pos(lg.decode_markers(_markers(spark, sf)))
    c = vw.clips(spark, sf).select("clip", F.posexplode(F.array(*[F.lit(s) for s in STAGES])).alias("pos", "stage"))
    return lg.runnable(c, done).select("clip", "stage", "pos")


_SV = ", ".join(f"('{s}', {i})" for i, s in enumerate(STAGES))
RUNNABLE = f"""WITH {MARK_SQL}, st(stage, pos) AS (VALUES {_SV}), f AS (SELECT clip, min(pos) AS p FROM mk WHERE status = 'failed' GROUP BY clip),
c AS (SELECT DISTINCT o_custkey AS clip FROM orders) SELECT c.clip, st.stage, st.pos FROM c JOIN st ON true LEFT JOIN f ON f.clip = c.clip WHERE f.p IS NULL OR st.pos <= f.p"""


def ledger_summary(spark, sf):
    return lg.summary(lg.decode_markers(_markers(spark, sf)))


SUMMARY = f"WITH {MARK_SQL} SELECT status, count(*) AS units FROM mk GROUP BY GROUPING SETS ((status), ())"


def degraded_metadata(spark, sf):
    done = lg.decode_markers(_markers(spark, sf))
    rows = lg.mark_degraded(vw.clips(spark, sf), done)
    return rows.select("clip", "num_frames", "degraded", "failed_units", "degraded_reason", F.array_join("failures", ",").alias("failures"))


DEGRADED = f"""WITH {vw.CLIPS_SQL}, {MARK_SQL}, f AS (SELECT clip, count(*) AS n, arg_max(detail, row(finished_at, detail)) AS d, string_agg(DISTINCT stage || '/' || unit, ',' ORDER BY stage || '/' || unit) AS u
  FROM mk WHERE status = 'failed' GROUP BY clip)
SELECT c.clip, c.num_frames, f.n IS NOT NULL AS degraded, coalesce(f.n, 0) AS failed_units, f.d AS degraded_reason, coalesce(f.u, '') AS failures FROM c LEFT JOIN f ON f.clip = c.clip"""


def latest_markers(spark, sf):
    """Newest marker per clip and stage, and whether the clip is degraded."""
    done = lg.decode_markers(_markers(spark, sf)).withColumn("unit", F.lit("whole"))
    last = lg.latest(done).select("clip", "stage", "finished_at", "status")
    bad = lg.degraded_clips(done).withColumn("degraded", F.lit(True))
    return last.join(bad, "clip", "left").withColumn("degraded", F.coalesce("degraded", F.lit(False)))


LATEST = f"""WITH {MARK_SQL}, b AS (SELECT DISTINCT clip FROM mk WHERE status = 'failed')
SELECT mk.clip, stage, max(finished_at) AS finished_at, max_by(status, finished_at) AS status, bool_or(b.clip IS NOT NULL) AS degraded
FROM mk LEFT JOIN b ON b.clip = mk.clip GROUP BY mk.clip, stage"""


# ------------------------------------------------------------------- contracts
def window_problems(spark, sf):
    """Camera windows with a bent rotation and hand windows with a lost row."""
    cam = camera.camera_windows(spark, sf)
    cam = cam.withColumn("rot", F.when(F.col("frame") % 5 == 2, F.transform("rot", lambda e: e * 1.1)).otherwise(F.col("rot")))
    a = quality.camera_window_problems(cam).withColumn("kind", F.lit("camera"))
    full = vw.sizes(spark, sf)
    hw = sc.to_frames(sc.windows(full, hq.BW, hq.BO)).select("clip", "win", "start", "end", "frame", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    h = hw.join(vw.hands(spark, sf), ["clip", "frame", "side"], "left").withColumn("valid", F.coalesce("valid", F.lit(False)))
    b = quality.hand_window_problems(h.filter("frame % 7 <> 5")).withColumn("kind", F.lit("hand"))
    return a.unionByName(b)


WINDOW_PROBLEMS = f"""WITH {camera.POSES_SQL}, {vw.schedule_sql(hq.BW, hq.BO, 'src', 'hwin')}, hf AS (SELECT clip, win, "end" - "start" AS n, unnest(range("start", "end")) AS frame FROM hwin),
g AS (SELECT clip, win, n, 2 * count(*) FILTER (WHERE frame % 7 <> 5) AS rows FROM hf GROUP BY clip, win, n)
SELECT clip, win, 'rotation' AS problem, count(*) AS rows, 'camera' AS kind FROM cam WHERE frame % 5 = 2 GROUP BY clip, win
UNION ALL SELECT clip, win, 'row count differs from window length', rows, 'hand' FROM g WHERE rows <> 2 * n"""


def archive_roundtrip(spark, sf):
    """Hand windows written as array archives and read back by frame ranges: every joint, root turn and shape."""
    root = scratch_path(spark)
    windows = hq.hand_windows(spark, sf).withColumn("path", npz.window_path("hand"))
    npz.write(windows, root, "hand_window")
    rows = npz.read(spark, root, "hand_window", task_bytes=4096).withColumn("clip", npz.clip_from_path().cast("int"))
    keys = ("clip", "start", "end", "frame", "side", "conf", "root_rot", "betas")
    return vw.long_joints(rows.filter("valid"), keys=keys).select(
        *keys[:5], rnd(F.col("conf")).alias("conf"), "joint", "x", "y", "z", *[rnd(F.col("root_rot")[i]).alias(f"r{i}") for i in range(9)],
        F.size("betas").alias("n_betas"), F.array_max("betas").alias("beta"))


_TURN = {i: e for i, e in zip(range(9), ("cos(a)", "0", "sin(a)", "0", "1", "0", "-sin(a)", "0", "cos(a)"))}
ARCHIVE = f"""WITH {hq.HWIN_SQL}, w AS (SELECT *, 0.05 * frame + 0.02 * win AS a FROM hw)
SELECT w.clip, w."start", w."end", w.frame, w.side, {r('w.conf')} AS conf, j.joint, {r('j.x + 0.01 * w.win')} AS x, {r('j.y')} AS y, {r('j.z')} AS z,
  {', '.join(f'{r(e)} AS r{i}' for i, e in _TURN.items())}, 10 AS n_betas, CAST(w.win AS DOUBLE) AS beta
FROM w JOIN j ON j.clip = w.clip AND j.frame = w.frame AND j.side = w.side WHERE w.valid"""


# ------------------------------------------------------------------ hand model
def plain_model() -> handmodel.HandModel:
    """A flat hand: finger f runs along y at x = (f - 2) * 2 cm, joints 3 cm apart."""
    n = 800
    template = np.zeros((n, 3))
    weights = np.zeros((n, 16))
    weights[:, 0] = 1.0
    for f, (name, joints) in enumerate(handmodel.FINGER_JOINTS.items()):
        for k, j in enumerate([*joints, handmodel.TIP_VERTEX[name]], start=1):
            template[j] = (0.02 * (f - 2), 0.03 * k, 0.0)
            weights[j] = 0.0
            weights[j, joints[min(k, 3) - 1]] = 1.0
    regressor = np.zeros((16, n))
    regressor[np.arange(16), np.arange(16)] = 1.0
    return handmodel.HandModel(template, np.zeros((n, 3, 10)), regressor, weights)


def bending_model() -> handmodel.HandModel:
    """The flat hand with a shape number that scales it, one that draws the tips back, and tips that sink as fingers bend."""
    flat = plain_model()
    tips = list(handmodel.TIP_VERTEX.values())
    shape = np.zeros((len(flat.template), 3, 10))
    shape[:, :, 0] = flat.template
    shape[tips, 1, 1] = -1.0
    bend = np.zeros((len(flat.template), 3, 15, 3, 3))
    for name, joints in handmodel.FINGER_JOINTS.items():
        bend[handmodel.TIP_VERTEX[name], 2, joints[0] - 1, 1, 1] = 0.1
    return handmodel.HandModel(flat.template, shape, flat.regressor, flat.weights, bend.reshape(-1, 3, 135))


def hand_landmarks(spark, sf):
    """Hands of many shapes with bent fingers and a turned wrist, side 0 with the mirrored model."""
    f = F.col("frame").cast("double")
    bend = 0.02 * (F.col("frame") % 10) + 0.05
    c, s = F.cos(bend), F.sin(bend)
    betas = F.concat(F.array(0.1 * (f % 3), F.when(F.col("frame") % 7 == 5, 0.1).otherwise(0.0)), F.array_repeat(F.lit(0.0), 8))
    rows = vw.hands(spark, sf).select(
        "clip", "frame", "side", "valid", F.col("joints")[0].alias("wrist"), betas.alias("betas"),
        F.array_repeat(v.mat(c, -s, 0.0, s, c, 0.0, 0.0, 0.0, 1.0), 15).alias("hand_pose"), v.yaw(0.05 * F.col("frame")).alias("root_rot"),
        F.lit(None).cast("array<struct<x:double,y:double,z:double>>").alias("joints"))
    right = bending_model()
    made = handmodel.add_landmarks(rows, {0: handmodel.mirror_model(right), 1: right})
    return vw.long_joints(made, extra=("rest_ok",))


_SGN = "CASE side WHEN 1 THEN 1 ELSE -1 END"
LANDMARKS = f"""WITH {vw.HANDS_SQL}, q AS (SELECT clip, frame, side, joint AS k, CASE WHEN joint > 0 THEN (joint - 1) % 4 + 1 ELSE 0 END AS n, floor((joint - 1) / 4) - 2 AS f,
  0.02 * (frame % 10) + 0.05 AS b, 1 + 0.1 * (frame % 3) AS s, CASE WHEN frame % 7 = 5 THEN 0.1 ELSE 0 END AS back FROM j WHERE valid),
l AS (SELECT *, CASE WHEN n = 0 THEN 0 ELSE 0.02 * f * s END AS x0, 0.03 * s AS len, 0.03 * s - back AS tip FROM q),
m AS (SELECT *, CASE n WHEN 0 THEN 0 WHEN 1 THEN x0 WHEN 2 THEN x0 - len * sin(b) ELSE x0 - len * (sin(b) + sin(2 * b)) - CASE n WHEN 4 THEN tip * sin(3 * b) ELSE 0 END END AS rx,
  CASE n WHEN 0 THEN 0 WHEN 1 THEN len WHEN 2 THEN len * (1 + cos(b)) ELSE len * (1 + cos(b) + cos(2 * b)) + CASE n WHEN 4 THEN tip * cos(3 * b) ELSE 0 END END AS ry,
  CASE n WHEN 4 THEN 0.1 * (cos(b) - 1) ELSE 0 END AS rz FROM l), wr AS (SELECT * FROM j WHERE joint = 0),
p AS (SELECT m.*, wr.x AS wx, wr.y AS wy, wr.z AS wz FROM m JOIN wr ON wr.clip = m.clip AND wr.frame = m.frame AND wr.side = m.side)
SELECT clip, frame, side, back = 0 AS rest_ok, k AS joint, {r(f'wx + {_SGN} * (cos(0.05 * frame) * rx + sin(0.05 * frame) * rz)')} AS x, {r('wy + ry')} AS y,
  {r('wz - sin(0.05 * frame) * rx + cos(0.05 * frame) * rz')} AS z FROM p"""


# --------------------------------------------------------------- user functions
def frame_inference(spark, sf):
    """A user function over frame batches: here a box from two columns."""
    import pandas as pd

    def detector(pdf):
        return pd.DataFrame({"clip": pdf["clip"], "frame": pdf["frame"], "x1": pdf["raw"], "conf": pdf["conf"].clip(0, 0.9)})

    rows = infer.infer_frames(vw.series(spark, sf).select("clip", "frame", "raw", "conf"), detector, "clip long, frame int, x1 double, conf double")
    return rows.select("clip", "frame", rnd(F.col("x1")).alias("x1"), rnd(F.col("conf")).alias("conf"))


FRAME_INFER = f"WITH {vw.SERIES_SQL} SELECT clip, frame, {r('raw')} AS x1, {r('greatest(0, least(0.9, conf))')} AS conf FROM series"


def window_inference(spark, sf):
    """A user function per window: here the mean of its frames and its first value."""
    import pandas as pd

    s = vw.series(spark, sf).select("clip", "frame", "raw")
    win = sc.windows(s.groupBy("clip").agg((F.max("frame") + 1).alias("num_frames")), 16, 8)

    def model(pdf):
        return pd.DataFrame({"clip": [pdf["clip"].iloc[0]], "win": [pdf["win"].iloc[0]], "frames": [len(pdf)],
                             "mean": [pdf["raw"].mean()], "head": [pdf["raw"].iloc[0]]})

    rows = infer.infer_windows(s, win, model, "clip long, win int, frames int, mean double, head double")
    return rows.select("clip", "win", "frames", rnd(F.col("mean")).alias("mean"), rnd(F.col("head")).alias("head"))


WINDOW_INFER = f"""WITH {vw.SERIES_SQL}, n AS (SELECT clip, max(frame) + 1 AS num_frames FROM series GROUP BY clip), {vw.schedule_sql(16, 8, 'n')}
SELECT win.clip, win.win, count(*) AS frames, {r('avg(raw)')} AS mean, {r('min_by(raw, frame)')} AS head
FROM win JOIN series s ON s.clip = win.clip AND s.frame >= win."start" AND s.frame < win."end" GROUP BY win.clip, win.win"""

QUERIES = {
    "probe_metadata": (probe_metadata, PROBE),
    "frame_inventory": (frame_inventory, INVENTORY),
    "manifest": (manifest, MANIFEST),
    "manifest_lines": (manifest_lines, LINES),
    "sorted_json": (sorted_json, SORTED),
    "log_summary": (log_summary, LOGS),
    "clip_names": (clip_names, NAMES),
    "episode_frames": (episode_frames, FRAMES),
    "episodes": (episodes, EPISODES),
    "episode_lengths": (episode_lengths, LENGTHS),
    "episode_reference": (episode_reference, EPISODE_REF),
    "clip_frames": (clip_frames, CLIP_FRAMES),
    "clip_reference": (clip_reference, CLIP_REF),
    "content_hash": (content_hash, HASH),
    "params_hash": (params_hash, PARAMS),
    "stage_inputs": (stage_inputs, INPUTS),
    "markers": (markers, MARKERS),
    "pending_units": (pending_units, PENDING),
    "runnable_units": (runnable_units, RUNNABLE),
    "ledger_summary": (ledger_summary, SUMMARY),
    "degraded_metadata": (degraded_metadata, DEGRADED),
    "latest_markers": (latest_markers, LATEST),
    "window_problems": (window_problems, WINDOW_PROBLEMS),
    "archive_roundtrip": (archive_roundtrip, ARCHIVE), "file_hashes": (file_hashes, FILE_HASH), "checked_sink": (checked_sink, CHECKED),
    "hand_landmarks": (hand_landmarks, LANDMARKS),
}
