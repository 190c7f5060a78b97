"""Files read back from disk: datasets, clip folders, archives, manifests, sinks."""

from pathlib import Path
import io
import json

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from motionweave.operators import handmodel
from motionweave.plans import ledger as lg, quality
from motionweave.sources import clips_json, files, ground_truth, lerobot, npz

INFO = {
    "fps": 30, "data_path": "data/chunk-{chunk_index:03d}/file-{file_index:03d}.parquet",
    "video_path": "videos/{video_key}/chunk-{chunk_index:03d}/file-{file_index:03d}.mp4",
    "features": {"cam": {"dtype": "video", "shape": [512, 512, 3]}, "state_mask": {"dtype": "bool", "shape": [2]},
                 "extrinsics_w2c": {"dtype": "float64", "shape": [16]}, "score": {"dtype": "float32", "shape": [1]}},
}


@pytest.fixture
def dataset(tmp_path):
    for d in ("meta/episodes/chunk-000", "data/chunk-000"):
        (tmp_path / d).mkdir(parents=True)
    (tmp_path / "meta/info.json").write_text(json.dumps(INFO))
    pq.write_table(pa.table({"task_index": [0, 1], "task": ["pour", "cut"]}), tmp_path / "meta/tasks.parquet")
    for name, length in (("a", 9), ("b", 5)):  # the later path wins
        pq.write_table(pa.table({"episode_index": [0, 1], "length": [length, 4], "task_index": [1, 0], "data/file_index": [0, 0],
                                 "videos/cam/file_index": [7, 8]}), tmp_path / f"meta/episodes/chunk-000/{name}.parquet")
    ep = [0] * 5 + [1] * 4
    pq.write_table(pa.table({"episode_index": ep, "frame_index": [*range(5), *range(4)], "extrinsics_w2c": [[1.0] * 16] * 9,
                             "state_mask": [[True, False]] * 9, "score": [[0.5]] * 9}), tmp_path / "data/chunk-000/file-000.parquet")
    return str(tmp_path)


def test_lerobot_dataset(spark, dataset):
    info = lerobot.read_info(spark, dataset)
    assert lerobot.vector_features(info) == {"state_mask": (2,), "extrinsics_w2c": (16,)}
    rows = lerobot.read_frames(spark, dataset, info, [1])
    assert rows.count() == 4 and rows.first().score == 0.5 and rows.schema["score"].dataType.simpleString() == "double"
    scan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in scan and "episode_index" in scan.split("PushedFilters")[1].split("]")[0]
    eps = lerobot.file_locations(lerobot.with_task(lerobot.read_episodes(spark, dataset), lerobot.read_tasks(spark, dataset)), info, "/d")
    first = eps.filter("episode_index = 0").first()
    assert (first.length, first.task, first.video_file) == (5, "cut", "/d/videos/cam/chunk-000/file-007.mp4")
    assert lerobot.length_check(lerobot.read_frames(spark, dataset, info), eps).count() == 0


def test_lerobot_problems(spark, dataset):
    bad = json.loads(json.dumps(INFO))
    bad["features"]["extrinsics_w2c"]["shape"] = [12]
    with pytest.raises(Exception, match="should hold 12"):
        lerobot.read_frames(spark, dataset, bad).collect()
    with pytest.raises(ValueError):
        lerobot.checked_info({"fps": 0})
    with pytest.raises(KeyError):
        lerobot.shape(INFO, "nope")


def test_clip_folders(spark, tmp_path):
    d = tmp_path / "train" / "seq1" / "clip-000003"
    d.mkdir(parents=True)
    frames = [{"frame_idx": i, "timestamp_ns": 1000 + i * 33333333} for i in range(3)]
    cam = {str(i): {"translation_xyz": [i, 2.0, 3.0], "quaternion_wxyz": [1.0, 0, 0, 0]} for i in range(3)}
    wrist = {"T_world_from_wrist": {"translation_xyz": [0.5, 0.5, 1.0]}}
    (d / "clip_info.json").write_text(json.dumps({"clip_length": 3, "frames": frames}))
    (d / "camera.json").write_text(json.dumps(cam))
    (d / "hands_pose.json").write_text(json.dumps({"0": {"left": wrist}, "1": {"left": wrist, "right": wrist}}))
    rows = clips_json.read(spark, str(tmp_path), "train", "seq1")
    ref = ground_truth.from_clips(rows)
    got = {(r.frame, r.side): r for r in ref.collect()}
    assert [k for k, r in sorted(got.items()) if r.valid] == [(0, 0), (1, 0), (1, 1)]
    p = got[(1, 0)].joints_world[0]
    assert (p.x, p.y, p.z) == (0.5, -1.5, -2.0) and got[(1, 0)].trans.x == 1.0
    assert quality.trajectory_problems(ref).count() == 0
    assert clips_json.read(spark, str(tmp_path), "test").count() == 0
    (d / "camera.json").write_text(json.dumps({k: cam[k] for k in ("0", "1")}))
    with pytest.raises(Exception, match="no camera entry for frame 2"):
        clips_json.read(spark, str(tmp_path)).collect()


def archive(path, **arrays):
    path.parent.mkdir(parents=True, exist_ok=True)
    np.savez(path, **arrays)


def test_camera_and_depth_archives(spark, tmp_path):
    depth = np.ones((2, 3, 4))
    depth[0, 0, 0] = np.nan
    archive(tmp_path / "c1/camera/windows/000010_000011.npz", rotation_c2w=np.stack([np.eye(3)] * 2), translation_c2w=np.arange(6.0).reshape(2, 3),
            intrinsics=np.stack([np.eye(3)] * 2), depth=depth, start=10, end=12)
    pattern = f"{tmp_path}/*/camera/windows/*.npz"
    cams = npz.read(spark, pattern, "camera_window").withColumn("clip", npz.clip_from_path()).orderBy("frame").collect()
    assert [(r.clip, r.start, r.end, r.frame, r.trans.y) for r in cams] == [("c1", 10, 12, 10, 1.0), ("c1", 10, 12, 11, 4.0)]
    assert npz.read(spark, pattern, "depth_samples").count() == 23


def test_stage_archives(spark, tmp_path):
    n = 3
    eye, joints = np.stack([np.eye(3)] * n), np.zeros((n, 2, 21, 3))
    joints[1, 0, 5, 0] = np.nan
    valid = np.ones((n, 2), bool)
    valid[2, 1] = False
    archive(tmp_path / "t.npz", frames=np.arange(n), timestamps=np.arange(n) / 30, hand_xyz_world=joints, hand_xyz_camera=joints, hand_valid=valid,
            hand_confidence=np.ones((n, 2)), hand_interpolated=~valid, camera_R_c2w=eye, camera_t_c2w=np.zeros((n, 3)), camera_K=eye * np.nan,
            bbox=np.full((n, 2, 4), np.nan), track_id=np.zeros((n, 2), int), mano_root_rot=np.stack([eye[:2]] * n), mano_hand_pose=np.zeros((n, 2, 15, 3, 3)),
            mano_betas=np.zeros((n, 2, 10)), postprocess_valid=valid)
    rows = {(r.frame, r.side): r for r in npz.read(spark, f"{tmp_path}/t.npz", "trajectory").collect()}
    assert rows[(2, 1)].joints_world is None and rows[(1, 0)].joints_world[5] is None and rows[(1, 0)].joints_world[4].x == 0.0
    assert rows[(0, 0)].k is None and rows[(0, 0)].box is None and len(rows[(0, 0)].hand_pose) == 15
    archive(tmp_path / "s.npz", rotation_c2w=eye, translation_c2w=np.zeros((n, 3)), valid=np.ones(n, bool), weight=np.ones(n))
    assert npz.read(spark, f"{tmp_path}/s.npz", "stitched_camera").filter("valid and k is null").count() == n
    archive(tmp_path / "m.npz", scales=np.ones(2), rotations=eye[:2], translations=np.zeros((2, 3)))
    assert npz.read(spark, f"{tmp_path}/m.npz", "sim3").count() == 2
    archive(tmp_path / "d.npz", boxes=np.full((n, 2, 4), np.nan), confidence=np.zeros((n, 2)), valid=np.zeros((n, 2), bool), track_id=-np.ones((n, 2), int),
            recovered=np.zeros((n, 2), bool))
    assert npz.read(spark, f"{tmp_path}/d.npz", "detection").filter("box is null and track_id = -1").count() == 2 * n
    archive(tmp_path / "r.npz", boxes=np.zeros((n, 4, 4)), confidence=np.zeros((n, 4)), count=np.array([0, 4, 1]))
    from motionweave.operators.detection import unpack_slots
    assert unpack_slots(npz.read(spark, f"{tmp_path}/r.npz", "raw_detections")).count() == 5


def test_archives_are_checked(spark, tmp_path):
    archive(tmp_path / "x.npz", valid=np.ones((1, 2), bool))
    with pytest.raises(Exception, match="lacks"):
        npz.read(spark, f"{tmp_path}/x.npz", "hand_window").collect()
    buf = io.BytesIO()
    np.savez(buf, joints_camera=np.array([{"a": 1}], dtype=object), valid=np.ones(1))
    (tmp_path / "y.npz").write_bytes(buf.getvalue())
    with pytest.raises(Exception, match="not a readable array archive"):
        npz.read(spark, f"{tmp_path}/y.npz", "hand_window").collect()


@pytest.mark.parametrize("text,message", [
    ('["a", "a"]', "not unique"), ('{"clips": [{"clip": "a", "num_frame": 3}]}', "unknown keys"),
    ('[{"video": "v"}]', "no clip name"), ('[{"clip": "a", "num_frames": 0}]', "must be positive"), ('[{"clip": "a", "from_stage": "x"}]', "from_stage")])
def test_bad_manifests(spark, tmp_path, text, message):
    (tmp_path / "m.json").write_text(text)
    with pytest.raises(Exception, match=message):
        files.read_manifest(spark, f"{tmp_path}/m.json").collect()


def test_tables_replace_only_their_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    files.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "clip int, v string"), path, "clip")
    files.write_table(spark.createDataFrame([(2, "c")], "clip int, v string"), path, "clip")
    assert sorted((r.clip, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c")]
    with pytest.raises(ValueError):
        files.write_table(spark.createDataFrame([], "clip int"), path)


def test_json_and_probe(spark, tmp_path):
    files.write_json(spark.createDataFrame([(2, None)], "b int, a string"), f"{tmp_path}/j")
    assert spark.read.text(f"{tmp_path}/j").first().value == '{"a":null,"b":2}'
    assert files.read_json(spark, f"{tmp_path}/j", "a string, b int").first().b == 2
    bad = spark.createDataFrame([(1, '{"streams":[{"avg_frame_rate":"0/0","width":1,"height":1}]}')], "clip int, text string")
    with pytest.raises(Exception, match="frame rate"):
        files.decode_probe(bad).collect()


def test_frames_from_files(spark, tmp_path):
    for i in (3, 1, 2):
        (tmp_path / f"{i:06d}.jpg").write_bytes(b"x" * i)
    listed = files.list_files(spark, f"{tmp_path}/*.jpg").withColumn("clip", F.lit(1))
    rows = files.frame_inventory(listed, spark.createDataFrame([(1, 2.0)], "clip int, fps double")).orderBy("frame").collect()
    assert [(r.frame, r.path[-10:], r.ts) for r in rows] == [(0, "000001.jpg", 0.0), (1, "000002.jpg", 0.5), (2, "000003.jpg", 1.0)]
    hashed = {r.path[-10:]: r.sha for r in lg.file_hashes(spark, f"{tmp_path}/*.jpg").collect()}
    import hashlib
    assert hashed["000002.jpg"] == hashlib.sha256(b"xx").hexdigest()


def test_ledger_roundtrip(spark, tmp_path):
    row = '{"stage":"hand","unit":"u","params_hash":"h","outputs":["o"],"status":"ok"}'
    rows = lg.decode_markers(spark.createDataFrame([("a", row), ("b", "{")], "clip string, text string"))
    lg.append(rows, f"{tmp_path}/l")
    back = spark.read.parquet(f"{tmp_path}/l")
    work = rows.select("clip", "stage", "unit", "params_hash")
    assert lg.pending(work, back, spark.createDataFrame([("a", "o")], "clip string, name string")).count() == 0
    assert lg.pending(work, back, spark.createDataFrame([("a", "x")], "clip string, name string")).count() == 1


def full_kinematics(m, betas, hp, root, wrist):
    """All vertices skinned with 4x4 matrices, for comparison."""
    shaped = m.template + m.shape_dirs[:, :, :len(betas)] @ betas
    rest = m.regressor @ shaped
    posed = shaped + (m.pose_dirs @ (hp - np.eye(3)).ravel() if m.pose_dirs is not None else 0)
    g = []
    for j, p in enumerate(handmodel.MODEL_PARENT):
        a = np.eye(4)
        a[:3, :3] = root if j == 0 else hp[j - 1]
        a[:3, 3] = rest[j] - (rest[p] if j else 0)
        g.append(a if j == 0 else g[p] @ a)
    pos = np.array([a[:3, 3] for a in g])
    for a, r in zip(g, rest):
        a[:3, 3] -= a[:3, :3] @ r
    verts = np.einsum("vj,jik,vk->vi", m.weights, np.array(g), np.column_stack([posed, np.ones(len(posed))]))[:, :3]
    out = [pos[0]]
    for name, js in handmodel.FINGER_JOINTS.items():
        out += [pos[j] for j in js] + [verts[handmodel.TIP_VERTEX[name]]]
    out = np.array(out)
    return out - out[0] + wrist


def test_kinematics_against_full_skinning():
    rng = np.random.default_rng(0)
    from motionweave.catalog.ingest import plain_model
    base = plain_model()
    w = rng.random((800, 16))
    m = handmodel.HandModel(base.template + rng.normal(size=(800, 3)) * 0.001, rng.normal(size=(800, 3, 10)) * 0.001, base.regressor,
                            w / w.sum(1, keepdims=True), rng.normal(size=(800, 3, 135)) * 0.001)
    rot = lambda: np.linalg.qr(rng.normal(size=(3, 3)))[0]
    hp = np.array([r * np.sign(np.linalg.det(r)) for r in (rot() for _ in range(15))])
    root = rot()
    root *= np.sign(np.linalg.det(root))
    betas, wrist = rng.normal(size=10), rng.normal(size=3)
    got = handmodel.landmarks_np(m, betas[None], hp[None], root[None], wrist[None])[0]
    np.testing.assert_allclose(got, full_kinematics(m, betas, hp, root, wrist), atol=1e-12)
    assert handmodel.check_mapping(base)
    swapped = base.template.copy()
    swapped[[744, 13]] = swapped[[13, 744]]
    assert not handmodel.check_mapping(handmodel.HandModel(swapped, base.shape_dirs, base.regressor, base.weights))


def test_trajectories_are_written_only_whole(spark, tmp_path):
    from motionweave.catalog import evaluation
    sf = "/root/testdata/sf0.001"
    traj = evaluation.prediction(spark, sf)
    even = traj.groupBy("clip").agg(F.count(F.lit(1)).alias("n")).filter("n % 2 = 0").select("clip")
    whole = traj.join(even, "clip", "left_semi")
    files.write_trajectory(whole, f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == whole.count()
    with pytest.raises(ValueError, match="breaks its contract"):
        files.write_trajectory(whole.filter("frame <> 3"), f"{tmp_path}/u")


def test_checked_sink_evaluates_once_and_publishes_whole(spark, tmp_path):
    from motionweave.sources.files import write_checked
    from pyspark.sql import functions as F
    path = str(tmp_path / "t")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(x):
        seen.add(1)
        return x

    rows = spark.createDataFrame([(c, i) for c in (1, 2) for i in range(5)], "clip int, x int").withColumn("x", counted("x"))
    late = lambda staged: staged.groupBy("clip").agg(F.count(F.lit(1)).alias("n")).where("n <> 5").select(
        F.lit("x").alias("field"), F.lit("not five").alias("problem"), F.col("n").alias("rows"))
    negative = {("x", "negative"): F.col("x") < 0}
    assert write_checked(rows, path, negative, late, "clip") == {} and seen.value == 10
    assert spark.read.parquet(path).count() == 10
    one = rows.where("clip = 1").withColumn("x", F.col("x") + 10)
    assert write_checked(one, path, negative, late, "clip") == {}
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("clip", "x").collect()) == [(1, 10 + i) for i in range(5)] + [(2, i) for i in range(5)]
    assert write_checked(one.withColumn("x", F.col("x") - 12), path, negative, late, "clip") == {("x", "negative"): 2}
    assert write_checked(one.where("x <> 11"), path, negative, late, "clip") == {("x", "not five"): 4}
    assert write_checked(one.where("x > 99"), path, negative, late, "clip") == {("table", "empty"): 0}
    assert spark.read.parquet(path).where("x < 0").count() == 0 and spark.read.parquet(path).count() == 10
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["clip=1", "clip=2"]
    whole = str(tmp_path / "w")
    for n in (3, 2):
        assert write_checked(spark.range(n).repartition(2), whole, {}) == {}
        assert spark.read.parquet(whole).count() == n


def test_digests_of_large_and_many_files(spark, tmp_path):
    import hashlib
    size = (2 << 30) + (64 << 20) + 7  # more than one binary cell can hold, without taking disk
    with (tmp_path / "large.bin").open("wb") as f:
        f.truncate(size)
        f.seek(1 << 30)
        f.write(b"inside")
    for i in range(40):
        (tmp_path / f"{i}.bin").write_bytes(b"x" * i)
    rows = {r.path.rsplit("/", 1)[1]: r for r in lg.file_hashes(spark, f"{tmp_path}/*.bin").collect()}
    assert len(rows) == 41 and all(rows[f"{i}.bin"].sha == hashlib.sha256(b"x" * i).hexdigest() for i in range(40))
    with (tmp_path / "large.bin").open("rb") as f:
        assert rows["large.bin"].sha == hashlib.file_digest(f, "sha256").hexdigest() and rows["large.bin"].size == size


def test_small_files_are_written_and_hashed_by_several_tasks(spark, tmp_path):
    from motionweave.catalog import ingest
    from motionweave.sources import digests

    spark.range(60).selectExpr("id as s_suppkey", "'name' as s_name").write.parquet(f"{tmp_path}/supplier.parquet")
    assert ingest.file_hashes(spark, str(tmp_path)).count() == 60
    newest = max(Path(spark.conf.get("spark.checkpoint.dir")).glob("motionweave-*/data/s_suppkey=0"), key=lambda p: p.stat().st_mtime).parent
    assert len({f.name[:10] for f in newest.rglob("part-*")}) > 1
    groups = digests.DigestReader({"path": f"{newest}/*/*.txt"}).partitions()
    assert sum(len(list(digests.DigestReader({"path": "-"}).read(g))) for g in groups) == len(groups) == 1


def test_landmarks_are_filled_in_place(spark):
    from motionweave.catalog.ingest import plain_model
    eye = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]
    kept = [(9.0, 9.0, 9.0)]
    rows = [(i, side, ok, [0.0] * 10, [eye] * 15, eye, (1.0 * i, 2.0, 3.0), kept, "other")
            for i, (side, ok) in enumerate([(1, True), (0, True), (1, False), (None, True), (1, None)])]
    df = spark.createDataFrame(rows, "id int, side int, valid boolean, betas array<double>, hand_pose array<array<double>>, root_rot array<double>, "
                               "wrist struct<x:double,y:double,z:double>, joints array<struct<x:double,y:double,z:double>>, more string")
    got = sorted(handmodel.add_landmarks(df, {1: plain_model()}).collect(), key=lambda r: r.id)
    assert [r.rest_ok for r in got] == [True, None, None, None, None] and [len(r.joints) for r in got] == [21, 1, 1, 1, 1]
    assert tuple(got[0].joints[0]) == (0.0, 2.0, 3.0) and all(r.more == "other" for r in got)
