"""The archive data source: round trips of every kind, ranges of frames, pushed options, and writes that fail."""

import hashlib
import io
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionweave.sources import npz

N = 6
ROT = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]


def point(i):
    return (float(i), float(i) / 2, -float(i))


def rows_of(kind):
    """Two archives of a kind with a hole in most optional values."""
    columns = npz.KINDS[kind].columns()
    spec = npz.KINDS[kind]
    out = []
    for a, path in enumerate(("c1/x/one.npz", "c2/x/two.npz")):
        start = 10 * a if spec.window else 0
        for i in range(N + a):
            for side in (0, 1) if spec.sided else (0,):
                ok = (i + side) % 3 != 1
                value = {
                    "path": path, "start": start, "end": start + N + a, spec.index: start + i, "side": side, "valid": ok, "rot": [x + i for x in ROT],
                    "trans": point(i), "k": None if i == 2 else ROT, "conf": 0.5 + i, "joints": [point(i + j) if j != 4 else None for j in range(21)] if ok else None,
                    "root_rot": ROT if i != 3 else None, "betas": [float(side)] * 10, "vertices": [point(i + j) for j in range(7)] if ok else None,
                    "depth": [[1.0 + i, None, 3.0]] * 2, "depth_conf": [[0.5, 0.25, None]] * 2, "pose_conf": None if i == 1 else 0.5,
                    "weight": float(i), "scale": 2.0 + i, "box": None if i == 1 else (0.0, 1.0, 2.0, 3.0 + i), "track_id": i - 1, "recovered": not ok,
                    "boxes": [(0.0, 1.0, 2.0, 3.0 + i), None, (1.0, 1.0, 2.0, 2.0)], "confs": [0.1, 0.2, 0.3], "right_scores": [1.0, 2.0, 3.0],
                    "left_scores": None if i == 0 else [1.0, 2.0, 3.0], "count": 2, "ts": i / 30, "interpolated": ok, "postprocess_valid": not ok,
                    "joints_world": [point(i + j) for j in range(21)] if ok else None, "joints_camera": [point(i - j) for j in range(21)] if ok else None,
                    "hand_pose": [ROT] * 15}
                out.append(tuple(value[c] for c in columns))
    return out, ", ".join(f"`{c}` {t}" for c, t in columns.items())


def plain(rows, columns):
    return sorted(tuple(repr(r[c].asDict() if hasattr(r[c], "asDict") else r[c]) for c in columns if c != "path") + (r["path"][-7:],) for r in rows)


@pytest.mark.parametrize("kind", [k for k in npz.KINDS if k != "depth_samples"])
def test_round_trip(spark, tmp_path, kind):
    rows, schema = rows_of(kind)
    df = spark.createDataFrame(rows, schema).withColumn("extra", F.lit(1)).orderBy(F.rand(3))
    npz.write(df, f"{tmp_path}/store", kind)
    columns = list(npz.KINDS[kind].columns())
    want = plain(df.collect(), columns)
    for options in ({}, {"task_bytes": 300}):
        back = npz.read(spark, f"{tmp_path}/store", kind, columns, **options)
        assert plain(back.collect(), columns) == want
    files = sorted(Path(tmp_path, "store").rglob("*.npz"))
    assert [str(f)[-12:] for f in files] == ["c1/x/one.npz", "c2/x/two.npz"] and not list(Path(tmp_path, "store", npz.STAGING).iterdir())
    before = [hashlib.sha256(f.read_bytes()).hexdigest() for f in files]
    npz.write(df.repartition(3), f"{tmp_path}/store", kind)
    assert [hashlib.sha256(f.read_bytes()).hexdigest() for f in files] == before
    with np.load(files[0], allow_pickle=False) as z:
        assert set(npz.KINDS[kind].required) <= set(z.files)


def test_frames_that_are_absent(spark, tmp_path):
    rows, schema = rows_of("hand_window")
    kept = [r for r in rows if r[3] % 10 not in (0, 3, 5) or r[4] == 1]
    npz.write(spark.createDataFrame(kept, schema), f"{tmp_path}/s", "hand_window")
    back = {(r.path[-7:], r.frame, r.side): r for r in npz.read(spark, f"{tmp_path}/s", "hand_window").collect()}
    assert len(back) == len(rows)
    assert not back["one.npz", 3, 0].valid and back["one.npz", 3, 0].betas is None and back["one.npz", 3, 1].betas == [1.0] * 10
    trajectory, schema = rows_of("trajectory")
    npz.write(spark.createDataFrame([r for r in trajectory if r[1] != 2], schema), f"{tmp_path}/t", "trajectory")
    back = npz.read(spark, f"{tmp_path}/t", "trajectory")
    assert back.filter("frame = 2 and rot is null and not valid").count() == 4 and back.count() == len(trajectory)


def save(path, **arrays):
    path.parent.mkdir(parents=True, exist_ok=True)
    np.savez(path, **arrays)


def test_only_required_arrays(spark, tmp_path):
    save(tmp_path / "t.npz", hand_xyz_world=np.zeros((3, 2, 21, 3)), hand_valid=np.ones((3, 2), bool), camera_R_c2w=np.stack([np.eye(3)] * 3),
         camera_t_c2w=np.ones((3, 3)))
    rows = npz.read(spark, f"{tmp_path}/t.npz", "trajectory").collect()
    assert len(rows) == 6 and {r.frame for r in rows} == {0, 1, 2}
    assert all(len(r.joints_world) == 21 and r.ts is None and r.box is None and r.interpolated is False for r in rows)


def test_pushed_options_and_parts(spark, tmp_path):
    depth = np.arange(10 * 4 * 6, dtype=np.float32).reshape(10, 4, 6)
    depth[3, 0, 0] = np.nan
    arrays = dict(rotation_c2w=np.stack([np.eye(3)] * 10), translation_c2w=np.zeros((10, 3)), intrinsics=np.stack([np.eye(3)] * 10), depth=depth, start=20)
    save(tmp_path / "a/w.npz", **arrays)
    buf = io.BytesIO()
    np.savez_compressed(buf, **arrays)
    (tmp_path / "b").mkdir()
    (tmp_path / "b/w.npz").write_bytes(buf.getvalue())
    for folder in "ab":
        whole = npz.read(spark, f"{tmp_path}/{folder}/*.npz", "depth_samples", task_bytes=500)
        assert whole.rdd.getNumPartitions() > 1
        rows = {(r.frame - 20, r.row, r.col): r.depth for r in whole.collect()}
        assert rows == {(i, r, c): float(depth[i, r, c]) for i, r, c in np.ndindex(10, 4, 6) if np.isfinite(depth[i, r, c])}
        some = npz.read(spark, f"{tmp_path}/{folder}", "depth_samples", ["frame", "row", "col", "depth"], stride=3, pixels=2, task_bytes=500)
        assert {(r.frame - 20, r.row, r.col): r.depth for r in some.collect()} == {
            k: x for k, x in rows.items() if k[0] % 3 == 0 and k[1] % 2 == 0 and k[2] % 2 == 0}
    save(tmp_path / "h.npz", joints_camera=np.zeros((4, 2, 21, 3)), valid=np.ones((4, 2), bool), vertices_camera=np.ones((4, 2, 778, 3), np.float32))
    one = npz.read(spark, f"{tmp_path}/h.npz", "hand_window", ["frame", "side", "vertices"], side=1).collect()
    assert [(r.frame, r.side, len(r.vertices)) for r in one] == [(i, 1, 778) for i in range(4)]
    assert "vertices" not in npz.read(spark, f"{tmp_path}/h.npz", "hand_window").columns


def test_failed_writes_leave_nothing(spark, tmp_path):
    rows, schema = rows_of("hand_window")
    df = spark.createDataFrame(rows, schema)
    broken = df.withColumn("conf", F.when((F.col("path") == "c2/x/two.npz") & (F.col("frame") > 12), F.raise_error(F.lit("lost"))).otherwise(F.col("conf")))
    with pytest.raises(Exception, match="lost"):
        npz.write(broken, f"{tmp_path}/s", "hand_window")
    assert not list(Path(tmp_path).rglob("*.npz"))
    with pytest.raises(Exception, match="unique"):
        npz.write(df.unionByName(df), f"{tmp_path}/s", "hand_window")
    with pytest.raises(Exception, match="lacks"):
        npz.write(df.drop("joints"), f"{tmp_path}/s", "hand_window")
    assert not list(Path(tmp_path).rglob("*.npz"))
    npz.write(df, f"{tmp_path}/s", "hand_window")
    assert len(list(Path(tmp_path).rglob("*.npz"))) == 2


def test_tasks_stage_nothing_after_an_abort(spark, tmp_path):
    rows, schema = rows_of("hand_window")
    df = spark.createDataFrame(rows, schema)
    one, two = [df.where(F.col("path") == p).sort("frame", "side").toArrow().combine_chunks().to_batches() for p in ("c1/x/one.npz", "c2/x/two.npz")]

    def aborted_between(writer):
        yield from one
        yield from two[:1]
        writer.abort([])

    for batches in (aborted_between, lambda w: w.abort([]) or iter(two)):
        writer = npz.ArchiveWriter({"kind": "hand_window", "path": f"{tmp_path}/s"}, df.columns)
        with pytest.raises(OSError):
            writer.write(batches(writer))
        assert not list(Path(tmp_path, "s", npz.STAGING).iterdir())


def test_bytes_from_another_store(spark, tmp_path):
    rows, schema = rows_of("detection")
    npz.write(spark.createDataFrame(rows, schema), f"{tmp_path}/s", "detection")
    columns = list(npz.KINDS["detection"].columns())
    loaded = npz.unpack(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{tmp_path}/s"), "detection")
    assert plain(loaded.collect(), columns) == plain(npz.read(spark, f"{tmp_path}/s", "detection").collect(), columns)


def test_small_ranges_share_a_task(spark, tmp_path):
    rows, schema = rows_of("hand_window")
    npz.write(spark.createDataFrame(rows, schema), f"{tmp_path}/store", "hand_window")
    options = {"kind": "hand_window", "path": f"{tmp_path}/store"}
    assert [len(p.ranges) for p in npz.ArchiveReader(options, ["path"]).partitions()] == [2]
    parts = npz.ArchiveReader(options | {"task_bytes": "100"}, ["path"]).partitions()
    ranges = [r for p in parts for r in p.ranges]
    assert 20 < len(parts) == max(n for _, _, n in ranges) < len(ranges)
    for path, _, n in ranges:
        assert sorted(i for p, i, _ in ranges if p == path) == list(range(n))
