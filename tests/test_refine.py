"""Gap filling, bone lengths and wrist depth on small trajectories."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from motionweave.operators import refine, windows as w
from motionweave.schemas import BONES

K = [500.0, 0.0, 320.0, 0.0, 500.0, 240.0, 0.0, 0.0, 1.0]
SCHEMA = "clip int, frame int, side int, joints array<struct<x:double,y:double,z:double>>, valid boolean, conf double, k array<double>"


def table(spark, joints, valid, conf=None, clip=1):
    rows = []
    for f in range(joints.shape[0]):
        for s in range(joints.shape[1]):
            pts = None if not np.isfinite(joints[f, s]).all() else [tuple(map(float, p)) for p in joints[f, s]]
            rows.append((clip, f, s, pts, bool(valid[f, s]), 0.8 if conf is None else float(conf[f, s]), K))
    return spark.createDataFrame(rows, SCHEMA)


def back(df, col="joints"):
    return {(r.frame, r.side): None if r[col] is None else np.array([[p.x, p.y, p.z] for p in r[col]]) for r in df.collect()}


def scene(n=10, seed=7):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, 2, 21, 3)) * 0.1 + np.array([0.0, 0.0, 1.0]), np.ones((n, 2), dtype=bool)


@pytest.mark.parametrize("block", [4, 4096])
def test_short_gap_is_filled_on_the_line(spark, block):
    joints, valid = scene()
    valid[3:6, 1] = False
    got = refine.fill_gaps(table(spark, joints, valid), 12, block if block > 12 else 16).cache()
    pts = back(got)
    for f in (3, 4, 5):
        t = (f - 2) / 4
        np.testing.assert_allclose(pts[(f, 1)], (1 - t) * joints[2, 1] + t * joints[6, 1])
    marks = {(r.frame, r.side) for r in got.filter("interpolated").collect()}
    assert marks == {(3, 1), (4, 1), (5, 1)}
    rep = refine.gap_report(got).first()
    assert (rep.gaps_filled, rep.frames_filled, rep.frames_left_missing) == (1, 3, 0)


def test_long_and_open_gaps_stay_missing(spark):
    joints, valid = scene(20)
    valid[2:7, 0] = False
    valid[17:, 0] = False
    got = refine.fill_gaps(table(spark, joints, valid), 4, 8)
    assert got.filter("interpolated").count() == 0


def test_valid_but_broken_frame_is_no_anchor(spark):
    joints, valid = scene(6)
    joints[3, 0] = np.nan
    got = refine.fill_gaps(table(spark, joints, valid), 12)
    np.testing.assert_allclose(back(got)[(3, 0)], (joints[2, 0] + joints[4, 0]) / 2)


def test_smoothing_keeps_run_edges(spark):
    joints, valid = scene(9)
    valid[5, 0] = False
    pts = back(w.smooth_hands(table(spark, joints, valid), 1, block=3))
    np.testing.assert_allclose(pts[(2, 0)], joints[1, 0] / 4 + joints[2, 0] / 2 + joints[3, 0] / 4)
    for f in (0, 4, 6, 8):
        np.testing.assert_allclose(pts[(f, 0)], joints[f, 0])


def lengths(p):
    return np.array([np.linalg.norm(p[c] - p[q]) for q, c in BONES])


def test_bone_scale_pulls_towards_the_mean(spark):
    joints, valid = scene(12)
    pts = back(refine.scale_bones(table(spark, joints, valid), 0.035))
    ref = np.mean([lengths(joints[f, 0]) for f in range(12)], axis=0)
    for f in range(12):
        raw = lengths(joints[f, 0])
        np.testing.assert_allclose(lengths(pts[(f, 0)]), raw * np.clip(ref / raw, 0.965, 1.035))
        np.testing.assert_allclose(pts[(f, 0)][0], joints[f, 0, 0])


def test_zero_bone_keeps_its_child(spark):
    joints, valid = scene(4)
    joints[:, :, 6] = joints[:, :, 5]  # bone 5 -> 6 has no length in any frame
    pts = back(refine.scale_bones(table(spark, joints, valid), 0.035))
    np.testing.assert_allclose(pts[(1, 0)][6], joints[1, 0, 6])


def test_median_reference(spark):
    joints, valid = scene(7)
    got = {r.bone: r.ref for r in refine.bone_reference(table(spark, joints, valid), "median").filter("side = 0").collect()}
    np.testing.assert_allclose([got[b] for b in range(20)], np.median([lengths(joints[f, 0]) for f in range(7)], axis=0))


def dense_depth(wrist, weight, lam):
    n = len(wrist)
    rays = wrist / wrist[:, 2:3]
    a = np.zeros((3 * n, n))
    for axis in range(3):
        for t in range(n):
            row = a[axis * n + t]
            lo, hi = max(t - 1, 0), min(t + 1, n - 1)
            row[hi] += rays[hi, axis]
            row[lo] += rays[lo, axis]
            row[t] -= 2 * rays[t, axis]
    return np.linalg.solve(np.diag(weight) + lam * a.T @ a, weight * wrist[:, 2])


def weights(conf, valid):
    med = np.median(conf[valid])
    return np.clip(conf / med, 0.5, 1.5) ** 8


@pytest.mark.parametrize("block,n,holes", [(4096, 25, ()), (8, 40, ()), (8, 61, (7, 30, 31)), (8, 50, (15,)), (8, 50, (14,)), (8, 33, (6, 24))])
def test_wrist_depth_equals_dense_solve(spark, block, n, holes):
    rng = np.random.default_rng(n)
    joints, valid = scene(n, n)
    t = np.arange(n)
    joints[:, :, 0, 2] = (1.0 + 0.1 * np.sin(0.3 * t))[:, None] + rng.normal(size=(n, 2)) * 0.02
    conf = rng.uniform(0.4, 0.95, size=(n, 2))
    for h in holes:
        valid[h, 0] = False
    got = refine.smooth_wrist_depth(table(spark, joints, valid, conf), 0.2, block=block)
    rows = {(r.frame, r.side): r for r in got.collect()}
    w_all = weights(conf, valid)
    for side in (0, 1):
        edges = [-1, *[h for h in holes if side == 0], n]
        for a, b in zip(edges, edges[1:]):
            frames = np.arange(a + 1, b)
            if len(frames) < 2:
                assert all(rows[(f, side)].depth_after is None for f in frames)
                continue
            want = dense_depth(joints[frames, side, 0], w_all[frames, side], 0.2)
            np.testing.assert_allclose([rows[(f, side)].depth_after for f in frames], want, rtol=1e-9)
    r = rows[(3, 1)]
    p = np.array([[q.x, q.y, q.z] for q in r.joints])
    np.testing.assert_allclose(p - p[0], joints[3, 1] - joints[3, 1, 0])  # hand shape kept
    np.testing.assert_allclose(p[0, :2] / p[0, 2], joints[3, 1, 0, :2] / joints[3, 1, 0, 2])  # same pixel


def test_wrist_depth_change_is_bounded(spark):
    joints, valid = scene(15, 2)
    got = refine.smooth_wrist_depth(table(spark, joints, valid), 0.2, max_change=0.001)
    assert got.select(F.max(F.abs(F.col("depth_after") - F.col("depth_before")))).first()[0] <= 0.001 + 1e-12


def test_weights_without_confidence_are_one(spark):
    joints, valid = scene(3)
    got = refine.confidence_weights(table(spark, joints, valid, np.zeros((3, 2))))
    assert {r.weight for r in got.collect()} == {1.0}
