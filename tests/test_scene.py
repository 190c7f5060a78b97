"""Alignment, stitching and scoring on scenes with a known answer."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionweave.functions import pose
from motionweave.operators import blend, evaluate as ev, schedule as sc, similarity as sim, stitch as st
from motionweave.session import cut_lineage

XYZ = "struct<x:double,y:double,z:double>"


def turn(deg):
    x, y, z = np.radians(deg)
    rx = np.array([[1, 0, 0], [0, np.cos(x), -np.sin(x)], [0, np.sin(x), np.cos(x)]])
    ry = np.array([[np.cos(y), 0, np.sin(y)], [0, 1, 0], [-np.sin(y), 0, np.cos(y)]])
    rz = np.array([[np.cos(z), -np.sin(z), 0], [np.sin(z), np.cos(z), 0], [0, 0, 1]])
    return rz @ ry @ rx


S, R, T = 1.35, turn((12, -7, 25)), np.array([0.4, -0.25, 1.1])


def pairs(spark, n=400, outliers=0.0, far=0.0, seed=1, wins=(1,)):
    rng = np.random.default_rng(seed)
    rows = []
    for w in wins:
        src = rng.uniform(-1, 1, size=(n, 3)) + far
        dst = S * src @ R.T + T
        bad = rng.random(n) < outliers
        dst[bad] += rng.uniform(0.3, 2, size=(bad.sum(), 3))
        rows += [(1, w, i // 20, i % 20, 0, tuple(map(float, a)), tuple(map(float, b)), 1.0) for i, (a, b) in enumerate(zip(src, dst))]
    return spark.createDataFrame(rows, f"clip int, win int, frame int, row int, col int, src {XYZ}, dst {XYZ}, weight double")


def check(f, tol=1e-9):
    assert f.scale == pytest.approx(S, rel=tol)
    np.testing.assert_allclose(np.array(f.rot).reshape(3, 3), R, atol=tol)
    np.testing.assert_allclose([f.trans.x, f.trans.y, f.trans.z], T, atol=max(tol, 1e-9) * 1e3)


def test_clean_fit(spark):
    check(sim.fit(sim.with_origin(pairs(spark))).first().fit)


def test_fit_far_from_the_origin_keeps_its_digits(spark):
    check(sim.fit(sim.with_origin(pairs(spark, far=1e4))).first().fit, 1e-7)


def test_degenerate_cloud_gives_no_fit(spark):
    one = pairs(spark, 50).withColumn("src", F.lit(None).cast(XYZ)).withColumn("src", F.struct(*[F.lit(1.0).alias(a) for a in "xyz"]))
    assert sim.fit(one).first().fit is None
    assert sim.fit(pairs(spark, 2)).first().fit is None


def test_fit_without_scale(spark):
    assert sim.fit(pairs(spark), with_scale=False).first().fit.scale == 1.0


@pytest.mark.parametrize("outliers", [0.0, 0.35])
def test_robust_fit(spark, outliers):
    # Outliers as small as 0.3 can hide under a threshold taken from the residuals.
    r = sim.robust_fit(pairs(spark, 600, outliers), inlier_threshold=0.05 if outliers else None).first()
    check(r.fit, 1e-8)
    assert r.inlier_ratio == pytest.approx(1 - outliers, abs=0.06)
    assert r.rmse < 1e-9


def test_too_few_points_are_rejected(spark):
    assert sim.robust_fit(pairs(spark, 8)).first().fit is None


def test_robust_fit_with_given_threshold_and_many_pairs(spark):
    rows = sim.robust_fit(pairs(spark, 300, 0.2, wins=(1, 2, 3)), inlier_threshold=0.01).collect()
    assert len(rows) == 3
    for r in rows:
        check(r.fit, 1e-8)


def test_hypotheses_do_not_take_the_drawn_points_along(spark):
    """One row per hypothesis with all drawn points of its pair would wait in Python's queue, on disk when there are many."""
    rows = sim.hypotheses(sim.with_origin(pairs(spark, 300, wins=(1, 2))), 20)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan
    got = rows.collect()
    assert sorted((r.win, r.hyp) for r in got) == [(w, h) for w in (1, 2) for h in range(20)]
    for r in got:
        check(r.fit, 1e-6)


def test_robust_fit_writes_the_points_once_and_bare(spark, monkeypatch):
    """No origin and no count per point; everything else that is written has at most a row per pair."""
    written = []

    def cut(df):
        written.append((df.columns, df.count()))
        return cut_lineage(df)

    monkeypatch.setattr(sim, "cut_lineage", cut)
    p = pairs(spark, 300, 0.2, wins=(1, 2, 3))
    nobody = p.limit(1).withColumn("clip", F.lit(None).cast("int"))
    assert len(sim.robust_fit(p.unionByName(nobody)).collect()) == 3
    assert written[0] == (["clip", "win", "frame", "row", "col", "src", "dst", "weight"], 900)
    assert all(n <= 3 for _, n in written[1:])


def recorded(module, monkeypatch):
    """(columns, optimized plan) of everything that the module writes."""
    written = []

    def cut(df):
        written.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return cut_lineage(df)

    monkeypatch.setattr(module, "cut_lineage", cut)
    return written


def test_best_hypothesis_is_written_before_the_lists_are_read_again(spark, monkeypatch):
    """Otherwise all hypotheses of all pairs are shuffled for a join with one number a pair."""
    written = recorded(sim, monkeypatch)
    check(sim.robust_fit(pairs(spark, 300, 0.2), inlier_threshold=0.05).first().fit, 1e-6)
    best = [plan for columns, plan in written if columns == ["clip", "win", "best"]]
    assert len(best) == 1 and "hyps" in best[0]
    assert not any("hyps" in plan and "score" in plan for columns, plan in written if columns == ["clip", "win", "fit"])


def test_stitch_merges_poses_without_the_points(spark, monkeypatch):
    """The fits are written, a row per pair; the plan that chains and merges no longer holds points or their shuffle files."""
    rng = np.random.default_rng(4)
    depth = rng.uniform(1, 2, size=(6, 4, 4))
    held = [(w, f) for w in (0, 1) for f in range(2 * w, 2 * w + 4)]
    samples = spark.createDataFrame([(1, w, f, r, c, float(depth[f, r, c])) for w, f in held for r in range(4) for c in range(4)],
                                    "clip int, win int, frame int, row int, col int, depth double")
    eye, k = [1.0, 0, 0, 0, 1.0, 0, 0, 0, 1.0], [3.0, 0, 1.5, 0, 3.0, 1.5, 0, 0, 1.0]
    rows = [(1, w, 2 * w, 2 * w + 4, f, [float(x) for x in eye], (0.1 * f, 0.0, 0.0), [float(x) for x in k]) for w, f in held]
    cams = spark.createDataFrame(rows, f"clip int, win int, start int, end int, frame int, rot array<double>, trans {XYZ}, k array<double>")
    written = recorded(st, monkeypatch)
    settled = []
    monkeypatch.setattr(st, "settle", lambda spark: settled.append(len(written)))
    got = st.stitch(samples, cams, cams.select("clip", "win", "start", "end").distinct(), 4, 2, stride=1).orderBy("frame").collect()
    assert [columns for columns, _ in written] == [["clip", "win", "fit"], ["clip", "frame", "rot", "trans", "k", "weight", "valid"]]
    assert "inliers" in written[0][1] and "inliers" not in written[1][1]
    assert settled == [1, 2]
    np.testing.assert_allclose([r.trans.x for r in got], 0.1 * np.arange(6), atol=1e-9)
    assert [r.weight for r in got] == [1, 1, 2, 2, 1, 1]


def test_chain_across_blocks(spark):
    n = 11
    f = pose.sim3(F.lit(S), F.array(*[F.lit(float(e)) for e in R.ravel()]), F.struct(*[F.lit(float(t)).alias(a) for t, a in zip(T, "xyz")]))
    win = spark.range(n).select(F.lit(1).alias("clip"), F.col("id").cast("int").alias("win"))
    got = {r.win: r.sim3 for r in st.chain(win.filter("win > 0").withColumn("fit", f), win, block=3).collect()}
    m, step = np.eye(4), np.eye(4)
    step[:3, :3], step[:3, 3] = S * R, T
    for w in range(n):
        g = got[w]
        np.testing.assert_allclose(g.scale * np.array(g.rot).reshape(3, 3), m[:3, :3], rtol=1e-9, atol=1e-9)
        np.testing.assert_allclose([g.trans.x, g.trans.y, g.trans.z], m[:3, 3], rtol=1e-9, atol=1e-9)
        m = m @ step


def test_chain_refuses_a_lost_window(spark):
    win = spark.createDataFrame([(1, 0), (1, 1)], "clip int, win int")
    none = win.filter("win > 5").withColumn("fit", F.lit(None).cast(sim.FIT))
    with pytest.raises(Exception, match="cannot be aligned"):
        st.chain(none, win).collect()


def test_three_windows_fold_in_order(spark):
    """Windows of 6 with stride 2: up to three meet in a frame."""
    clips = spark.createDataFrame([(1, 10)], "clip int, num_frames int")
    rows = sc.to_frames(sc.windows(clips, 6, 4)).withColumn("side", F.lit(0)).withColumn("valid", F.lit(True)).withColumn("conf", F.lit(0.5))
    rows = rows.withColumn("joints", F.array_repeat(F.struct(*[F.col("win").cast("double").alias(a) for a in "xyz"]), 21))
    got = {r.frame: (r.joints[0].x, r.weight) for r in blend.blend_hands(rows).collect()}
    for f in range(10):
        value, n = None, 0
        for w in range(3):
            if 2 * w <= f < 2 * w + 6:
                a = (f - 2 * w) / 3 if w and f < 2 * w + 4 else 1.0
                value = float(w) if value is None else value if a <= 0 else (1 - a) * value + a * w
                n += 1
        assert got[f] == (pytest.approx(value), n)


def trajectory(spark, n=40, shift=(0.0, 0.0, 0.0), gauge=None, seed=3, drop=()):
    rng = np.random.default_rng(seed)
    joints = rng.normal(size=(n, 2, 21, 3)) * 0.1 + np.array([0, 0, 1.0]) + np.array(shift)
    rows = []
    for f in range(n):
        r, t = turn((0, 3 * f, 0)), np.array([0.01 * f, 0, 0])
        pts = joints[f]
        if gauge is not None:
            r, t, pts = gauge[0] @ r, gauge[0] @ t + gauge[1], pts @ gauge[0].T + gauge[1]
        for s in range(2):
            rows.append((1, f, s, [tuple(map(float, p)) for p in pts[s]], (f, s) not in drop, [float(e) for e in r.ravel()], tuple(map(float, t))))
    return spark.createDataFrame(rows, f"clip int, frame int, side int, joints_world array<{XYZ}>, valid boolean, rot array<double>, trans {XYZ}")


def test_same_trajectory_scores_zero(spark):
    t = trajectory(spark)
    r = ev.report(t, t, 10.0).first()
    assert r.action_mpjpe_mm == pytest.approx(0, abs=1e-9) and r.num_chunks == 31 and r.coverage == 1.0 and r.camera_error_mm == 0


@pytest.mark.parametrize("block", [16, 4096])
def test_rigid_gauge_changes_nothing(spark, block):
    r = ev.report(trajectory(spark), trajectory(spark, gauge=(turn((20, 40, 5)), np.array([1.0, 2, 3]))), 10.0, block=block).first()
    assert r.action_mpjpe_mm == pytest.approx(0, abs=1e-9)
    assert r.num_terms == 31 * 10 * 2 * 21


def test_offset_is_the_error(spark):
    r = ev.report(trajectory(spark), trajectory(spark, shift=(0, 0.03, 0.04)), 10.0, block=16).first()
    assert r.action_mpjpe_mm == pytest.approx(50) and r.wrist_mm == pytest.approx(50) and r.world_z_error_mm == pytest.approx(40)


def test_missing_frames_leave_the_mean_but_count_in_coverage(spark):
    drop = {(f, 1) for f in range(10, 14)}
    r = ev.report(trajectory(spark, drop=drop), trajectory(spark, shift=(0, 0.03, 0.04)), 10.0).first()
    assert r.action_mpjpe_mm == pytest.approx(50) and r.coverage == pytest.approx(1 - 4 / 80)


def test_unequal_lengths_and_long_chunks_are_errors(spark):
    with pytest.raises(Exception, match="frame counts differ"):
        ev.terms(trajectory(spark, 20), trajectory(spark, 19), 5).collect()
    with pytest.raises(Exception, match="chunk is longer"):
        ev.terms(trajectory(spark, 5), trajectory(spark, 5), 6).collect()
    with pytest.raises(ValueError):
        ev.load(trajectory(spark, 3))
