"""Block-split operators against plain loops, with blocks small enough to be crossed."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from motionweave.operators import blocks, windows as w

BLOCK = 4


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(3)
    return pd.DataFrame([(c, f, float(rng.normal()), bool(rng.random() < 0.35)) for c, n in ((1, 41), (2, 5), (3, 1)) for f in range(n)],
                        columns=["clip", "frame", "v", "ok"])


def test_bracket_looks_across_empty_blocks(spark, series):
    s = series.copy()
    s.loc[(s["clip"] == 1) & s.frame.between(6, 30), "ok"] = False
    got = blocks.bracket(spark.createDataFrame(s), ["clip"], F.col("ok"), F.struct("frame", "v"), block=BLOCK)
    got = got.select("clip", "frame", F.col("prev.frame").alias("p"), F.col("next.frame").alias("n"), F.col("next.v").alias("nv")).toPandas()
    for row in got.itertuples():
        anchors = s[(s["clip"] == row.clip) & s.ok]
        before, after = anchors[anchors.frame <= row.frame], anchors[anchors.frame >= row.frame]
        assert (None if pd.isna(row.p) else row.p) == (before.frame.max() if len(before) else None)
        assert (None if pd.isna(row.n) else row.n) == (after.frame.min() if len(after) else None)
        if len(after):
            assert row.nv == after.sort_values("frame").v.iloc[0]


def test_ranked_is_the_plain_rank(spark, series):
    df = spark.createDataFrame(series.sample(frac=1, random_state=1))
    got = blocks.ranked(df, ["clip"], ["frame"], F.floor(F.col("frame") / 3), "rk", counts=True).toPandas()
    assert (got.rk == got.frame).all()
    assert (got.rk_n == got["clip"].map(series.groupby("clip").size())).all()


@pytest.mark.parametrize("kind", ["normal", "ties", "outliers", "tiny"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(5)
    v = {"normal": rng.normal(size=3001), "ties": rng.integers(0, 3, 2000).astype(float),
         "outliers": np.concatenate([rng.normal(size=999), [1e12, -1e12]]), "tiny": np.array([3.0, 1.0])}[kind]
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "v": v}))
    # A coarse sketch makes the bracket do real work.
    got = blocks.exact_quantiles(df, ["k"], "v", {"a": 0.25, "b": 0.5, "c": 0.9, "d": 0.0, "e": 1.0}, accuracy=100).first()
    assert got.n == len(v)
    np.testing.assert_allclose([got.a, got.b, got.c, got.d, got.e], np.quantile(v, [0.25, 0.5, 0.9, 0, 1]))


def test_binomial_filter_across_blocks(spark, series):
    got = w.binomial_filter(spark.createDataFrame(series), ["v"], 3, block=BLOCK).toPandas().sort_values(["clip", "frame"])
    for clip, g in series.groupby("clip"):
        x = g.v.to_numpy()
        for _ in range(3):
            p = np.pad(x, 1, mode="edge")
            x = p[:-2] / 4 + p[1:-1] / 2 + p[2:] / 4
        np.testing.assert_allclose(got[got["clip"] == clip].v, x)


def test_runs_across_blocks(spark, series):
    s = series.copy()
    s.loc[(s["clip"] == 1) & s.frame.between(3, 22), "ok"] = True
    got = w.run_table(spark.createDataFrame(s), F.col("ok"), ["clip"], block=BLOCK).toPandas()
    want = []
    for clip, g in s.groupby("clip"):
        start = None
        for f, ok in [*zip(g.frame, g.ok), (g.frame.max() + 1, False)]:
            if ok and start is None:
                start = f
            if not ok and start is not None:
                want.append((clip, start, f))
                start = None
    assert sorted(zip(got["clip"], got.start, got.stop)) == sorted(want)


def test_filter_translation_keeps_invalid_frames_out(spark):
    rows = [(1, f, f != 9, (float(f) if f != 9 else 500.0, 0.0, 1.0)) for f in range(20)]
    df = spark.createDataFrame(rows, "clip int, frame int, valid boolean, trans struct<x:double,y:double,z:double>")
    got = {r.frame: r.trans.x for r in w.filter_translation(df, block=BLOCK).collect()}
    assert got[9] == 500.0
    np.testing.assert_allclose([got[f] for f in range(1, 19) if f != 9], [f for f in range(1, 19) if f != 9])
    assert got[0] == pytest.approx(0.25) and got[19] == pytest.approx(18.75)


def test_filter_translation_without_valid_frames_changes_nothing(spark):
    df = spark.createDataFrame([(1, f, False, (float(f * f), 0.0, 0.0)) for f in range(6)],
                               "clip int, frame int, valid boolean, trans struct<x:double,y:double,z:double>")
    assert {r.frame: r.trans.x for r in w.filter_translation(df).collect()} == {f: float(f * f) for f in range(6)}


def test_no_ordered_partition_is_a_whole_clip(spark):
    """Every ordered window over frames carries the block in its partition."""
    df = spark.range(100).select((F.col("id") * 0).alias("clip"), F.col("id").cast("int").alias("frame"), F.col("id").cast("double").alias("v"))
    plan = w.binomial_filter(df, ["v"])._jdf.queryExecution().optimizedPlan().toString()
    specs = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert specs and all("_block" in line or "_bucket" in line for line in specs)


def test_frame_rate_snaps(spark):
    rows = [(1, i, 10 ** 9 + i * 33_333_333 + (i % 3) * 1000) for i in range(30)] + [(2, i, i * 70_000_000) for i in range(9)]
    got = {r.clip: r.fps for r in w.fps_from_timestamps(spark.createDataFrame(rows, "clip int, frame int, ts_ns long")).collect()}
    assert got[1] == 30.0
    assert got[2] == pytest.approx(1e9 / 7e7)


SPARSE = [0, 2, 3, 5, 6, 8, 21, 22, 23, 40]


def _answers(df, keys=("clip", "frame")):
    return sorted(map(str, df.orderBy(*keys).collect()))


@pytest.mark.parametrize("frames", [SPARSE, list(range(14))])
def test_blocks_do_not_change_ordered_operators(spark, frames):
    from pyspark.sql import functions as F

    from motionweave.functions import vec as v
    from motionweave.operators import windows as w

    rows = [(c, f, float(f * f % 17 + c), f * 1_000_000 * (c + 1), f % 3 != 1) for c in (1, 2) for f in frames]
    df = spark.createDataFrame(rows, "clip int, frame int, v double, ts_ns long, valid boolean").withColumn(
        "trans", v.vec(F.col("v"), F.col("v") * 2, F.lit(0.0)))
    for run in (lambda b: w.binomial_filter(df, ["v"], 2, block=b).select("clip", "frame", "v"),
                lambda b: w.filter_translation(df, passes=2, block=b).select("clip", "frame", "trans"),
                lambda b: w.displacement(df, block=b).select("clip", "frame", "step"),
                lambda b: w.runs(df, F.col("valid"), ("clip",), b).select("clip", "frame", "run_start", "run_end")):
        assert _answers(run(4)) == _answers(run(4096))
    assert _answers(w.fps_from_timestamps(df, block=4), ("clip",)) == _answers(w.fps_from_timestamps(df, block=4096), ("clip",))
    steps = {(r["clip"], r["frame"]): r["step"] for r in w.displacement(df, block=4).collect()}
    for c in (1, 2):
        for a, b in zip(frames, frames[1:]):
            assert abs(steps[c, b] - 5 ** 0.5 * abs(b * b % 17 - a * a % 17)) < 1e-9
        assert steps[c, frames[0]] is None


def test_names_of_any_length_are_ranked(spark):
    from motionweave.sources import files

    names = sorted(f"f_{i}.jpg" for i in range(1300))
    paths = spark.createDataFrame([("a", f"/x/{n}") for n in reversed(names)] + [("b", "/y/q.jpg")], "clip string, path string")
    fps = spark.createDataFrame([("a", 10.0), ("b", 10.0)], "clip string, fps double")
    got = files.frame_inventory(paths, fps).where("clip = 'a'").orderBy("frame").collect()
    assert [r["path"] for r in got] == [f"/x/{n}" for n in names]
    for whole in (0, 500):  # in buckets
        rows = files.frame_inventory(paths, fps, whole=whole).where("clip = 'a'").orderBy("frame").collect()
        assert rows == got
    # The paths are shuffled once, without the names taken from them.
    plan = files.frame_inventory(paths, fps)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan[:plan.index("Initial Plan") if "Initial Plan" in plan else None].splitlines() if "Exchange hashpartitioning" in line]
    assert len([line for line in moved if "_bucket" in line]) == 3 and "Exchange hashpartitioning(clip#" in plan


def test_triples_never_repeat_a_point():
    for m in range(3, 40):
        for hyp in range(128):
            a, turn = hyp * 3 % m, hyp * 3 // m
            second, third = 1 + turn % (m - 1), 1 + turn % (m - 2)
            third += third >= second
            assert len({a, (a + second) % m, (a + third) % m}) == 3
