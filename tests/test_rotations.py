"""Rotation columns against plain numpy."""

import numpy as np
from pyspark.sql import functions as F

from motionweave.functions import pose
from motionweave.operators import blend


def turn(axis, angle):
    axis = np.asarray(axis, float) / np.linalg.norm(axis)
    k = np.array([[0, -axis[2], axis[1]], [axis[2], 0, -axis[0]], [-axis[1], axis[0], 0]])
    return np.eye(3) + np.sin(angle) * k + (1 - np.cos(angle)) * k @ k


def between(a, b, w):
    """a turned by the share w of what leads from a to b."""
    d = a.T @ b
    angle = np.arccos(np.clip((np.trace(d) - 1) / 2, -1, 1))
    if angle < 1e-9:
        return a
    return a @ turn([d[2, 1] - d[1, 2], d[0, 2] - d[2, 0], d[1, 0] - d[0, 1]], w * angle)


def random_turns(n, seed):
    rng = np.random.default_rng(seed)
    return [turn(rng.normal(size=3), rng.uniform(0, 3.1)) for _ in range(n)]


def test_slerp(spark):
    a, b = random_turns(60, 1), random_turns(60, 2)
    b[:3] = [a[0], a[1] @ turn([0, 1, 0], 1e-8), a[2] @ turn([1, 0, 0], 1e-3)]
    w = np.linspace(0, 1, 60)
    rows = [(i, x.ravel().tolist(), y.ravel().tolist(), float(z)) for i, (x, y, z) in enumerate(zip(a, b, w))] + [(99, None, a[0].ravel().tolist(), 0.5)]
    df = spark.createDataFrame(rows, "i int, a array<double>, b array<double>, w double").withColumn("r", pose.slerp("a", "b", "w"))
    got = {r.i: r.r for r in df.collect()}
    assert got.pop(99) is None
    for i, r in got.items():
        np.testing.assert_allclose(np.reshape(r, (3, 3)), between(a[i], b[i], w[i]), atol=1e-7)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_fold_of_rotations(spark):
    turns = random_turns(9, 3)
    groups = [turns[:1], turns[1:3], turns[3:6], turns[6:9], []]
    alphas = [[1.0], [1.0, 0.25], [1.0, 0.5, 0.75], [1.0, 0.0, 0.5], []]
    df = spark.createDataFrame([(i, [(x.ravel().tolist(), w) for x, w in zip(g, ws)]) for i, (g, ws) in enumerate(zip(groups, alphas))],
                               "i int, c array<struct<root_rot:array<double>,alpha:double>>")
    got = {r.i: r.r for r in df.select("i", blend.fold_rotations(F.col("c"), "root_rot").alias("r")).collect()}
    assert got[4] is None
    for i, (g, ws) in enumerate(zip(groups[:4], alphas[:4])):
        want = g[0]
        for x, w in zip(g[1:], ws[1:]):
            want = between(want, x, w) if w > 0 else want
        np.testing.assert_allclose(np.reshape(got[i], (3, 3)), want, atol=1e-7)
