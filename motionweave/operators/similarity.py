"""Similarity fits from distributed moments, and the robust fit per window pair.

Only weighted sums cross the shuffle; they combine map-side, so a pair may hold any
number of points. The 3x3 decomposition sees one row per pair.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import pose, vec as v
from ..session import cut_lineage, settle
from .blocks import exact_quantiles

PAIR = ("clip", "win")
MIN_VARIANCE = 1e-12
PIECE = 65_536  # points scored together
FIT = "struct<scale:double,rot:array<double>,trans:struct<x:double,y:double,z:double>>"


def moment_terms(src: Column, dst: Column, w: Column) -> list[Column]:
    """Terms whose sums determine a weighted fit: 1, n>0, s, d, d s^T, |s|^2."""
    s, d = v.xyz(src), v.xyz(dst)
    terms = [w, F.when(w > 0, F.lit(1.0)).otherwise(0.0)]
    terms += [w * c for c in s] + [w * c for c in d]
    terms += [w * d[i] * s[j] for i in range(3) for j in range(3)]
    return terms + [w * v.dot(src, src)]


def _fit_np(m: np.ndarray, with_scale: bool) -> tuple[np.ndarray, np.ndarray]:
    """[N, 18] moments -> [N, 13] (scale, rotation, translation) and a usable mask."""
    w = np.where(m[:, 0] > 0, m[:, 0], 1.0)[:, None]
    ms, md = m[:, 2:5] / w, m[:, 5:8] / w
    cov = m[:, 8:17].reshape(-1, 3, 3) / w[:, :, None] - md[:, :, None] * ms[:, None, :]
    var = m[:, 17] / w[:, 0] - np.einsum("ni,ni->n", ms, ms)
    ok = (m[:, 0] > 0) & (m[:, 1] >= 3) & (var > MIN_VARIANCE) & np.isfinite(cov).all(axis=(1, 2))
    cov = np.where(ok[:, None, None], cov, np.eye(3))
    u, sv, vt = np.linalg.svd(cov)
    sign = np.ones_like(sv)
    sign[:, 2] = np.where(np.linalg.det(u) * np.linalg.det(vt) < 0, -1.0, 1.0)
    rot = np.einsum("nij,nj,njk->nik", u, sign, vt)
    scale = (sv * sign).sum(axis=1) / np.where(ok, var, 1.0) if with_scale else np.ones(len(m))
    ok &= np.isfinite(scale) & (scale > 0)
    trans = md - scale[:, None] * np.einsum("nij,nj->ni", rot, ms)
    return np.column_stack([scale, rot.reshape(-1, 9), trans]), ok


def _fitter(with_scale: bool):
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solve(moments: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(moments), index=moments.index, dtype=object)
        some = moments.notna()
        if some.any():
            fit, ok = _fit_np(np.stack(moments[some].to_numpy()).astype(float), with_scale)
            out[some] = pd.Series([f if good else None for f, good in zip(fit, ok)], index=out.index[some], dtype=object)
        return out

    return solve


def fit_struct(arr: Column) -> Column:
    return F.when(arr.isNotNull(), pose.sim3(arr[0], F.slice(arr, 2, 9), v.vec(arr[10], arr[11], arr[12])))


def fit(points: DataFrame, keys=PAIR, with_scale: bool = True, mask: Column | None = None) -> DataFrame:
    """Least-squares similarity src -> dst per key; ``fit`` is NULL when degenerate.

    Sums are taken around the column ``origin`` (struct src, dst) when there is one, to
    keep digits far from the origin.
    """
    src, dst = F.col("src"), F.col("dst")
    if "origin" in points.columns:
        src, dst = v.sub(src, F.col("origin")["src"]), v.sub(dst, F.col("origin")["dst"])
    rows = points if mask is None else points.filter(mask)
    sums = [F.sum(t).alias(f"_m{i}") for i, t in enumerate(moment_terms(src, dst, F.col("weight")))]
    carry = [F.first("origin").alias("origin")] if "origin" in points.columns else []
    m = rows.groupBy(*keys).agg(*sums, *carry)
    m = m.withColumn("_fit", _fitter(with_scale)(F.array(*[F.col(f"_m{i}") for i in range(len(sums))])))
    f = fit_struct(F.col("_fit"))
    if carry:
        m = m.withColumn("_f", f)
        o, g = F.col("origin"), F.col("_f")
        trans = v.add(v.sub(o["dst"], v.scale(v.mul_vec(g["rot"], o["src"]), g["scale"])), g["trans"])
        f = F.when(g.isNotNull(), pose.sim3(g["scale"], g["rot"], trans))
    return m.select(*keys, f.alias("fit"))


def origins(points: DataFrame, keys=PAIR, order=("frame", "row", "col")) -> DataFrame:
    """One fixed point pair per key and the number of points."""
    return points.groupBy(*keys).agg(
        F.min_by(F.struct("src", "dst"), F.struct(*order)).alias("origin"), F.count(F.lit(1)).alias("n"))


def with_origin(points: DataFrame, keys=PAIR, order=("frame", "row", "col")) -> DataFrame:
    """Attach one fixed point pair per key and the number of points."""
    return points.join(origins(points, keys, order), list(keys))


def residual(f: Column) -> Column:
    return v.distance(pose.sim3_apply(f, F.col("src")), F.col("dst"))


def residuals(points: DataFrame, fits: DataFrame, keys=PAIR) -> DataFrame:
    return points.join(fits, list(keys)).withColumn("residual", residual(F.col("fit")))


def _triple_fits(keys: list[str], count: int, with_scale: bool, schema):
    """All three-point fits of one key from its drawn points, as one row."""
    def run(pool: pa.Table) -> pa.Table:
        m = pool.num_rows
        if m < 3:
            return schema.empty_table()
        pool = pool.sort_by("_r")
        xyz = lambda c: np.column_stack([pc.struct_field(pool[c], a).to_numpy() for a in "xyz"])
        src, dst, gain = xyz("src"), xyz("dst"), pool["weight"].to_numpy()
        hyp = np.arange(count)
        a, turn = 3 * hyp % m, 3 * hyp // m
        # Second and third point by their distance from the first, 1 .. m - 1, never the same.
        second, third = 1 + turn % (m - 1), 1 + turn % (m - 2)
        third = np.where(third < second, third, third + 1)
        at = np.column_stack([a, (a + second) % m, (a + third) % m])
        s, d, w = src[at] - src[at[:, :1]], dst[at] - dst[at[:, :1]], gain[at][:, :, None]  # around the first of the three
        cross = (w[..., None] * d[..., :, None] * s[..., None, :]).sum(axis=1).reshape(-1, 9)
        sums = [w.sum(axis=1), (w > 0).sum(axis=1), (w * s).sum(axis=1), (w * d).sum(axis=1), cross,
                (w * s * s).sum(axis=(1, 2))[:, None]]
        found, ok = _fit_np(np.column_stack(sums).astype(float), with_scale)
        move = dst[a] - found[:, :1] * np.einsum("nij,nj->ni", found[:, 1:10].reshape(-1, 3, 3), src[a]) + found[:, 10:]
        found, move, n = found[ok], move[ok], int(ok.sum())
        if n == 0:
            return schema.empty_table()
        rot = pa.ListArray.from_arrays(pa.array(range(0, 9 * n + 1, 9), pa.int32()), pa.array(found[:, 1:10].ravel()))
        trans = pa.StructArray.from_arrays([pa.array(c) for c in move.T], names=list("xyz"))
        fits = pa.StructArray.from_arrays([pa.array(found[:, 0]), rot, trans], names=["scale", "rot", "trans"])
        each = pa.StructArray.from_arrays([pa.array(hyp[ok], pa.int32()), fits], names=["hyp", "fit"])
        hyps = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), each).cast(schema.field("hyps").type)
        return pa.table([*[pool[k][:1] for k in keys], hyps], schema=schema)
    return run


def hypothesis_lists(points: DataFrame, count: int = 128, with_scale: bool = True, seed: int = 0, keys=PAIR,
                     order=("frame", "row", "col")) -> DataFrame:
    """``count`` three-point fits per key as one list ``hyps`` of (hyp, fit), from points picked by a seeded hash.

    About 4 * 3 * count points per key are drawn by hash, whatever the key holds; the
    triples walk through them in hash order. ``points`` carries ``n``, the points of its key.
    """
    want = 3 * count
    h = F.xxhash64(*[F.col(c) for c in (*keys, *order)], F.lit(seed))
    pool = points.withColumn("_h", h).filter(F.pmod(F.col("_h"), F.col("n")) < 4 * want)
    first = Window.partitionBy(*keys).orderBy("_h", *order)
    pool = pool.select(*keys, *order, "src", "dst", "weight", "_h").withColumn("_r", F.row_number().over(first)).filter(
        F.col("_r") <= want).select(*keys, "_r", "src", "dst", "weight")
    kinds = [T.StructField(k, points.schema[k].dataType) for k in keys]
    out = T.StructType([*kinds, T.StructField("hyps", T._parse_datatype_string(f"array<struct<hyp:int,fit:{FIT}>>"))])
    # The drawn points of a key meet in one call; a row per hypothesis would carry them all into Python's queue on disk.
    return pool.groupBy(*keys).applyInArrow(_triple_fits(list(keys), count, with_scale, to_arrow_schema(out)), out)


def hypotheses(points: DataFrame, count: int = 128, with_scale: bool = True, seed: int = 0, keys=PAIR,
               order=("frame", "row", "col")) -> DataFrame:
    """``hypothesis_lists`` as one row per key and hypothesis."""
    lists = hypothesis_lists(points, count, with_scale, seed, keys, order)
    return lists.select(*keys, F.inline("hyps"))


def _inlier_sums(keys: list[str], weighted: bool, schema):
    """Inlier weight of every hypothesis over a piece of a pair's points, all at once."""
    def run(points: pa.Table, heads: pa.Table) -> pa.Table:
        if points.num_rows == 0 or heads.num_rows == 0:
            return schema.empty_table()
        head = heads.slice(0, 1).to_pylist()[0]
        hyps = head["hyps"]
        turn = np.array([np.array(h["fit"]["rot"]).reshape(3, 3) * h["fit"]["scale"] for h in hyps])
        move = np.array([[h["fit"]["trans"][a] for a in "xyz"] for h in hyps])
        xyz = lambda c: np.column_stack([pc.struct_field(points[c], a).to_numpy() for a in "xyz"])
        src, dst = xyz("src"), xyz("dst")
        gain = points["weight"].to_numpy() if weighted else np.ones(len(src))
        total = np.zeros(len(hyps))
        for i in range(0, len(src), 4096):
            part = slice(i, i + 4096)
            off = np.einsum("hij,nj->nhi", turn, src[part]) + move - dst[part, None]
            near = np.sqrt(np.einsum("nhi,nhi->nh", off, off)) <= head["threshold"]
            total += gain[part] @ near
        cols = [pa.array([head["_" + k]] * len(hyps), schema.field(k).type) for k in keys]
        return pa.table([*cols, pa.array([h["hyp"] for h in hyps], pa.int32()), pa.array(total)], schema=schema)
    return run


def scores(points: DataFrame, heads: DataFrame, keys: list[str], weighted: bool) -> DataFrame:
    """(keys, hyp, score): inlier weight of each hypothesis of ``heads`` (keys, n, threshold, hyps).

    Points are dealt to pieces of about ``PIECE`` rows, so a pair of any size is scored by
    as many tasks as it has pieces, and a piece returns one sum per hypothesis.
    """
    pieces = F.ceil(F.col("n") / F.lit(PIECE)).cast("int")
    left = points.select(*keys, "src", "dst", "weight", F.pmod(F.xxhash64("src", "dst"), pieces).cast("int").alias("piece"))
    right = heads.filter("hyps is not null").select(
        *[F.col(k).alias("_" + k) for k in keys], "threshold", "hyps", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("_piece"))
    names = [*keys, "hyp", "score"]
    kinds = [*[points.schema[k].dataType for k in keys], T.IntegerType(), T.DoubleType()]
    out = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    each = left.groupBy(*keys, "piece").cogroup(right.groupBy(*["_" + k for k in keys], "_piece")).applyInArrow(
        _inlier_sums(keys, weighted, to_arrow_schema(out)), out)
    return each.groupBy(*keys, "hyp").agg(F.sum("score").alias("score"))


def robust_fit(points: DataFrame, with_scale: bool = True, inlier_threshold: float | None = None,
               iterations: int = 128, min_inliers: int = 12, refits: int = 2, weighted: bool = False,
               seed: int = 0, keys=PAIR, order=("frame", "row", "col")) -> DataFrame:
    """Outlier-safe similarity per pair: three-point hypotheses, then refits on inliers.

    The threshold is three times the median residual of a plain fit (at least 1 mm, 1 cm
    when that fit is degenerate) unless given. ``fit`` is NULL for a pair that is
    rejected; the other columns say how well the pair agrees.
    """
    keys = list(keys)
    spark = points.sparkSession

    def kept(df: DataFrame) -> DataFrame:
        out = cut_lineage(df)
        settle(spark)
        return out

    pts = kept(points.dropna(subset=keys).select(*keys, *order, "src", "dst", "weight"))
    # Per pair, not per point: the origin is joined to the points where sums need it.
    heads = kept(origins(pts, keys, order))
    if inlier_threshold is None:
        plain = kept(fit(pts.join(heads, keys), keys, with_scale).filter("fit is not null"))
        med = exact_quantiles(residuals(pts, plain, keys), keys, "residual", {"_med": 0.5}).select(*keys, "_med")
        heads = kept(heads.join(med, keys, "left").withColumn(
            "threshold", F.when(F.col("_med").isNull(), F.lit(0.01)).otherwise(
                F.greatest(F.lit(1e-3), 3.0 * F.col("_med")))).drop("_med"))
    else:
        if inlier_threshold <= 0:
            raise ValueError("inlier_threshold must be positive")
        heads = heads.withColumn("threshold", F.lit(inlier_threshold))
    enough = heads.filter(F.col("n") >= max(3, min_inliers)).select(*keys, "n")
    hyps = hypothesis_lists(pts.join(enough, keys), iterations, with_scale, seed, keys, order)
    tries = kept(heads.select(*keys, "n", "threshold").join(hyps, keys, "left"))

    # One pass scores all hypotheses; one row per (piece, hypothesis) leaves it.
    tried = scores(pts.join(heads.select(*keys, "n"), keys), tries, keys, weighted)
    # Written first: beside its unfinished sums the lists of hypotheses would be shuffled once more for the join.
    best = kept(tried.groupBy(*keys).agg(F.max_by("hyp", F.struct("score", -F.col("hyp"))).alias("best")))
    chosen = F.filter("hyps", lambda x: x["hyp"] == F.col("best"))[0]["fit"]
    current = kept(tries.join(best, keys).select(*keys, chosen.alias("fit")))

    for _ in range(max(1, refits)):
        near = pts.join(heads.drop("n").join(current, keys), keys).withColumnRenamed("fit", "_old")
        again = fit(near, keys, with_scale, residual(F.col("_old")) <= F.col("threshold"))
        current = kept(current.drop("fit").join(again, keys, "left"))
    r = residual(F.col("fit"))
    near = pts.join(heads.select(*keys, "threshold").join(current, keys), keys).withColumn("_r", r).withColumn(
        "_in", F.col("_r") <= F.col("threshold"))
    stats = near.groupBy(*keys).agg(
        F.count_if("_in").alias("inliers"),
        F.sqrt(F.avg(F.when(F.col("_in"), F.col("_r") * F.col("_r")))).alias("rmse"))
    out = heads.select(*keys, "n", "threshold").join(current.select(*keys, "fit"), keys, "left").join(stats, keys, "left")
    good = F.col("fit").isNotNull() & (F.col("inliers") >= min_inliers)
    return out.select(
        *keys, "n", "threshold", F.coalesce("inliers", F.lit(0)).alias("inliers"),
        (F.coalesce("inliers", F.lit(0)) / F.col("n")).alias("inlier_ratio"), "rmse",
        F.when(good, F.col("fit")).alias("fit"))
