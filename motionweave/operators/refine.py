"""Refinement of hand trajectories: short gaps, bone lengths, wrist depth."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import camera, hand, vec as v
from ..schemas import BONES, NUM_JOINTS
from ..session import cut_lineage
from .blocks import BLOCK, block_of, exact_quantiles, over_halo
from .windows import runs

MAX_GAP = 12
BONE_BOUND = 0.035
DEPTH_LAMBDA = 0.2
# Confidence relative to the clip median, its clamp and its power.
WEIGHT_CLAMP = (0.5, 1.5)
WEIGHT_POWER = 8
HAND = ("clip", "side")


# --------------------------------------------------------------- gap filling
def fill_gaps(hands: DataFrame, max_gap: int = MAX_GAP, block: int = BLOCK) -> DataFrame:
    """Fill runs of 1..max_gap missing frames between two complete frames.

    Joints and confidence follow the straight line between the two. Needs a row for
    every frame; the look-around is at most ``max_gap`` frames. Adds ``interpolated``.
    """
    if max_gap < 1:
        raise ValueError("max_gap must be at least 1")

    def body(rows, asc, desc):
        ok = F.col("valid") & v.all_finite(F.col("joints"))
        rows = rows.withColumn("_a", F.when(ok, F.struct("frame", "joints", "conf")))
        upto = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn("_p", F.last("_a", True).over(upto(asc))).withColumn(
            "_n", F.last("_a", True).over(upto(desc)))

    rows = over_halo(hands, HAND, max_gap, max_gap, body, block=block)
    p, n = F.col("_p"), F.col("_n")
    span = (n["frame"] - p["frame"]).cast("double")
    fill = F.coalesce(F.col("_a").isNull() & (span - 1 >= 1) & (span - 1 <= max_gap), F.lit(False))
    rows = rows.withColumn("_fill", fill).withColumn(
        "_w", F.when(fill, (F.col("frame") - p["frame"]) / F.nullif(span, F.lit(0.0))))
    w = F.col("_w")
    return rows.withColumns({
        "joints": F.when(F.col("_fill"), hand.lerp_joints(p["joints"], n["joints"], w)).otherwise(F.col("joints")),
        "conf": F.when(F.col("_fill"), (1.0 - w) * p["conf"] + w * n["conf"]).otherwise(F.col("conf")),
        "valid": F.col("valid") | F.col("_fill"),
        "interpolated": F.col("_fill"),
    }).drop("_a", "_p", "_n", "_fill", "_w")


def gap_report(filled: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per clip: gaps filled, frames filled, frames still missing."""
    def starts(rows, asc, _):
        before = F.coalesce(F.lag("interpolated").over(asc) & (F.lag("frame").over(asc) == F.col("frame") - 1),
                            F.lit(False))
        return rows.withColumn("_start", F.col("interpolated") & ~before)

    slim = filled.select("clip", "side", "frame", "valid", "interpolated")
    return over_halo(slim, HAND, 1, 0, starts, block=block).groupBy("clip").agg(
        F.count_if("_start").alias("gaps_filled"), F.count_if("interpolated").alias("frames_filled"),
        F.count_if(~F.col("valid")).alias("frames_left_missing"))


# --------------------------------------------------------------- bone lengths
def bone_rows(hands: DataFrame) -> DataFrame:
    """(clip, side, bone, length) for every bone of every valid hand-frame."""
    ok = hands.filter(F.col("valid") & F.col("joints").isNotNull())
    return ok.select("clip", "side", "frame", F.posexplode(hand.bone_lengths(F.col("joints"))).alias("bone", "length"))


def bone_reference(hands: DataFrame, reference: str = "mean") -> DataFrame:
    """Reference length per (clip, side, bone): mean or exact median over valid frames."""
    rows = bone_rows(hands)
    keys = ["clip", "side", "bone"]
    if reference == "mean":
        return rows.groupBy(*keys).agg(F.avg("length").alias("ref"))
    if reference != "median":
        raise ValueError("reference must be 'mean' or 'median'")
    return exact_quantiles(rows, keys, "length", {"ref": 0.5}).drop("n")


def _reference_arrays(ref: DataFrame) -> DataFrame:
    """One row per (clip, side) with 20 references; dropped unless all are usable."""
    arr = ref.filter(F.col("ref").isNotNull() & ~F.isnan("ref")).groupBy("clip", "side").agg(
        F.array_sort(F.collect_list(F.struct("bone", "ref"))).alias("r"))
    return arr.filter(F.size("r") == len(BONES)).select("clip", "side", F.col("r")["ref"].alias("refs"))


def scale_bones(hands: DataFrame, bound: float = BONE_BOUND, reference: str = "mean") -> DataFrame:
    """Pull bone lengths towards the clip reference, at most ``bound`` per frame."""
    if not 0 <= bound <= 1:
        raise ValueError("bound must lie in [0, 1]")
    refs = _reference_arrays(bone_reference(hands, reference))
    rows = hands.join(refs, ["clip", "side"], "left")
    ratio = F.zip_with(
        F.col("refs"), hand.bone_lengths(F.col("joints")),
        lambda ref, length: F.when((ref > 0) & (length > 1e-9),
                                   v.clamp(ref / F.nullif(length, F.lit(0.0)), 1.0 - bound, 1.0 + bound)))
    use = F.col("valid") & F.col("refs").isNotNull() & F.col("joints").isNotNull()
    joints = F.col("joints")

    def walk(ratios: Column) -> Column:
        """Walk out from the wrist: each joint hangs off the new place of its parent; a
        bone without a ratio keeps its child where it was."""
        def hang(done: Column, j: Column) -> Column:
            up = F.when(j % 4 == 1, F.lit(0)).otherwise(j - 1)
            old, base, start, r = F.get(joints, j), F.get(joints, up), F.get(done, up), F.get(ratios, j - 1)
            moved = v.vec(*[start[a] + r * (old[a] - base[a]) for a in "xyz"])
            return F.concat(done, F.array(F.when(r.isNotNull(), moved).otherwise(old)))

        return F.aggregate(F.sequence(F.lit(1), F.lit(NUM_JOINTS - 1)), F.slice(joints, 1, 1), hang)

    # The ratios are bound once; a filter pushed through this projection cannot copy them
    # into every step of the walk.
    return rows.withColumn("joints", F.when(use, v.let(ratio, walk)).otherwise(joints)).drop("refs")


def bone_deviation(hands: DataFrame, ref: DataFrame, name: str) -> DataFrame:
    """Worst |length / reference - 1| per (clip, side, bone)."""
    rows = bone_rows(hands).join(ref, ["clip", "side", "bone"])
    dev = F.abs(F.col("length") / F.nullif(F.col("ref"), F.lit(0.0)) - 1.0)
    return rows.groupBy("clip", "side", "bone").agg(F.max(dev).alias(name))


# ---------------------------------------------------------------- wrist depth
def confidence_weights(hands: DataFrame, per_side: bool = False) -> DataFrame:
    """clamp(conf / median)^8, the median over valid positive confidences of the clip.

    A missing or non-finite confidence has no weight (NULL), unless the clip has no
    usable confidence at all, which makes every weight 1.
    """
    keys = ["clip", "side"] if per_side else ["clip"]
    usable = hands.filter(F.col("valid") & (F.col("conf") > 0) & ~F.isnan("conf")).select(*keys, "conf")
    med = exact_quantiles(usable, keys, "conf", {"_med": 0.5}).drop("n")
    rel = v.clamp(F.col("conf") / F.col("_med"), *WEIGHT_CLAMP)
    return hands.join(med, keys, "left").withColumn(
        "weight", F.when(F.col("_med").isNull(), F.lit(1.0)).otherwise(F.pow(rel, F.lit(WEIGHT_POWER)))).drop("_med")


def solve_bands(diag: np.ndarray, up1: np.ndarray, up2: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Solve a symmetric positive definite system with two bands above the diagonal.

    ``rhs`` is [n, m]. Rows are taken in pairs, which makes the system tridiagonal in 2x2
    blocks; cyclic reduction then solves it in log(n) steps over whole arrays. Systems laid
    one after another, their couplings zero, are solved together.
    """
    n = len(diag)
    if n == 0:
        return np.zeros((0, rhs.shape[1]))
    k = -(-n // 2)
    d, u1, u2 = (np.append(x.astype(float), [fill] * (2 * k - n)).reshape(k, 2)
                 for x, fill in ((diag, 1.0), (up1, 0.0), (up2, 0.0)))
    own = np.stack([np.stack([d[:, 0], u1[:, 0]], 1), np.stack([u1[:, 0], d[:, 1]], 1)], 1)
    ahead = np.stack([np.stack([u2[:, 0], np.zeros(k)], 1), np.stack([u1[:, 1], u2[:, 1]], 1)], 1)[:-1]
    y = np.zeros((2 * k, rhs.shape[1]))
    y[:n] = rhs
    return _reduce(own, ahead, y.reshape(k, 2, -1)).reshape(2 * k, -1)[:n]


def _reduce(own: np.ndarray, ahead: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Cyclic reduction: ``ahead[i]`` ties block i to block i + 1. Odd blocks are expressed by
    their neighbours, the even ones form a system of half the size."""
    if len(own) == 1:
        return np.linalg.solve(own, rhs)
    odd, even, y = own[1::2], own[::2].copy(), rhs[::2].copy()
    into, out_of = ahead[::2], ahead[1::2]
    n_in, n_out = len(into), len(out_of)
    from_left = np.linalg.solve(odd, np.concatenate([into.swapaxes(1, 2), rhs[1::2]], 2))
    from_left, known = from_left[:, :, :2], from_left[:, :, 2:]
    from_right = np.linalg.solve(odd[:n_out], out_of)
    even[:n_in] -= into @ from_left
    even[1:] -= out_of.swapaxes(1, 2) @ from_right
    y[:n_in] -= into @ known
    y[1:] -= out_of.swapaxes(1, 2) @ known[:n_out]
    x = np.empty_like(rhs)
    x[::2] = _reduce(even, -(into[:n_out] @ from_right), y)
    x[1::2] = known - from_left @ x[::2][:n_in]
    x[1::2][:n_out] -= from_right @ x[::2][1:]
    return x


def _depth_system(hands: DataFrame, lam: float, per_side: bool, block: int) -> DataFrame:
    """Rows of the normal equations, one per valid hand-frame, with their run.

    The smoothness term couples a frame with two neighbours on each side, so each row
    needs a look-around of two frames only.
    """
    ok = F.col("valid") & v.all_finite(F.col("joints"))
    depth = F.col("joints")[0]["z"]
    depth = F.when(ok & (F.abs(depth) < camera.DEPTH_EPS), F.raise_error(
        F.lit("wrist depth is zero: its ray is undefined")).cast("double")).otherwise(depth)
    # Only the wrist is needed from here on; the table is small and read several times.
    slim = cut_lineage(hands.select("clip", "side", "frame", "conf", "valid", ok.alias("_ok"),
                                    F.when(ok, _wrist_ray()).alias("_ray"), F.when(ok, depth).alias("_d0")))
    rows = runs(confidence_weights(slim, per_side), F.col("_ok"), HAND, block).filter(F.col("run_end") > F.col("run_start"))
    # A run with a frame that has no weight is left as it is.
    lost = rows.filter("weight is null").select(*HAND, "run_start").distinct()
    rows = rows.join(lost, [*HAND, "run_start"], "left_anti")

    f, s, e = F.col("frame"), F.col("run_start"), F.col("run_end")

    def coef(row: Column, col_offset: int) -> Column:
        """Coefficient of sample row+offset in the second difference at ``row``."""
        outside = (row < s) | (row > e) | (row + col_offset < s) | (row + col_offset > e)
        inner = -2.0 if col_offset == 0 else 1.0
        edge_first = {-1: 0.0, 0: -1.0, 1: 1.0}[col_offset]
        edge_last = {-1: -1.0, 0: 1.0, 1: 0.0}[col_offset]
        return F.when(outside, 0.0).when(row == s, edge_first).when(row == e, edge_last).otherwise(inner)

    def gram(shift: int) -> Column:
        """Coefficient product sum over second differences that see f and f+shift."""
        terms = []
        for k in range(-1, 2):
            off = shift - k
            if -1 <= off <= 1:
                terms.append(coef(f + k, -k) * coef(f + k, off))
        return sum(terms[1:], terms[0])

    def body(r, asc, _):
        nxt = {k: F.lead("_ray", k).over(asc) for k in (1, 2)}
        same = {k: F.lead("run_start", k).over(asc) == s for k in (1, 2)}
        r = r.withColumn("_up1", F.when(same[1], lam * gram(1) * v.dot(F.col("_ray"), nxt[1])))
        r = r.withColumn("_up2", F.when(same[2], lam * gram(2) * v.dot(F.col("_ray"), nxt[2])))
        r = r.withColumn("_diag", F.col("weight") + lam * gram(0) * v.dot(F.col("_ray"), F.col("_ray")))
        r = r.withColumn("_lo1", F.when(F.lag("run_start", 1).over(asc) == s, F.lag("_up1", 1).over(asc)))
        return r.withColumn("_lo2", F.when(F.lag("run_start", 2).over(asc) == s, F.lag("_up2", 2).over(asc)))

    rows = over_halo(rows, HAND, 4, 4, body, block=block)
    zero = {c: F.coalesce(c, F.lit(0.0)) for c in ("_up1", "_up2", "_lo1", "_lo2")}
    return rows.withColumns(zero).withColumn("_rhs", F.col("weight") * F.col("_d0")).withColumn(
        "_block", block_of("frame", block))


def _wrist_ray() -> Column:
    p = camera.project(F.col("k"), F.col("joints")[0], front_only=False)
    return camera.ray(F.col("k"), p["u"], p["v"])


BAND = ["frame", "_diag", "_up1", "_up2", "_lo1", "_lo2", "_rhs"]
PIECE = ("clip", "side", "_block", "run_start")


def _starts(rows: pa.Table) -> np.ndarray:
    """Where the pieces begin; a piece is what a block holds of a run, its rows adjacent and by frame."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for key in PIECE:
        code = pc.dictionary_encode(rows[key].combine_chunks(), null_encoding="encode").indices.to_numpy()
        new[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(new)


class _Pieces:
    """The equations of many pieces at once.

    The last two rows of a piece that goes on in the next block are separators, all others
    inner rows; inner rows of different pieces are not coupled. ``ties`` holds, per row, the
    couplings to the two separators before and the two after its piece's inner rows.
    """

    def __init__(self, rows: pa.Table, block: int):
        self.diag, self.up1, self.up2, lo1, lo2, self.rhs = (rows[c].to_numpy() for c in BAND[1:])
        b, start, end = (rows[c].to_numpy().astype(np.int64) for c in ("_block", "run_start", "run_end"))
        n = rows.num_rows
        self.first = _starts(rows)
        size = np.diff(np.append(self.first, n))
        since = np.arange(n) - np.repeat(self.first, size)
        self.left_over = np.repeat(size, size) - 1 - since  # rows of the piece that follow
        goes_on = end >= (b + 1) * block
        self.inner = ~goes_on | (self.left_over > 1)
        before_last = self.left_over - 2 * goes_on  # inner rows of the piece that follow
        entered, self.ties = start < b * block, np.zeros((n, 4))
        at = lambda mask: np.flatnonzero(mask & self.inner)
        for i, column, band in ((at(entered & (since == 0)), 1, lo1), (at(entered & (since == 0)), 0, lo2),
                                (at(entered & (since == 1)), 1, lo2), (at(goes_on & (before_last == 0)), 2, self.up1),
                                (at(goes_on & (before_last == 0)), 3, self.up2), (at(goes_on & (before_last == 1)), 2, self.up2)):
            self.ties[i, column] = band[i]
        self.near = np.where(before_last >= 1, self.up1, 0.0), np.where(before_last >= 2, self.up2, 0.0)

    def solve(self, columns: np.ndarray) -> np.ndarray:
        """Inner rows solved for [n, m] right-hand sides; zero at the separators."""
        out, at = np.zeros(columns.shape), self.inner
        out[at] = solve_bands(self.diag[at], self.near[0][at], self.near[1][at], columns[at])
        return out


def _by_piece(solve):
    """Hand whole pieces to ``solve``, as many at once as an Arrow batch brings; the last piece waits for its rest."""
    def run(batches):
        held = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = pa.Table.from_batches([*held, batch])
            cut = int(_starts(rows)[-1])
            if cut:
                yield from solve(rows.slice(0, cut)).to_batches()
            held = rows.slice(cut).to_batches()
        if held:
            yield from solve(pa.Table.from_batches(held)).to_batches()
    return run


def smooth_wrist_depth(hands: DataFrame, lam: float = DEPTH_LAMBDA, max_change: float | None = None,
                       per_side: bool = False, block: int = BLOCK) -> DataFrame:
    """Wrist depth along its camera ray with the least acceleration, per valid run.

    Minimises sum w (d - d0)^2 + lam * |second difference of d * ray|^2 and shifts the
    whole hand. A run longer than one block is solved exactly by substructuring: each
    block eliminates its inner rows, the two border rows per block form a small chained
    system, and the blocks then fill in their inner rows. Adds ``depth_before`` and
    ``depth_after`` (NULL where nothing was solved).
    """
    if lam < 0:
        raise ValueError("lam must not be negative")
    if block < 8:
        raise ValueError("block must hold at least 8 frames")
    rows = _depth_system(hands, lam, per_side, block)
    slim = cut_lineage(rows.select("clip", "side", "_block", "run_start", "run_end", *BAND))
    clip_t = hands.schema["clip"].dataType.simpleString()
    side_t = hands.schema["side"].dataType.simpleString()
    ids = f"clip {clip_t}, side {side_t}"

    def eliminate(rows: pa.Table) -> pa.Table:
        p = _Pieces(rows, block)
        x = p.solve(np.column_stack([p.ties, p.rhs]))
        sums = np.add.reduceat(p.ties[:, :, None] * x[:, None, :], p.first, axis=0)
        last = np.append(p.first[1:], rows.num_rows) - 1
        m = np.add.reduceat((~p.inner).astype(np.int32), p.first)
        own, own_rhs = np.zeros((len(last), 2, 2)), np.zeros((len(last), 2))
        for i, back in ((0, m == 2), (1, np.zeros(len(m), bool))):
            at = np.maximum(last - back, 0)
            used = m > i
            own[used, i, i], own_rhs[used, i] = p.diag[at[used]], p.rhs[at[used]]
        two = m == 2
        own[two, 0, 1] = own[two, 1, 0] = p.up1[last[two] - 1]
        lists = lambda x: pa.array(x.reshape(len(x), -1).tolist(), pa.list_(pa.float64()))
        keys = rows.select(["clip", "side", "run_start", "_block"]).take(pa.array(p.first))
        for name, column in (("m", pa.array(m, pa.int32())), ("schur", lists(sums[:, :, :4])), ("schur_rhs", lists(sums[:, :, 4])),
                             ("own", lists(own)), ("own_rhs", lists(own_rhs))):
            keys = keys.append_column(name, column)
        return keys

    def together(rows: DataFrame) -> DataFrame:
        return rows.repartition("clip", "side", "_block").sortWithinPartitions("clip", "side", "frame")

    long_run = block_of("run_start", block) < block_of("run_end", block)
    parts = together(slim.filter(long_run)).mapInArrow(
        _by_piece(eliminate), f"{ids}, run_start int, _block int, m int, schur array<double>, schur_rhs array<double>, "
                              "own array<double>, own_rhs array<double>")

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        """Block-tridiagonal sweep over the separators of one run (two unknowns each)."""
        pdf = pdf.sort_values("_block").reset_index(drop=True)
        n = len(pdf) - 1  # the last block has no separator
        schur = [np.array(s, dtype=float).reshape(4, 4) for s in pdf["schur"]]
        srhs = [np.array(s, dtype=float) for s in pdf["schur_rhs"]]
        dia, off, rhs = [], [], []
        for i in range(n):
            m = int(pdf["m"].iloc[i])
            a = np.array(pdf["own"].iloc[i], dtype=float).reshape(2, 2)
            a = a - schur[i][2:, 2:] - schur[i + 1][:2, :2] if m == 2 else a
            r = np.array(pdf["own_rhs"].iloc[i], dtype=float) - srhs[i][2:] - srhs[i + 1][:2]
            if m == 1:  # a run that starts on the last frame of a block
                a0 = float(np.array(pdf["own"].iloc[i], dtype=float)[0]) - schur[i + 1][1, 1]
                a = np.array([[1.0, 0.0], [0.0, a0]])
                r = np.array([0.0, float(pdf["own_rhs"].iloc[i][0]) - srhs[i + 1][1]])
            dia.append(a)
            rhs.append(r)
            off.append(-schur[i + 1][:2, 2:])  # couples separator i with separator i+1
        for i in range(1, n):
            g = np.linalg.solve(dia[i - 1], off[i - 1]).T
            dia[i] = dia[i] - g @ off[i - 1]
            rhs[i] = rhs[i] - g @ rhs[i - 1]
        x = [None] * n
        for i in range(n - 1, -1, -1):
            r = rhs[i] if i == n - 1 else rhs[i] - off[i] @ x[i + 1]
            x[i] = np.linalg.solve(dia[i], r)
        zero = [0.0, 0.0]
        return pd.DataFrame({
            "clip": pdf["clip"], "side": pdf["side"], "run_start": pdf["run_start"], "_block": pdf["_block"],
            "left": [zero] + [xi.tolist() for xi in x], "right": [xi.tolist() for xi in x] + [zero]})

    borders = parts.groupBy("clip", "side", "run_start").applyInPandas(
        chain, f"{ids}, run_start int, _block int, left array<double>, right array<double>")

    def finish(rows: pa.Table) -> pa.Table:
        p = _Pieces(rows, block)
        border = np.column_stack([rows[c].to_numpy() for c in ("l0", "l1", "r0", "r1")])
        x = p.solve((p.rhs - (p.ties * border).sum(axis=1))[:, None])[:, 0]
        x = np.where(p.inner, x, np.where(p.left_over == 0, border[:, 3], border[:, 2]))
        return rows.select(["clip", "side", "frame"]).append_column("_solved", pa.array(x))

    at_border = {name: F.coalesce(F.get(side, F.lit(i)), F.lit(0.0)) for name, side, i in (
        ("l0", "left", 0), ("l1", "left", 1), ("r0", "right", 0), ("r1", "right", 1))}
    solved = together(slim.join(borders, list(PIECE), "left").withColumns(at_border).drop("left", "right")).mapInArrow(
        _by_piece(finish), f"{ids}, frame int, _solved double")
    out = hands.join(solved, ["clip", "side", "frame"], "left")
    before = F.col("joints")[0]["z"]
    step = F.col("_solved") - before
    if max_change is not None:
        step = v.clamp(step, -max_change, max_change)
    out = out.withColumn("_step", step).withColumn("_ray", F.when(F.col("_solved").isNotNull(), _wrist_ray()))
    return out.withColumns({
        "depth_before": F.when(F.col("_solved").isNotNull(), before),
        "depth_after": F.when(F.col("_solved").isNotNull(), before + F.col("_step")),
        "joints": F.when(F.col("_solved").isNotNull(),
                         hand.shift_joints(F.col("joints"), v.scale(F.col("_ray"), F.col("_step")))
                         ).otherwise(F.col("joints")),
    }).drop("_solved", "_step", "_ray")
