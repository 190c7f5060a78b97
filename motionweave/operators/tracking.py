"""Two-hand tracking: slot selection with state, then anchors and recovery.

Selection is the one operator whose state runs through a whole clip. It is still
split exactly: a block of frames is a function from the state it is entered with to
the state it leaves, and the states it can be entered with are known (each side holds
one of the detections of the last ``max_gap`` frames, or none). So

1. every block is run from all its possible entry states at once; runs that reach the
   same state merge, which happens within a few frames;
2. the block functions of a clip are chained, one small row per block;
3. every block is run once more from its true entry state.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import box as bx, vec as v
from .blocks import BEFORE, BLOCK, halo, over_halo
from .schedule import frames

IOU_FLOOR = 0.10
NONE = (-1, -1)
UNLABELLED = -1  # a detection without a side is no side's label pick
COLS = ["frame", "slot", "x1", "y1", "x2", "y2", "conf", "side"]


class _Det:
    """One detection of one frame. Without a confidence it is the weakest, without a corner it cannot be compared."""

    __slots__ = ("key", "x1", "y1", "x2", "y2", "conf", "side", "area", "rank", "whole")

    def __init__(self, row):
        frame, slot, self.x1, self.y1, self.x2, self.y2, self.conf, side = row
        self.key = (int(frame), int(slot))
        self.side = int(side)
        self.area = max(0.0, self.x2 - self.x1) * max(0.0, self.y2 - self.y1)
        self.rank = self.conf if self.conf == self.conf else -math.inf
        self.whole = math.isfinite(self.x1 + self.y1 + self.x2 + self.y2)

    def iou(self, other: "_Det") -> float:
        if not (self.whole and other.whole):
            return -1.0
        w = min(self.x2, other.x2) - max(self.x1, other.x1)
        h = min(self.y2, other.y2) - max(self.y1, other.y1)
        if w <= 0 or h <= 0:
            return 0.0
        inter = w * h
        union = self.area + other.area - inter
        return inter / union if union > 0 else 0.0


def _strongest(cands):
    return max(cands, key=lambda d: (d.rank, d.area), default=None)


def _choose(dets: list[_Det], held: list, floor: float) -> list:
    """Pick at most one detection per side for one frame.

    ``held[s]`` is the box side ``s`` still follows, or None when it has gone stale.
    """
    pick = [_strongest([d for d in dets if d.side == s]) for s in (0, 1)]
    for s in (0, 1):
        if pick[s] is None and held[s] is not None:
            pick[s] = _strongest([d for d in dets if d is not pick[1 - s] and d.iou(held[s]) >= floor])

    follows = lambda s, d: -1.0 if d is None or held[s] is None else d.iou(held[s])
    broken = [s for s in (0, 1) if 0.0 <= follows(s, pick[s]) < floor]
    if len(broken) == 2:
        return pick[::-1]
    for s in broken:
        mine, other = pick[s], pick[1 - s]
        score = follows(s, mine)
        # The other side's box may be traded; any other box is simply free.
        better = max((d for d in dets if follows(s, d) > score),
                     key=lambda d: (follows(s, d), d.rank), default=None)
        if better is not None:
            pick[1 - s] = mine if better is other else other
            pick[s] = better
    return pick


def _frames(pdf: pd.DataFrame) -> list[tuple[int, list[_Det]]]:
    rows = pdf[COLS].fillna({"side": UNLABELLED}).sort_values(["frame", "slot"]).itertuples(index=False, name=None)
    out: list[tuple[int, list[_Det]]] = []
    for row in rows:
        d = _Det(row)
        if not out or out[-1][0] != d.key[0]:
            out.append((d.key[0], []))
        out[-1][1].append(d)
    return out


def _fresh(state, frame: int, max_gap: int):
    """Drop what has gone stale, so that equal futures compare equal."""
    return tuple(k if k != NONE and frame - k[0] <= max_gap else NONE for k in state)


def _step(state, frame, dets, known, max_gap, floor):
    state = _fresh(state, frame, max_gap)
    pick = _choose(dets, [known.get(k) for k in state], floor)
    return tuple(state[s] if pick[s] is None else pick[s].key for s in (0, 1)), pick


def _transition(pdf: pd.DataFrame, block: int, max_gap: int, floor: float):
    """Exit state of a block for every state it can be entered with."""
    b = int(pdf["_block"].iloc[0])
    first, after = b * block, (b + 1) * block
    rows_of = _frames(pdf)
    known = {d.key: d for _, dets in rows_of for d in dets}
    entry_keys = [NONE] + [k for k in known if k[0] < first]
    entries = [(p, q) for p in entry_keys for q in entry_keys if p == NONE or p != q]
    current = {e: _fresh(e, first, max_gap) for e in entries}
    for frame, dets in rows_of:
        if frame < first:
            continue
        moved = {s: _step(s, frame, dets, known, max_gap, floor)[0] for s in set(current.values())}
        current = {e: moved[s] for e, s in current.items()}
    return b, {e: _fresh(s, after, max_gap) for e, s in current.items()}


def _flat(state) -> list[int]:
    return [*state[0], *state[1]]


def select_slots(dets: DataFrame, max_gap: int = 4, iou_floor: float = IOU_FLOOR, block: int = BLOCK) -> DataFrame:
    """Label picks, continuity adoption, swap or upgrade, one detection per side.

    Returns (clip, frame, side, slot, box, conf), where ``side`` is the track side.
    """
    if max_gap < 0 or max_gap >= block:
        raise ValueError("max_gap must lie in [0, block)")
    flat = dets.select("clip", "frame", "slot", "box.*", "conf", "side")
    rows = halo(flat, max_gap, 0, block=block)
    key = f"clip {dets.schema['clip'].dataType.simpleString()}"

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        b, moves = _transition(pdf, block, max_gap, iou_floor)
        pairs = [_flat(e) + _flat(s) for e, s in moves.items()]
        return pd.DataFrame({"clip": pdf["clip"].iloc[:1].to_list(), "_block": [b], "moves": [sum(pairs, [])]})

    # Only a block with a later block behind it needs its function; most clips have none.
    last = rows.filter("_own").groupBy("clip").agg(F.max("_block").alias("_last"))
    inner = rows.join(last, "clip").filter("_block < _last").drop("_last")
    moves = inner.groupBy("clip", "_block").applyInPandas(summarise, f"{key}, _block int, moves array<int>")

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block")
        state, expect, entries = (NONE, NONE), None, []
        for b, flat_moves in zip(pdf["_block"], pdf["moves"]):
            if expect is not None and b != expect:
                state = (NONE, NONE)  # a block without any detection outlasts the memory
            table = {tuple(flat_moves[i:i + 4]): flat_moves[i + 4:i + 8] for i in range(0, len(flat_moves), 8)}
            p, q, r, s = (int(x) for x in table[tuple(_flat(state))])
            state = ((p, q), (r, s))
            entries.append(_flat(state))
            expect = b + 1
        return pd.DataFrame({"clip": pdf["clip"], "_block": pdf["_block"] + 1, "entry": entries})

    entry = moves.groupBy("clip").applyInPandas(chain, f"{key}, _block int, entry array<int>")

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        first = int(pdf["_block"].iloc[0]) * block
        start = pdf["entry"].iloc[0]
        state = (NONE, NONE) if start is None else ((int(start[0]), int(start[1])), (int(start[2]), int(start[3])))
        rows_of = _frames(pdf)
        known = {d.key: d for _, ds in rows_of for d in ds}
        out = []
        for frame, ds in rows_of:
            if frame < first:
                continue
            state, pick = _step(state, frame, ds, known, max_gap, iou_floor)
            out += [(frame, s, d.key[1], d.x1, d.y1, d.x2, d.y2, d.conf) for s, d in enumerate(pick) if d is not None]
        res = pd.DataFrame(out, columns=["frame", "side", "slot", "x1", "y1", "x2", "y2", "conf"])
        res.insert(0, "clip", pdf["clip"].iloc[0])
        return res

    picked = rows.join(entry, ["clip", "_block"], "left").groupBy("clip", "_block").applyInPandas(
        replay, f"{key}, frame int, side int, slot int, x1 double, y1 double, x2 double, y2 double, conf double")
    return picked.select("clip", "frame", "side", "slot", bx.box(*[F.col(c) for c in bx.CORNERS]).alias("box"), "conf")


def recover(cands: DataFrame, min_confidence: float = 0.75, max_gap: int = 4, min_iou: float = 0.20,
            block: int = BLOCK) -> DataFrame:
    """Keep anchors, plus weak candidates that lie on the line between two close anchors.

    Anchors further apart than ``max_gap`` frames recover nothing, so the look-around
    is bounded and stays inside a frame block.
    """
    if not (0 <= min_confidence <= 1 and 0 <= min_iou <= 1 and max_gap >= 0):
        raise ValueError("thresholds must lie in [0, 1] and max_gap must not be negative")

    def body(rows, asc, desc):
        anchor = F.when(F.col("conf") >= min_confidence, F.struct("frame", "box"))
        upto = lambda w: w.rowsBetween(BEFORE, 0)
        rows = rows.withColumn("_a", anchor)
        return rows.withColumn("_p", F.last("_a", True).over(upto(asc))).withColumn(
            "_n", F.last("_a", True).over(upto(desc)))

    rows = over_halo(cands, ["clip", "side"], max_gap, max_gap, body, block=block)
    p, n = F.col("_p"), F.col("_n")
    gap = n["frame"] - p["frame"] - 1
    w = (F.col("frame") - p["frame"]) / F.nullif((n["frame"] - p["frame"]).cast("double"), F.lit(0.0))
    close = (gap >= 1) & (gap <= max_gap)
    overlap = v.let(bx.lerp(p["box"], n["box"], w), lambda expected: bx.iou(F.col("box"), expected))
    on_line = F.when(close, overlap >= min_iou)
    anchor = F.col("conf") >= min_confidence
    recovered = F.coalesce(~anchor & on_line, F.lit(False))
    return rows.withColumn("recovered", recovered).filter(anchor | recovered).drop("_a", "_p", "_n")


def dense_frames(clips: DataFrame, sides: tuple = (0, 1), length: str = "num_frames") -> DataFrame:
    """Every (clip, frame, side) of the clips.

    They are as many as the detections, but Spark sizes them by the clips they are spread from and would broadcast them
    to a join; the hint has the join sort and merge both sides.
    """
    rows = frames(clips, length)
    return rows.withColumn("frame", F.col("frame").cast("int")).withColumn(
        "side", F.explode(F.array(*[F.lit(s) for s in sides]))).hint("merge")


def track(dets: DataFrame, clips: DataFrame, min_confidence: float = 0.75, max_gap: int = 4,
          min_iou: float = 0.20, block: int = BLOCK) -> DataFrame:
    """Full track table: one row per (clip, frame, side), missing ones kept as missing."""
    kept = recover(select_slots(dets, max_gap, block=block), min_confidence, max_gap, min_iou, block)
    rows = dense_frames(clips).join(kept, ["clip", "frame", "side"], "left")
    valid = F.col("box").isNotNull()
    return rows.select(
        "clip", "frame", "side", "box", F.coalesce("conf", F.lit(0.0)).alias("conf"), valid.alias("valid"),
        F.when(valid, F.lit(0)).otherwise(F.lit(-1)).cast("bigint").alias("track_id"),
        F.coalesce("recovered", F.lit(False)).alias("recovered"))


def stack_sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """One table from two single-side tracks; they must cover the same frames."""
    both = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))
    check = both.groupBy("clip").agg(
        F.sum(F.when(F.col("side") == 0, 1).otherwise(-1)).alias("_d"))
    uneven = F.when(F.col("_d") != 0, F.raise_error(F.lit("left and right tracks differ in length")).cast("long"))
    return both.join(check.withColumn("_d", F.coalesce(uneven, F.col("_d"))), "clip").filter("_d = 0").drop("_d")


def request_rows(tracks: DataFrame) -> DataFrame:
    """The hand-frames a reconstruction model is asked for: exactly the valid tracks.

    Rows rather than one list per clip, so a long clip never becomes a single value.
    """
    return tracks.filter("valid").select("clip", "side", "frame", "box", "conf", F.lit(True).alias("det"))
