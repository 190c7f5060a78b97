"""The split tracker against a plain frame loop, and its rules one by one."""

import datetime
import random

import pytest

from motionweave.operators import tracking as tr

SCHEMA = "clip long, frame int, slot int, box struct<x1:double,y1:double,x2:double,y2:double>, conf double, side int"


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    inter = w * h
    return inter / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter)


def loop(dets, gap=4, floor=0.1):
    """One clip, one pass, state in two variables: (frame, box) per side."""
    size = lambda d: (d["conf"], (d["box"][2] - d["box"][0]) * (d["box"][3] - d["box"][1]))
    seen = [None, None]
    out = {}
    for frame in sorted({d["frame"] for d in dets}):
        here = sorted((d for d in dets if d["frame"] == frame), key=lambda d: d["slot"])
        held = [s[1] if s is not None and frame - s[0] <= gap else None for s in seen]
        got = [max((d for d in here if d["side"] == s), key=size, default=None) for s in (0, 1)]
        for s in (0, 1):
            if got[s] is None and held[s]:
                free = [d for d in here if d is not got[1 - s] and iou(d["box"], held[s]) >= floor]
                got[s] = max(free, key=size, default=None)
        overlap = lambda s, d: iou(d["box"], held[s]) if d and held[s] else -1
        lost = [s for s in (0, 1) if 0 <= overlap(s, got[s]) < floor]
        if lost == [0, 1]:
            got.reverse()
        elif lost:
            s = lost[0]
            best = max((d for d in here if overlap(s, d) > overlap(s, got[s])), key=lambda d: (overlap(s, d), d["conf"]), default=None)
            if best is not None:
                if best is got[1 - s]:
                    got[1 - s] = got[s]
                got[s] = best
        for s in (0, 1):
            if got[s]:
                seen[s] = (frame, got[s]["box"])
                out[(frame, s)] = got[s]["slot"]
    return out


def frame_of(spark, dets, clip=1):
    return spark.createDataFrame([(clip, d["frame"], d["slot"], d["box"], d["conf"], d["side"]) for d in dets], SCHEMA)


def det(frame, slot, x, side, conf=0.9, y=0.0):
    return {"frame": frame, "slot": slot, "box": (float(x), float(y), float(x) + 10, float(y) + 10), "conf": conf, "side": side}


@pytest.mark.parametrize("seed", range(4))
def test_split_equals_loop(spark, seed):
    rng = random.Random(seed)
    dets = []
    for frame in range(120):
        if rng.random() < 0.2:
            continue
        for slot in range(rng.choice((1, 1, 2, 2, 3, 4))):
            dets.append(det(frame, slot, rng.choice((0, 4, 8, 30, 33, 60)) + frame % 3, rng.randint(0, 1), rng.choice((0.5, 0.8, 0.9))))
    got = {(r.frame, r.side): r.slot for r in tr.select_slots(frame_of(spark, dets), block=7).collect()}
    assert got == loop(dets)


def test_state_reaches_over_many_blocks(spark):
    """One hand labelled as the other for a whole clip: only the first label decides."""
    dets = [det(0, 0, 0, 0), det(0, 1, 40, 1)] + [det(f, 0, f * 0.2, 1) for f in range(1, 60)]
    got = {(r.frame, r.side): r.slot for r in tr.select_slots(frame_of(spark, dets), block=5).collect()}
    assert got == loop(dets)


def test_swapped_labels_are_traded_back(spark):
    dets = [det(0, 0, 0, 0), det(0, 1, 40, 1), det(1, 0, 1, 1), det(1, 1, 41, 0)]
    got = {(r.frame, r.side): r.slot for r in tr.select_slots(frame_of(spark, dets)).collect()}
    assert got[(1, 0)] == 0 and got[(1, 1)] == 1


def test_one_box_feeds_one_side(spark):
    dets = [det(0, 0, 0, 0), det(0, 1, 2, 1), det(1, 0, 1, 0)]
    got = {(r.frame, r.side): r.slot for r in tr.select_slots(frame_of(spark, dets)).collect()}
    assert (1, 0) in got and (1, 1) not in got


def clips(spark, n):
    return spark.createDataFrame([(1, n)], "clip long, num_frames int")


def track(spark, dets, n):
    rows = tr.track(frame_of(spark, dets), clips(spark, n), block=6).collect()
    return {(r.frame, r.side): r for r in rows}


def test_weak_candidate_between_anchors_is_recovered(spark):
    got = track(spark, [det(0, 0, 0, 0), det(1, 0, 1, 0, 0.4), det(2, 0, 2, 0)], 4)
    assert got[(1, 0)].valid and got[(1, 0)].recovered and got[(1, 0)].track_id == 0
    assert not got[(3, 0)].valid and got[(3, 0)].track_id == -1 and got[(3, 0)].conf == 0.0
    assert len(got) == 8


def test_weak_candidate_off_the_line_stays_missing(spark):
    got = track(spark, [det(0, 0, 0, 0), det(1, 0, 9, 0, 0.4), det(2, 0, 0, 0)], 3)
    assert not got[(1, 0)].valid


@pytest.mark.parametrize("gap,found", [(4, True), (5, False)])
def test_recovery_gap(spark, gap, found):
    dets = [det(0, 0, 0, 0)] + [det(f, 0, 0, 0, 0.5) for f in range(1, gap + 1)] + [det(gap + 1, 0, 0, 0)]
    assert track(spark, dets, gap + 2)[(2, 0)].valid is found


def test_uneven_sides_are_refused(spark):
    full = tr.dense_frames(clips(spark, 3)).withColumnRenamed("side", "s")
    left, right = full.filter("s = 0").drop("s"), full.filter("s = 1 and frame < 2").drop("s")
    with pytest.raises(Exception, match="differ in length"):
        tr.stack_sides(left, right).collect()


def test_missing_values_do_not_stop_the_selection(spark):
    """A box without a side is adopted, one without confidence or corner stays its side's only pick."""
    dets = [det(0, 0, 0, 0), det(0, 1, 40, 1), det(1, 0, 1, None), {**det(1, 1, 41, 1, None), "box": (None, 0.0, None, 10.0)},
            det(2, 0, 2, 0, None), det(2, 1, 3, 0, 0.1), det(2, 2, 41, None)]
    rows = tr.select_slots(frame_of(spark, dets)).collect()
    assert {(r.frame, r.side): r.slot for r in rows} == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 1, (2, 0): 1}
    bare = next(r for r in rows if (r.frame, r.side) == (1, 1))
    assert bare.conf is None and tuple(bare.box) == (None, 0.0, None, 10.0)


def test_request_rows_are_the_whole_tracks(spark, tmp_path):
    """The rows themselves come out, of the tracker with its state, also beyond the last order of a clip."""
    import duckdb

    from motionweave import catalog

    day = datetime.datetime(1995, 1, 1)
    # order key, side, x, confidence: labels are swapped in frame 1, side 0 is weak in frame 2 and mislabelled in frame 4.
    seen = [(0, 0, 0, 0.9), (0, 1, 40, 0.9), (1, 1, 1, 0.9), (1, 0, 41, 0.9), (2, 0, 2, 0.5), (2, 1, 42, 0.9),
            (3, 0, 3, 0.9), (3, 1, 43, 0.9), (4, 1, 4, 0.9), (4, 1, 44, 0.95), (500, 1, 10, 0.9)]
    spark.createDataFrame(
        [(k, i, side, 1, float(x), 1.0, 0.0, (1 - conf) / 5, "N", "O", day) for i, (k, side, x, conf) in enumerate(seen)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k,) for k in range(4)], "o_orderkey long").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    want = [(0, s, f, 40.0 * s + f, 0.0, 40.0 * s + f + 20, 20.0, 0.5 if (s, f) == (0, 2) else 0.95 if (s, f) == (1, 4) else 0.9, True, 5, 0, 4)
            for s in (0, 1) for f in range(5)] + [(1, 1, 0, 10.0, 0.0, 30.0, 20.0, 0.9, True, 1, 0, 0)]
    got = catalog.queries()["request_rows"](spark, str(tmp_path))
    assert got.columns == ["clip", "side", "frame", "x1", "y1", "x2", "y2", "conf", "det", "rows", "first", "last"]
    assert sorted(map(tuple, got.collect())) == want
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert sorted(con.execute(catalog.oracle_sql()["request_rows"]).fetchall()) == want


@pytest.mark.parametrize("name", ["request_rows", "unpack_detections"])
def test_frames_spread_from_clips_are_not_broadcast(spark, name):
    """Spark sizes a frame table by the clips behind it, so a broadcast would take all frames to the driver."""
    from motionweave import catalog

    rows = catalog.queries()[name](spark, "/root/testdata/sf0.001")
    assert rows.count() > 0
    joins = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if " Join " in f" {line} " and "frame" in line]
    assert joins and all("strategy=merge" in line for line in joins)


@pytest.mark.parametrize("last", [True, False])
def test_owner_windows_are_looked_up_not_spread(spark, last):
    from pyspark.sql import functions as F

    from motionweave.operators import schedule as sc

    spans = [(1, 0, 0, 5), (1, 1, 3, 300), (1, 2, 100, 140), (1, 3, 127, 129), (2, 0, 10, 20), (None, 0, 0, 400)]
    asked = [(c, f, f"{c}-{f}") for c in (1, 2, 3, None) for f in (0, 4, 5, 99, 127, 128, 129, 139, 140, 299, 300, 4, None)]
    win = spark.createDataFrame(spans, "clip int, win int, start int, end int")
    frames = spark.createDataFrame(asked, "clip int, frame int, note string")
    got = sc.owner_window(frames, win, last)
    assert got.columns == ["clip", "frame", "note", "win", "start", "end"]

    def owner(c, f):
        holds = [s[1:] for s in spans if c is not None and f is not None and s[0] == c and s[2] <= f < s[3]]
        return (max if last else min)(holds, default=(None, None, None))

    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted([(c, f, n, *owner(c, f)) for c, f, n in asked], key=key)
    # A window of a hundred million frames is a list entry in each of its blocks, not a row per frame.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan and "explode(sequence(start" not in plan


def test_owner_window_leaves_out_orders_without_customer(spark, tmp_path):
    from motionweave.catalog import windows

    spark.createDataFrame([(1, 200_000.0), (1, 9_000.0), (None, 50_000.0)], "o_custkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    rows = sorted(map(tuple, windows.owner_window(spark, str(tmp_path)).collect()))
    assert rows == [(1, f, min(f // 8, 1), max(0, f // 8 - 1)) for f in range(21)]
