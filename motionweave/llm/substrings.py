"""Removal of long repeated substrings, exact over the whole corpus, by sampled and induced suffix sorting.

In every stretch of LENGTH bytes the k-gram with the least hash, the leftmost of equals, is its anchor. Equal stretches
have equal anchors at equal places, so only suffixes that start at an anchor, one in about 140 bytes, are sampled and
named (by the hash of their k-gram); names that occur once are done. Stretches with one anchor form a run. Runs whose
whole strings have a twin are repeated from end to end. Of runs that share the name only, one of each kind is sorted:

* names are dealt to shards of bounded size; in a shard the suffixes at anchors are sorted by their bytes, with the
  length of the prefix that each shares with the one before (LCP);
* the order of the suffixes one byte further left follows by induction: they sort by (name, byte, rank of the suffix to
  the right), and their LCP is one more than the least LCP between those ranks. So the tuples (byte, rank, LCP) are
  carried left, a byte a step, and a stretch is repeated where the LCP with a neighbour reaches LENGTH.

A name with so many kinds of runs that a shard could not hold them is counted stretch by stretch instead, with partial
sums, so that no group has to fit one task. Spark's shuffle is the disk-backed queue between the steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .common import fresh, quoted, settle, text_of
from .textbytes import blocks, mix, offsets_and_bytes, prefix_hash, span_hash

LENGTH = 400
GRAM = 32
SHARD = 16_384       # runs sorted together, about
CROWD = 8_192        # kinds of runs of one name beyond which it is counted instead of sorted


def _sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Least of every w neighbours: running minima from both ends of blocks of w."""
    n = len(h) - w + 1
    padded = np.full(-(-len(h) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(h)] = h
    table = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def runs_of(offsets: np.ndarray, data: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, anchor, first, last, name, run_name): stretches first..last of a text have the k-gram at anchor as theirs.

    Positions count from the start of the text; texts shorter than `length` have no stretch and no run.
    """
    w = length - gram + 1
    empty = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(data) < length:
        return empty
    prefix = prefix_hash(data)
    at = np.arange(len(data) - gram + 1)
    h = span_hash(prefix, at, at + gram)
    least = _sliding_min(h, w)
    valid = np.zeros(len(least) + 1, bool)
    for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
        if hi - lo >= length:
            valid[lo:hi - length + 1] = True
            if hi - length + 1 < len(valid):
                valid[hi - length + 1] = False
    valid = valid[:-1]
    begin = np.zeros(len(least), bool)
    begin[0] = True
    begin[1:] = (h[:len(least) - 1] == least[:-1]) | (least[1:] != least[:-1]) | ~valid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(begin)]
    begin[inner] = True
    first = np.flatnonzero(begin & valid)
    if len(first) == 0:
        return empty
    view = np.lib.stride_tricks.sliding_window_view(h, w)
    anchor = np.concatenate([first[i:i + 2048] + np.argmin(view[first[i:i + 2048]], axis=1) for i in range(0, len(first), 2048)])
    row = np.searchsorted(offsets, first, side="right") - 1
    stop = offsets[row + 1] - length
    last = np.minimum(np.r_[first[1:] - 1, len(least)], stop)
    name = span_hash(prefix, anchor, anchor + gram)
    run = mix(span_hash(prefix, first, last + length) + (anchor - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    start = offsets[row]
    return row, anchor - start, first - start, last - start, name.view(np.int64), run.view(np.int64)


def _runs(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = offsets_and_bytes(batch.column(1))
            keys = batch.column(0)
            for lo, hi in blocks(offsets):
                base = offsets[lo]
                row, anchor, first, last, name, run_name = runs_of(offsets[lo:hi + 1] - base, data[base:offsets[hi]], length, gram)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(row + lo)), *[pa.array(x.astype(np.int32)) for x in (anchor, first, last)], pa.array(name), pa.array(run_name)],
                    names=["digest", "anchor", "first", "last", "name", "run"])
    return run


def _stretches(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = offsets_and_bytes(batch.column(0))
            for i, reps in enumerate(batch.column(1)):
                prefix = prefix_hash(data[offsets[i]:offsets[i + 1]])
                for rep in reps.as_py():
                    p = np.arange(rep["first"], rep["last"] + 1)
                    n = len(p)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, rep["name"])), pa.array(np.full(n, rep["run"])), pa.array(p - rep["anchor"]),
                         pa.array(span_hash(prefix, p, p + length).view(np.int64))], names=["name", "run", "at", "stretch"])
    return run


def _run_bytes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = offsets_and_bytes(batch.column(1))
            for i, reps in enumerate(batch.column(2)):
                reps, whole = reps.as_py(), data[offsets[i]:offsets[i + 1]].tobytes()
                get = lambda c: [r[c] for r in reps]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.full(len(reps), i))), *[pa.array(get(c), pa.int64()) for c in ("name", "anchor", "first", "last")],
                     pa.array(get("single"), pa.bool_()), pa.array([whole[r["first"]:r["last"] + length] for r in reps], pa.binary())],
                    names=["digest", "name", "anchor", "first", "last", "single", "bytes"])
    return run


def induced(group: np.ndarray, left: np.ndarray, n_left: np.ndarray, right: np.ndarray, n_right: np.ndarray, length: int) -> np.ndarray:
    """hit[i, o]: the string of `length` bytes that starts o bytes left of anchor i also starts o bytes left of another
    anchor of its group. left (nearest byte first) and right hold the bytes around the anchors, as far as n_left, n_right.
    """
    n = len(group)
    hit = np.zeros((n, left.shape[1] + 1), bool)
    words = np.zeros((n, -(-right.shape[1] // 8) * 8), np.uint8)
    words[:, :right.shape[1]] = right
    keys = words.view(">u8").astype(np.uint64)
    order = np.lexsort([n_right, *keys.T[::-1], group])
    same = group[order][1:] == group[order][:-1]
    differs = right[order][1:] != right[order][:-1]
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), right.shape[1])
    lcp = np.zeros(n, np.int64)
    lcp[1:] = np.where(same, np.minimum(first, np.minimum(n_right[order][1:], n_right[order][:-1])), 0)
    for o in range(left.shape[1] + 1):
        if o:
            at = np.flatnonzero(n_left[order] >= o)
            if len(at) < 2:
                break
            moved = order[at]
            key = group[moved].astype(np.int64) * 256 + left[moved, o - 1]
            turn = np.argsort(key, kind="stable")
            key, at = key[turn], at[turn]
            new = np.zeros(len(at), np.int64)
            pair = np.flatnonzero(key[1:] == key[:-1]) + 1
            if len(pair):
                span = np.stack([at[pair - 1] + 1, at[pair] + 1], axis=1).ravel()
                new[pair] = 1 + np.minimum.reduceat(np.r_[lcp, 0], span)[::2]
            order, lcp = moved[turn], new
        long = lcp >= length
        hit[order[long], o] = True
        hit[order[:-1][long[1:]], o] = True
    return hit


def _sorter(length: int):
    kinds = pa.schema([("digest", pa.binary()), ("start", pa.int64()), ("end", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        col = lambda c: table[c].to_numpy()
        anchor, first, last = col("anchor"), col("first"), col("last")
        n, before, after = len(anchor), anchor - first, last + length - anchor
        left, right = np.zeros((n, int(before.max())), np.uint8), np.zeros((n, int(after.max())), np.uint8)
        for i, raw in enumerate(table["bytes"].to_pylist()):
            b = np.frombuffer(raw, np.uint8)
            left[i, :before[i]] = b[:before[i]][::-1]
            right[i, :after[i]] = b[before[i]:]
        group = np.unique(col("name"), return_inverse=True)[1]
        hit = induced(group, left, before, right, after, length)
        hit &= table["single"].to_numpy(zero_copy_only=False)[:, None]
        edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, lo = np.nonzero(edge == 1)
        _, hi = np.nonzero(edge == -1)
        return pa.table([table["digest"].take(pa.array(row)), pa.array(anchor[row] - hi + 1), pa.array(anchor[row] - lo + length)], schema=kinds)
    return run


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Union of spans (start, end) as maximal spans in order."""
    out: list[list[int]] = []
    for s, e in sorted(map(tuple, spans)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _remove(carry: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(carry), batch.column(carry + 1)
            rows = []
            for i in range(batch.num_rows):
                raw = texts[i].as_py().encode()
                cuts = merged([(x["start"], x["end"]) for x in spans[i].as_py() or []])
                keep, at = [], 0
                for s, e in cuts:
                    keep.append(raw[at:s])
                    at = e
                keep.append(raw[at:])
                left = b"".join(keep)
                rows.append((len(raw), len(raw) - len(left), [{"start": s, "end": e} for s, e in cuts], hashlib.sha256(left).hexdigest(),
                             left if with_text else None))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.binary())
            made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(carry)], *made],
                                             names=[*batch.schema.names[:carry], "n_bytes", "n_removed", "spans", "kept_sha256", "kept"])
    return run


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(digest, spans) of texts (digest, whole) that hold a repeated stretch; spans may overlap."""
    runs = cut_lineage(texts.mapInArrow(_runs(length, gram), "digest binary, anchor int, first int, last int, name bigint, run bigint"))
    twins = runs.groupBy("name", "run").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("digest", "anchor", "first", "last")).alias("rep"))
    names = twins.groupBy("name").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds")).where("all > 1")
    shared = cut_lineage(twins.join(names, "name").select("name", "run", "n", "kinds", "rep.*"))
    settle(texts)
    # Runs that share a name but differ somewhere, one representative of each kind, with their bytes.
    apart = shared.where("kinds > 1")
    reps = apart.groupBy("digest").agg(F.collect_list(F.struct(
        "name", "run", "anchor", "first", "last", (F.col("n") == 1).alias("single"), (F.col("kinds") > crowd).alias("crowd"))).alias("reps"))
    once = texts.join(reps, "digest").dropDuplicates(["digest"])
    split = lambda flag: F.filter("reps", lambda r: r["crowd"] == F.lit(flag)).alias("reps")
    once = cut_lineage(once.select("digest", split(False), split(True).alias("crowds"), "whole"))
    settle(texts)
    sorted_reps = once.where(F.size("reps") > 0).select("digest", "whole", "reps").mapInArrow(
        _run_bytes(length), "digest binary, name bigint, anchor bigint, first bigint, last bigint, single boolean, bytes binary")
    shards = -(-max(1, apart.count()) // SHARD)
    spans = cut_lineage(sorted_reps.groupBy(F.pmod(F.xxhash64("name"), F.lit(shards)).alias("shard")).applyInArrow(
        _sorter(length), "digest binary, start bigint, end bigint"))
    settle(texts)
    spans = spans.unionByName(_counted(once.where(F.size("crowds") > 0).select("whole", F.col("crowds").alias("reps")), apart, length))
    whole = runs.join(shared.where("n > 1").select("name", "run"), ["name", "run"], "left_semi").select(
        "digest", F.col("first").cast("bigint").alias("start"), (F.col("last") + length).cast("bigint").alias("end"))
    found = cut_lineage(whole.unionByName(spans).groupBy("digest").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    settle(texts)
    return found


def _counted(texts: DataFrame, apart: DataFrame, length: int) -> DataFrame:
    """Spans (digest, start, end) of the runs `reps` of texts, by counting the hashes of their stretches."""
    parts = cut_lineage(texts.mapInArrow(_stretches(length), "name bigint, run bigint, at bigint, stretch bigint"))
    again = parts.groupBy("name", "stretch").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name", "stretch")
    found = parts.join(again, ["name", "stretch"], "left_semi").groupBy("name", "run").agg(F.sort_array(F.collect_list("at")).alias("ats"))
    some = apart.where("n = 1").join(found, ["name", "run"])
    # Consecutive stretches share a value of at - index, which names their interval.
    return some.select("digest", "anchor", F.posexplode("ats").alias("i", "at")).groupBy(
        "digest", "anchor", (F.col("at") - F.col("i")).alias("island")).agg(
        (F.col("anchor") + F.min("at")).alias("start"), (F.col("anchor") + F.max("at") + length).alias("end")).select("digest", "start", "end")


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256, kept) per row.

    Every byte that a repeated string of `length` bytes covers is removed: one that starts at another place of the same
    text, of another text, or of a repeated row. `spans` are the maximal removed runs in bytes, `kept` the remaining
    bytes (null unless `with_text`; a cut may fall inside a character). Missing texts are empty, texts shorter than
    `length` stay whole, an empty table gives an empty frame.
    """
    digest, whole = fresh(docs, "digest", "whole")
    texts = docs.select(F.unhex(F.md5(text_of(text))).alias("digest"), text_of(text).alias("whole"))
    spans = repeated_spans(texts, length).withColumnRenamed("digest", "span_digest")
    rows = docs.select(F.col(quoted(doc_id)).alias("id"), F.unhex(F.md5(text_of(text))).alias(digest), text_of(text).alias(whole))
    joined = rows.join(spans, F.col(digest) == F.col("span_digest"), "left").select("id", whole, "spans")
    kind = docs.schema[doc_id].dataType.simpleString()
    done = joined.mapInArrow(_remove(1, with_text), f"id {kind}, n_bytes bigint, n_removed bigint, "
                             "spans array<struct<start:bigint,end:bigint>>, kept_sha256 string, kept binary")
    return done.withColumnRenamed("id", doc_id)
