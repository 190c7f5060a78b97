"""Prefix trie of conversations by time-forward processing: subtree totals travel to parents through spilling queues.

A node is a sequence of turns that some conversation starts with. Its identity is a 128-bit digest of the depth and of the
running sums of the turns' own digests, so it needs no walk from the root. Nodes are dealt into shards that are connected
pieces of the tree: a piece holds nodes whose numbers of members have the same magnitude (between two powers of ``SPAN``)
and lie in one band of ``SPAN`` depths, hence at most ``SPAN`` * ``SPAN`` nodes, whatever the hottest prefix. Inside a
shard nodes are sorted by reverse level order; each takes what waits for it in a priority queue that spills to disk and
sends its own total on to its parent. Totals of shard roots are summed by the parent they hang on and enter that parent's
shard as messages, deeper and smaller shards first. Tails with a single member need no passing: one leaf, nothing saved.
"""

from __future__ import annotations

import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .ordered import digests, laid, placed

SPAN = 1024
BLOCK = 4096  # a multiple of SPAN
QUEUE = 100_000
ENDS_BITS = 12
HEAD = 5
PARTS = ("p1", "p2", "p3", "p4")
TOTALS = "node binary, parent binary, top boolean, n_leaves bigint, saved bigint"


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, chars): every turn as a digest of role and text, numbered from 0 by turn, missing ones first.

    Missing roles and texts are empty. Equal turn numbers are ordered by the digest. Rows without a conv_id belong to no
    conversation. Other columns are ignored.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    slim = turns.where("conv_id is not null").select(
        "conv_id", "turn", F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.length(text).cast("long").alias("chars"))
    return placed(laid(slim, "conv_id", "turn", "digest"), "conv_id", "pos").select("conv_id", "pos", "digest", "chars")


def with_shared_heads(ordered: DataFrame, group: Column, length: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``length`` (at most ``HEAD``) turns are replaced by those of conversation ``group``.

    Returns the turns as ``ordered_turns`` gives them, and (conv_id) of all conversations, also those left without a turn.
    """
    convs = ordered.select("conv_id").distinct().withColumn("_base", group).withColumn("_h", length.cast("int"))
    heads = ordered.where(F.col("pos") < HEAD).groupBy(F.col("conv_id").alias("_base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("_head"))
    convs = cut_lineage(convs.join(heads, "_base", "left").select(
        "conv_id", "_h", F.when(F.col("_h") > 0, F.slice("_head", 1, F.greatest("_h", F.lit(1)))).alias("_head")))
    first = convs.select("conv_id", F.inline("_head")).select("conv_id", "pos", "digest", "chars")
    own = ordered.join(convs.select("conv_id", "_h", F.coalesce(F.size("_head"), F.lit(0)).alias("_m")), "conv_id")
    rest = own.where("pos >= _h").select("conv_id", (F.col("pos") - F.col("_h") + F.col("_m")).alias("pos"), "digest", "chars")
    return first.unionByName(rest), convs.select("conv_id")


def _key(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast("string") for s in sums])))


def _paths(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, node, parent, chars): each turn with the node it ends in; long conversations are summed by block."""
    own = F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("digest")))
    rows = turns.withColumn("_own", own).withColumns(
        {p: F.conv(F.substring("_own", 8 * i + 1, 8), 16, 10).cast("long") for i, p in enumerate(PARTS)}).withColumn(
        "_block", F.floor(F.col("pos") / BLOCK)).drop("_own", "digest")
    inside = Window.partitionBy("conv_id", "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"_{p}": F.sum(p).over(inside) for p in PARTS})
    long = turns.where(F.col("pos") == BLOCK).select("conv_id")
    sums = rows.join(long, "conv_id", "left_semi").groupBy("conv_id", "_block").agg(*[F.sum(p).alias(p) for p in PARTS])
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv_id", "_block", *[F.sum(p).over(before).alias(f"_in_{p}") for p in PARTS])
    rows = rows.join(carried, ["conv_id", "_block"], "left")
    total = [F.col(f"_{p}") + F.coalesce(f"_in_{p}", F.lit(0)) for p in PARTS]
    return rows.select("conv_id", "pos", _key(F.col("pos") + 1, total).alias("node"),
                       _key(F.col("pos"), [t - F.col(p) for t, p in zip(total, PARTS)]).alias("parent"), "chars")


class SpillingQueue:
    """A priority queue of tuples; beyond ``limit`` it writes its heap as a sorted run to a nameless scratch file."""

    def __init__(self, limit: int = QUEUE, page: int = 1024):
        self.limit, self.page = limit, page
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # (item, run) of the runs on disk
        self.runs: list[Iterator[tuple]] = []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) >= self.limit:
            self._spill()

    def _spill(self) -> None:
        self.heap.sort()
        file = tempfile.TemporaryFile()
        for i in range(0, len(self.heap), self.page):
            pickle.dump(self.heap[i:i + self.page], file, pickle.HIGHEST_PROTOCOL)
        file.seek(0)
        self.heap = []
        self.runs.append(self._read(file))
        self._advance(len(self.runs) - 1)

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: int) -> None:
        item = next(self.runs[run], None)
        if item is not None:
            heapq.heappush(self.heads, (item, run))

    def take(self, key: tuple) -> Iterator[tuple]:
        """Remove and give all items that start with the key; smaller ones have been taken before."""
        n = len(key)
        while self.heap and self.heap[0][:n] == key:
            yield heapq.heappop(self.heap)
        while self.heads and self.heads[0][0][:n] == key:
            item, run = heapq.heappop(self.heads)
            self._advance(run)
            yield item


def _forward(limit: int):
    """Totals of the nodes of a shard, which arrive deepest first; parents in the same shard get them from the queue."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(limit)
        for batch in batches:
            out_leaves, out_saved = [], []
            cols = [batch.column(c).to_pylist() for c in ("depth", "node", "parent", "top", "leaves", "saved")]
            for depth, node, parent, top, leaves, saved in zip(*cols):
                for item in queue.take((-depth, node)):
                    leaves += item[2]
                    saved += item[3]
                if not top:
                    queue.push((1 - depth, parent, leaves, saved))
                out_leaves.append(leaves)
                out_saved.append(saved)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("parent"), batch.column("top"), pa.array(out_leaves, pa.int64()),
                 pa.array(out_saved, pa.int64())], names=["node", "parent", "top", "n_leaves", "saved"])

    return step


def _pieces(paths: DataFrame, nodes: DataFrame, span: int) -> DataFrame:
    """The nodes with magnitude, band, whether they start a piece, and the node that starts it: from the least member's path."""
    rows = paths.join(nodes, "node")
    part = Window.partitionBy("conv_id", F.floor(F.col("pos") / BLOCK)).orderBy("pos")
    top = (F.col("pos") % span == 0) | (F.lag("rank").over(part) != F.col("rank"))
    rows = rows.withColumn("top", top).withColumn("piece", F.last(F.when(F.col("top"), F.col("node")), True).over(
        part.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.where("conv_id = least").select(
        "node", "parent", (F.col("pos") + 1).alias("depth"), "conv_id", "n_convs", "chars", "rank",
        F.floor(F.col("pos") / span).alias("band"), "top", "piece")


def prefix_trie(turns: DataFrame, convs: DataFrame, span: int = SPAN, limit: int = QUEUE) -> DataFrame:
    """One row per node of the trie of conversations.

    ``turns`` is (conv_id, pos, digest, chars) with pos gapless from 0, ``convs`` (conv_id) of all conversations, distinct;
    those without turns are members of the root only. Returns conv_id (least member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens (characters that members beyond the first need not repeat, over the subtree) and
    ends_sha256 (of the ids of the members that end here). No conversations: no rows. Prefixes count as equal if their
    128-bit digests are.

    Shards are settled one (magnitude, band) after the other. Their number grows with the logarithm of the members and with
    the deepest prefix that two conversations share, divided by ``span``.
    """
    if BLOCK % span:
        raise ValueError(f"span must divide {BLOCK}")
    paths = cut_lineage(_paths(turns))
    zero = _key(F.lit(0), [F.lit(0)] * 4)
    # A rank is the highest power of the span that a node's members exceed.
    rank = F.ceil(F.log(F.col("n_convs").cast("double")) / F.log(F.lit(float(span)))).cast("int")
    nodes = paths.groupBy("node").agg(F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("n_convs")).withColumn("rank", rank)
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        zero.alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
        F.lit(0).cast("long").alias("chars"), (rank + 1).alias("rank"), F.lit(-1).cast("long").alias("band"), F.lit(True).alias("top"),
        zero.alias("piece"))
    tree = cut_lineage(_pieces(paths, nodes, span).unionByName(root))
    children = cut_lineage(tree.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("_single")))

    shared = tree.where("n_convs > 1").join(children, "node", "left").select(
        "node", "parent", "depth", "rank", "band", "top", "piece",
        F.coalesce("_single", F.when(F.col("n_children").isNull(), 1), F.lit(0)).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    shared = cut_lineage(shared)
    stages = sorted(((r["rank"], r["band"]) for r in shared.select("rank", "band").distinct().collect()), key=lambda s: (s[0], -s[1]))
    done: list[DataFrame] = []
    for r, b in stages:
        here = shared.where((F.col("rank") == r) & (F.col("band") == b))
        if done:
            sent = _union(done).where("top").groupBy(F.col("parent").alias("node")).agg(
                F.sum("n_leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
            here = here.join(sent, "node", "left").withColumn("leaves", F.col("leaves") + F.coalesce("_leaves", F.lit(0))).withColumn(
                "saved", F.col("saved") + F.coalesce("_saved", F.lit(0)))
        shard = here.repartition("piece").sortWithinPartitions(F.desc("depth"), "node")
        done.append(cut_lineage(shard.select("depth", "node", "parent", "top", "leaves", "saved").mapInArrow(_forward(limit), TOTALS)))

    last = paths.groupBy("conv_id").agg(F.max_by("node", "pos").alias("node"))
    ends = convs.join(last, "conv_id", "left").select(F.coalesce("node", zero).alias("node"), "conv_id")
    chunks = ends.groupBy("node", F.shiftright("conv_id", ENDS_BITS).alias("_chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("_ids"))
    hashes = digests(chunks, "node", ["_chunk"], "_ids", "ends_sha256")

    above = tree.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = tree.join(children, "node", "left").join(hashes, "node", "left").join(above, "parent", "left")
    if done:
        out = out.join(_union(done).select("node", "n_leaves", "saved"), "node", "left")
    else:
        out = out.withColumn("n_leaves", F.lit(None).cast("long")).withColumn("saved", F.lit(None).cast("long"))
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
