"""Near-duplicate classes by ProbMinHash.

Shingles of five words are weighted by 1 + ln(occurrences). Every shingle is a Poisson process whose rate is its weight;
its arrivals fall on random registers and each register keeps the first arrival it sees. A shingle stops as soon as its
next arrival is later than every register of its text holds. Two texts agree in a register with the probability Jaccard
of their weights, which is the plain Jaccard similarity where weights are equal. Registers are banded, texts sharing a
band are candidates, and a candidate is linked if the plain Jaccard similarity of the shingle sets is 0.8 or more.

Where one text repeats a passage more often than its near copy, the weighted similarity falls far below the plain one.
A text with repeated shingles therefore has a second set of bands, from registers in which every shingle weighs 1; these
are the bands that a text without repeats has anyway. Two texts with plain similarity 0.8 share one with 0.99993.

Texts with one shingle set are one node from the start, so copies cost a row each and no pair. Within a bucket nodes are
held against its most central node first, the one whose buckets are largest, which in a group of near copies is the
common original; a second round takes another pivot per bucket. Nodes that are still apart from others in their bucket
are joined with them by prefix filtering: of two sets that similar, one of the rarest 20 % + 1 shingles of each is
shared, at places that leave enough shingles behind them. No pair within one component is needed, no bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import cut_lineage
from . import graph
from .common import fresh, quoted, text_of
from .textbytes import blocks, mix, offsets_and_bytes, word_hashes

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
_UNIT = 2.0 ** -53


def shingles(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count) of the distinct shingles of a block's texts, by row and hash.

    A text of one to four words has one shingle, all of its words; a text without words has none.
    """
    h, row, _, _ = word_hashes(offsets, data)
    if len(h) == 0:
        return row, h, h.astype(np.int64)
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    counts = np.diff(np.r_[first, len(row)])
    powers = np.uint64(0xD6E8FEB86659FD93) ** np.arange(WORDS, dtype=np.uint64)
    whole = np.zeros(len(h), np.uint64)
    n = len(h) - WORDS + 1
    keep = np.zeros(len(h), bool)
    if n > 0:
        for k in range(WORDS):
            whole[:n] += h[k:n + k] * powers[k]
        keep[:n] = row[:n] == row[WORDS - 1:]
    for k, size in zip(first[counts < WORDS], counts[counts < WORDS], strict=True):
        whole[k] = (h[k:k + size] * powers[:size]).sum(dtype=np.uint64) + np.uint64(size)
        keep[k] = True
    grams, rows = mix(whole[keep]), row[keep]
    order = np.lexsort((grams, rows))
    grams, rows = grams[order], rows[order]
    new = np.r_[True, (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])]
    at = np.flatnonzero(new)
    return rows[at], grams[at], np.diff(np.r_[at, len(grams)])


def signatures(rows: np.ndarray, grams: np.ndarray, weights: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """n x m registers: the shingle whose arrival comes first in each; zero for texts without shingles."""
    when = np.full(n * m, np.inf)
    who = np.zeros(n * m, np.uint64)
    clock = np.zeros(len(rows))
    left = np.arange(len(rows))
    step = 0
    while len(left):
        step += 1
        draw = mix(grams[left] + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64))
        clock[left] -= np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * _UNIT) / weights[left]
        slot = rows[left] * m + (mix(draw) % np.uint64(m)).astype(np.int64)
        np.minimum.at(when, slot, clock[left])
        won = clock[left] == when[slot]
        who[slot[won]] = grams[left[won]]
        latest = when.reshape(n, m).max(axis=1)
        left = left[clock[left] < latest[rows[left]]]
    return who.reshape(n, m)


def _banded(sig: np.ndarray) -> np.ndarray:
    band = np.zeros((len(sig), BANDS), np.uint64)
    for k in range(ROWS):
        band = mix(band * np.uint64(31) + sig[:, k::ROWS])
    return mix(band + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def bands_of(rows: np.ndarray, grams: np.ndarray, counts: np.ndarray, n: int) -> list[np.ndarray]:
    """Distinct band hashes of each of n texts: of its weighted registers and of those with weights of 1."""
    band = _banded(signatures(rows, grams, 1.0 + np.log(counts), n))
    again = np.zeros(n, bool)
    again[rows[counts > 1]] = True
    mine = again[rows]
    plain = _banded(signatures((np.cumsum(again) - 1)[rows[mine]], grams[mine], np.ones(mine.sum()), int(again.sum())))
    out = list(band)
    for k, i in enumerate(np.flatnonzero(again)):
        out[i] = np.union1d(band[i], plain[k])
    return out


def _fingerprints(carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = offsets_and_bytes(batch.column(batch.num_columns - 1))
            for lo, hi in blocks(offsets):
                n = hi - lo
                rows, grams, counts = shingles(offsets[lo:hi + 1], data)
                band = bands_of(rows, grams, counts, n)
                at = np.searchsorted(rows, np.arange(n + 1))
                low = grams.astype(np.uint32)
                key, sets, bands = [], [], []
                for i in range(n):
                    a, b = at[i], at[i + 1]
                    if a == b:
                        key.append(None), sets.append(None), bands.append(None)
                        continue
                    g = grams[a:b]
                    key.append(np.array([g.sum(dtype=np.uint64), mix(g ^ np.uint64(b - a)).sum(dtype=np.uint64)], ">u8").tobytes())
                    sets.append(np.unique(low[a:b]).tobytes())
                    bands.append(band[i])
                kept = [batch.column(i).slice(lo, n) for i in range(len(carry))]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(key, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sets, pa.binary())],
                    names=[*carry, "key", "bands", "grams"])
    return run


def fingerprints(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """(carry..., key, bands, grams) per row: identity of the shingle set, band hashes, the set in 32 bits per shingle."""
    (t,) = fresh(docs, "whole_text")
    source = docs.select(*[F.col(quoted(c)) for c in carry], text_of(text).alias(t))
    kinds = ", ".join(f"{quoted(c)} {docs.schema[c].dataType.simpleString()}" for c in carry)
    return source.mapInArrow(_fingerprints(carry), f"{kinds}, key binary, bands array<bigint>, grams binary")


def _jaccard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ga, gb = batch.column("ga"), batch.column("gb")
        keep, last, left = [], None, None
        for i in range(batch.num_rows):
            x = ga[i].as_buffer()
            if last is None or not x.equals(last):
                last, left = x, np.frombuffer(x, np.uint32)
            right = np.frombuffer(gb[i].as_buffer(), np.uint32)
            small, large = sorted((len(left), len(right)))
            if small < SIMILARITY * large:
                keep.append(False)
                continue
            common = small + large - len(np.union1d(left, right))
            keep.append(common >= SIMILARITY * (small + large - common))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets (key, grams) are similar enough."""
    with_a = pairs.join(sets.select(F.col("key").alias("a"), F.col("grams").alias("ga")), "a")
    with_b = with_a.join(sets.select(F.col("key").alias("b"), F.col("grams").alias("gb")), "b")
    return with_b.select("a", "b", "ga", "gb").mapInArrow(_jaccard, "a binary, b binary")


def _pivot_pairs(members: DataFrame, rank) -> DataFrame:
    """(pivot, member) of every bucket, where they lie in different components; the pivot comes first by `rank`."""
    pivot = members.groupBy("bucket").agg(F.min(F.struct(rank.alias("rank"), "key", "root")).alias("p"))
    joined = members.join(pivot, "bucket").where(F.col("root") != F.col("p")["root"])
    return joined.select(F.least("key", F.col("p")["key"]).alias("a"), F.greatest("key", F.col("p")["key"]).alias("b")).distinct()


def _taken_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, grams in enumerate(batch.column("grams")):
            g = np.frombuffer(grams.as_buffer(), np.uint32).astype(np.int64)
            row = pa.array(np.full(len(g), i))
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(row) for c in ("key", "root", "minor")], pa.array(np.full(len(g), len(g))), pa.array(g)],
                                             names=["key", "root", "minor", "size", "gram"])


def _prefix_pairs(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets (key, root, minor, grams) that may be similar enough, one of them minor, in different components."""
    rows = cut_lineage(sets.select("key", "root", "minor", "grams").mapInArrow(_taken_apart, "key binary, root binary, minor boolean, size bigint, gram bigint"))
    counts = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Shingles of one set only come first in every order and match nothing: they count, but need no row.
    shared = rows.join(counts, "gram")
    lonely = F.col("size") - F.count(F.lit(1)).over(W.partitionBy("key"))
    place = lonely + F.row_number().over(W.partitionBy("key").orderBy("n", "gram"))
    least = F.ceil(F.lit(SIMILARITY) * F.col("size") - F.lit(1e-9))
    prefix = shared.withColumn("place", place).where(F.col("place") <= F.col("size") - least + 1)
    p = prefix.where("minor").select("gram", *[F.col(c).alias("x_" + c) for c in ("key", "root", "size", "place")])
    q = prefix.select("gram", *[F.col(c).alias("y_" + c) for c in ("key", "root", "size", "place")])
    common = F.ceil(F.lit(SIMILARITY / (1 + SIMILARITY)) * (F.col("x_size") + F.col("y_size")) - F.lit(1e-9))
    left = 1 + F.least(F.col("x_size") - F.col("x_place"), F.col("y_size") - F.col("y_place"))
    fit = (F.least("x_size", "y_size") >= F.lit(SIMILARITY) * F.greatest("x_size", "y_size") - F.lit(1e-9)) & (left >= common)
    pairs = p.join(q, (p["gram"] == q["gram"]) & (F.col("x_root") != F.col("y_root")) & fit)
    return pairs.select(F.least("x_key", "y_key").alias("a"), F.greatest("x_key", "y_key").alias("b")).distinct()


def _with_more(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) once more links (a, b) are known."""
    links = cut_lineage(links)
    if links.isEmpty():
        return found
    return cut_lineage(graph.components(links.unionByName(found.select(F.col("node").alias("a"), F.col("root").alias("b")))))


def _rooted(members: DataFrame, found: DataFrame) -> DataFrame:
    rooted = members.drop("root").join(found.select(F.col("node").alias("key"), "root"), "key", "left")
    return cut_lineage(rooted.withColumn("root", F.coalesce("root", "key")))


def roots_of(prints: DataFrame) -> DataFrame:
    """(node, root) of every key that is linked to another: the least key of its component."""
    nodes = prints.where("key is not null").groupBy("key").agg(F.first("bands").alias("bands"))
    rows = nodes.select("key", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut_lineage(rows.join(shared, "bucket").withColumn("root", F.col("key")))
    central = members.groupBy("key").agg(F.sum("n").alias("central"))
    members = cut_lineage(members.join(central, "key"))
    keys = members.select("key").distinct()
    sets = cut_lineage(prints.where("key is not null").select("key", "grams").join(keys, "key", "left_semi").dropDuplicates(["key"]))
    found = graph.components(verified(_pivot_pairs(members, -F.col("central")), sets))
    members = _rooted(members, found)
    found = _with_more(found, verified(_pivot_pairs(members, F.xxhash64("bucket", "key")), sets))
    members = _rooted(members, found)
    # What still lies apart in a bucket: all members outside its largest component against the others.
    sizes = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    apart = members.select("bucket", "key", "root").join(largest.select("bucket", F.col("top")["root"].alias("top")), "bucket")
    apart = apart.groupBy("key", "root").agg(F.bool_or(F.col("root") != F.col("top")).alias("minor"))
    rest = _prefix_pairs(cut_lineage(sets.join(apart, "key")))
    return _with_more(found, verified(rest, sets))


def classes(prints: DataFrame, ident) -> DataFrame:
    """(key, class) for every key of written fingerprints: the least `ident` among the rows of the class."""
    found = roots_of(prints)
    each = prints.where("key is not null").groupBy("key").agg(F.min(ident).alias("least"))
    rooted = each.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    return rooted.join(rooted.groupBy("root").agg(F.min("least").alias("class")), "root").select("key", "class")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, class_id) per row: class_id is the least doc_id of the texts linked to this one, over any number of links.

    Rows with equal shingle sets share a class. Texts without words are alone: their class is their own doc_id, and so
    is that of every text without links. Missing ids are passed over when the least is sought. Repeated rows come back
    repeated; an empty table gives an empty frame.
    """
    prints = cut_lineage(fingerprints(docs, [doc_id], text))
    found = classes(prints, F.col(doc_id))
    out = prints.select(doc_id, "key").join(found, "key", "left")
    return out.select(F.col(doc_id), F.when(F.col("key").isNull(), F.col(doc_id)).otherwise(F.col("class")).alias("class_id"))


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of the frame without near duplicates: of each class the row with the least id stays.

    Texts without words all stay. Of rows that agree in id and text one stays.
    """
    ident, digest = fresh(docs, "row_id", "row_digest")
    named = docs.select("*", F.coalesce(F.concat(F.lit("="), F.col(doc_id).cast("string")), F.lit("-")).alias(ident), F.md5(text_of(text)).alias(digest))
    prints = cut_lineage(fingerprints(named, [doc_id, ident, digest], text))
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(digest).alias("digest"), F.col(ident).alias("ident"))
    stay = classes(prints, order).select(F.col("class")["ident"].alias("stay_id"), F.col("class")["digest"].alias("stay_digest")).distinct()
    wordless = prints.where("key is null").select(F.col(ident).alias("stay_id"), F.col(digest).alias("stay_digest")).distinct()
    stay = stay.unionByName(wordless)
    kept = named.join(stay, (F.col(ident) == F.col("stay_id")) & (F.col(digest) == F.col("stay_digest")), "left_semi")
    return kept.dropDuplicates([ident, digest]).select(*docs.columns)
