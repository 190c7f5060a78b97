"""Mixing sources to target weights with hash-threshold histograms.

Every row has a hash. The words of a source are summed by hash bucket, the running sum finds the bucket in which the
source's budget runs out, and only the rows of that one bucket are summed again by the next bits of the hash. Three
rounds of 4096 buckets leave a boundary of about one row; rows below the threshold are taken. Nothing is sorted but
the histograms, and thresholds of a smaller budget select a subset of those of a larger one.

Rows that agree in id and text have one hash and are taken together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import cut_lineage
from .common import fresh, nullable_key, quoted, text_of, words_of
from .ordered import ROW_BITS, laid

WEIGHTS = (5, 2, 1)
SHARE = 1.5     # of all words
MOST = 2.0      # times a source's own size
BITS, ROUNDS, HASH_BITS = 12, 3, 60


def sized(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The frame with (key, size, hash) of each row; a missing text has no words."""
    key, size, h = fresh(docs, "mix_key", "mix_size", "mix_hash")
    named = F.concat(F.coalesce(F.col(quoted(doc_id)).cast("string"), F.lit("")), F.lit("\n"), F.md5(text_of(text)))
    return docs.select(
        "*", nullable_key(source).alias(key), F.size(words_of(text_of(text))).cast("long").alias(size),
        F.conv(F.substring(F.md5(named), 1, HASH_BITS // 4), 16, 10).cast("long").alias(h))


def targets(rows: DataFrame) -> DataFrame:
    """(key, source_size, target) per source, from rows with (key, size).

    Weights go round by the sources' code-point order, a missing source last. The budget is shared by weight; a source
    stops at MOST times its size and the rest is shared again, which ends at one common level per unit of weight.
    """
    each = rows.groupBy("key").agg(F.sum("size").alias("source_size"))
    named = _summed_before(laid(each, F.col("key") == "-", "key").withColumn("one", F.lit(1)), "one")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("one_before") % len(WEIGHTS) + 1).cast("int"))
    capped = named.select("key", "source_size", weight.alias("weight"), (F.lit(MOST) * F.col("source_size")).alias("cap"))
    full = F.col("cap") / F.col("weight")
    by_ratio = _summed_before(laid(capped, full, "key"), "cap", "weight")
    all_of = by_ratio.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    level = by_ratio.withColumn("level", (F.lit(SHARE) * F.lit(all_of["words"]) - F.col("cap_before")) / (F.lit(all_of["weight"]) - F.col("weight_before")))
    # The first source, by words a weight, that the common level does not fill; it and all after it share that level.
    free = level.where(F.col("level") < full).agg(F.min(F.struct("at", "level")).alias("first")).first()["first"]
    if free is None:
        return level.select("key", "source_size", F.col("cap").alias("target"))
    return level.select("key", "source_size", F.when(
        F.col("at") >= free["at"], F.lit(free["level"]) * F.col("weight")).otherwise(F.col("cap")).alias("target"))


def _summed_before(rows: DataFrame, *columns: str) -> DataFrame:
    """Add `<column>_before`, the sum over all rows before by ``at``: within the range, plus the sums of earlier ranges.

    Only the ranges, as many as there are shuffle partitions, meet in one window.
    """
    rows = rows.withColumn("range", F.shiftright("at", ROW_BITS))
    earlier = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    near, far = earlier(W.partitionBy("range").orderBy("at")), earlier(W.orderBy("range"))
    ranges = rows.groupBy("range").agg(*[F.sum(c).alias(c) for c in columns])
    starts = ranges.select("range", *[F.sum(c).over(far).alias(f"{c}_start") for c in columns])
    none = F.lit(0)
    return rows.join(starts, "range").select("*", *[
        (F.coalesce(F.sum(c).over(near), none) + F.coalesce(f"{c}_start", none)).alias(f"{c}_before") for c in columns])


def thresholds(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """(key, source_size, target, copies, below): rows with a hash under `below` get one copy more than `copies`."""
    fits = F.col("target") >= F.col("source_size")
    state = cut_lineage(goal).select(
        "*", F.when(fits, 1).otherwise(0).cast("long").alias("copies"),
        F.when(fits, F.col("target") - F.col("source_size")).otherwise(F.col("target")).alias("left"),
        F.lit(0).cast("long").alias("prefix"), F.lit(True).alias("open"))
    shift = HASH_BITS
    for _ in range(ROUNDS):
        shift -= BITS
        inside = rows.join(state.where("open").select("key", "prefix"), "key").where(
            F.shiftright("hash", shift + BITS) == F.col("prefix"))
        hist = inside.groupBy("key", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        run = hist.join(state.select("key", "left"), "key").withColumn(
            "cum", F.sum("words").over(W.partitionBy("key").orderBy("bucket")))
        edge = run.where(F.col("cum") > F.col("left")).groupBy("key").agg(
            F.min(F.struct("bucket", (F.col("left") - (F.col("cum") - F.col("words"))).alias("rest"), "words")).alias("edge"))
        # One row per source: written, so that each round reads it instead of planning all rounds before.
        state = cut_lineage(state.join(edge, "key", "left").select(
            "key", "source_size", "target", "copies",
            F.when(F.col("edge").isNotNull(), F.col("edge")["rest"]).otherwise(F.col("left")).alias("left"),
            F.when(F.col("edge").isNotNull(), F.col("edge")["bucket"])
            .when(F.col("open"), F.shiftleft(F.col("prefix") + 1, BITS))
            .otherwise(F.shiftleft("prefix", BITS)).alias("prefix"),
            (F.col("open") & F.col("edge").isNotNull()).alias("open"),
            F.when(F.col("edge").isNotNull(), F.col("edge")["words"]).otherwise(0).alias("words")))
    # the last bucket is taken whole if that comes nearer to the budget
    near = F.col("open") & (2 * F.col("left") >= F.col("words"))
    # Written, so that Spark knows its size when it plans the join, and moves the rows only if there are too many sources.
    return cut_lineage(state.select(
        "key", "source_size", "target", "copies",
        F.shiftleft(F.col("prefix") + F.when(near, 1).otherwise(0), shift).alias("below")))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The frame with a column `mix`: size, source_size, target of the source, copies taken of the row.

    One row out per row in. Sources without words get target 0. Missing sources are one source; missing ids hash by
    their text. An empty table gives an empty frame.
    """
    rows = sized(docs, text, doc_id, source)
    key, size, h = rows.columns[-3:]
    slim = cut_lineage(rows.select(F.col(key).alias("key"), F.col(size).alias("size"), F.col(h).alias("hash")))
    limit = thresholds(slim, targets(slim))
    return _decide(rows, limit, docs.columns, key, size, h)


def mix_slim(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """As `mix`, but of the id alone: the texts are read once and not carried on."""
    rows = sized(docs.select(*[F.col(quoted(c)) for c in (doc_id, text, source)]), text, doc_id, source)
    key, size, h = rows.columns[-3:]
    slim = cut_lineage(rows.select(F.col(quoted(doc_id)), F.col(key).alias("key"), F.col(size).alias("size"), F.col(h).alias("hash")))
    limit = thresholds(slim.select("key", "size", "hash"), targets(slim))
    return _decide(slim, limit, [doc_id], "key", "size", "hash")


def _decide(rows: DataFrame, limit: DataFrame, keep: list[str], key: str, size: str, h: str) -> DataFrame:
    (name,) = fresh(rows, "mix")
    limit = limit.select(*[F.col(c).alias("lim_" + c) for c in limit.columns])
    joined = rows.join(limit, F.col(key) == F.col("lim_key"))
    copies = F.col("lim_copies") + F.when(F.col(h) < F.col("lim_below"), 1).otherwise(0)
    return joined.select(*[rows[quoted(c)] for c in keep], F.struct(
        F.col(size).alias("size"), F.col("lim_source_size").alias("source_size"), F.col("lim_target").alias("target"),
        copies.alias("copies")).alias(name))
