"""Shards of near equal bytes by histogram sort: exact bytes below candidate boundaries, refined until the splitters are close enough.

Documents are ordered by a fixed-width hexadecimal key: digest of the text, digest of the id, number of the row, so equal
texts stand next to each other and a key of any weight can be cut. A splitter starts with all keys; every round divides the
stretch it lies in by the next ``DIGITS`` digits, counts the bytes below each of these probes exactly, and either takes the
nearest one, if it is within the tolerance, or goes on in the stretch between two probes. Only rows of such stretches are
counted again. Then rows are exchanged once, by range of the key, and numbered within their shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .ordered import laid, placed

SHARDS = 40
DIGITS = 3
PART = 12  # digits of the text, of the id, of the row
OVERHEAD = 16
TOLERANCE = 0.001


def slim(docs: DataFrame, ident: str = "doc_id") -> DataFrame:
    """(ident, size, text_crc32, key): bytes of the text plus ``OVERHEAD``, its check sum, and the place in the order.

    A missing text is empty. Rows with equal text and id are told apart by a number that only decides which of them stands
    first.
    """
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    name = F.coalesce(F.col(ident).cast("string"), F.lit(""))
    row = F.sha1(F.monotonically_increasing_id().cast("string").cast("binary"))
    key = F.concat(F.substring(F.md5(data), 1, PART), F.substring(F.md5(F.encode(name, "UTF-8")), 1, PART), F.substring(row, 1, PART))
    return docs.select(F.col(ident), (F.octet_length(data) + OVERHEAD).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
                       key.alias("key"))


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[str]:
    """First keys (prefixes of keys) of the shards from the second on; "g" is beyond every key.

    ``tolerance`` is a share of the mean shard. What reaches the driver is one row per splitter and round.
    """
    total = rows.agg(F.sum("size")).first()[0]
    if not total:
        return ["g"] * (shards - 1)
    # Bytes below are compared with i / shards of all bytes in whole numbers: both sides times the number of shards.
    open_ = {i: ("", 0) for i in range(1, shards)}  # splitter: the stretch it lies in and the bytes below that stretch
    found: dict[int, str] = {}
    width = 0
    while open_:
        below = {prefix: b for prefix, b in open_.values()}
        head, probe = F.substring("key", 1, width), F.substring("key", 1, width + DIGITS)
        part = rows if width == 0 else rows.where(head.isin(list(below)))
        counts = part.groupBy(head.alias("head"), probe.alias("probe")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        run = Window.partitionBy("head").orderBy("probe").rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("to", F.sum("bytes").over(run))
        goals = rows.sparkSession.range(1).select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("i"), F.lit(prefix).alias("head"), F.lit(total * i - shards * b).cast("long").alias("goal"))
            for i, (prefix, b) in open_.items()])))
        inside = F.col("to") * shards >= F.col("goal")
        began = (F.col("to") - F.col("bytes")) * shards < F.col("goal")
        hit = counts.join(F.broadcast(goals), "head").where(inside & began)
        for r in hit.select("i", "head", "probe", "bytes", "to", "n").collect():
            start = below[r["head"]] + r["to"] - r["bytes"]
            over, under = shards * (start + r["bytes"]) - total * r["i"], total * r["i"] - shards * start
            last = r["n"] == 1 or width + DIGITS >= 3 * PART  # nothing left to cut
            if min(over, under) <= tolerance * total or last:
                # The key after this probe's rows: the probe itself with its last digit raised.
                found[r["i"]] = r["probe"] if under <= over else _after(r["probe"])
                del open_[r["i"]]
            else:
                open_[r["i"]] = (r["probe"], start)
        width += DIGITS
    return [found[i] for i in range(1, shards)]


def _after(prefix: str) -> str:
    """The least string of digits above all keys that start with the prefix."""
    n = int(prefix, 16) + 1
    return "g" if n == 16 ** len(prefix) else f"{n:0{len(prefix)}x}"


def _shard(key: Column, cuts: list[str]) -> Column:
    """Number of splitters at or below the key, by halving."""
    def between(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < F.lit(cuts[mid]), between(lo, mid)).otherwise(between(mid + 1, hi))

    return between(0, len(cuts))


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, ident: str = "doc_id") -> DataFrame:
    """(ident, size, text_crc32, shard, slot) of every row: shards of near equal bytes, slots gapless from 0.

    Bytes of a shard differ from the mean by twice the tolerance at most, or by the row that a boundary would have to cut.
    Missing texts are empty, missing ids equal each other, repeated rows count each; other columns are left out. No rows: none.
    """
    rows = cut_lineage(slim(docs, ident))
    cuts = splitters(rows, shards, tolerance)
    order = laid(rows.withColumn("shard", _shard(F.col("key"), cuts)), "key")
    return placed(order, "shard", "slot").select(ident, "size", "text_crc32", "shard", "slot")
