"""Content identity, completion ledger and the tables derived from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEDGER
from ..sources import digests

# What each stage reads, as a path pattern inside the clip folder. A stage
# never reads its own output, so its identity does not change once it has run.
STAGE_INPUTS = {
    "preprocess": r"^video/[^/]+$",
    "detection": r"^metadata\.json$",
    "hand": r"^detection/detection\.npz$",
    "camera": r"^metadata\.json$",
    "stitch": r"^camera/windows/[^/]+\.npz$",
    "fusion": r"^(hand/hand_camera|camera/stitched_camera)\.npz$",
    "refine": r"^trajectory/trajectory_raw\.npz$",
}


def file_hashes(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, size, sha) of files of any size, streamed through the hash where they are read."""
    return digests.read(spark, pattern)


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def params_hash(stage: Column, params: dict[str, Column], inputs: Column, shard: Column, shards: Column,
                extra: dict[str, Column] | None = None) -> Column:
    """Identity of one unit of work, whatever the order of its inputs. The shard is part of it: another cut is another unit."""
    body = F.struct(
        F.struct(*[(extra or {})[k].alias(k) for k in sorted(extra or {})] or [F.lit(0).alias("_")]).alias("extra"),
        F.array_sort(inputs).alias("inputs"),
        F.struct(*[params[k].alias(k) for k in sorted(params)]).alias("params"),
        F.struct(shards.alias("count"), shard.alias("index")).alias("selection"),
        stage.alias("stage"))
    return F.sha2(F.to_json(body, {"ignoreNullFields": "false"}), 256)


def inputs_per_stage(files: DataFrame) -> DataFrame:
    """(clip, stage, files, first_name, digest): identity of what a stage consumes.

    ``files``: clip, path relative to the clip folder, sha. The pattern table has seven
    rows, so each file is matched where it is read. The digest is taken in two levels,
    per bucket of names and then over the buckets, so that a clip with millions of
    window files never forms one list.
    """
    hits = F.array(*[F.when(F.col("path").rlike(p), F.lit(s)) for s, p in STAGE_INPUTS.items()])
    rows = files.withColumn("stage", F.explode(F.filter(hits, lambda s: s.isNotNull())))
    rows = rows.withColumn("name", F.substring_index("path", "/", -1)).withColumn("bucket", F.substring(F.sha2("name", 256), 1, 3))
    parts = rows.groupBy("clip", "stage", "bucket").agg(
        _digest(F.concat("name", F.lit(":"), "sha")).alias("part"), F.count(F.lit(1)).alias("n"), F.min("name").alias("low"))
    return parts.groupBy("clip", "stage").agg(
        F.sum("n").alias("files"), F.min("low").alias("first_name"), _digest(F.concat("bucket", F.lit("="), "part")).alias("digest"))


def _digest(entry: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(F.collect_list(entry)), ";"), 256)


def decode_markers(rows: DataFrame, text: str = "text") -> DataFrame:
    """Marker JSON -> ledger rows. Unreadable or incomplete markers count as absent."""
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LEDGER if f.name != "clip")
    m = rows.withColumn("_m", F.from_json(text, kind, {"mode": "PERMISSIVE"}))
    need = [F.col("_m")[c].isNotNull() for c in ("stage", "unit", "params_hash")]
    keep = [c for c in rows.columns if c != text]
    return m.filter(need[0] & need[1] & need[2]).select(*keep, "_m.*")


def append(ledger_rows: DataFrame, path: str) -> None:
    ledger_rows.write.mode("append").parquet(path)


def latest(ledger: DataFrame, order: str = "finished_at") -> DataFrame:
    """Newest row per (clip, stage, unit); of several as new as each other the one with the greatest text."""
    rest = [c for c in ledger.columns if c not in ("clip", "stage", "unit")]
    row = F.struct(*rest)
    return ledger.groupBy("clip", "stage", "unit").agg(F.max_by(row, F.struct(F.col(order).alias("o"), F.to_json(row).alias("r"))).alias("r")).select(
        "clip", "stage", "unit", "r.*")


def pending(work: DataFrame, ledger: DataFrame, outputs: DataFrame) -> DataFrame:
    """Units still to do: no ledger row with the same identity whose outputs all exist.

    work: clip, stage, unit, params_hash. ledger: the same plus outputs. outputs: clip, name.
    """
    names = ledger.select("clip", "stage", "unit", "params_hash", F.explode_outer("outputs").alias("name"))
    here = outputs.select("clip", "name", F.lit(True).alias("_here")).distinct()
    known = names.join(here, ["clip", "name"], "left")
    whole = known.groupBy("clip", "stage", "unit", "params_hash").agg(
        F.bool_and(F.col("name").isNull() | F.coalesce("_here", F.lit(False))).alias("ok")).filter("ok")
    return work.join(whole.drop("ok"), ["clip", "stage", "unit", "params_hash"], "left_anti")


def runnable(work: DataFrame, ledger: DataFrame) -> DataFrame:
    """Drop stages behind a failed stage of the same clip. ``work`` and ``ledger`` carry
    the stage position ``pos``."""
    failed = ledger.filter(F.col("status") == "failed").groupBy("clip").agg(F.min("pos").alias("_failed"))
    return work.join(failed, "clip", "left").filter(F.col("_failed").isNull() | (F.col("pos") <= F.col("_failed"))).drop("_failed")


def summary(ledger: DataFrame) -> DataFrame:
    """Units per status, and the total (status NULL)."""
    return ledger.groupingSets([[F.col("status")], []], F.col("status")).agg(F.count(F.lit(1)).alias("units"))


def degraded_clips(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("status") == "failed").select("clip").distinct()


def degraded_units(ledger: DataFrame) -> DataFrame:
    """What failed, one row per failed unit."""
    return ledger.filter(F.col("status") == "failed").select("clip", "stage", "unit", "detail", "finished_at")


def mark_degraded(clips: DataFrame, ledger: DataFrame) -> DataFrame:
    """Clip metadata with a degraded flag, the failed units (stage/unit, sorted) and the reason of the last one.

    A clip has few stages and units per stage; the list holds each failed one once.
    """
    bad = degraded_units(ledger).groupBy("clip").agg(
        F.count(F.lit(1)).alias("failed_units"),
        F.array_sort(F.collect_set(F.concat_ws("/", "stage", "unit"))).alias("failures"),
        F.max_by("detail", F.struct("finished_at", "detail")).alias("degraded_reason"))
    rows = clips.join(bad, "clip", "left")
    return rows.withColumn("degraded", F.col("failed_units").isNotNull()).withColumn(
        "failed_units", F.coalesce("failed_units", F.lit(0))).withColumn("failures", F.coalesce("failures", F.array().cast("array<string>")))
