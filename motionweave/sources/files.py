"""Frame inventories, probe texts, manifests, log summaries and table sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.blocks import BEFORE
from ..schemas import STAGES

WHOLE_CLIP = 1 << 17  # images that one task may sort
MANIFEST_KEYS = ("clip", "video", "num_frames", "from_stage", "notes", "shards")
PROBE = ("streams array<struct<avg_frame_rate:string,r_frame_rate:string,nb_frames:string,duration:string,"
         "width:string,height:string,codec_name:string>>, format struct<duration:string>")


# ------------------------------------------------------------------- frames
def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """File names and sizes without reading contents."""
    return spark.read.format("binaryFile").load(pattern).select("path", "length", "modificationTime")


def frame_inventory(paths: DataFrame, fps: DataFrame, image_format: str = "jpg", whole: int = WHOLE_CLIP) -> DataFrame:
    """Sorted image names -> frame number and timestamp per clip.

    Rows: clip, path. A clip of up to ``whole`` images is ranked at once; in a longer one names are ranked in buckets of one
    prefix length, which keeps name order whatever the names' lengths, so no task sorts a long clip. Paths are shuffled
    once, with the clip and the bucket only; rates and starts are joined by the same keys.
    """
    name = F.substring_index("path", "/", -1)
    named = paths.filter(F.col("path").endswith(f".{image_format}"))
    # All but the last three characters of the longest stem: about a thousand numbered frames.
    long = named.groupBy("clip").agg(F.count(F.lit(1)).alias("_n"), F.greatest(
        F.lit(0), F.max(F.length(name)) - (len(image_format) + 4)).alias("_cut")).where(F.col("_n") > whole).select("clip", "_cut")
    # Long clips are few: at most one for every ``whole`` rows.
    rows = named.filter("clip is not null").join(F.broadcast(long), "clip", "left").select(
        "clip", "path", F.when(F.col("_cut").isNotNull(), F.left(name, F.col("_cut"))).otherwise("").alias("_bucket"))
    sizes = rows.groupBy("clip", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    base = F.sum("_n").over(Window.partitionBy("clip").orderBy("_bucket").rowsBetween(BEFORE, -1))
    starts = sizes.select("clip", "_bucket", F.coalesce(base, F.lit(0)).alias("_base")).join(fps.select("clip", "fps"), "clip", "left")
    place = F.row_number().over(Window.partitionBy("clip", "_bucket").orderBy(name))
    lost = F.raise_error(F.concat(F.lit("no fps for clip "), F.col("clip").cast("string"))).cast("double")
    ranked = rows.withColumn("_r", place).join(starts.hint("merge"), ["clip", "_bucket"]).withColumn("frame", F.col("_base") + F.col("_r") - 1)
    return ranked.select(
        "clip", F.col("frame").cast("int").alias("frame"), "path",
        (F.col("frame") / F.coalesce("fps", lost)).alias("ts"))


# --------------------------------------------------------------------- probe
def rate(text: Column) -> Column:
    """'30000/1001' or '25' -> number; NULL when unusable."""
    return F.when(text.isNotNull() & (text != "") & (text != "0/0"), _ratio(F.split(text, "/")))


def _ratio(parts: Column) -> Column:
    number = lambda c: F.when(c.rlike(r"^\s*[-+]?\d+(\.\d+)?\s*$"), c).cast("double")
    top, bottom = number(F.get(parts, F.lit(0))), F.when(F.size(parts) > 1, number(F.get(parts, F.lit(1)))).otherwise(1.0)
    return top / F.nullif(bottom, F.lit(0.0))


def decode_probe(rows: DataFrame, text: str = "text") -> DataFrame:
    """Probe JSON per clip -> fps, size, frame count, duration, codec.

    The average rate counts, else the real one; the frame count is the stored one, else
    round(duration * fps). A clip that yields no positive fps, length or size is an error.
    """
    number = lambda c: F.when(c.rlike(r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"), c).cast("double")
    whole = lambda c: F.when(c.rlike(r"^\s*[-+]?\d+\s*$"), F.trim(c)).cast("bigint")
    p = rows.withColumn("_p", F.from_json(text, PROBE))
    s = F.get(F.col("_p")["streams"], F.lit(0))
    p = p.withColumn("_fps", F.coalesce(F.when(rate(s["avg_frame_rate"]) != 0, rate(s["avg_frame_rate"])), rate(s["r_frame_rate"])))
    duration = number(s["duration"])
    p = p.withColumn("_dur", F.coalesce(F.when(duration != 0, duration), number(F.col("_p")["format"]["duration"])))
    p = p.withColumn("_n", F.coalesce(whole(s["nb_frames"]), F.bround(F.col("_dur") * F.col("_fps")).cast("bigint")))
    w, h = F.coalesce(whole(s["width"]), F.lit(0)), F.coalesce(whole(s["height"]), F.lit(0))

    def need(value: Column, kind: str, message: str) -> Column:
        return F.when(value > 0, value).otherwise(F.raise_error(F.concat(
            F.lit(message + ": "), F.col("clip").cast("string"))).cast(kind))

    n = F.coalesce(F.col("_n"), F.raise_error(F.lit("neither frame count nor duration is known")).cast("bigint"))
    return p.select(
        "clip", need(F.col("_fps"), "double", "no positive frame rate").alias("fps"),
        need(w, "bigint", "invalid width").alias("width"), need(h, "bigint", "invalid height").alias("height"),
        n.alias("num_frames"), F.coalesce("_dur", n / F.col("_fps")).alias("duration"),
        F.coalesce(s["codec_name"], F.lit("unknown")).alias("codec"))


def clip_name(path: Column) -> Column:
    """File stem of a video path."""
    return F.regexp_replace(F.regexp_extract(path, r"[^/]+$", 0), r"\.[^.]*$", "")


# ------------------------------------------------------------------ manifests
def decode_manifest(texts: DataFrame, text: str = "text") -> DataFrame:
    """Manifest documents -> clip rows. An entry is a name or an object.

    Unknown keys, missing names, unknown stages, non-positive lengths and repeated
    names are errors.
    """
    body = F.coalesce(F.get_json_object(text, "$.clips"), F.col(text))
    entries = texts.select(F.explode(F.from_json(body, "array<string>")).alias("e"))
    obj = F.from_json("e", "map<string,string>")
    rows = entries.withColumn("m", F.when(F.col("e").startswith("{"), obj).otherwise(F.create_map(F.lit("clip"), F.col("e"))))
    unknown = F.array_except(F.map_keys("m"), F.array(*[F.lit(k) for k in MANIFEST_KEYS]))
    get = lambda k: F.try_element_at(F.col("m"), F.lit(k))
    n = get("num_frames").cast("int")
    problem = (
        F.when(F.size(unknown) > 0, F.concat(F.lit("unknown keys "), F.to_json(unknown)))
        .when(get("clip").isNull() | (get("clip") == ""), F.lit("an entry has no clip name"))
        .when(get("from_stage").isNotNull() & ~get("from_stage").isin(*STAGES), F.lit("unknown from_stage"))
        .when(n <= 0, F.lit("num_frames must be positive")))
    rows = rows.withColumn("_bad", problem).select(
        F.when(F.col("_bad").isNull(), get("clip")).otherwise(F.raise_error(F.col("_bad")).cast("string")).alias("clip"),
        get("video").alias("video"), n.alias("num_frames"), get("from_stage").alias("from_stage"),
        F.coalesce(get("notes"), F.lit("")).alias("notes"))
    fields = [c for c in rows.columns if c != "clip"]
    one = rows.groupBy("clip").agg(F.count(F.lit(1)).alias("_c"), *[F.first(c).alias(c) for c in fields])
    twice = F.raise_error(F.concat(F.lit("clip name is not unique: "), F.col("clip"))).cast("string")
    return one.select(F.when(F.col("_c") == 1, F.col("clip")).otherwise(twice).alias("clip"), *fields)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return decode_manifest(spark.read.text(path, wholetext=True).withColumnRenamed("value", "text"))


def manifest_lines(clips: DataFrame) -> DataFrame:
    """One JSON object per clip: a manifest written and read without one big document."""
    return clips.select("clip", F.to_json(F.struct(*[c for c in MANIFEST_KEYS if c in clips.columns])).alias("entry"))


# ----------------------------------------------------------------- log texts
def last_summary(logs: DataFrame, text: str = "text") -> DataFrame:
    """The last line of each log that is a JSON object, NULL when there is none."""
    lines = F.transform(F.split(F.col(text), r"\r?\n"), lambda x: F.trim(x))
    objects = F.filter(lines, lambda x: x.startswith("{") & F.from_json(x, "map<string,string>").isNotNull())
    return logs.withColumn("summary", F.try_element_at(objects, F.lit(-1)))


# --------------------------------------------------------------------- sinks
def write_table(df: DataFrame, path: str, partition_by: str | None = None, require_rows: bool = True) -> None:
    """Parquet sink. With ``partition_by`` only the partitions present are replaced.

    An empty table is refused; Spark's committer makes the result appear at once."""
    if require_rows and df.isEmpty():
        raise ValueError("refusing to write an empty table")
    writer = df.write.mode("overwrite")
    if partition_by is not None:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    writer.parquet(path)


def sorted_json(*columns: str) -> Column:
    """JSON text with keys in name order."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def write_json(df: DataFrame, path: str) -> None:
    df.select(sorted_json(*df.columns).alias("value")).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_checked(df: DataFrame, path: str, checks: dict[tuple[str, str], Column], later=None, partition_by: str | None = None,
                  publish: bool = True) -> dict[tuple[str, str], int]:
    """Write a table that becomes visible only if no row breaks a check; returns the broken checks with their rows.

    The frame is evaluated once: checks are counted by an observation of the pass that writes the rows to a staging folder.
    ``later(staged)`` may look at the written copy, where only the columns that it needs are read, and gives rows
    (field, problem, rows) for what takes more than one row to see. Sound tables are moved into place, with
    ``partition_by`` only the partitions present are replaced; others leave nothing behind. An empty table is a problem.
    """
    spark = df.sparkSession
    names = {f"c{i}": key for i, key in enumerate(checks)}
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(checks[k]).alias(n) for n, k in names.items()])
    jvm = spark._jvm
    # Readers of the target pass over names with an underscore.
    stage = jvm.org.apache.hadoop.fs.Path(f"{path}/_staged-{uuid.uuid4().hex}")
    store = stage.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        writer = watched.write
        (writer if partition_by is None else writer.partitionBy(partition_by)).parquet(stage.toString())
        counts = seen.get
        bad = {names[n]: counts[n] for n in names if counts[n]}
        if not counts["rows"]:
            bad[("table", "empty")] = 0
        elif later is not None:
            found = later(spark.read.schema(df.schema).parquet(stage.toString()))
            bad |= {(r["field"], r["problem"]): r["rows"] for r in found.groupBy("field", "problem").agg(F.sum("rows").alias("rows")).collect()}
        if publish and not bad:
            _publish(store, jvm, stage, path, partition_by is None)
        return bad
    finally:
        store.delete(stage, True)


def _publish(store, jvm, stage, path: str, whole: bool) -> None:
    """Move what was staged into place: the files of a whole table after its old ones are gone, or folder by folder."""
    place = lambda name: jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    if whole:
        for old in store.listStatus(jvm.org.apache.hadoop.fs.Path(path)):
            if not old.getPath().getName().startswith("_staged-"):
                store.delete(old.getPath(), True)
    for new in store.listStatus(stage):
        name = new.getPath().getName()
        if new.isDirectory():
            store.delete(place(name), True)
        elif not whole:
            continue  # the mark of a finished write
        if not store.rename(new.getPath(), place(name)):
            raise OSError(f"cannot move {new.getPath()} to {place(name)}")


def write_trajectory(traj: DataFrame, path: str) -> None:
    """Write trajectory rows by clip; a broken row or an absent frame stops the write, and nothing changes."""
    from ..plans.quality import frame_problems, row_checks

    bad = write_checked(traj, path, row_checks(traj), frame_problems, "clip")
    if bad:
        raise ValueError(f"trajectory breaks its contract: {bad}")
