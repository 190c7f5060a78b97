"""LeRobot v3 datasets: frame labels, episode metadata, tasks, file locations."""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default path templates of the dataset layout.
DATA_PATH = "data/chunk-{chunk_index:03d}/file-{file_index:03d}.parquet"
VIDEO_PATH = "videos/{video_key}/chunk-{chunk_index:03d}/file-{file_index:03d}.mp4"


def read_info(spark: SparkSession, root: str) -> dict:
    """The dataset header: one small JSON document. Needs a positive fps."""
    rows = spark.read.text(f"{root}/meta/info.json", wholetext=True).take(1)
    return checked_info(json.loads(rows[0][0]))


def checked_info(info: dict) -> dict:
    if float(info.get("fps", 0) or 0) <= 0:
        raise ValueError("the dataset has no positive fps")
    return info


def shape(info: dict, name: str) -> tuple:
    if name not in info.get("features", {}):
        raise KeyError(f"feature {name!r} is not in this dataset")
    return tuple(int(d) for d in info["features"][name].get("shape", []))


def vector_features(info: dict) -> dict[str, tuple]:
    """Features that are neither video nor image and hold more than one number."""
    out = {}
    for name, feature in info.get("features", {}).items():
        dims = shape(info, name)
        if feature.get("dtype") not in ("video", "image") and math.prod(dims) > 1:
            out[name] = dims
    return out


def video_key(info: dict) -> str:
    for name, feature in info.get("features", {}).items():
        if feature.get("dtype") == "video":
            return name
    raise ValueError("the dataset declares no video feature")


def decode_frames(rows: DataFrame, info: dict) -> DataFrame:
    """Check declared lengths, widen vectors to double, turn one-element arrays into scalars.

    A vector of the wrong length is an error. Declared booleans become boolean.
    """
    vectors = vector_features(info)
    cols = []
    for field in rows.schema:
        c = F.col(f"`{field.name}`")
        is_array = isinstance(field.dataType, T.ArrayType)
        if field.name in vectors and is_array:
            want = vectors[field.name][0]
            wrong = F.raise_error(F.concat(F.lit(f"column {field.name} should hold {want} values, has "),
                                           F.size(c).cast("string"))).cast(field.dataType)
            c = F.when(F.size(c) == want, c).otherwise(wrong)
            if not isinstance(field.dataType.elementType, T.ArrayType):
                c = c.cast("array<double>")
        elif is_array and shape_or_none(info, field.name) == (1,):
            c = F.get(c, F.lit(0))
            c = c.cast("boolean" if info["features"][field.name].get("dtype") == "bool" else "double")
        elif info.get("features", {}).get(field.name, {}).get("dtype") == "bool":
            c = c.cast("boolean")
        cols.append(c.alias(field.name))
    return rows.select(*cols)


def shape_or_none(info: dict, name: str):
    return shape(info, name) if name in info.get("features", {}) else None


def read_frames(spark: SparkSession, root: str, info: dict, episodes: list[int] | None = None) -> DataFrame:
    """Frame labels of all episodes, or of some: the filter is pushed to the Parquet scan."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/data")
    if episodes is not None:
        rows = rows.filter(F.col("episode_index").isin(*episodes))
    return decode_frames(rows, info)


def latest_episodes(rows: DataFrame, path: str = "_path") -> DataFrame:
    """One row per episode_index: the one from the greatest file path, of several in it the greatest."""
    names = [c for c in rows.columns if c != path]
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    pick = F.max_by(row, F.struct(F.col(path).alias("p"), F.xxhash64(F.to_json(row)).alias("h"))).alias("_row")
    return rows.groupBy("episode_index").agg(pick).select("_row.*")


def read_episodes(spark: SparkSession, root: str) -> DataFrame:
    rows = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/meta/episodes")
    return latest_episodes(rows.withColumn("_path", F.col("_metadata.file_path")))


def read_tasks(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/meta/tasks.parquet").select("task_index", F.col("task").cast("string").alias("task"))


def with_task(episodes: DataFrame, tasks: DataFrame) -> DataFrame:
    return episodes.join(tasks, "task_index", "left")


def template_path(template: str, **columns) -> Column:
    """A path template such as ``a-{x:03d}`` filled from columns or texts."""
    out, args = [], []
    for literal, name, width in re.findall(r"([^{]*)(?:\{(\w+)(?::0?(\d*)d)?\})?", template):
        out.append(literal.replace("%", "%%"))
        if name:
            value = columns[name]
            if isinstance(value, str):
                out.append(value.replace("%", "%%"))
            else:
                out.append(f"%0{width}d" if width else "%d")
                args.append(value.cast("bigint"))
    return F.format_string("".join(out), *args) if args else F.lit("".join(out))


def file_locations(episodes: DataFrame, info: dict, root: str) -> DataFrame:
    """Data and video file of each episode; a missing chunk or file index counts as 0."""
    key = video_key(info)

    def index(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`"), F.lit(0)) if name in episodes.columns else F.lit(0)

    data = template_path(info.get("data_path", DATA_PATH), chunk_index=index("data/chunk_index"), file_index=index("data/file_index"))
    video = template_path(info.get("video_path", VIDEO_PATH), video_key=key,
                          chunk_index=index(f"videos/{key}/chunk_index"), file_index=index(f"videos/{key}/file_index"))
    return episodes.withColumns({"data_file": F.concat(F.lit(f"{root}/"), data), "video_file": F.concat(F.lit(f"{root}/"), video)})


def length_check(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """Episodes whose metadata length differs from the rows found."""
    found = frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("rows"))
    return episodes.select("episode_index", "length").join(found, "episode_index", "left").filter(
        ~F.col("length").eqNullSafe(F.col("rows")))
