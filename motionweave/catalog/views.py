"""Motion tables derived from the given tables, once in Spark and once in SQL.

``*_SQL`` constants are common table expressions with the same rows as the function
of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import box as bx, vec as v
from ..operators.blocks import ranked
from ..operators.schedule import frames

DIGITS = 6


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rnd(c: Column) -> Column:
    return F.round(c, DIGITS)


def r(sql: str) -> str:
    """Rounded SQL number without a negative zero."""
    return f"(round(CAST({sql} AS DOUBLE), {DIGITS}) + 0)"


def xyz_cols(c: Column, prefix: str = "") -> list[Column]:
    return [rnd(c[a]).alias(f"{prefix}{a}") for a in "xyz"]


def long_joints(df: DataFrame, col: str = "joints", keys: tuple = ("clip", "frame", "side"), extra: tuple = ()) -> DataFrame:
    rows = df.filter(F.col(col).isNotNull()).select(*keys, *extra, F.posexplode(col).alias("joint", "p"))
    return rows.filter(F.col("p").isNotNull()).select(*keys, *extra, "joint", *xyz_cols(F.col("p")))


# ------------------------------------------------------------ events -> series
def series(spark: SparkSession, sf: str) -> DataFrame:
    """clip, frame, v (NULL where missing), valid, conf, ts_us: one series per user."""
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    rows = ranked(ev, ["user_id"], ["ts", "event_id"], F.date_trunc("hour", "ts"), "frame")
    ok = F.col("event_type") != "error"
    return rows.select(
        F.col("user_id").alias("clip"), F.col("frame").cast("int").alias("frame"), F.when(ok, F.col("value")).alias("v"),
        ok.alias("valid"), (1.0 / (1.0 + F.col("value") / 100.0)).alias("conf"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
        F.col("value").alias("raw"))


SERIES_SQL = """
series AS (
  SELECT user_id AS clip, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS frame,
         CASE WHEN event_type <> 'error' THEN value END AS v, event_type <> 'error' AS valid,
         CAST(1 AS DOUBLE) / (1 + value / 100) AS conf, epoch_us(ts) AS ts_us, value AS raw
  FROM events)"""


def camera_series(spark: SparkSession, sf: str) -> DataFrame:
    """One camera pose per series frame; invalid frames keep a made-up far position."""
    s = series(spark, sf)
    bad = F.lit(1000.0)
    return s.select(
        "clip", "frame", "valid", v.yaw(0.03 * F.col("frame")).alias("rot"),
        v.vec(F.coalesce(F.col("v") / 31.4159265, bad), F.coalesce(F.col("v") / 27.1828183, bad), 0.1 * F.col("frame")).alias("trans"))


CAMERA_SERIES_SQL = SERIES_SQL + """,
cam AS (
  SELECT clip, frame, valid, 0.03 * frame AS yaw, coalesce(v / CAST(31.4159265 AS DOUBLE), 1000) AS x, coalesce(v / CAST(27.1828183 AS DOUBLE), 1000) AS y,
         CAST(0.1 AS DOUBLE) * frame AS z FROM series)"""


# --------------------------------------------------------- embeddings -> hands
def embedding_frames(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    rows = ranked(e, ["label"], ["vec_id"], F.floor(F.col("vec_id") / 4096), "rn")
    return rows.select(
        F.col("label").alias("clip"), F.floor(F.col("rn") / 2).cast("int").alias("frame"), (F.col("rn") % 2).cast("int").alias("side"),
        "vec_id", "embedding")


def hands(spark: SparkSession, sf: str) -> DataFrame:
    """Hand rows: 21 joints about one metre in front of the camera, every fifth missing."""
    rows = embedding_frames(spark, sf)
    e = lambda i: F.get(F.col("embedding"), i).cast("double")
    joints = F.transform(F.sequence(F.lit(0), F.lit(20)), lambda j: v.vec(e(3 * j), e(3 * j + 1), 1.0 + e(3 * j + 2)))
    return rows.select("clip", "frame", "side", joints.alias("joints"), (F.col("vec_id") % 5 != 2).alias("valid"),
                       (0.5 + e(F.lit(63))).alias("conf"))


HANDS_SQL = """
h AS (
  SELECT label AS clip, CAST(floor((rn - 1) / 2) AS INTEGER) AS frame, CAST((rn - 1) % 2 AS INTEGER) AS side,
         embedding AS e, vec_id, vec_id % 5 <> 2 AS valid, 0.5 + CAST(embedding[64] AS DOUBLE) AS conf
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings)),
j AS (
  SELECT clip, frame, side, valid, conf, CAST(joint AS INTEGER) AS joint, CAST(e[3 * joint + 1] AS DOUBLE) AS x,
         CAST(e[3 * joint + 2] AS DOUBLE) AS y, 1 + CAST(e[3 * joint + 3] AS DOUBLE) AS z
  FROM (SELECT *, unnest(range(21)) AS joint FROM h)),
len AS (SELECT clip, max(frame) + 1 AS n FROM h GROUP BY clip)"""

K = (500.0, 0.0, 320.0, 0.0, 480.0, 240.0, 0.0, 0.0, 1.0)
YAW, YAW_REF = 0.05, 0.04


def sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Frames per embedding clip: two vectors make a frame."""
    e = table(spark, sf, "embeddings").groupBy(F.col("label").alias("clip"))
    return e.agg(F.ceil(F.count(F.lit(1)) / 2).cast("int").alias("num_frames"))


def poses(spark: SparkSession, sf: str, yaw: float = YAW) -> DataFrame:
    """One camera per frame: turning about y, moving in x and y."""
    f = F.col("frame").cast("double")
    return frames(sizes(spark, sf)).select(
        "clip", "frame", v.yaw(yaw * f).alias("rot"), v.vec(0.02 * f, 0.01 * f, F.lit(0.0)).alias("trans"),
        v.mat(*K).alias("k"), F.lit(True).alias("valid"))


# World joints by the pose of YAW, as SQL over j.
WORLD_SQL = HANDS_SQL + f""",
w AS (
  SELECT clip, frame, side, valid, conf, joint,
         cos({YAW} * frame) * x + sin({YAW} * frame) * z + 0.02 * frame AS x, y + 0.01 * frame AS y,
         -sin({YAW} * frame) * x + cos({YAW} * frame) * z AS z
  FROM j)"""


# ------------------------------------------------------------ lineitem -> boxes
FRAMES_PER_CLIP = 500


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Detections: an order is a frame, its few lines are the boxes seen in it."""
    li = table(spark, sf, "lineitem")
    rest = [c for c in li.columns if c != "l_orderkey"]
    rows = li.withColumn("slot", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*rest)) - 1)
    x, y = F.col("l_quantity"), 100.0 * F.col("l_discount")
    return rows.select(
        F.floor(F.col("l_orderkey") / FRAMES_PER_CLIP).cast("bigint").alias("clip"),
        (F.col("l_orderkey") % FRAMES_PER_CLIP).cast("int").alias("frame"), F.col("slot").cast("int").alias("slot"),
        bx.box(x, y, x + 20.0, y + 20.0).alias("box"), F.round(1.0 - 5.0 * F.col("l_tax"), 2).alias("conf"),
        (F.col("l_suppkey") % 2).cast("int").alias("side"))


BOXES_SQL = f"""
b AS (
  SELECT CAST(floor(l_orderkey / {FRAMES_PER_CLIP}) AS BIGINT) AS clip, CAST(l_orderkey % {FRAMES_PER_CLIP} AS INTEGER) AS frame,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity,
           l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS INTEGER) AS slot,
         l_quantity AS x1, 100 * l_discount AS y1, l_quantity + 20 AS x2, 100 * l_discount + 20 AS y2,
         round(1 - 5 * l_tax, 2) AS conf, CAST(l_suppkey % 2 AS INTEGER) AS side
  FROM lineitem)"""


# --------------------------------------------------------------- orders -> clips
def clips(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    n = (F.floor(F.sum(F.round("o_totalprice").cast("bigint")) / 10000) + 1).cast("int")
    return o.groupBy(F.col("o_custkey").alias("clip")).agg(n.alias("num_frames"))


CLIPS_SQL = """
c AS (
  SELECT o_custkey AS clip, CAST(floor(sum(CAST(round(o_totalprice) AS BIGINT)) / 10000) + 1 AS INTEGER) AS num_frames
  FROM orders GROUP BY o_custkey)"""


def schedule_sql(window: int, overlap: int, source: str = "c", name: str = "win") -> str:
    stride = window - overlap
    return f"""
{name} AS (
  SELECT clip, num_frames, CAST(win AS INTEGER) AS win, CAST(win * {stride} AS INTEGER) AS "start",
         CAST(least(win * {stride} + {window}, num_frames) AS INTEGER) AS "end"
  FROM (SELECT *, unnest(range(CAST(greatest(1, ceil((num_frames - {overlap}) / {stride}.0)) AS BIGINT))) AS win FROM {source}))"""
