"""Views that give the engine's inputs from the star-schema test tables, in Spark and as DuckDB SQL.

All are deterministic. The SQL text of a view is a common table expression to put before a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FRAME_HOURS = 4
EXTENSIONS = ("mp4", "avi", "mov", "mkv", "wmv", "flv", "m4v", "txt", "MP4", "jpg")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as detections: a user is a video, four hours are a frame."""
    hour = F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)")
    k = F.get_json_object("props", "$.k").cast("int")
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), (F.floor(hour / FRAME_HOURS) + 1).cast("int").alias("frame_no"), "event_id", "value", F.length("event_type").alias("class_id"), k.alias("k"))
    e = e.withColumn("box_idx", (F.row_number().over(Window.partitionBy("video_id", "frame_no").orderBy("event_id")) - 1).cast("int"))
    x, y = ((F.col("video_id") * 97 + F.col("k") * 3) % 1700).cast("double"), ((F.col("video_id") * 31 + F.col("k") * 2) % 950).cast("double")
    w, h = F.floor(F.col("value") / 8) + 10, F.floor(F.col("value") / 12) + 6
    return e.select("video_id", "frame_no", "box_idx", "class_id", x.alias("x1"), y.alias("y1"), (x + w).cast("double").alias("x2"), (y + h).cast("double").alias("y2"))


DETECTIONS_SQL = f"""
e0 AS (SELECT user_id AS video_id, (date_diff('hour', TIMESTAMP '2024-01-01', ts) // {FRAME_HOURS} + 1)::INTEGER AS frame_no, event_id, value,
       length(event_type)::INTEGER AS class_id, (props ->> '$.k')::INTEGER AS k FROM events),
e1 AS (SELECT *, (row_number() OVER (PARTITION BY video_id, frame_no ORDER BY event_id) - 1)::INTEGER AS box_idx,
       ((video_id * 97 + k * 3) % 1700)::DOUBLE AS x1, ((video_id * 31 + k * 2) % 950)::DOUBLE AS y1 FROM e0),
det AS (SELECT video_id, frame_no, box_idx, class_id, x1, y1, x1 + floor(value / 8) + 10 AS x2, y1 + floor(value / 12) + 6 AS y2 FROM e1)"""


def step_detections(spark: SparkSession, sf_dir: str, step: int) -> DataFrame:
    """What a step's detector finds: a third of the event types each; its videos are those of videos()."""
    d = detections(spark, sf_dir).filter(F.col("class_id") % 3 == {1: 0, 2: 1, 4: 2}[step])
    return d.withColumn("video_id", F.concat(F.lit("v"), F.col("video_id").cast("string"))).select("video_id", "frame_no", "box_idx", "x1", "y1", "x2", "y2")


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers as videos with probe results, some of them missing; group_id is the camera's number, if known."""
    c = F.col("c_custkey")
    ext = F.element_at(F.array(*[F.lit(x) for x in EXTENSIONS]), (c % len(EXTENSIONS) + 1).cast("int"))
    name = F.concat(F.when(c % 11 == 0, F.lit("clip_time_location_masked_")).otherwise(F.lit("cam")), c.cast("string"), F.lit("."), ext)
    rate = F.when(c % 7 == 0, F.lit("30000/1001")).when(c % 7 == 1, F.lit("25/1")).when(c % 7 == 2, F.lit("0/0")).when(c % 7 == 3, F.lit("N/A")).otherwise(F.lit("30/1"))
    return read(spark, sf_dir, "customer").select(
        F.concat(F.lit("v"), c.cast("string")).alias("video_id"),
        F.concat(F.lit("/videos/d"), (c % 5).cast("string"), F.lit("/"), name).alias("path"),
        F.when(c % 3 == 0, 1280).when(c % 3 == 1, 1920).otherwise(2560).cast("int").alias("width"),
        F.when(c % 3 == 0, 720).when(c % 3 == 1, 1080).otherwise(1440).cast("int").alias("height"),
        rate.alias("r_frame_rate"),
        F.when(c % 4 != 0, c % 900).cast("long").alias("nb_frames"),
        F.when(c % 6 != 0, (c % 97).cast("double") / 4).alias("duration"),
        F.when(c % 5 == 0, c % 50).cast("long").alias("decoder_frames"),
        F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")).cast("int").alias("group_id"),
    )


VIDEOS_SQL = f"""
v0 AS (SELECT c_custkey AS c, [{', '.join(repr(x) for x in EXTENSIONS)}][(c_custkey % {len(EXTENSIONS)} + 1)::INTEGER] AS ext, c_nationkey FROM customer),
vid AS (SELECT 'v' || c AS video_id,
  '/videos/d' || (c % 5) || '/' || CASE WHEN c % 11 = 0 THEN 'clip_time_location_masked_' ELSE 'cam' END || c || '.' || ext AS path,
  (CASE c % 3 WHEN 0 THEN 1280 WHEN 1 THEN 1920 ELSE 2560 END)::INTEGER AS width, (CASE c % 3 WHEN 0 THEN 720 WHEN 1 THEN 1080 ELSE 1440 END)::INTEGER AS height,
  CASE c % 7 WHEN 0 THEN '30000/1001' WHEN 1 THEN '25/1' WHEN 2 THEN '0/0' WHEN 3 THEN 'N/A' ELSE '30/1' END AS r_frame_rate,
  CASE WHEN c % 4 <> 0 THEN c % 900 END AS nb_frames, CASE WHEN c % 6 <> 0 THEN (c % 97)::DOUBLE / 4 END AS duration,
  CASE WHEN c % 5 = 0 THEN c % 50 END AS decoder_frames, CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END::INTEGER AS group_id FROM v0)"""


def cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nations as camera templates of two boxes each."""
    n = F.col("n_nationkey")

    def box(a, b, c, d):
        return F.struct(*[v.cast("int").alias(k) for k, v in zip(("x1", "y1", "x2", "y2"), (a, b, c, d))])

    return read(spark, sf_dir, "nation").select(
        F.when(n % 2 == 0, n.cast("string")).otherwise(F.lower("n_name")).alias("camera_id"),
        F.when(n % 3 == 0, 1280).otherwise(1920).cast("int").alias("image_width"),
        F.when(n % 3 == 0, 720).otherwise(1080).cast("int").alias("image_height"),
        F.array(box(n * 7, n * 3, n * 7 + 201, n * 3 + 41), box(F.lit(900) + n, F.lit(600) + n * 2, F.lit(1111) + n, F.lit(633) + n * 2)).alias("boxes"),
        n.cast("int").alias("camera_no"),
    )


CAMERAS_SQL = """
cam AS (SELECT CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey::VARCHAR ELSE lower(n_name) END AS camera_id,
  (CASE WHEN n_nationkey % 3 = 0 THEN 1280 ELSE 1920 END)::INTEGER AS image_width, (CASE WHEN n_nationkey % 3 = 0 THEN 720 ELSE 1080 END)::INTEGER AS image_height,
  [{'x1': n * 7, 'y1': n * 3, 'x2': n * 7 + 201, 'y2': n * 3 + 41}, {'x1': 900 + n, 'y1': 600 + n * 2, 'x2': 1111 + n, 'y2': 633 + n * 2}] AS boxes, n AS camera_no
  FROM (SELECT *, n_nationkey::INTEGER AS n FROM nation))"""


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """suppliers as names mapped to cameras; some cameras don't exist."""
    s = F.col("s_suppkey")
    key = F.when(s % 4 == 0, F.concat(F.lit("cam"), s.cast("string"))).when(s % 4 == 1, F.concat(F.lit("cam"), s.cast("string"), F.lit(".mp4"))).otherwise(F.concat(F.lit("Depot-"), s.cast("string"), F.lit("_ride")))
    return read(spark, sf_dir, "supplier").select(key.alias("key"), ((s * 2) % 60).cast("string").alias("camera_id"))


MAPPING_SQL = """
map AS (SELECT CASE WHEN s_suppkey % 4 = 0 THEN 'cam' || s_suppkey WHEN s_suppkey % 4 = 1 THEN 'cam' || s_suppkey || '.mp4' ELSE 'Depot-' || s_suppkey || '_ride' END AS key,
  ((s_suppkey * 2) % 60)::VARCHAR AS camera_id FROM supplier)"""


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections as lines of label files, with some that can't be read."""
    d = detections(spark, sf_dir)
    r = lambda c: (F.floor(c * 1e6 + 0.5).cast("double") / 1e6).cast("decimal(9,6)").cast("string")
    line = F.concat_ws(" ", F.col("class_id").cast("string"), r((F.col("x1") + F.col("x2")) / 3840), r((F.col("y1") + F.col("y2")) / 2160), r((F.col("x2") - F.col("x1")) / 1920), r((F.col("y2") - F.col("y1")) / 1080))
    n = F.col("video_id") * 7 + F.col("frame_no") + F.col("box_idx")
    value = F.when(n % 13 == 0, F.lit("")).when(n % 13 == 1, F.lit("0 0.5 0.5 0.1")).when(n % 13 == 2, F.lit("0 0.5 x.5 0.1 0.1")).otherwise(line)
    name = F.concat(F.lit("/labels/v_"), F.col("video_id").cast("string"), F.lit("_"), F.when(n % 17 == 0, F.lit("zz")).otherwise(F.col("frame_no").cast("string")), F.lit(".txt"))
    return d.select(name.alias("path"), "box_idx", value.alias("value"))


LABEL_LINES_SQL = """
n0 AS (SELECT *, video_id * 7 + frame_no + box_idx AS n FROM det),
lab AS (SELECT '/labels/v_' || video_id || '_' || CASE WHEN n % 17 = 0 THEN 'zz' ELSE frame_no::VARCHAR END || '.txt' AS path, box_idx,
  CASE n % 13 WHEN 0 THEN '' WHEN 1 THEN '0 0.5 0.5 0.1' WHEN 2 THEN '0 0.5 x.5 0.1 0.1' ELSE
  class_id || ' ' || (floor((x1 + x2) / 3840 * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE)::DECIMAL(9,6) || ' ' || (floor((y1 + y2) / 2160 * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE)::DECIMAL(9,6) || ' ' || (floor((x2 - x1) / 1920 * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE)::DECIMAL(9,6) || ' ' || (floor((y2 - y1) / 1080 * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE)::DECIMAL(9,6) END AS value FROM n0)"""


def gray_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as 8 x 8 gray images."""
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), F.col("label").alias("group_id"), F.transform("embedding", lambda x: x.cast("double")).alias("gray"))


def shard_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"), (F.col("p_size").cast("long") * (F.col("p_partkey") % 5 + 1) * 1000).alias("weight"))
