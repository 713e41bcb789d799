"""Sources and sinks over files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.functions import geometry as G
from maskwright.functions import names as N
from maskwright.operators import labels

CAMERA_SCHEMA = "imageWidth INT, imageHeight INT, shapes ARRAY<STRUCT<points: ARRAY<ARRAY<DOUBLE>>>>, _corrupt_record STRING"
#: Reference images of a camera, in order of preference.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".bmp")


def scan_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """path, length, modified of all files; contents are never read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def scan_videos(spark: SparkSession, path: str, recursive: bool = True, extensions=N.EXTENSIONS, natural: bool = True) -> DataFrame:
    """Videos in order: natural order of paths or plain order; a single file works too."""
    found = scan_files(spark, path, recursive).filter(N.is_video(F.col("path"), extensions))
    found = found.select(N.stem(F.col("path")).alias("video_id"), "path", N.extension(F.col("path")).alias("ext"), "length")
    return found.orderBy(N.natural_key(F.col("path"))) if natural else found.orderBy("path")


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of label files: path, box_idx (order in the file), value."""

    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return raw.select("path", F.posexplode(F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")).alias("box_idx", "value"))


def read_cameras(spark: SparkSession, path: str) -> DataFrame:
    """Camera templates from LabelMe files, by id; files that can't be read or lack a size are left out."""
    raw = spark.read.schema(CAMERA_SCHEMA).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    rows = raw.select(F.col("_metadata.file_path").alias("path"), "imageWidth", "imageHeight", "shapes", "_corrupt_record")
    boxes = F.filter(F.transform(F.filter("shapes", lambda s: F.size(s["points"]) >= 2), lambda s: G.points_box(s["points"])), G.has_area)
    good = rows.filter("_corrupt_record IS NULL AND imageWidth > 0 AND imageHeight > 0")
    return good.select(N.stem(F.col("path")).alias("camera_id"), "path", F.col("imageWidth").alias("image_width"), F.col("imageHeight").alias("image_height"), boxes.alias("boxes")).filter(F.size("boxes") > 0).orderBy("camera_id")


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of names to camera ids; a .json ending of an id goes."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "camera_id")).withColumn("camera_id", F.regexp_replace("camera_id", r"\.json$", ""))


def camera_images(spark: SparkSession, path: str) -> DataFrame:
    """The preferred reference image of each camera; only chosen files' contents are read."""
    rank = F.array_position(F.array(*[F.lit(x) for x in IMAGE_EXTENSIONS]), N.extension(F.col("path")))
    found = spark.read.format("binaryFile").load(path).filter(rank > 0)
    best = found.groupBy(N.stem(F.col("path")).alias("camera_id")).agg(F.min_by("path", F.struct(rank, "path")).alias("path"))
    return found.select("path", "content").join(best, "path")


def write_regions(regions: DataFrame, path: str) -> None:
    regions.repartition("video_id").sortWithinPartitions("video_id", "frame_no", "box_idx").write.mode("overwrite").parquet(path)


def write_json(regions: DataFrame, path: str) -> None:
    """One line of JSON per video."""
    labels.to_json(regions).write.mode("overwrite").json(path)


def only_missing(videos: DataFrame, done: DataFrame, overwrite: bool = False) -> DataFrame:
    """Videos without an output of more than 0 bytes."""
    return videos if overwrite else videos.join(done.filter("length > 0").select("video_id"), "video_id", "left_anti")


def clear_steps(spark: SparkSession, root: str, tag: str, start: int = 1) -> list[str]:
    """Delete the output folders of the steps from `start` on; gives those that were there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = []
    for step in range(start, 5):
        path = jvm.org.apache.hadoop.fs.Path(root, N.step_folder(step, tag))
        if path.getFileSystem(conf).delete(path, True):
            gone.append(path.getName())
    return gone
