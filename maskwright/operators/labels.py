"""Label lines to detections, regions and nested frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.functions import geometry as G
from maskwright.functions import names as N


def parse(lines: DataFrame, *keep: str) -> DataFrame:
    """lines(path, box_idx, value) with their video, frame, numbers and a status; nothing is dropped."""
    t = F.split(F.trim("value"), r"\s+")
    number = lambda i: F.get(t, F.lit(i)).try_cast("double")
    rows = lines.select(
        N.video_of_label(F.col("path")).alias("video_id"), N.frame_number(F.col("path")).alias("frame_no"), "box_idx",
        F.get(t, F.lit(0)).try_cast("int").alias("class_id"), number(1).alias("cx"), number(2).alias("cy"), number(3).alias("bw"), number(4).alias("bh"),
        F.size(t).alias("tokens"), (F.trim("value") == "").alias("blank"), *keep,
    )
    bad = F.col("cx").isNull() | F.col("cy").isNull() | F.col("bw").isNull() | F.col("bh").isNull()
    status = F.when(F.col("blank"), "blank").when(F.col("frame_no").isNull(), "bad frame").when(F.col("tokens") < 5, "too few tokens").when(bad, "bad number").otherwise("ok")
    return rows.withColumn("status", status).drop("tokens", "blank")


def detections(lines: DataFrame) -> DataFrame:
    return parse(lines).filter("status = 'ok'").drop("status")


def face_detections(lines: DataFrame) -> DataFrame:
    """Label lines for faces: a file counts for the video that its name gives without the frame number, and
    for a video of the file's whole name; both, without distinct. Which videos there are decides a later join."""
    parsed = parse(lines.withColumn("file", N.stem(F.col("path"))), "file").filter("status = 'ok'").drop("status")
    return parsed.drop("file").unionByName(parsed.drop("video_id").withColumnRenamed("file", "video_id"))


def confident(rows: DataFrame, passes: DataFrame) -> DataFrame:
    """rows(pass_name, score, ...) of at least their pass's threshold, from passes(pass_name, conf)."""
    limits = passes.select("pass_name", "conf").distinct()
    return rows.join(limits, "pass_name").filter(F.col("score") >= F.col("conf")).drop("conf")


def rejected(lines: DataFrame) -> DataFrame:
    return parse(lines).filter("status <> 'ok'").select("video_id", "frame_no", "box_idx", "status")


def to_pixels(rows: DataFrame, width: int, height: int) -> DataFrame:
    b = G.from_yolo(*[F.col(c) for c in ("cx", "cy", "bw", "bh")], F.lit(width), F.lit(height))
    return rows.withColumn("b", b).select("video_id", "frame_no", "box_idx", "b.x1", "b.y1", "b.x2", "b.y2")


def by_frame(regions: DataFrame) -> DataFrame:
    """One row per frame with its boxes in order."""
    packed = F.array_sort(F.collect_list(F.struct("box_idx", F.struct("x1", "y1", "x2", "y2").alias("b"))))
    return regions.groupBy("video_id", "frame_no").agg(F.transform(packed, lambda s: s["b"]).alias("boxes"))


def dedupe_frames(regions: DataFrame, min_iou: float, max_distance: float) -> DataFrame:
    """Greedy distinct boxes of each frame, renumbered in order of their centres."""
    frames = by_frame(regions).select("video_id", "frame_no", F.posexplode(G.dedupe(F.col("boxes"), min_iou, max_distance)).alias("box_idx", "b"))
    return frames.select("video_id", "frame_no", "box_idx", "b.x1", "b.y1", "b.x2", "b.y2")


def merge_passes(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Union of two passes' label lines, each line of a file once."""
    both = primary.withColumn("pass_name", F.lit("primary")).unionByName(secondary.withColumn("pass_name", F.lit("secondary")))
    return both.groupBy("path", "value").agg(F.min("pass_name").alias("pass_name"), F.count("*").alias("times"))


def to_json(regions: DataFrame) -> DataFrame:
    """A video's detections as JSON: frame number to list of [x1, y1, x2, y2], frames in order."""
    frames = by_frame(regions).select("video_id", "frame_no", F.transform("boxes", lambda b: F.array(b["x1"], b["y1"], b["x2"], b["y2"])).alias("boxes"))
    entries = F.array_sort(F.collect_list(F.struct("frame_no", "boxes")))
    pairs = F.transform(entries, lambda e: F.struct(e["frame_no"].cast("string").alias("k"), e["boxes"].alias("v")))
    return frames.groupBy("video_id").agg(F.to_json(F.map_from_entries(pairs)).alias("json"))


def from_json(rows: DataFrame) -> DataFrame:
    parsed = rows.select("video_id", F.explode(F.from_json("json", "map<string, array<array<double>>>")).alias("k", "boxes"))
    flat = parsed.select("video_id", F.col("k").cast("int").alias("frame_no"), F.posexplode("boxes").alias("box_idx", "b"))
    return flat.select("video_id", "frame_no", "box_idx", *[F.col("b")[i].alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


def within_time(frames: DataFrame, limit, fps) -> DataFrame:
    """Frames up to int(limit * fps); no limit if that is null or 0."""
    most = F.floor(F.lit(limit).cast("double") * fps)
    return frames.filter((F.coalesce(most, F.lit(0)) <= 0) | (F.col("frame_no") <= most))


def join_frames(frames: DataFrame, regions: DataFrame) -> DataFrame:
    """Every frame with its boxes; frames without any keep an empty list, regions past the video go."""
    return frames.join(by_frame(regions), ["video_id", "frame_no"], "left").withColumn("boxes", F.coalesce("boxes", F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")))


def summary(regions: DataFrame) -> DataFrame:
    """Counts per video."""
    return regions.groupBy("video_id").agg(F.countDistinct("frame_no").alias("frames_detected"), F.count("*").alias("boxes"), F.min("frame_no").alias("first_frame"), F.max("frame_no").alias("last_frame"))


def run_counts(regions: DataFrame) -> DataFrame:
    """Per video: frames, and boxes and frames by origin, of regions(video_id, frame_no, origin)."""
    of = lambda origin: F.col("origin") == origin
    frames = lambda origin: F.countDistinct(F.when(of(origin), F.col("frame_no")))
    return regions.groupBy("video_id").agg(
        F.countDistinct("frame_no").alias("frames"), F.count_if(of("detected")).alias("detected"), F.count_if(of("filled")).alias("filled"),
        frames("detected").alias("frames_detected"), frames("filled").alias("frames_filled"),
    )


def frame_counts(frames: DataFrame, regions: DataFrame) -> DataFrame:
    """Per video the frames there are, and those with boxes."""
    joined = join_frames(frames, regions)
    return joined.groupBy("video_id").agg(F.count("*").alias("frames"), F.count_if(F.size("boxes") > 0).alias("frames_with_regions"))
