"""The anonymisation steps as resumable DataFrame transformations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.config import CAR_PLATES, TRUCK_PLATES, FaceConfig, OverlayConfig, PlateConfig
from maskwright.functions import geometry as G
from maskwright.functions import names as N
from maskwright.operators import labels, temporal


@dataclass(frozen=True)
class Step:
    """A step and how its rectangles are made; every step detects anew, so it needs no other step's."""

    number: int
    name: str
    run: Callable[[], DataFrame]


def plate_regions(detected: DataFrame, cfg=CAR_PLATES, width: int = 1920, height: int = 1080) -> DataFrame:
    """Detections to final regions: distinct in each frame, then the temporal folds."""
    distinct = labels.dedupe_frames(detected, cfg.frame_dedupe_iou, cfg.frame_dedupe_distance)
    return temporal.temporal_folds(distinct, cfg, width=width, height=height)


def face_regions(detected: DataFrame, cfg=FaceConfig()) -> DataFrame:
    return temporal.fill_face_gaps(detected, cfg.gap_fill_window, cfg.gap_fill_mode).drop("origin")


def blur_plan(regions: DataFrame, cfg, width: int, height: int) -> DataFrame:
    """Rectangles to blur and their kernel; empty ones go."""
    r = G.blur_rectangle(F.struct("x1", "y1", "x2", "y2"), F.lit(width), F.lit(height), cfg)
    rows = regions.withColumn("r", r).filter(G.has_area(F.col("r")))
    return rows.select("video_id", "frame_no", "box_idx", "r.x1", "r.y1", "r.x2", "r.y2", G.odd_kernel(F.lit(cfg.blur_radius)).alias("kernel"))


def overlay_jobs(videos: DataFrame, matches: DataFrame, cameras: DataFrame, cfg, suffix: str = "_masked") -> DataFrame:
    """One row per video: its scaled boxes and filter graph, or status "passthrough" without a match."""
    from maskwright.operators.matching import small

    j = videos.join(matches.select("video_id", "camera_id"), "video_id", "left").join(small(cameras.select("camera_id", "image_width", "image_height", "boxes")), "camera_id", "left")
    sx, sy = F.col("width") / F.col("image_width"), F.col("height") / F.col("image_height")
    scaled = F.filter(F.transform("boxes", lambda b: G.scale_box(b, sx, sy, F.col("width"), F.col("height"), cfg.pad)), G.has_area)
    j = j.withColumn("scaled", F.coalesce(scaled, F.array().cast("array<struct<x1:int,y1:int,x2:int,y2:int>>")))
    graph = F.when(F.size("scaled") > 0, G.filter_graph(F.col("scaled"), cfg.blur_radius, cfg.blur_power, F.col("width"), cfg.max_output_width))
    return j.select(
        "video_id", "path", "camera_id", "scaled", graph.alias("filter_graph"),
        F.concat(N.stem(F.col("path")), F.lit(suffix), N.extension(F.col("path"))).alias("output_name"),
        F.when(F.size("scaled") > 0, "masked").otherwise("passthrough").alias("status"),
    )


def plate_outputs(videos: DataFrame, rectangles: DataFrame) -> DataFrame:
    """What becomes of every video in a plate step: blurred with so many rectangles, or passed through."""
    n = rectangles.groupBy("video_id").agg(F.count("*").alias("rectangles"), F.countDistinct("frame_no").alias("frames"))
    j = videos.select("video_id", "path").join(n, "video_id", "left").withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("rectangles", "frames")})
    return j.withColumns({"status": F.when(F.col("rectangles") > 0, "blurred").otherwise("passthrough"), "output_name": N.file_name(F.col("path"))})


def run_steps(steps: list[Step], start: int = 1, keep: Callable[[int, DataFrame], DataFrame] | None = None) -> DataFrame:
    """The rectangles of the steps from `start` on, in order; keep() may write a step's result and give what to go on with."""
    out = None
    for step in sorted(steps, key=lambda s: s.number):
        if step.number >= start:
            made = step.run().withColumn("step", F.lit(step.number))
            made = keep(step.number, made) if keep else made
            out = made if out is None else out.unionByName(made)
    if out is None:
        raise ValueError(f"no step from {start} on")
    return out


def overlay_rectangles(jobs: DataFrame, cfg=OverlayConfig()) -> DataFrame:
    """The boxes of overlay_jobs() as rectangles; they hold for all frames (frame_no is null)."""
    rows = jobs.select("video_id", F.lit(None).cast("int").alias("frame_no"), F.posexplode("scaled").alias("box_idx", "r"))
    return rows.select("video_id", "frame_no", "box_idx", "r.x1", "r.y1", "r.x2", "r.y2", F.lit(cfg.blur_radius).alias("kernel"))


def default_steps(detections: Callable[[int], DataFrame], videos: DataFrame, matches: DataFrame, cameras: DataFrame, width: int = 1920, height: int = 1080) -> list[Step]:
    """The four steps: detections(number) gives what a step's detector finds, matches the cameras of step 3."""
    face = FaceConfig()
    return [
        Step(1, "car plates", lambda: blur_plan(plate_regions(detections(1), CAR_PLATES, width, height), CAR_PLATES, width, height)),
        Step(2, "truck plates", lambda: blur_plan(plate_regions(detections(2), TRUCK_PLATES, width, height), TRUCK_PLATES, width, height)),
        Step(3, "time and location overlay", lambda: overlay_rectangles(overlay_jobs(videos, matches, cameras, OverlayConfig()))),
        Step(4, "faces", lambda: blur_plan(face_regions(detections(4), face), PlateConfig(blur_radius=face.blur_radius), width, height)),
    ]
