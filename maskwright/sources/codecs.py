"""Interfaces to what lies outside Spark: probes, decoders, encoders and detectors.

Implementations are given by the user; the ones here are stubs for tests. Rows that fail carry a
status and go on, as one bad video must not stop a batch.
"""

from __future__ import annotations

import shutil
from collections.abc import Iterable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.session import ship_package


class Probe(Protocol):
    def __call__(self, path: str) -> dict: ...


class Decoder(Protocol):
    def __call__(self, path: str, last_frame: int | None) -> Iterator[tuple[int, int, int, int, bytes]]:
        """Frame number, height, width, channels, pixels."""


class Encoder(Protocol):
    def __call__(self, path: str, frames: Iterable[tuple[int, int, int, int, bytes]], fps: float) -> int: ...


class Detector(Protocol):
    def __call__(self, images: list[bytes], device: str) -> list[list[tuple[int, float, float, float, float]]]:
        """Class and normalised centre and size of each image's boxes."""


def find_tool(name: str) -> str:
    found = shutil.which(name)
    if not found:
        raise RuntimeError(f"{name} is not installed; give a codec of your own")
    return found


def detect(frames: DataFrame, make_detector, batch: int = 8, cpu_fallback: bool = True) -> DataFrame:
    """frames(video_id, frame_no, pixels) to detections with a status.

    The detector is made once per task. A batch that fails is tried again image by image, then on
    the CPU; an image that still fails gives one row without a box and status "failed".
    """
    ship_package(frames.sparkSession)
    kind = frames.schema["video_id"].dataType.simpleString()

    def attempt(detector, images):
        try:
            return [(r, "ok") for r in detector(images, "gpu")]
        except Exception:
            pass
        out = []
        for image in images:
            result, status = [], "failed"
            for device in ("gpu", "cpu") if cpu_fallback else ("gpu",):
                try:
                    result, status = detector([image], device)[0], "retried" if device == "gpu" else "cpu"
                    break
                except Exception:
                    continue
            out.append((result, status))
        return out

    def run(batches):
        detector = make_detector()
        for pdf in batches:
            rows = []
            for k in range(0, len(pdf), batch):
                part = pdf.iloc[k : k + batch]
                for (video, frame), (boxes, status) in zip(zip(part.video_id, part.frame_no), attempt(detector, [bytes(p) for p in part.pixels])):
                    rows += [(video, frame, i, int(b[0]), *map(float, b[1:]), status) for i, b in enumerate(boxes)]
                    if status == "failed":
                        rows.append((video, frame, None, None, None, None, None, None, status))
            yield pd.DataFrame(rows, columns=["video_id", "frame_no", "box_idx", "class_id", "cx", "cy", "bw", "bh", "status"]).astype({"box_idx": "Int32", "class_id": "Int32"})

    return frames.select("video_id", "frame_no", "pixels").mapInPandas(run, f"video_id {kind}, frame_no int, box_idx int, class_id int, cx double, cy double, bw double, bh double, status string")


def decode(videos: DataFrame, decoder: Decoder) -> DataFrame:
    """videos(video_id, path, last_frame) to frames, streamed; a video that fails gives one row of status "failed"."""
    kind = videos.schema["video_id"].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            for video, path, last in zip(pdf.video_id, pdf.path, pdf.last_frame):
                last = None if pd.isna(last) else int(last)
                try:
                    for frame, h, w, c, pixels in decoder(path, last):
                        if last is not None and frame > last:
                            break
                        yield pd.DataFrame([(video, frame, h, w, c, pixels, "ok")], columns=["video_id", "frame_no", "height", "width", "channels", "pixels", "status"])
                except Exception:
                    yield pd.DataFrame([(video, 0, 0, 0, 0, b"", "failed")], columns=["video_id", "frame_no", "height", "width", "channels", "pixels", "status"])

    return videos.select("video_id", "path", "last_frame").mapInPandas(run, f"video_id {kind}, frame_no int, height int, width int, channels int, pixels binary, status string")


def encode(frames: DataFrame, encoder: Encoder, out_dir: str, fps: float, suffix: str = ".mp4") -> DataFrame:
    """Frames of each video, in order, streamed into the encoder: (video_id, path, frames, status)."""
    kind = frames.schema["video_id"].dataType.simpleString()

    def run(batches):
        import itertools

        def rows():
            for pdf in batches:
                yield from zip(pdf.video_id, pdf.frame_no, pdf.height, pdf.width, pdf.channels, pdf.pixels)

        for video, group in itertools.groupby(rows(), key=lambda r: r[0]):
            path = f"{out_dir}/{video}{suffix}"
            try:
                n, status = encoder(path, (r[1:] for r in group), fps), "ok"
            except Exception:
                n, status = 0, "failed"
            yield pd.DataFrame([(video, path, n, status)], columns=["video_id", "path", "frames", "status"])

    ordered = frames.repartition("video_id").sortWithinPartitions("video_id", "frame_no")
    return ordered.select("video_id", "frame_no", "height", "width", "channels", "pixels").mapInPandas(run, f"video_id {kind}, path string, frames int, status string")


def redact(videos: DataFrame, rectangles: DataFrame, decoder: Decoder, encoder: Encoder, out_dir: str, fps: float = 25.0, suffix: str = ".mp4") -> DataFrame:
    """videos(video_id, path, last_frame) decoded, blurred and encoded in one task per video: (video_id, path, frames, status).

    rectangles(video_id, frame_no, x1, y1, x2, y2, kernel) come to the videos, so no pixel is shuffled;
    those without a frame number hold for every frame. Frames stream from the decoder to the encoder. A
    video without rectangles has status "passthrough" and keeps its path; one that fails, "failed".
    """
    from maskwright.functions import images

    ship_package(videos.sparkSession)
    kind = videos.schema["video_id"].dataType.simpleString()
    each = F.struct(F.coalesce("frame_no", F.lit(0)).alias("f"), "x1", "y1", "x2", "y2", F.col("kernel").cast("int").alias("k"))
    packed = rectangles.groupBy("video_id").agg(F.sort_array(F.collect_list(each)).alias("rects"))
    jobs = videos.select("video_id", "path", "last_frame").join(packed, "video_id", "left")

    def blurred(path, last, rects):
        by: dict[int, list] = {}
        for r in rects:
            by.setdefault(r["f"], []).append(r)
        for frame, h, w, c, pixels in decoder(path, last):
            if last is not None and frame > last:
                return
            mine = [*by.get(0, []), *by.get(frame, [])]
            if mine:
                img = np.frombuffer(pixels, np.uint8).reshape((h, w, c) if c > 1 else (h, w))
                for r in mine:
                    img = images.blur_in_place(img, [(r["x1"], r["y1"], r["x2"], r["y2"])], r["k"])
                pixels = img.tobytes()
            yield frame, h, w, c, pixels

    def run(batches):
        for batch in batches:
            for video, path, last, rects in zip(*(batch.column(n).to_pylist() for n in ("video_id", "path", "last_frame", "rects"))):
                out, n, status = f"{out_dir}/{video}{suffix}", 0, "ok"
                if not rects:
                    out, status = path, "passthrough"
                else:
                    try:
                        n = encoder(out, blurred(path, last, rects), fps)
                    except Exception:
                        status = "failed"
                yield pa.RecordBatch.from_arrays([pa.array([video], batch.schema.field("video_id").type), pa.array([out]), pa.array([n], pa.int32()), pa.array([status])], ["video_id", "path", "frames", "status"])

    return jobs.mapInArrow(run, f"video_id {kind}, path string, frames int, status string")
