"""Pixel operators over tables of frames, Arrow batches in and out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.functions import images
from maskwright.session import ship_package

#: Rows of an Arrow batch of frames; frames are large.
FRAME_ROWS = 16


def blur_frames(frames: DataFrame, how: str = "gaussian", size: int = 31, power: int = 1) -> DataFrame:
    """frames(video_id, frame_no, height, width, channels, pixels, rects array<array<int>>) with blurred pixels.

    how: "gaussian" blurs in place in order, "box" blurs crops of the original. A frame whose bytes
    don't fit its size passes with status "bad frame".
    """
    ship_package(frames.sparkSession)

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, FRAME_ROWS):
                part = batch.slice(k, FRAME_ROWS)
                pixels, status = [], []
                for h, w, c, raw, rects in zip(*(part.column(n).to_pylist() for n in ("height", "width", "channels", "pixels", "rects"))):
                    if raw is None or len(raw) != h * w * c:
                        pixels.append(raw)
                        status.append("bad frame")
                        continue
                    img = np.frombuffer(raw, np.uint8).reshape((h, w, c) if c > 1 else (h, w))
                    done = images.blur_in_place(img, rects or [], size) if how == "gaussian" else images.mask_boxes(img, rects or [], size, power)
                    pixels.append(done.tobytes())
                    status.append("ok")
                yield pa.RecordBatch.from_arrays([part.column(n) for n in ("video_id", "frame_no", "height", "width", "channels")] + [pa.array(pixels, pa.binary()), pa.array(status)], ["video_id", "frame_no", "height", "width", "channels", "pixels", "status"])

    kinds = {f.name: f.dataType.simpleString() for f in frames.schema}
    schema = ", ".join(f"{n} {kinds[n]}" for n in ("video_id", "frame_no", "height", "width", "channels")) + ", pixels binary, status string"
    return frames.select("video_id", "frame_no", "height", "width", "channels", "pixels", "rects").mapInArrow(run, schema)


def first_frames(frames: DataFrame) -> DataFrame:
    return frames.filter("frame_no = 1")


def signatures(frames: DataFrame) -> DataFrame:
    """frames(image_id, height, width, channels, pixels, boxes array<array<int>>): (image_id, signature), null for none."""
    ship_package(frames.sparkSession)

    def run(batches):
        for batch in batches:
            out = []
            for h, w, c, raw, boxes in zip(*(batch.column(i).to_pylist() for i in range(1, 6))):
                s = images.signature(np.frombuffer(raw, np.uint8).reshape((h, w, c) if c > 1 else (h, w)), boxes)
                out.append(None if s is None else s.astype(np.float32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.float32()))], ["image_id", "signature"])

    return frames.select(F.col("image_id").cast("long").alias("image_id"), "height", "width", "channels", "pixels", "boxes").mapInArrow(run, "image_id long, signature array<float>")


def gray_frames(images_: DataFrame, side: int = 8) -> DataFrame:
    """Arrays of numbers as frames: scaled by each array's range to bytes."""
    ship_package(images_.sparkSession)

    def run(batches):
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                x = np.array(v, float)
                span = x.max() - x.min()
                out.append(np.rint((x - x.min()) / (span if span > 0 else 1) * 255).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["image_id", "pixels"])

    rows = images_.select("image_id", "gray").mapInArrow(run, "image_id long, pixels binary")
    return rows.withColumns({"height": F.lit(side), "width": F.lit(side), "channels": F.lit(1)})
