"""Balanced shards and detection passes."""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def assign_shards(items: DataFrame, shards: int) -> DataFrame:
    """items(item_id, weight, ...) with shard_id: heaviest first to the lightest shard so far.

    Ties of weight go by item_id, ties of load to the lowest shard; repeated rows are items of their
    own, and a null weight counts as 0. Greedy balancing is a sequential fold over all items, so they are sorted and streamed
    through one task at every size; it holds the shards' loads only, and its sort spills.
    """
    at, n = items.columns.index("weight"), max(1, shards)

    def deal(batches):
        heap = [(0, k) for k in range(n)]
        for batch in batches:
            out = []
            for weight in batch.column(at).to_pylist():
                total, k = heap[0]
                heapq.heapreplace(heap, (total + (weight or 0), k))
                out.append(k)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], [*batch.schema.names, "shard_id"])

    ordered = items.repartition(1).sortWithinPartitions(F.coalesce("weight", F.lit(0)).desc(), "item_id")
    return ordered.mapInArrow(deal, StructType([*items.schema.fields, StructField("shard_id", IntegerType())]))


def default_batch(imgsz: int) -> int:
    """The batch size that an image size gets if none is given; names.batch_size() is the same as a Column."""
    return next((n for least, n in ((5120, 2), (3840, 3), (2560, 4), (1920, 8)) if imgsz >= least), 16)


def detection_passes(cfg) -> list[dict]:
    """The primary pass and, if it is on, the secondary one.

    The secondary pass has the primary threshold unless it has its own; a batch size that isn't given
    follows from the pass's image size.
    """
    def one(name, imgsz, conf, augment, batch):
        return {"pass_name": name, "imgsz": imgsz, "conf": conf, "augment": augment, "batch": max(1, batch) if batch is not None else default_batch(imgsz)}

    passes = [one("primary", cfg.imgsz, cfg.detection_conf_thresh, cfg.augment, cfg.detect_batch_size)]
    if cfg.secondary:
        conf = cfg.detection_conf_thresh if cfg.secondary_conf_thresh is None else cfg.secondary_conf_thresh
        passes.append(one("secondary", cfg.secondary_imgsz or cfg.imgsz, conf, cfg.secondary_augment, cfg.secondary_batch_size))
    return passes


def shard_weight(frames, width, height):
    """Frames times pixels, each at least 1."""
    one = F.lit(1)
    return F.greatest(one, frames).cast("long") * F.greatest(one, width).cast("long") * F.greatest(one, height).cast("long")


def workers(requested: int, ids: int, items: int) -> int:
    return max(1, min(requested, ids, items)) if ids and items else 1


def sample_videos(videos: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n videos, the same ones for a seed."""
    return videos.orderBy(F.xxhash64("video_id", F.lit(seed)), "video_id").limit(n)


