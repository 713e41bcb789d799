"""Streaming form of the gap fill: state per video is its tracks; an extension, batches remain the reference."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame

from maskwright.operators import temporal
from maskwright.session import ship_package


def stream_gap_fill(regions: DataFrame, cfg, timeout: str = "1 hour") -> DataFrame:
    """regions(video_id, frame_no, box_idx, x1..y2), frames of a video in order across micro-batches.

    Each micro-batch gives the boxes detected in it and those that fill gaps up to them. State is
    the last box of each open track, so it is bounded by the boxes of gap_fill_window frames; a
    video without new frames for `timeout` loses it.
    """
    ship_package(regions.sparkSession)
    kind = regions.schema["video_id"].dataType.simpleString()
    columns = ["video_id", "frame_no", "box_idx", "x1", "y1", "x2", "y2"]

    def update(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        old: dict[int, list] = {int(f): r for f, r in json.loads(state.get[0]).items()} if state.exists else {}
        frames = dict(old)
        for pdf in pdfs:
            for f, *r in zip(*(pdf[c].tolist() for c in ("frame_no", "x1", "y1", "x2", "y2"))):
                frames.setdefault(int(f), []).append(r)
        done = temporal.fill_gaps(frames, cfg.gap_fill_window, cfg.gap_fill_mode, cfg)
        last = max(old, default=0)
        new = {f: r for f, r in done.items() if f > last}
        keep = {f: r for f, r in frames.items() if f >= max(frames) - cfg.gap_fill_window}
        state.update((json.dumps(keep),))
        state.setTimeoutDuration(_ms(timeout))
        yield pd.DataFrame([(key[0], f, i, *r) for f in sorted(new) for i, r in enumerate(new[f])], columns=columns)

    schema = f"video_id {kind}, frame_no int, box_idx int, x1 double, y1 double, x2 double, y2 double"
    return regions.select(*columns).groupBy("video_id").applyInPandasWithState(update, schema, "frames string", "append", "ProcessingTimeTimeout")


def _ms(text: str) -> int:
    number, unit = text.split()
    return int(number) * {"second": 1000, "minute": 60_000, "hour": 3_600_000}[unit.rstrip("s")]
