"""Ordered folds over a video's frames: gap filling, carrying forward, stabilising.

The folds depend on the order of frames and on greedy one-to-one matching, so they run per video
in one grouped function; face gaps, which pair boxes by position, are native (fill_face_gaps).
Regions are lists [x1, y1, x2, y2]; a video is a dict from frame number to its list of regions.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskwright.functions import geometry as G
from maskwright.session import ship_package


def center_key(r):
    return round((r[0] + r[2]) / 2, 3), round((r[1] + r[3]) / 2, 3)


def _measures(r):
    return (r[0] + r[2]) / 2, (r[1] + r[3]) / 2, max(1.0, r[2] - r[0], r[3] - r[1])


def _distance(ax, ay, bx, by) -> float:
    return math.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay))


def overlap(a, b) -> float:
    inter = max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    if inter <= 0:
        return 0.0
    union = sum(max(0.0, r[2] - r[0]) * max(0.0, r[3] - r[1]) for r in (a, b)) - inter
    return inter / union if union > 0 else 0.0


def is_repeat(regions, candidate, min_iou, max_distance) -> bool:
    x, y, side = _measures(candidate)
    for r in regions:
        ex, ey, _ = _measures(r)
        if overlap(r, candidate) >= min_iou or _distance(ex, ey, x, y) / side <= max_distance:
            return True
    return False


def pair_greedily(before, after, gaps, reach, min_iou, growth):
    """One-to-one pairs (i, j), best first: larger overlap, smaller distance, smaller gap, larger indices."""
    ranked = []
    for i, p in enumerate(before):
        px, py, ps = _measures(p)
        gap = max(1, gaps[i])
        for j, c in enumerate(after):
            cx, cy, cs = _measures(c)
            far = _distance(px, py, cx, cy) / max(ps, cs)
            same = overlap(p, c)
            if same >= min_iou or far <= reach + (gap - 1) * growth:
                ranked.append((same, -far, -gap, i, j))
    pairs, left, right = [], set(), set()
    for _, _, _, i, j in sorted(ranked, reverse=True):
        if i not in left and j not in right:
            left.add(i)
            right.add(j)
            pairs.append((i, j))
    return pairs


def between(a, b, t):
    return [p + (q - p) * t for p, q in zip(a, b)]


def fill_gaps(frames: dict, window: int, mode: str, cfg) -> dict:
    """Frames missing within a track get the boxes between, unless a similar one is there."""
    if window <= 0:
        return frames
    out = {f: [list(r) for r in regions] for f, regions in frames.items()}
    tracks: list[tuple[list, int]] = []
    for frame in sorted(frames):
        now = frames[frame]
        pairs = pair_greedily([b for b, _ in tracks], now, [frame - seen for _, seen in tracks], cfg.match_distance, cfg.match_iou, cfg.growth_gap)
        joined = dict(pairs)
        for i, j in pairs:
            box, seen = tracks[i]
            if 0 < frame - seen - 1 <= window:
                for f in range(seen + 1, frame):
                    t = (f - seen) / (frame - seen)
                    made = (list(box) if t <= 0.5 else list(now[j])) if mode == "nearest" else between(box, now[j], t)
                    here = out.setdefault(f, [])
                    if not is_repeat(here, made, cfg.temporal_dedupe_iou, cfg.temporal_dedupe_distance):
                        here.append(made)
        taken = set(joined.values())
        kept = [t for i, t in enumerate(tracks) if i not in joined and frame - t[1] <= window]
        tracks = kept + [(now[joined[i]], frame) for i in sorted(joined)] + [(r, frame) for j, r in enumerate(now) if j not in taken]
    return {f: r for f, r in out.items() if r}


def carry_forward(frames: dict, window: int, cfg) -> dict:
    """Boxes of tracks that are lost go on for at most `window` frames, past the last frame too."""
    if window <= 0 or not frames:
        return frames
    out = {f: [list(r) for r in regions] for f, regions in frames.items()}
    tracks: list[tuple[list, int]] = []
    for frame in range(min(frames), max(frames) + window + 1):
        now = frames.get(frame, [])
        pairs = pair_greedily([b for b, _ in tracks], now, [frame - seen for _, seen in tracks], cfg.match_distance, cfg.match_iou, cfg.growth_carry)
        joined = dict(pairs)
        here = [list(r) for r in now]
        kept = []
        for i, (box, seen) in enumerate(tracks):
            if i not in joined and 0 < frame - seen <= window:
                kept.append((box, seen))
                if not is_repeat(here, box, cfg.temporal_dedupe_iou, cfg.temporal_dedupe_distance):
                    here.append(list(box))
        taken = set(joined.values())
        tracks = [(now[j], frame) for _, j in pairs] + kept + [(r, frame) for j, r in enumerate(now) if j not in taken]
        if here:
            out[frame] = sorted(here, key=center_key)
    return out


def stabilize(frames: dict, width: float, height: float, cfg) -> dict:
    """Boxes are expanded and smoothed along their matches with the frame visited before."""
    if not cfg.temporal_smoothing:
        return frames
    alpha = min(1.0, max(0.0, cfg.smoothing_alpha))
    out, before = {}, []
    for frame in sorted(frames):
        now = [_expanded(r, width, height, cfg) for r in frames[frame]]
        for i, j in pair_greedily(before, now, [1] * len(before), cfg.match_distance, cfg.match_iou, 0.0):
            now[j] = [p * (1 - alpha) + c * alpha for p, c in zip(before[i], now[j])]
        before = out[frame] = sorted(now, key=center_key)
    return out


def _expanded(r, width, height, cfg):
    w, h = max(0.0, r[2] - r[0]), max(0.0, r[3] - r[1])
    w2 = max(w + 2 * cfg.pad_px, w * (1 + 2 * cfg.pad_ratio), cfg.min_width)
    h2 = max(h + 2 * cfg.pad_px, h * (1 + 2 * cfg.pad_ratio), cfg.min_height)
    cx, cy = (r[0] + r[2]) / 2, (r[1] + r[3]) / 2
    return [min(max(0.0, v), top) for v, top in zip((cx - w2 / 2, cy - h2 / 2, cx + w2 / 2, cy + h2 / 2), (width, height, width, height))]


def run_folds(frames: dict, width: float, height: float, cfg, steps) -> dict:
    if "fill" in steps:
        frames = fill_gaps(frames, cfg.gap_fill_window, cfg.gap_fill_mode, cfg)
    if "carry" in steps:
        frames = carry_forward(frames, cfg.carry_forward_window, cfg)
    if "stabilize" in steps:
        frames = stabilize(frames, width, height, cfg)
    return frames


def temporal_folds(regions: DataFrame, cfg, steps=("fill", "carry", "stabilize"), width: float = 1920.0, height: float = 1080.0) -> DataFrame:
    """regions(video_id, frame_no, box_idx, x1..y2) after the given folds; one shuffle, on video_id."""
    ship_package(regions.sparkSession)
    kind = regions.schema["video_id"].dataType.simpleString()
    columns = ["video_id", "frame_no", "box_idx", "x1", "y1", "x2", "y2"]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["frame_no", "box_idx"], kind="stable")
        frames: dict[int, list] = {}
        for f, *r in zip(*(pdf[c].tolist() for c in ("frame_no", "x1", "y1", "x2", "y2"))):
            frames.setdefault(f, []).append(r)
        done = run_folds(frames, width, height, cfg, steps)
        video = pdf["video_id"].iloc[0]
        return pd.DataFrame([(video, f, i, *r) for f in sorted(done) for i, r in enumerate(done[f])], columns=columns)

    return regions.select(*columns).groupBy("video_id").applyInPandas(one, f"video_id {kind}, frame_no int, box_idx int, x1 double, y1 double, x2 double, y2 double")


def fill_face_gaps(regions: DataFrame, window: int, mode: str = "interpolate") -> DataFrame:
    """Gaps between detected frames, at most `window` frames long, filled box by box in list order.

    Native: frames are packed to arrays, the next frame comes by lead(), frames between by
    sequence(), and the shorter list decides how many boxes are paired. Ties of nearest go later.
    """
    b = F.struct("x1", "y1", "x2", "y2")
    frames = regions.groupBy("video_id", "frame_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("box_idx", b.alias("b")))), lambda s: s["b"]).alias("boxes"))
    w = Window.partitionBy("video_id").orderBy("frame_no")
    paired = frames.withColumns({"next_no": F.lead("frame_no").over(w), "next_boxes": F.lead("boxes").over(w)})
    gap = F.col("next_no") - F.col("frame_no") - 1
    between_ = F.when((gap > 0) & (gap <= window), F.sequence(F.col("frame_no") + 1, F.col("next_no") - 1)).otherwise(F.array().cast("array<int>"))
    n = F.least(F.size("boxes"), F.size("next_boxes"))

    def made(f):
        t = (f - F.col("frame_no")).cast("double") / (F.col("next_no") - F.col("frame_no")).cast("double")

        def one(a, c):
            return F.when(t < 0.5, a).otherwise(c) if mode == "nearest" else G.interpolate(a, c, t)

        return F.struct(f.alias("frame_no"), F.zip_with(F.slice("boxes", F.lit(1), n), F.slice("next_boxes", F.lit(1), n), one).alias("boxes"), F.lit("filled").alias("origin"))

    own = F.array(F.struct(F.col("frame_no"), F.col("boxes"), F.lit("detected").alias("origin")))
    every = paired.select("video_id", F.explode(F.concat(own, F.coalesce(F.transform(between_, made), F.array().cast("array<struct<frame_no:int,boxes:array<struct<x1:double,y1:double,x2:double,y2:double>>,origin:string>>")))).alias("f"))
    return every.select("video_id", "f.frame_no", "f.origin", F.posexplode("f.boxes").alias("box_idx", "b")).select("video_id", "frame_no", "box_idx", "origin", "b.x1", "b.y1", "b.x2", "b.y2")
