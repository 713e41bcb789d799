"""Box geometry as Column functions; a box is a struct of doubles x1, y1, x2, y2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x1, y1, x2, y2) -> Column:
    return F.struct(*[c.cast("double").alias(n) for c, n in zip((x1, y1, x2, y2), ("x1", "y1", "x2", "y2"))])


def center_x(b: Column) -> Column:
    return (b["x1"] + b["x2"]) / 2.0


def center_y(b: Column) -> Column:
    return (b["y1"] + b["y2"]) / 2.0


def width(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["x2"] - b["x1"])


def height(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["y2"] - b["y1"])


def area(b: Column) -> Column:
    return width(b) * height(b)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 without overlap."""
    w = F.greatest(F.lit(0.0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    h = F.greatest(F.lit(0.0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    inter = w * h
    union = area(a) + area(b) - inter
    return F.when((inter > 0) & (union > 0), inter / F.when(union > 0, union)).otherwise(F.lit(0.0))


def scale_of(b: Column) -> Column:
    return F.greatest(F.lit(1.0), width(b), height(b))


def distance_ratio(a: Column, b: Column, scale: Column) -> Column:
    """Distance of centres as a share of the given scale."""
    dx, dy = center_x(a) - center_x(b), center_y(a) - center_y(b)
    return F.sqrt(dx * dx + dy * dy) / scale


def similar(existing: Column, candidate: Column, min_iou: float, max_distance: float) -> Column:
    """Whether a candidate repeats an existing box; only the candidate's size is the scale."""
    return (iou(existing, candidate) >= min_iou) | (distance_ratio(existing, candidate, scale_of(candidate)) <= max_distance)


def allowed_distance(ratio: float, gap: Column, growth: float) -> Column:
    return F.lit(ratio) + F.greatest(F.lit(0), gap - 1) * growth


def interpolate(a: Column, b: Column, t: Column) -> Column:
    return F.struct(*[(a[n] + (b[n] - a[n]) * t).alias(n) for n in ("x1", "y1", "x2", "y2")])


def clip(b: Column, w: Column, h: Column) -> Column:
    def inside(v, top):
        return F.greatest(F.lit(0.0), F.least(top.cast("double"), v))

    return F.struct(inside(b["x1"], w).alias("x1"), inside(b["y1"], h).alias("y1"), inside(b["x2"], w).alias("x2"), inside(b["y2"], h).alias("y2"))


def expand(b: Column, w: Column, h: Column, pad_px: float, pad_ratio: float, min_w: float, min_h: float) -> Column:
    """Grown about its centre to the largest of padded, relative and least size, then clipped to the frame."""
    new_w = F.greatest(width(b) + 2 * pad_px, width(b) * (1 + 2 * pad_ratio), F.lit(float(min_w)))
    new_h = F.greatest(height(b) + 2 * pad_px, height(b) * (1 + 2 * pad_ratio), F.lit(float(min_h)))
    cx, cy = center_x(b), center_y(b)
    return clip(F.struct((cx - new_w / 2).alias("x1"), (cy - new_h / 2).alias("y1"), (cx + new_w / 2).alias("x2"), (cy + new_h / 2).alias("y2")), w, h)


def smooth(previous: Column, current: Column, alpha: float) -> Column:
    a = min(1.0, max(0.0, alpha))
    return F.struct(*[(previous[n] * (1 - a) + current[n] * a).alias(n) for n in ("x1", "y1", "x2", "y2")])


def from_yolo(cx: Column, cy: Column, bw: Column, bh: Column, w: Column, h: Column, clipped: bool = True, rounded: bool = True) -> Column:
    """Pixel corners of a normalised centre and size; rounds half to even."""
    raw = [(cx - bw / 2) * w, (cy - bh / 2) * h, (cx + bw / 2) * w, (cy + bh / 2) * h]
    if rounded:
        raw = [F.rint(v) for v in raw]
    b = box(*raw)
    return clip(b, w, h) if clipped else b


def scale_box(b: Column, sx: Column, sy: Column, w: Column, h: Column, pad: int = 0) -> Column:
    """Template box in a video's size: scaled, rounded half to even, padded, clipped; ints."""
    def put(v, top, d):
        return F.greatest(F.lit(0), F.least(top, F.rint(v).cast("int") + d)).cast("int")

    return F.struct(
        put(b["x1"] * sx, w, -pad).alias("x1"), put(b["y1"] * sy, h, -pad).alias("y1"),
        put(b["x2"] * sx, w, pad).alias("x2"), put(b["y2"] * sy, h, pad).alias("y2"),
    )


def scale_box_truncated(b: Column, sx: Column, sy: Column) -> Column:
    """Template box for matching: scaled and truncated, neither padded nor clipped."""
    return F.struct(*[(b[n] * (sx if n[0] == "x" else sy)).cast("int").alias(n) for n in ("x1", "y1", "x2", "y2")])


def has_area(b: Column) -> Column:
    return (b["x1"] < b["x2"]) & (b["y1"] < b["y2"])


def blur_rectangle(b: Column, w: Column, h: Column, cfg) -> Column:
    """Rounded corners, padded by pixels and by a share of the side, clipped to the image; ints."""
    r = {n: F.rint(b[n]).cast("int") for n in ("x1", "y1", "x2", "y2")}
    x_pad = F.rint(F.greatest(F.lit(0), r["x2"] - r["x1"]) * cfg.expand_x_ratio).cast("int")
    y_pad = F.rint(F.greatest(F.lit(0), r["y2"] - r["y1"]) * cfg.expand_y_ratio).cast("int")
    return F.struct(
        F.greatest(F.lit(0), r["x1"] - cfg.expand_left_px - x_pad).alias("x1"),
        F.greatest(F.lit(0), r["y1"] - cfg.expand_top_px - y_pad).alias("y1"),
        F.least(w, r["x2"] + cfg.expand_right_px + x_pad).alias("x2"),
        F.least(h, r["y2"] + cfg.expand_bottom_px + y_pad).alias("y2"),
    )


def odd_kernel(k: Column, least: int = 1) -> Column:
    return F.greatest(F.lit(least), F.when(k % 2 == 0, k + 1).otherwise(k))


def box_blur_radii(b: Column, radius: int) -> tuple[Column, Column]:
    """Luma and chroma radii for a box."""
    side = F.greatest(F.lit(1), F.floor(F.least(b["x2"] - b["x1"], b["y2"] - b["y1"]) / 2).cast("int"))
    luma = F.greatest(F.lit(1), F.least(F.lit(radius), side))
    return luma, F.greatest(F.lit(1), F.floor(luma / 2).cast("int"))


def points_box(points: Column) -> Column:
    """Bounding box of polygon points, rounded half to even."""
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return F.struct(
        F.rint(F.array_min(xs)).cast("int").alias("x1"), F.rint(F.array_min(ys)).cast("int").alias("y1"),
        F.rint(F.array_max(xs)).cast("int").alias("x2"), F.rint(F.array_max(ys)).cast("int").alias("y2"),
    )


def dedupe(boxes: Column, min_iou: float, max_distance: float) -> Column:
    """Greedy distinct by similarity over boxes in the order of their centres (rounded to 3 digits, stable)."""
    keyed = F.transform(boxes, lambda b, i: F.struct(F.round(center_x(b), 3).alias("cx"), F.round(center_y(b), 3).alias("cy"), i.alias("i"), b.alias("b")))
    ordered = F.transform(F.array_sort(keyed), lambda k: k["b"])
    start = F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")
    return F.aggregate(ordered, start, lambda acc, b: F.when(F.exists(acc, lambda e: similar(e, b, min_iou, max_distance)), acc).otherwise(F.concat(acc, F.array(b))))


def filter_graph(boxes: Column, radius: int, power: int, video_width: Column | None = None, max_width: int = 0) -> Column:
    """ffmpeg filter graph: crops come from the original, later overlays lie on top."""
    n = F.size(boxes)
    head = F.concat(F.lit("[0:v]split="), (n + 1).cast("string"), F.lit("[base]"), F.array_join(F.transform(boxes, lambda b, i: F.concat(F.lit("[crop"), i.cast("string"), F.lit("]"))), ""))

    def part(b, i):
        luma, chroma = box_blur_radii(b, radius)
        s = lambda c: c.cast("string")
        p = str(max(1, power))
        crop = F.concat(
            F.lit("[crop"), s(i), F.lit("]crop="), s(b["x2"] - b["x1"]), F.lit(":"), s(b["y2"] - b["y1"]), F.lit(":"), s(b["x1"]), F.lit(":"), s(b["y1"]),
            F.lit(",boxblur=luma_radius="), s(luma), F.lit(f":luma_power={p}:chroma_radius="), s(chroma), F.lit(f":chroma_power={p}[blur"), s(i), F.lit("]"),
        )
        below = F.when(i == 0, F.lit("base")).otherwise(F.concat(F.lit("masked"), s(i - 1)))
        out = F.when(i == n - 1, F.lit("vout")).otherwise(F.concat(F.lit("masked"), s(i)))
        over = F.concat(F.lit("["), below, F.lit("][blur"), s(i), F.lit("]overlay="), s(b["x1"]), F.lit(":"), s(b["y1"]), F.lit("["), out, F.lit("]"))
        return F.concat(crop, F.lit(";"), over)

    graph = F.concat(head, F.lit(";"), F.array_join(F.transform(boxes, part), ";"))
    if video_width is None or max_width <= 0:
        return graph
    return F.when(video_width > max_width, F.concat(graph, F.lit(f";[vout]scale={max_width}:-2[vpreview]"))).otherwise(graph)
