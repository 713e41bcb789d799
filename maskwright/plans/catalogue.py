"""Registered queries and their DuckDB SQL. Doubles are rounded to 6 digits on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskwright import config
from maskwright.functions import geometry as G
from maskwright.functions import names as N
from maskwright.operators import labels, matching, pixels, sharding, temporal
from maskwright.plans import commands, fold_sql, steps
from maskwright.sources import adapters as A

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
W, H = 1920, 1080
_BOX = ("x1", "y1", "x2", "y2")


def query(sql: str | None = None, name: str | None = None):
    def add(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql
        return fn

    return add


def r6(c, name: str):
    return (F.round(c, 6) + F.lit(0.0)).alias(name)


def boxes6(struct: str) -> list:
    return [r6(F.col(f"{struct}.{n}"), n) for n in _BOX]


def plain6() -> list:
    return [r6(F.col(n), n) for n in _BOX]


DET = "WITH " + A.DETECTIONS_SQL
R = "round({0}, 6) AS {1}"
IOU = """(CASE WHEN greatest(0.0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0.0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)) > 0 THEN
 greatest(0.0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0.0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)) /
 (({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1) + ({b}.x2 - {b}.x1) * ({b}.y2 - {b}.y1) - greatest(0.0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0.0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))) ELSE 0.0 END)"""


def det(spark, sf) -> DataFrame:
    return A.detections(spark, sf)


# --- temporal --------------------------------------------------------------------------------------

_FACE_SQL = DET + """,
f AS (SELECT video_id, frame_no, list({{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} ORDER BY box_idx) AS b FROM det GROUP BY ALL),
n AS (SELECT *, lead(frame_no) OVER w AS nf, lead(b) OVER w AS nb FROM f WINDOW w AS (PARTITION BY video_id ORDER BY frame_no)),
g AS (SELECT *, unnest(range(frame_no + 1, nf)) AS fr FROM n WHERE nf - frame_no - 1 BETWEEN 1 AND {win}),
i AS (SELECT *, unnest(range(1, least(len(b), len(nb)) + 1)) AS k, (fr - frame_no)::DOUBLE / (nf - frame_no)::DOUBLE AS t FROM g)
SELECT video_id, frame_no, box_idx, 'detected' AS origin, x1, y1, x2, y2 FROM det
UNION ALL SELECT video_id, fr::INTEGER, (k - 1)::INTEGER, 'filled', {cols} FROM i"""


@query(_FACE_SQL.format(win=5, cols=", ".join(f"round(b[k].{c} + (nb[k].{c} - b[k].{c}) * t, 6)" for c in _BOX)))
def faces_gap_fill(spark, sf):
    return temporal.fill_face_gaps(det(spark, sf), 5).select("video_id", "frame_no", "box_idx", "origin", *plain6())


@query(_FACE_SQL.format(win=5, cols=", ".join(f"CASE WHEN t < 0.5 THEN b[k].{c} ELSE nb[k].{c} END" for c in _BOX)))
def faces_gap_fill_nearest(spark, sf):
    return temporal.fill_face_gaps(det(spark, sf), 5, "nearest").select("video_id", "frame_no", "box_idx", "origin", *plain6())


@query(DET + """, f AS (SELECT DISTINCT video_id, frame_no FROM det), n AS (SELECT *, lead(frame_no) OVER (PARTITION BY video_id ORDER BY frame_no) AS nf FROM f)
SELECT video_id, frame_no, nf AS next_frame, (nf - frame_no - 1)::INTEGER AS gap FROM n WHERE nf - frame_no - 1 BETWEEN 1 AND 18""")
def frame_gaps(spark, sf):
    w = Window.partitionBy("video_id").orderBy("frame_no")
    d = det(spark, sf).select("video_id", "frame_no").distinct().withColumn("next_frame", F.lead("frame_no").over(w))
    return d.withColumn("gap", F.col("next_frame") - F.col("frame_no") - 1).filter("gap BETWEEN 1 AND 18").select("video_id", "frame_no", "next_frame", "gap")


_LEADS = ", ".join(f"lead({c}) OVER w AS n{c}" for c in _BOX)
_EXPANDED = """x AS (SELECT video_id, frame_no, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy,
 greatest(x2 - x1 + 8, (x2 - x1) * 1.3, 30) AS w, greatest(y2 - y1 + 8, (y2 - y1) * 1.3, 16) AS h FROM one),
z AS (SELECT video_id, frame_no, least(greatest(0.0, cx - w / 2), 1920) AS x1, least(greatest(0.0, cy - h / 2), 1080) AS y1,
 least(greatest(0.0, cx + w / 2), 1920) AS x2, least(greatest(0.0, cy + h / 2), 1080) AS y2 FROM x)"""


_MULTI = DET.replace("WITH ", "WITH RECURSIVE ") + ", " + fold_sql.packed("det", "pk") + ", "


def halves_up(df: DataFrame) -> DataFrame:
    """Rows of boxes rounded to 6 digits; halves of any digits occur."""
    return df.select("video_id", "frame_no", "box_idx", *[(F.floor(F.col(c) * 1e6 + 0.5).cast("double") / 1e6).alias(c) for c in _BOX])


def _folds_sql() -> str:
    c = config.CAR_PLATES
    return _DEDUPED + ", dd AS (SELECT video_id, frame_no, acc AS boxes FROM d), " + ", ".join([fold_sql.fill("fl", "dd", c), fold_sql.carry("cf", "fl", c), fold_sql.stabilize("sb", "cf", c, W, H)]) + " " + fold_sql.rows("sb")


@query(_MULTI + fold_sql.fill("fl", "pk", config.TRUCK_PLATES) + " " + fold_sql.rows("fl"))
def tracked_gap_fill_multi(spark, sf):
    return halves_up(temporal.temporal_folds(det(spark, sf), config.TRUCK_PLATES, ("fill",)))


_NEAREST = config.configure(config.TRUCK_PLATES, gap_fill_mode="nearest")


@query(_MULTI + fold_sql.fill("fl", "pk", _NEAREST) + " " + fold_sql.rows("fl"))
def tracked_gap_fill_nearest_multi(spark, sf):
    return halves_up(temporal.temporal_folds(det(spark, sf), _NEAREST, ("fill",)))


@query(_MULTI + fold_sql.carry("cf", "pk", config.TRUCK_PLATES) + " " + fold_sql.rows("cf"))
def carry_forward_multi(spark, sf):
    return halves_up(temporal.temporal_folds(det(spark, sf), config.TRUCK_PLATES, ("carry",)))


@query(_MULTI + fold_sql.stabilize("sb", "pk", config.TRUCK_PLATES, W, H) + " " + fold_sql.rows("sb"))
def stabilize_multi(spark, sf):
    return halves_up(temporal.temporal_folds(det(spark, sf), config.TRUCK_PLATES, ("stabilize",)))


# --- geometry --------------------------------------------------------------------------------------


@query(DET + f""" SELECT a.video_id, a.frame_no, a.box_idx, b.box_idx AS other_idx, round({IOU.format(a='a', b='b')}, 6) AS iou,
 round(sqrt(((a.x1 + a.x2) / 2 - (b.x1 + b.x2) / 2) ** 2 + ((a.y1 + a.y2) / 2 - (b.y1 + b.y2) / 2) ** 2) / greatest(1.0, b.x2 - b.x1, b.y2 - b.y1), 6) AS distance
 FROM det a JOIN det b ON a.video_id = b.video_id AND a.frame_no = b.frame_no AND a.box_idx < b.box_idx""")
def box_pairs(spark, sf):
    d = det(spark, sf).select("video_id", "frame_no", "box_idx", F.struct(*_BOX).alias("b"))
    o = d.select("video_id", "frame_no", F.col("box_idx").alias("other_idx"), F.col("b").alias("c"))
    j = d.join(o, ["video_id", "frame_no"]).filter("box_idx < other_idx")
    b, c = F.col("b"), F.col("c")
    return j.select("video_id", "frame_no", "box_idx", "other_idx", r6(G.iou(b, c), "iou"), r6(G.distance_ratio(b, c, G.scale_of(c)), "distance"))


@query(DET + " SELECT video_id, frame_no, box_idx, round((x1 + x2) / 2, 6) AS cx, round((y1 + y2) / 2, 6) AS cy, x2 - x1 AS w, y2 - y1 AS h, round((x2 - x1) * (y2 - y1), 6) AS area FROM det")
def box_measures(spark, sf):
    b = F.struct(*_BOX)
    return det(spark, sf).select("video_id", "frame_no", "box_idx", r6(G.center_x(b), "cx"), r6(G.center_y(b), "cy"), r6(G.width(b), "w"), r6(G.height(b), "h"), r6(G.area(b), "area"))


@query(DET.replace("WITH ", "WITH ") + ", one AS (SELECT * FROM det), " + _EXPANDED.replace("video_id, frame_no,", "video_id, frame_no, box_idx,") + " SELECT video_id, frame_no, box_idx, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2 FROM z".replace("one AS", "one AS"))
def box_expand(spark, sf):
    c = config.CAR_PLATES
    e = G.expand(F.struct(*_BOX), F.lit(W), F.lit(H), c.pad_px, c.pad_ratio, c.min_width, c.min_height)
    return det(spark, sf).withColumn("e", e).select("video_id", "frame_no", "box_idx", *boxes6("e"))


@query(DET + """ SELECT video_id, frame_no, box_idx, rint_x1::INTEGER AS x1, rint_y1::INTEGER AS y1, rint_x2::INTEGER AS x2, rint_y2::INTEGER AS y2, 31 AS kernel FROM (
 SELECT *, greatest(0, bx1 - 4 - xp) AS rint_x1, greatest(0, by1 - 2 - yp) AS rint_y1, least(1920, bx2 + 4 + xp) AS rint_x2, least(1080, by2 + 6 + yp) AS rint_y2 FROM (
 SELECT *, round_even(greatest(0, bx2 - bx1) * 0.12::DOUBLE, 0) AS xp, round_even(greatest(0, by2 - by1) * 0.16::DOUBLE, 0) AS yp FROM (
 SELECT *, round_even(x1, 0) AS bx1, round_even(y1, 0) AS by1, round_even(x2, 0) AS bx2, round_even(y2, 0) AS by2 FROM det))) WHERE rint_x1 < rint_x2 AND rint_y1 < rint_y2""")
def blur_rectangles(spark, sf):
    return steps.blur_plan(det(spark, sf), config.CAR_PLATES, W, H)


@query("WITH " + A.CAMERAS_SQL + """, v AS (SELECT * FROM (VALUES (1280, 720), (1920, 1080), (2560, 1440)) t(w, h)),
s AS (SELECT camera_id, w, h, b, w::DOUBLE / image_width AS sx, h::DOUBLE / image_height AS sy, unnest(range(1, 3)) AS k FROM (SELECT camera_id, image_width, image_height, boxes AS b FROM cam), v),
p AS (SELECT camera_id, w, h, (k - 1)::INTEGER AS box_no, greatest(0, least(w, round_even(b[k].x1 * sx, 0) - 6))::INTEGER AS x1, greatest(0, least(h, round_even(b[k].y1 * sy, 0) - 6))::INTEGER AS y1,
 greatest(0, least(w, round_even(b[k].x2 * sx, 0) + 6))::INTEGER AS x2, greatest(0, least(h, round_even(b[k].y2 * sy, 0) + 6))::INTEGER AS y2,
 trunc(b[k].x1 * sx)::INTEGER AS tx1, trunc(b[k].y2 * sy)::INTEGER AS ty2 FROM s)
SELECT camera_id, w AS width, box_no, x1, y1, x2, y2, tx1, ty2 FROM p WHERE x1 < x2 AND y1 < y2""")
def template_boxes(spark, sf):
    sizes = spark.range(3).select(F.element_at(F.array(F.lit(1280), F.lit(1920), F.lit(2560)), (F.col("id") + 1).cast("int")).alias("width"), F.element_at(F.array(F.lit(720), F.lit(1080), F.lit(1440)), (F.col("id") + 1).cast("int")).alias("height"))
    c = A.cameras(spark, sf).join(F.broadcast(sizes)).select("camera_id", "width", "height", "image_width", "image_height", F.posexplode("boxes").alias("box_no", "b"))
    sx, sy = F.col("width") / F.col("image_width"), F.col("height") / F.col("image_height")
    s = c.withColumns({"s": G.scale_box(F.col("b"), sx, sy, F.col("width"), F.col("height"), 6), "t": G.scale_box_truncated(F.col("b"), sx, sy)})
    return s.filter(G.has_area(F.col("s"))).select("camera_id", "width", "box_no", "s.x1", "s.y1", "s.x2", "s.y2", F.col("t.x1").alias("tx1"), F.col("t.y2").alias("ty2"))


@query(DET + """ SELECT video_id, frame_no, box_idx, (CASE WHEN box_idx % 2 = 0 THEN box_idx + 31 ELSE box_idx + 30 END)::INTEGER AS kernel,
 greatest(1, least(30, greatest(1, floor(least(x2 - x1, y2 - y1) / 2))))::INTEGER AS luma,
 greatest(1, greatest(1, least(30, greatest(1, floor(least(x2 - x1, y2 - y1) / 2))))::INTEGER // 2)::INTEGER AS chroma,
 round(2.0::DOUBLE + greatest(0, frame_no - 1) * 0.75::DOUBLE, 6) AS allowed FROM det""")
def kernels_and_radii(spark, sf):
    luma, chroma = G.box_blur_radii(F.struct(*_BOX), 30)
    return det(spark, sf).select("video_id", "frame_no", "box_idx", G.odd_kernel(F.col("box_idx") + 30, 3).cast("int").alias("kernel"), luma.cast("int").alias("luma"), chroma.cast("int").alias("chroma"), r6(G.allowed_distance(2.0, F.col("frame_no"), 0.75), "allowed"))


@query(DET + """, n AS (SELECT *, """ + _LEADS + """ FROM det WINDOW w AS (PARTITION BY video_id, box_idx ORDER BY frame_no))
SELECT video_id, frame_no, box_idx, """ + ", ".join(f"round({c} + (n{c} - {c}) * 0.25::DOUBLE, 6) AS i{c}, round({c} * (1 - 0.45::DOUBLE) + n{c} * 0.45::DOUBLE, 6) AS s{c}" for c in _BOX) + " FROM n WHERE nx1 IS NOT NULL")
def interpolate_and_smooth(spark, sf):
    w = Window.partitionBy("video_id", "box_idx").orderBy("frame_no")
    d = det(spark, sf).select("video_id", "frame_no", "box_idx", F.struct(*_BOX).alias("b")).withColumn("c", F.lead("b").over(w)).filter("c IS NOT NULL")
    d = d.withColumns({"i": G.interpolate(F.col("b"), F.col("c"), F.lit(0.25)), "s": G.smooth(F.col("b"), F.col("c"), 0.45)})
    return d.select("video_id", "frame_no", "box_idx", *[r6(F.col(f"{k}.{n}"), k + n) for n in _BOX for k in ("i", "s")])


@query("WITH " + A.CAMERAS_SQL + """, p AS (SELECT camera_id, list_transform(boxes, lambda b: [[b.x1 + 0.5::DOUBLE, b.y1::DOUBLE], [b.x2 + 1.5::DOUBLE, b.y1 + 2.5::DOUBLE], [b.x1::DOUBLE + 3, b.y2 + 0.5::DOUBLE]]) AS shapes FROM cam),
u AS (SELECT camera_id, unnest(range(1, len(shapes) + 1)) AS k, shapes FROM p)
SELECT camera_id, (k - 1)::INTEGER AS shape_no, round_even(list_min([q[1] FOR q IN shapes[k]]), 0)::INTEGER AS x1, round_even(list_min([q[2] FOR q IN shapes[k]]), 0)::INTEGER AS y1,
 round_even(list_max([q[1] FOR q IN shapes[k]]), 0)::INTEGER AS x2, round_even(list_max([q[2] FOR q IN shapes[k]]), 0)::INTEGER AS y2 FROM u""")
def polygon_boxes(spark, sf):
    pt = lambda x, y: F.array(x.cast("double"), y.cast("double"))
    shapes = F.transform("boxes", lambda b: F.array(pt(b["x1"] + 0.5, b["y1"]), pt(b["x2"] + 1.5, b["y1"] + 2.5), pt(b["x1"] + 3, b["y2"] + 0.5)))
    return A.cameras(spark, sf).select("camera_id", F.posexplode(shapes).alias("shape_no", "p")).withColumn("b", G.points_box(F.col("p"))).select("camera_id", "shape_no", "b.*")


# --- labels ----------------------------------------------------------------------------------------

LAB = "WITH " + A.DETECTIONS_SQL + "," + A.LABEL_LINES_SQL + """,
tok AS (SELECT regexp_replace(path, '^.*/(v_[0-9]+)_[^_]*$', '\\1') AS video_id, try_cast(regexp_extract(path, '_([^_]*)\\.txt$', 1) AS INTEGER) AS frame_no, box_idx, value, string_split(value, ' ') AS t FROM lab),
par AS (SELECT video_id, frame_no, box_idx, try_cast(t[1] AS INTEGER) AS class_id, try_cast(t[2] AS DOUBLE) AS cx, try_cast(t[3] AS DOUBLE) AS cy, try_cast(t[4] AS DOUBLE) AS bw, try_cast(t[5] AS DOUBLE) AS bh,
 CASE WHEN value = '' THEN 'blank' WHEN frame_no IS NULL THEN 'bad frame' WHEN len(t) < 5 THEN 'too few tokens' WHEN try_cast(t[2] AS DOUBLE) IS NULL OR try_cast(t[3] AS DOUBLE) IS NULL OR try_cast(t[4] AS DOUBLE) IS NULL OR try_cast(t[5] AS DOUBLE) IS NULL THEN 'bad number' ELSE 'ok' END AS status FROM tok)"""


@query(LAB + " SELECT video_id, frame_no, box_idx, class_id, cx, cy, bw, bh FROM par WHERE status = 'ok'")
def label_parse(spark, sf):
    return labels.detections(A.label_lines(spark, sf))


@query(LAB + " SELECT video_id, frame_no, box_idx, status FROM par WHERE status <> 'ok'")
def label_rejects(spark, sf):
    return labels.rejected(A.label_lines(spark, sf))


@query(LAB + """ SELECT video_id, frame_no, box_idx, least(1920, greatest(0, round_even((cx - bw / 2) * 1920, 0))) AS x1, least(1080, greatest(0, round_even((cy - bh / 2) * 1080, 0))) AS y1,
 least(1920, greatest(0, round_even((cx + bw / 2) * 1920, 0))) AS x2, least(1080, greatest(0, round_even((cy + bh / 2) * 1080, 0))) AS y2 FROM par WHERE status = 'ok'""")
def label_to_pixels(spark, sf):
    return labels.to_pixels(labels.detections(A.label_lines(spark, sf)), W, H)


@query(LAB + ", p2 AS (SELECT path, value FROM lab WHERE box_idx = 0), b AS (SELECT path, value, 'primary' AS p FROM lab UNION ALL SELECT path, value, 'secondary' FROM p2) SELECT path, value, min(p) AS pass_name, count(*) AS times FROM b GROUP BY path, value")
def merge_passes(spark, sf):
    lines = A.label_lines(spark, sf)
    return labels.merge_passes(lines.select("path", "value"), lines.filter("box_idx = 0").select("path", "value"))


@query(DET + " SELECT video_id, count(DISTINCT frame_no) AS frames_detected, count(*) AS boxes, min(frame_no) AS first_frame, max(frame_no) AS last_frame FROM det GROUP BY video_id")
def detection_summary(spark, sf):
    return labels.summary(det(spark, sf))


@query(DET + """, f AS (SELECT video_id, frame_no, '"' || frame_no || '":[' || string_agg('[' || x1 || ',' || y1 || ',' || x2 || ',' || y2 || ']', ',' ORDER BY box_idx) || ']' AS j FROM det GROUP BY video_id, frame_no)
SELECT video_id, '{' || string_agg(j, ',' ORDER BY frame_no) || '}' AS json FROM f GROUP BY video_id""")
def detection_json(spark, sf):
    return labels.to_json(det(spark, sf))


@query(DET + " SELECT video_id, frame_no, box_idx, x1, y1, x2, y2 FROM det")
def detection_json_round_trip(spark, sf):
    return labels.from_json(labels.to_json(det(spark, sf)))


@query(LAB + " SELECT video_id, frame_no, box_idx, class_id, cx, cy, bw, bh FROM par WHERE status = 'ok' UNION ALL SELECT video_id || '_' || frame_no, frame_no, box_idx, class_id, cx, cy, bw, bh FROM par WHERE status = 'ok'")
def face_labels(spark, sf):
    return labels.face_detections(A.label_lines(spark, sf))


@query(DET + ", s AS (SELECT *, y1 / 950 AS score, CASE WHEN box_idx % 2 = 0 THEN 'primary' ELSE 'secondary' END AS pass_name FROM det) SELECT video_id, frame_no, box_idx, pass_name, round(score, 6) AS score FROM s WHERE score >= CASE pass_name WHEN 'primary' THEN 0.18::DOUBLE ELSE 0.1::DOUBLE END")
def confident_detections(spark, sf):
    cfg = config.configure(config.CAR_PLATES, secondary=True)
    passes = spark.createDataFrame([(p["pass_name"], p["conf"]) for p in sharding.detection_passes(cfg)], "pass_name string, conf double")
    scored = det(spark, sf).withColumns({"score": F.col("y1") / 950, "pass_name": F.when(F.col("box_idx") % 2 == 0, "primary").otherwise("secondary")})
    return labels.confident(scored, passes).select("video_id", "frame_no", "box_idx", "pass_name", r6(F.col("score"), "score"))


@query("WITH filled AS (" + _FACE_SQL.format(win=5, cols="0, 0, 0, 0") + ") SELECT video_id, count(DISTINCT frame_no) AS frames, count_if(origin = 'detected')::BIGINT AS detected, count_if(origin = 'filled')::BIGINT AS filled, count(DISTINCT frame_no) FILTER (WHERE origin = 'detected') AS frames_detected, count(DISTINCT frame_no) FILTER (WHERE origin = 'filled') AS frames_filled FROM filled GROUP BY video_id")
def run_counts(spark, sf):
    return labels.run_counts(temporal.fill_face_gaps(det(spark, sf), 5))


@query(DET + " SELECT video_id, max(frame_no)::BIGINT AS frames, count(DISTINCT frame_no) AS frames_with_regions FROM det GROUP BY video_id")
def frame_counts(spark, sf):
    d = det(spark, sf)
    frames = d.groupBy("video_id").agg(F.max("frame_no").alias("m")).select("video_id", F.explode(F.sequence(F.lit(1), F.col("m"))).alias("frame_no"))
    return labels.frame_counts(frames, d)


_SIM = """CASE WHEN len(list_filter(acc, lambda e:
 (CASE WHEN greatest(0.0, least(e.x2, c.x2) - greatest(e.x1, c.x1)) * greatest(0.0, least(e.y2, c.y2) - greatest(e.y1, c.y1)) > 0 THEN greatest(0.0, least(e.x2, c.x2) - greatest(e.x1, c.x1)) * greatest(0.0, least(e.y2, c.y2) - greatest(e.y1, c.y1)) /
 ((e.x2 - e.x1) * (e.y2 - e.y1) + (c.x2 - c.x1) * (c.y2 - c.y1) - greatest(0.0, least(e.x2, c.x2) - greatest(e.x1, c.x1)) * greatest(0.0, least(e.y2, c.y2) - greatest(e.y1, c.y1))) ELSE 0.0 END) >= 0.4
 OR sqrt(((e.x1 + e.x2) / 2 - (c.x1 + c.x2) / 2) ** 2 + ((e.y1 + e.y2) / 2 - (c.y1 + c.y2) / 2) ** 2) / greatest(1.0, c.x2 - c.x1, c.y2 - c.y1) <= 0.75)) > 0 THEN acc ELSE list_append(acc, c) END"""


_DEDUPED = DET.replace("WITH ", "WITH RECURSIVE ") + """,
o AS (SELECT video_id, frame_no, list({'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2} ORDER BY round((x1 + x2) / 2, 3), round((y1 + y2) / 2, 3), box_idx) AS b FROM det GROUP BY ALL),
k AS (SELECT video_id, frame_no, b, 1 AS n, [b[1]] AS acc FROM o
 UNION ALL SELECT video_id, frame_no, b, n + 1, """ + _SIM.replace("c.", "b[n + 1].").replace("list_append(acc, c)", "list_append(acc, b[n + 1])") + """ FROM k WHERE n < len(b)),
d AS (SELECT video_id, frame_no, acc FROM k WHERE n = len(b))"""


@query(_DEDUPED + """, u AS (SELECT video_id, frame_no, acc, unnest(range(1, len(acc) + 1)) AS i FROM d)
SELECT video_id, frame_no, (i - 1)::INTEGER AS box_idx, acc[i].x1 AS x1, acc[i].y1 AS y1, acc[i].x2 AS x2, acc[i].y2 AS y2 FROM u""")
def frame_dedupe(spark, sf):
    c = config.CAR_PLATES
    return labels.dedupe_frames(det(spark, sf), c.frame_dedupe_iou, c.frame_dedupe_distance)


@query(_folds_sql())
def temporal_folds_multi(spark, sf):
    return halves_up(steps.plate_regions(det(spark, sf), config.CAR_PLATES))


@query(DET + " SELECT video_id, frame_no, (row_number() OVER (PARTITION BY video_id, frame_no ORDER BY round((x1 + x2) / 2, 3), round((y1 + y2) / 2, 3), box_idx) - 1)::INTEGER AS place, box_idx FROM det")
def centre_order(spark, sf):
    b = F.struct(*_BOX)
    w = Window.partitionBy("video_id", "frame_no").orderBy(F.round(G.center_x(b), 3), F.round(G.center_y(b), 3), "box_idx")
    return det(spark, sf).select("video_id", "frame_no", (F.row_number().over(w) - 1).cast("int").alias("place"), "box_idx")


@query(DET + ", f AS (SELECT video_id, max(frame_no) AS m FROM det GROUP BY 1), a AS (SELECT video_id, unnest(range(1, m + 1))::INTEGER AS frame_no FROM f) SELECT a.video_id, a.frame_no, count(det.box_idx)::INTEGER AS boxes FROM a LEFT JOIN det USING (video_id, frame_no) WHERE a.frame_no <= floor(3.5 * 25) GROUP BY ALL")
def frames_with_regions(spark, sf):
    d = det(spark, sf)
    frames = d.groupBy("video_id").agg(F.max("frame_no").alias("m")).select("video_id", F.explode(F.sequence(F.lit(1), F.col("m"))).alias("frame_no"))
    return labels.join_frames(labels.within_time(frames, 3.5, F.lit(25.0)), d).select("video_id", "frame_no", F.size("boxes").alias("boxes"))


# --- sources, metadata, names ----------------------------------------------------------------------

VID = "WITH " + A.VIDEOS_SQL + r""",
fil AS (SELECT *, regexp_replace(path, '^.*/', '') AS name, regexp_replace(path, '^.*/([^/]*)\.[^./]*$', '\1') AS stem, lower('.' || regexp_replace(path, '^.*\.', '')) AS ext FROM vid)"""
_EXTS = "('.mp4', '.avi', '.mov', '.mkv', '.wmv', '.flv', '.m4v')"


@query(VID + f" SELECT video_id, path, stem, ext, contains(lower(stem), '_time_location_masked') AS masked, ext IN ('.mp4', '.mov', '.avi', '.mkv', '.m4v') AS short FROM fil WHERE ext IN {_EXTS}")
def video_scan(spark, sf):
    p = F.col("path")
    return A.videos(spark, sf).filter(N.is_video(p)).select("video_id", "path", N.stem(p).alias("stem"), N.extension(p).alias("ext"), N.is_already_masked(p).alias("masked"), N.is_video(p, N.EXTENSIONS_SHORT).alias("short"))


@query(VID + r""", t AS (SELECT video_id, path, list_transform(regexp_extract_all(path, '[0-9]+|[^0-9]+'), lambda x: CASE WHEN regexp_matches(x, '^[0-9]') THEN lpad(x, 20, '0') ELSE x END) AS key FROM fil)
SELECT video_id, array_to_string(key, '') AS natural_key FROM t""")
def natural_sort(spark, sf):
    return A.videos(spark, sf).select("video_id", F.array_join(N.natural_key(F.col("path")), "").alias("natural_key"))


@query(VID + """, r AS (SELECT *, try_cast(string_split(r_frame_rate, '/')[1] AS DOUBLE) AS a, try_cast(coalesce(string_split(r_frame_rate, '/')[2], '1') AS DOUBLE) AS b FROM fil),
q AS (SELECT *, CASE WHEN b <> 0 AND a / b > 0 THEN a / b END AS fps FROM r)
SELECT video_id, round(coalesce(fps, 25.0), 6) AS fps, coalesce(CASE WHEN nb_frames > 0 THEN nb_frames END, CASE WHEN duration > 0 AND fps > 0 THEN greatest(1, round_even(duration * fps, 0)::BIGINT) END, CASE WHEN decoder_frames > 0 THEN decoder_frames END, 1)::BIGINT AS frames,
 coalesce(CASE WHEN nb_frames > 0 THEN nb_frames END, CASE WHEN duration > 0 AND fps > 0 THEN greatest(1, round_even(duration * fps, 0)::BIGINT) END, CASE WHEN decoder_frames > 0 THEN decoder_frames END, 1)::BIGINT * width * height AS weight FROM q""")
def probe_metadata(spark, sf):
    v = A.videos(spark, sf).withColumn("rate", N.frame_rate(F.col("r_frame_rate")))
    frames = N.frame_count(F.col("nb_frames"), F.col("duration"), F.col("rate"), F.col("decoder_frames"))
    return v.select("video_id", r6(F.coalesce("rate", F.lit(25.0)), "fps"), frames.alias("frames"), sharding.shard_weight(frames, F.col("width"), F.col("height")).alias("weight"))


@query("""SELECT p_partkey AS id, lower(regexp_replace(p_name, '[^A-Za-z0-9]+', '', 'g')) AS norm, nullif(regexp_extract(p_partkey::VARCHAR || 'x', '^([0-9]+)', 1), '') AS prefix,
 trim(regexp_replace(lower(CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_name END), '[^0-9a-z]+', '_', 'g'), '_') AS tag FROM part""")
def name_functions(spark, sf):
    p = A.read(spark, sf, "part")
    even = F.col("p_size") % 2 == 0
    name = F.when(even, F.concat(F.lit("Videos_-"), F.col("p_name"))).otherwise(F.col("p_name"))
    return p.select(F.col("p_partkey").alias("id"), N.normalize(F.col("p_name")).alias("norm"), N.number_prefix(F.concat(F.col("p_partkey").cast("string"), F.lit("x"))).alias("prefix"), N.input_tag(name).alias("tag"))


@query("""SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN '_run' || p_size ELSE '_set_' || p_size || CASE WHEN p_size % 2 = 0 THEN '_smoke' ELSE '' END END AS tag,
 (CASE WHEN p_size % 7 = 0 THEN greatest(1, p_size % 3) WHEN p_size * 120 >= 5120 THEN 2 WHEN p_size * 120 >= 3840 THEN 3 WHEN p_size * 120 >= 2560 THEN 4 WHEN p_size * 120 >= 1920 THEN 8 ELSE 16 END)::INTEGER AS batch,
 'v' || p_partkey || '_face_blurred.mp4' AS face_name, [p_size, p_size + 1]::INTEGER[] AS ids FROM part""")
def tags_and_batches(spark, sf):
    p, s = A.read(spark, sf, "part"), F.col("p_size")
    explicit = F.when(s % 3 == 0, F.concat(F.lit("run"), s.cast("string")))
    ids = N.id_list(F.concat(s.cast("string"), F.lit(" ,, "), (s + 1).cast("string"), F.lit(",")))
    return p.select(
        F.col("p_partkey").alias("id"), N.output_tag(F.concat(F.lit("videos-Set "), s.cast("string")), explicit, s % 2 == 0).alias("tag"),
        N.batch_size(s * 120, F.when(s % 7 == 0, s % 3)).cast("int").alias("batch"), F.concat(F.lit("v"), F.col("p_partkey").cast("string"), F.lit("_face_blurred.mp4")).alias("face_name"), ids.alias("ids"),
    )


# --- matching --------------------------------------------------------------------------------------

CAM = "WITH " + A.CAMERAS_SQL
_LINKS = VID[5:] + "," + A.CAMERAS_SQL + "," + A.MAPPING_SQL


@query("WITH " + _LINKS + """, sized AS (SELECT v.video_id, c.camera_id FROM vid v JOIN cam c ON v.width = c.image_width AND v.height = c.image_height)
SELECT * FROM sized UNION ALL SELECT v.video_id, c.camera_id FROM vid v, cam c WHERE v.video_id NOT IN (SELECT video_id FROM sized)""")
def camera_candidates(spark, sf):
    return matching.candidates(A.videos(spark, sf), A.cameras(spark, sf)).select("video_id", "camera_id")


_FUZZY = r""", nk AS (SELECT regexp_replace(lower(regexp_replace(key, '(.)\.[^.]*$', '\1')), '[^a-z0-9]+', '', 'g') AS norm, camera_id FROM map),
nv AS (SELECT video_id, regexp_replace(lower(stem), '[^a-z0-9]+', '', 'g') AS nm FROM fil),
sc AS (SELECT nm, norm, camera_id, list_max(list_transform(range(1, len(nm) + 1), lambda i: list_max(list_transform(range(0, len(nm) - i + 2), lambda l: CASE WHEN contains(norm, substr(nm, i, l)) THEN l ELSE 0 END)))) AS score FROM (SELECT DISTINCT nm FROM nv), nk WHERE norm <> '' AND NOT regexp_matches(norm, '^[0-9]+$')),
rk AS (SELECT nm, camera_id, score, row_number() OVER (PARTITION BY nm ORDER BY score DESC, camera_id DESC) AS r, lead(score, 1, -1) OVER (PARTITION BY nm ORDER BY score DESC, camera_id DESC) AS second FROM sc WHERE score >= 3),
fz AS (SELECT nv.video_id, rk.camera_id AS fuzzy_id, rk.score::INTEGER AS score FROM rk JOIN nv USING (nm) WHERE r = 1 AND score > second)"""


@query("WITH " + _LINKS + _FUZZY + " SELECT * FROM fz")
def fuzzy_names(spark, sf):
    return matching.fuzzy_keys(A.videos(spark, sf), A.mapping(spark, sf)).select("video_id", "fuzzy_id", F.col("score").cast("int").alias("score"))


@query("WITH " + _LINKS + _FUZZY + r""", kc AS (SELECT DISTINCT camera_id FROM cam), mk AS (SELECT key, max(camera_id) AS mapped FROM map GROUP BY key),
st AS (SELECT f.video_id, f.stem, coalesce(a.mapped, b.mapped) AS mapped FROM fil f LEFT JOIN mk a ON a.key = f.name LEFT JOIN mk b ON b.key = f.stem)
SELECT st.video_id, CASE WHEN mapped IS NOT NULL THEN k0.camera_id ELSE coalesce(k1.camera_id, k2.camera_id, k3.camera_id) END AS camera_id,
 CASE WHEN mapped IS NOT NULL THEN CASE WHEN k0.camera_id IS NULL THEN 'none' ELSE 'mapping' END WHEN k1.camera_id IS NOT NULL THEN 'fuzzy' WHEN k2.camera_id IS NOT NULL THEN 'stem' WHEN k3.camera_id IS NOT NULL THEN 'prefix' ELSE 'none' END AS method
FROM st LEFT JOIN fz USING (video_id) LEFT JOIN kc k0 ON k0.camera_id = mapped LEFT JOIN kc k1 ON k1.camera_id = fuzzy_id LEFT JOIN kc k2 ON k2.camera_id = stem LEFT JOIN kc k3 ON k3.camera_id = regexp_extract(stem, '^([0-9]+)', 1)""")
def exact_match(spark, sf):
    return matching.exact_match(A.videos(spark, sf), A.cameras(spark, sf), A.mapping(spark, sf))


_NCC = """im AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS g FROM embeddings),
mn AS (SELECT vec_id, label, list_transform(g, lambda x: x - list_avg(g)) AS c FROM im), un AS (SELECT vec_id, label, c, sqrt(list_dot_product(c, c)) AS n FROM mn),
tp AS (SELECT label, min_by(c, vec_id) AS tc, min_by(n, vec_id) AS tn FROM un GROUP BY label),
scr AS (SELECT u.vec_id AS video_id, t.label AS camera_id, CASE WHEN u.n < 1e-6 OR t.tn < 1e-6 THEN 0.0 ELSE list_dot_product(u.c, t.tc) / (u.n * t.tn) END AS score FROM un u, tp t)"""


def ncc_scores(spark, sf) -> DataFrame:
    """Every image against the first image of each group; features are made once per image, not per pair."""
    images = A.gray_images(spark, sf).select("image_id", "group_id", matching.unit(F.col("gray")).alias("u"))
    templates = matching.small(images.groupBy(F.col("group_id").alias("camera_id")).agg(F.min_by("u", "image_id").alias("t")))
    return images.join(templates).select(F.col("image_id").alias("video_id"), "camera_id", F.coalesce(matching.dot(F.col("u"), F.col("t")), F.lit(0.0)).alias("score"))


@query("WITH " + _NCC + """, rk AS (SELECT *, row_number() OVER w AS r, lead(score, 1, 0.0) OVER w AS second FROM scr WINDOW w AS (PARTITION BY video_id ORDER BY round(score, 9) DESC, camera_id))
SELECT video_id, camera_id, round(score, 6) AS score, round(score - second, 6) AS margin FROM rk WHERE r = 1 AND round(score, 9) >= 0.15 AND round(score - second, 9) >= 0.005""")
def ncc_top_match(spark, sf):
    s = ncc_scores(spark, sf).withColumn("score", F.round("score", 9))
    best = matching.top_with_margin(s).withColumn("margin", F.round("margin", 9))
    return matching.accept(best, 0.15, 0.005).select("video_id", "camera_id", r6(F.col("score"), "score"), r6(F.col("margin"), "margin"))


_FAST = """, fs AS (SELECT u.vec_id AS video_id, t.label AS camera_id, round(1 - sqrt(list_sum(list_transform(range(1, len(u.c) + 1), lambda i: (u.c[i] / u.n - t.tc[i] / t.tn) ** 2))) / 2, 9) AS score FROM un u, tp t),
fb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY score DESC, camera_id) AS r FROM fs) WHERE r = 1),
nb AS (SELECT * FROM (SELECT video_id, camera_id, round(score, 9) AS score, row_number() OVER (PARTITION BY video_id ORDER BY round(score, 9) DESC, camera_id) AS r FROM scr) WHERE r = 1)"""


def _fast_scores(spark, sf) -> DataFrame:
    images = A.gray_images(spark, sf).select("image_id", "group_id", matching.unit(F.col("gray")).alias("u"))
    templates = matching.small(images.groupBy(F.col("group_id").alias("camera_id")).agg(F.min_by("u", "image_id").alias("t")))
    diff = F.zip_with("u", "t", lambda x, y: (x - y) * (x - y))
    return images.join(templates).select(F.col("image_id").alias("video_id"), "camera_id", F.round(1 - F.sqrt(F.aggregate(diff, F.lit(0.0), lambda s, x: s + x)) / 2, 9).alias("score"))


@query("WITH " + _NCC + _FAST + " SELECT fb.video_id, fb.camera_id, round(least(fb.score, nb.score), 6) AS score FROM fb JOIN nb USING (video_id, camera_id)")
def matchers_agree(spark, sf):
    fast = matching.top_with_margin(_fast_scores(spark, sf))
    slow = matching.top_with_margin(ncc_scores(spark, sf).withColumn("score", F.round("score", 9)))
    return matching.agree(fast, slow).select("video_id", "camera_id", r6(F.col("score"), "score"))


@query()
def signature_matchers_agree(spark, sf):
    """matchers_agree with the signatures as the fast matcher."""
    fast = matching.top_with_margin(signature_scores(spark, sf).filter("score IS NOT NULL"))
    slow = matching.top_with_margin(ncc_scores(spark, sf).withColumn("score", F.round("score", 9)))
    return matching.agree(fast, slow).select("video_id", "camera_id", r6(F.col("score"), "score"))


@query("WITH " + _NCC + _FAST + " SELECT i.vec_id AS video_id, coalesce(fb.camera_id, nb.camera_id) AS camera_id, round(coalesce(fb.score, nb.score, 0.0), 6) AS score FROM im i LEFT JOIN (SELECT * FROM fb WHERE score >= 0.5) fb ON fb.video_id = i.vec_id LEFT JOIN (SELECT * FROM nb WHERE score >= 0.2) nb ON nb.video_id = i.vec_id")
def force_best_match(spark, sf):
    v = A.gray_images(spark, sf).select(F.col("image_id").alias("video_id"))
    fast = matching.accept(matching.top_with_margin(_fast_scores(spark, sf)), 0.5, 0.0)
    slow = matching.top_with_margin(ncc_scores(spark, sf).withColumn("score", F.round("score", 9))).filter("score >= 0.2")
    return matching.force_best(v, fast, slow).select("video_id", "camera_id", r6(F.col("score"), "score"))


def signature_scores(spark, sf) -> DataFrame:
    """Every image against the first image of each group by the dot product of their signatures; null if either has none or lengths differ."""
    frames = pixels.gray_frames(A.gray_images(spark, sf)).withColumn("boxes", F.expr("array(array(0, 0, 8, 4), array(0, 4, 8, 8))"))
    signed = pixels.signatures(frames).withColumn("signature", F.col("signature").cast("array<double>"))
    images = A.gray_images(spark, sf).select("image_id", "group_id").join(signed, "image_id")
    templates = matching.small(images.groupBy(F.col("group_id").alias("camera_id")).agg(F.min_by("signature", "image_id").alias("t")))
    score = F.when(F.size("signature") == F.size("t"), F.round(matching.dot(F.col("signature"), F.col("t")), 9))
    return images.join(templates).select(F.col("image_id").alias("video_id"), "camera_id", score.alias("score"))


@query()
def force_best_match_all(spark, sf):
    """The best camera of every video: each candidate by the fast score, else NCC, else 0.0, and no threshold."""
    slow = ncc_scores(spark, sf).select("video_id", "camera_id", F.round("score", 9).alias("ncc"))
    scores = slow.join(signature_scores(spark, sf), ["video_id", "camera_id"], "left").withColumn("score", F.coalesce("score", "ncc", F.lit(0.0)))
    return matching.top_with_margin(scores).select("video_id", "camera_id", r6(F.col("score"), "score"))


@query(DET + " SELECT video_id, class_id AS camera_id, round(sum(y1 / 950 * ((x2 - x1) * (y2 - y1))) / sum((x2 - x1) * (y2 - y1)), 6) AS score FROM det GROUP BY 1, 2")
def area_weighted_score(spark, sf):
    d = det(spark, sf).select("video_id", F.col("class_id").alias("camera_id"), (F.col("y1") / 950).alias("score"), G.area(F.struct(*_BOX)).alias("area"))
    return matching.area_mean(d).select("video_id", "camera_id", r6(F.col("score"), "score"))


@query("WITH " + _LINKS + """, j AS (SELECT v.video_id, v.stem, v.ext, v.width, v.height, c.camera_id, c.image_width, c.image_height, c.boxes FROM fil v LEFT JOIN cam c ON c.camera_no = v.group_id),
u AS (SELECT *, unnest(range(1, 3)) AS k, width::DOUBLE / image_width AS sx, height::DOUBLE / image_height AS sy FROM j WHERE camera_id IS NOT NULL),
b AS (SELECT video_id, width, k, greatest(0, least(width, round_even(boxes[k].x1 * sx, 0) - 6))::INTEGER AS x1, greatest(0, least(height, round_even(boxes[k].y1 * sy, 0) - 6))::INTEGER AS y1,
 greatest(0, least(width, round_even(boxes[k].x2 * sx, 0) + 6))::INTEGER AS x2, greatest(0, least(height, round_even(boxes[k].y2 * sy, 0) + 6))::INTEGER AS y2 FROM u),
n AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY k) - 1 AS i, count(*) OVER (PARTITION BY video_id) AS n FROM b WHERE x1 < x2 AND y1 < y2),
l AS (SELECT *, greatest(1, least(30, greatest(1, least(x2 - x1, y2 - y1) // 2))) AS luma FROM n),
g AS (SELECT video_id, '[0:v]split=' || (max(n) + 1) || '[base]' || string_agg('[crop' || i || ']', '' ORDER BY i) || ';' ||
 string_agg('[crop' || i || ']crop=' || (x2 - x1) || ':' || (y2 - y1) || ':' || x1 || ':' || y1 || ',boxblur=luma_radius=' || luma || ':luma_power=6:chroma_radius=' || greatest(1, luma // 2) || ':chroma_power=6[blur' || i || '];[' ||
 CASE WHEN i = 0 THEN 'base' ELSE 'masked' || (i - 1) END || '][blur' || i || ']overlay=' || x1 || ':' || y1 || '[' || CASE WHEN i = n - 1 THEN 'vout' ELSE 'masked' || i END || ']', ';' ORDER BY i) ||
 CASE WHEN max(width) > 1920 THEN ';[vout]scale=1920:-2[vpreview]' ELSE '' END AS filter_graph FROM l GROUP BY video_id)
SELECT j.video_id, j.camera_id, filter_graph, j.stem || '_masked' || j.ext AS output_name, CASE WHEN filter_graph IS NULL THEN 'passthrough' ELSE 'masked' END AS status FROM j LEFT JOIN g USING (video_id)""")
def overlay_jobs(spark, sf):
    v, c = A.videos(spark, sf), A.cameras(spark, sf)
    m = v.join(F.broadcast(c.select("camera_id", "camera_no")), F.col("group_id") == F.col("camera_no")).select("video_id", "camera_id")
    return steps.overlay_jobs(v, m, c, config.OverlayConfig()).drop("scaled", "path")


_GRAPHS = ORACLES["overlay_jobs"]


@query(_GRAPHS.replace("SELECT j.video_id, j.camera_id, filter_graph, j.stem || '_masked' || j.ext AS output_name,", "SELECT j.video_id, (SELECT path FROM vid WHERE vid.video_id = j.video_id) AS path, filter_graph, j.stem || '_masked' || j.ext AS output_name,").replace("SELECT j.video_id, (", "SELECT video_id, 'ffmpeg -hide_banner -loglevel error -y -i ' || path || ' -filter_complex ' || filter_graph || ' -map ' || CASE WHEN filter_graph LIKE '%[vpreview]' THEN '[vpreview]' ELSE '[vout]' END || ' -map 0:a? -c:v libx264 -preset veryfast -crf 18 -pix_fmt yuv420p -c:a copy -movflags +faststart ' || output_name AS with_audio, 'ffmpeg -hide_banner -loglevel error -n -i ' || path || ' -filter_complex ' || filter_graph || ' -map ' || CASE WHEN filter_graph LIKE '%[vpreview]' THEN '[vpreview]' ELSE '[vout]' END || ' -c:v libx264 -preset veryfast -crf 18 -pix_fmt yuv420p -an -movflags +faststart ' || output_name AS without_audio FROM (SELECT j.video_id, (") + ") WHERE status = 'masked'")
def mask_arguments(spark, sf):
    """Calls of the encoder for all masked videos, and those to try next without audio."""
    v, c = A.videos(spark, sf), A.cameras(spark, sf)
    m = v.join(F.broadcast(c.select("camera_id", "camera_no")), F.col("group_id") == F.col("camera_no")).select("video_id", "camera_id")
    jobs = steps.overlay_jobs(v, m, c, config.OverlayConfig()).filter("status = 'masked'")
    call = lambda **how: F.array_join(commands.mask(F.col("path"), F.col("filter_graph"), F.col("output_name"), **how), " ")
    return jobs.select("video_id", call().alias("with_audio"), call(overwrite=False, audio=False).alias("without_audio"))


@query(VID + """, r AS (SELECT *, try_cast(string_split(r_frame_rate, '/')[1] AS DOUBLE) AS a, try_cast(coalesce(string_split(r_frame_rate, '/')[2], '1') AS DOUBLE) AS b FROM fil),
q AS (SELECT *, coalesce(CASE WHEN b <> 0 AND a / b > 0 THEN a / b END, 25.0::DOUBLE) AS fps, CASE WHEN video_id LIKE '%0' THEN 2.5::DOUBLE ELSE 0.0::DOUBLE END AS seconds FROM r)
SELECT video_id, 'ffmpeg -i ' || path || ' -vf fps=' || fps || ' -q:v 2' || CASE WHEN seconds > 0 THEN ' -t ' || seconds ELSE '' END || ' -y /frames/' || video_id || '_%06d.jpg' AS extract,
 'ffmpeg -y -framerate ' || fps || ' -i /frames/' || video_id || '_%06d.jpg -c:v libx264 -pix_fmt yuv420p -crf 23 -preset medium /out/' || video_id || '.mp4' AS encode,
 'ffmpeg -hide_banner -loglevel error -y -i /tmp/' || video_id || '.avi -c:v libx264 -preset veryfast -crf 18 -pix_fmt yuv420p -movflags +faststart /out/' || video_id || '.mp4' AS transcode FROM q""")
def frame_arguments(spark, sf):
    """Calls that take videos apart into frames, put frames together, and turn intermediate videos into final ones."""
    v = A.videos(spark, sf).withColumn("fps", F.coalesce(N.frame_rate(F.col("r_frame_rate")), F.lit(25.0)))
    name = lambda *parts: F.concat(*[F.lit(p) if p.startswith("/") or p.startswith(".") or p.startswith("_") else F.col(p) for p in parts])
    seconds = F.when(F.col("video_id").endswith("0"), 2.5).otherwise(0.0)
    frames, out = name("/frames/", "video_id", "_%06d.jpg"), name("/out/", "video_id", ".mp4")
    calls = {"extract": commands.extract_frames(F.col("path"), F.col("fps"), frames, seconds), "encode": commands.encode_frames(frames, F.col("fps"), out), "transcode": commands.transcode(name("/tmp/", "video_id", ".avi"), out)}
    return v.select("video_id", *[F.array_join(c, " ").alias(n) for n, c in calls.items()])


@query("WITH RECURSIVE " + _LINKS + ", " + A.DETECTIONS_SQL + """, b AS (SELECT 'v' || video_id AS video_id, frame_no, box_idx FROM (""" + ORACLES["blur_rectangles"].replace("FROM det)))", "FROM det WHERE class_id % 3 = 0)))") + """)),
n AS (SELECT video_id, count(*)::BIGINT AS rectangles, count(DISTINCT frame_no)::BIGINT AS frames FROM b GROUP BY video_id)
SELECT video_id, coalesce(rectangles, 0)::BIGINT AS rectangles, coalesce(frames, 0)::BIGINT AS frames, CASE WHEN rectangles > 0 THEN 'blurred' ELSE 'passthrough' END AS status, name AS output_name FROM fil LEFT JOIN n USING (video_id)""")
def plate_outputs(spark, sf):
    rectangles = steps.blur_plan(A.step_detections(spark, sf, 1), config.CAR_PLATES, W, H)
    return steps.plate_outputs(A.videos(spark, sf), rectangles).drop("path")


@query("WITH " + _LINKS + " SELECT video_id, path FROM vid WHERE NOT EXISTS (SELECT 1 FROM cam WHERE camera_no = group_id)")
def unmatched_videos(spark, sf):
    v, c = A.videos(spark, sf), A.cameras(spark, sf)
    return v.join(F.broadcast(c.select("camera_no")), F.col("group_id") == F.col("camera_no"), "left_anti").select("video_id", "path")


@query("WITH " + A.MAPPING_SQL + " SELECT key, camera_id FROM map")
def mapping_parse(spark, sf):
    packed = A.mapping(spark, sf).groupBy(F.hash("key") % 4).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("key", F.concat("camera_id", F.lit(".json")))))).alias("value"))
    return packed.select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "camera_id")).withColumn("camera_id", F.regexp_replace("camera_id", r"\.json$", ""))


@query("WITH " + _NCC + " SELECT video_id, camera_id, printf('ncc score=%.4f margin=%.4f', round(score, 9), round(score / 2, 9)) AS method FROM scr WHERE round(score, 9) >= 0.5")
def match_method_text(spark, sf):
    s = ncc_scores(spark, sf).withColumn("score", F.round("score", 9)).filter("score >= 0.5")
    return s.select("video_id", "camera_id", matching.method_text("ncc", F.col("score"), F.round(F.col("score") / 2, 9)).alias("method"))


# --- shards, passes, pixels ------------------------------------------------------------------------


@query("SELECT item_id, weight FROM (SELECT p_partkey AS item_id, p_size::BIGINT * (p_partkey % 5 + 1) * 1000 AS weight FROM part)")
def shard_weights(spark, sf):
    return A.shard_items(spark, sf).select("item_id", "weight")


_SHARDS = """WITH RECURSIVE items AS (SELECT p_partkey AS item_id, p_size::BIGINT * (p_partkey % 5 + 1) * 1000 AS weight FROM part),
ranked AS (SELECT *, row_number() OVER (ORDER BY weight DESC, item_id) AS n FROM items),
dealt AS (SELECT 0::BIGINT AS n, NULL::BIGINT AS item_id, NULL::BIGINT AS weight, NULL::INTEGER AS shard_id, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[] AS loads
 UNION ALL SELECT r.n, r.item_id, r.weight, (list_position(loads, list_min(loads)) - 1)::INTEGER,
 list_transform(range(1, 9), lambda i: (loads[i] + CASE WHEN i = list_position(loads, list_min(loads)) THEN r.weight ELSE 0 END)::BIGINT) FROM dealt d JOIN ranked r ON r.n = d.n + 1)"""


@query(_SHARDS + " SELECT item_id, weight, shard_id FROM dealt WHERE n > 0")
def balanced_shards(spark, sf):
    return sharding.assign_shards(A.shard_items(spark, sf), 8)


@query(_SHARDS + " SELECT shard_id, sum(weight)::BIGINT AS weight, count(*) AS items FROM dealt WHERE n > 0 GROUP BY shard_id")
def shard_totals(spark, sf):
    return sharding.assign_shards(A.shard_items(spark, sf), 8).groupBy("shard_id").agg(F.sum("weight").alias("weight"), F.count("*").alias("items"))


def _passes(spark, sf, settings) -> DataFrame:
    """Every video with the passes of each of (name, settings)."""
    rows = [(name, p["pass_name"], p["imgsz"], p["conf"], p["augment"], p["batch"]) for name, cfg in settings for p in sharding.detection_passes(cfg)]
    plan = spark.createDataFrame(rows, "step string, pass_name string, imgsz int, conf double, augment boolean, batch int")
    return A.videos(spark, sf).select("video_id").join(F.broadcast(plan))


@query("WITH " + A.VIDEOS_SQL + """, p(step, pass_name, imgsz, conf, augment, batch) AS (VALUES ('car', 'primary', 1920, 0.18::DOUBLE, false, 8), ('truck', 'primary', 5120, 0.1::DOUBLE, false, 1),
 ('car2', 'primary', 1920, 0.18::DOUBLE, false, 8), ('car2', 'secondary', 2560, 0.1::DOUBLE, true, 4), ('plain', 'primary', 640, 0.18::DOUBLE, true, 16), ('plain', 'secondary', 640, 0.18::DOUBLE, false, 16),
 ('wide', 'primary', 5200, 0.3::DOUBLE, false, 2), ('wide', 'secondary', 2600, 0.3::DOUBLE, true, 4))
SELECT video_id, step, pass_name, imgsz, conf, augment, batch FROM vid, p""")
def detection_passes(spark, sf):
    """Passes by the defaults of the steps, with the secondary one on, and with what isn't given derived from the primary pass."""
    set_ = config.configure
    plain = set_(config.PlateConfig(), {"tta_augment": True, "secondary_detection_enabled": True, "secondary_tta_augment": False})
    wide = set_(config.PlateConfig(), {"imgsz": 5200, "detection_conf_thresh": 0.3, "secondary_detection_enabled": True, "secondary_imgsz": 2600})
    return _passes(spark, sf, [("car", config.CAR_PLATES), ("truck", config.TRUCK_PLATES), ("car2", set_(config.CAR_PLATES, secondary=True)), ("plain", plain), ("wide", wide)])


@query()
def sample_videos(spark, sf):
    return sharding.sample_videos(A.videos(spark, sf), 20).select("video_id", "path")


@query()
def gaussian_blur(spark, sf):
    frames = pixels.gray_frames(A.gray_images(spark, sf)).withColumns({"video_id": F.col("image_id"), "frame_no": F.lit(1), "rects": F.expr("array(array(1, 1, 6, 5), array(4, 2, 9, 8))")})
    return pixels.blur_frames(frames, "gaussian", 5).select("video_id", "frame_no", F.hex("pixels").alias("pixels"), "status")


@query("""WITH r AS (SELECT vec_id, embedding, list_min(embedding)::DOUBLE AS lo, list_max(embedding)::DOUBLE AS hi FROM embeddings),
p AS (SELECT vec_id, list_transform(embedding, lambda x: round_even((x::DOUBLE - lo) / (CASE WHEN hi > lo THEN hi - lo ELSE 1 END) * 255, 0)) AS g FROM r)
SELECT vec_id AS image_id, array_to_string(list_transform(g, lambda v: printf('%02X', v::INTEGER)), '') AS pixels FROM p""")
def gray_frames(spark, sf):
    return pixels.gray_frames(A.gray_images(spark, sf)).select("image_id", F.hex("pixels").alias("pixels"))


@query("""WITH r AS (SELECT vec_id, embedding, list_min(embedding)::DOUBLE AS lo, list_max(embedding)::DOUBLE AS hi FROM embeddings),
p AS (SELECT vec_id, list_transform(embedding, lambda x: round_even((x::DOUBLE - lo) / (CASE WHEN hi > lo THEN hi - lo ELSE 1 END) * 255, 0)) AS g FROM r),
b AS (SELECT vec_id, list_transform(range(0, 64), lambda i: CASE WHEN i // 8 BETWEEN 2 AND 5 AND i % 8 BETWEEN 1 AND 6 THEN
 round_even(list_sum(list_transform(range(0, 9), lambda k: g[(greatest(2, least(5, i // 8 + k // 3 - 1)) * 8 + greatest(1, least(6, i % 8 + k % 3 - 1)) + 1)::INTEGER])) / 9, 0) ELSE g[i + 1] END) AS g FROM p)
SELECT vec_id AS video_id, array_to_string(list_transform(g, lambda v: printf('%02X', v::INTEGER)), '') AS pixels FROM b""")
def box_blur(spark, sf):
    frames = pixels.gray_frames(A.gray_images(spark, sf)).withColumns({"video_id": F.col("image_id"), "frame_no": F.lit(1), "rects": F.expr("array(array(1, 2, 7, 6))")})
    return pixels.blur_frames(frames, "box", 1, 1).select("video_id", F.hex("pixels").alias("pixels"))


@query()
def text_signatures(spark, sf):
    frames = pixels.gray_frames(A.gray_images(spark, sf)).withColumn("boxes", F.expr("array(array(0, 0, 8, 4), array(0, 4, 8, 8))"))
    s = pixels.signatures(frames)
    return s.select("image_id", F.size("signature").alias("length"), F.round(F.aggregate("signature", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")), 4).alias("norm"))


def _cascade(spark, sf) -> DataFrame:
    """The match cascade over all videos; a video's first frame is the image of its number, if there is one."""
    v = A.videos(spark, sf).withColumn("masked", N.is_already_masked(F.col("path")))
    own = F.concat(F.lit("v"), F.col("video_id").cast("string"))
    ncc = ncc_scores(spark, sf).select(own.alias("video_id"), F.col("camera_id").cast("string").alias("camera_id"), F.round("score", 9).alias("score")).persist()
    signed = signature_scores(spark, sf).select(own.alias("video_id"), F.col("camera_id").cast("string").alias("camera_id"), "score").persist()
    cfg = config.OverlayConfig()

    def best(scores, least, margin):
        return lambda asked: matching.accept(matching.top_with_margin(scores.join(asked.select("video_id"), "video_id", "left_semi")), least, margin)

    def forced(asked):
        scores = ncc.withColumnRenamed("score", "ncc").join(signed, ["video_id", "camera_id"], "left").withColumn("score", F.coalesce("score", "ncc", F.lit(0.0)))
        return matching.top_with_margin(scores.join(asked.select("video_id"), "video_id", "left_semi"))

    exact = matching.exact_match(v, A.cameras(spark, sf), A.mapping(spark, sf))
    return matching.cascade(v, exact, best(signed.filter("score IS NOT NULL"), cfg.fast_score, cfg.fast_margin), best(ncc, cfg.ncc_score, cfg.ncc_margin), forced)


@query()
def match_cascade(spark, sf):
    return _cascade(spark, sf).select("video_id", "camera_id", "method", r6(F.col("score"), "score"))


@query()
def full_pipeline(spark, sf):
    """Rectangles of all four steps."""
    v = A.videos(spark, sf)
    done = steps.default_steps(lambda k: A.step_detections(spark, sf, k), v, _cascade(spark, sf), A.cameras(spark, sf), W, H)
    return steps.run_steps(done).select("step", "video_id", "frame_no", "box_idx", "x1", "y1", "x2", "y2", "kernel")
