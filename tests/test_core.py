"""Core operators: geometry, names, temporal folds, matching, sharding, files, streaming."""

import json
import math
import random

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from maskwright import config
from maskwright.functions import geometry as G
from maskwright.functions import images
from maskwright.functions import names as N
from maskwright.operators import labels, matching, pixels, sharding, temporal
from maskwright.plans import catalogue, steps
from maskwright.sources import codecs, files

CFG = config.PlateConfig()


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def b(*v):
    return F.struct(*[F.lit(float(x)).alias(n) for x, n in zip(v, ("x1", "y1", "x2", "y2"))])


def test_iou_and_distance(spark):
    r = one(spark, G.iou(b(0, 0, 10, 10), b(5, 0, 15, 10)), G.iou(b(0, 0, 1, 1), b(2, 2, 3, 3)), G.distance_ratio(b(0, 0, 10, 10), b(5, 0, 15, 10), G.scale_of(b(5, 0, 15, 10))), G.iou(b(3, 3, 3, 3), b(3, 3, 3, 3)))
    assert r[0] == pytest.approx(1 / 3) and r[1] == 0 and r[2] == pytest.approx(0.5) and r[3] == 0


def test_rounding_is_half_even(spark):
    r = one(spark, G.from_yolo(*[F.lit(x) for x in (0.5, 0.5, 0.25, 0.25)], F.lit(10), F.lit(20))).asDict(True)
    box = next(iter(r.values()))
    assert (box["x1"], box["x2"], box["y1"], box["y2"]) == (4.0, 6.0, 8.0, 12.0)


def test_expand_is_a_maximum(spark):
    r = one(spark, G.expand(b(100, 100, 110, 104), F.lit(1920), F.lit(1080), 3, 0.12, 28, 14).alias("e"))["e"]
    assert (r["x2"] - r["x1"], r["y2"] - r["y1"]) == (28, 14)


def test_filter_graph(spark):
    boxes = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(q, ("x1", "y1", "x2", "y2"))]) for q in ((1, 2, 41, 22), (5, 5, 9, 9))])
    g = one(spark, G.filter_graph(boxes, 30, 6, F.lit(2560), 1920))[0]
    assert g == "[0:v]split=3[base][crop0][crop1];[crop0]crop=40:20:1:2,boxblur=luma_radius=10:luma_power=6:chroma_radius=5:chroma_power=6[blur0];[base][blur0]overlay=1:2[masked0];[crop1]crop=4:4:5:5,boxblur=luma_radius=2:luma_power=6:chroma_radius=1:chroma_power=6[blur1];[masked0][blur1]overlay=5:5[vout];[vout]scale=1920:-2[vpreview]"


def lcs(x, y):
    return max((k for i in range(len(x)) for k in range(len(x) - i + 1) if x[i : i + k] in y), default=0)


def test_names(spark):
    pairs = [("abcdef", "zcdez"), ("", "x"), ("aaa", "aa"), ("cam12", "12cam")]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", N.common_substring(F.col("a"), F.col("b")).alias("n"))
    assert all(r["n"] == lcs(r["a"], r["b"]) for r in df.collect())
    names = ["v10.mp4", "v2.mp4", "v1b.mp4", "V3.mp4"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in names], "s string").orderBy(N.natural_key(F.col("s"))).collect()]
    assert got == ["V3.mp4", "v1b.mp4", "v2.mp4", "v10.mp4"]
    r = one(spark, N.normalize(F.lit("/a/Çam_é-1 2.mp4")), N.video_of_label(F.lit("/x/a_b_12.txt")), N.frame_number(F.lit("/x/a_b_12.txt")), N.frame_number(F.lit("a_x.txt")), N.frame_rate(F.lit("30000/1001")), N.frame_rate(F.lit("0/0")), N.output_tag(F.lit("Videos_- New Set"), F.lit(""), F.lit(True)), N.extension(F.lit("/d/.mp4")))
    assert r[0] == "çamé12" and r[1] == "a_b" and r[2] == 12 and r[3] is None and r[4] == pytest.approx(29.97003) and r[5] is None and r[6] == "_new_set_smoke" and r[7] == ""


def test_dedupe(spark):
    rows = [("v", 1, i, *map(float, q)) for i, q in enumerate([(0, 0, 10, 10), (1, 0, 11, 10), (50, 50, 60, 60), (300, 0, 310, 10)])]
    df = spark.createDataFrame(rows, "video_id string, frame_no int, box_idx int, x1 double, y1 double, x2 double, y2 double")
    once = labels.dedupe_frames(df, 0.45, 0.7)
    assert [r["x1"] for r in once.orderBy("box_idx").collect()] == [0.0, 50.0, 300.0]
    assert labels.dedupe_frames(once, 0.45, 0.7).count() == 3


def test_fill_gap_bounds_and_ties():
    a, c = [0.0, 0.0, 10.0, 10.0], [30.0, 0.0, 40.0, 10.0]
    out = temporal.fill_gaps({1: [a], 4: [c]}, 5, "interpolate", CFG)
    assert out[2][0][0] == pytest.approx(10) and out[3][0][0] == pytest.approx(20)
    assert temporal.fill_gaps({1: [a], 3: [c]}, 5, "nearest", CFG)[2] == [a]
    assert set(temporal.fill_gaps({1: [a], 7: [c]}, 5, "interpolate", CFG)) == set(range(1, 8))
    assert set(temporal.fill_gaps({1: [a], 8: [c]}, 5, "interpolate", CFG)) == {1, 8}


def test_distance_gate_needs_a_least_overlap():
    a, far = [0.0, 0.0, 10.0, 10.0], [900.0, 0.0, 910.0, 10.0]
    assert temporal.pair_greedily([a], [far], [1], 1.8, 0.0, 0.6) == [(0, 0)]
    assert temporal.pair_greedily([a], [far], [1], 1.8, 0.1, 0.6) == []
    assert temporal.pair_greedily([a, a], [a], [1, 1], 1.8, 0.0, 0.6) == [(1, 0)]


def test_carry_forward():
    out = temporal.carry_forward({1: [[0.0, 0.0, 10.0, 10.0]], 9: [[500.0, 0.0, 510.0, 10.0]]}, 2, CFG)
    assert sorted(out) == [1, 2, 3, 9, 10, 11]


def test_smoothing_crosses_gaps_and_can_be_off():
    frames = {1: [[0.0, 0.0, 40.0, 40.0]], 100: [[20.0, 0.0, 60.0, 40.0]]}
    out = temporal.stabilize(frames, 1920, 1080, CFG)
    assert out[100][0][0] < 20 + 1e-9 and out[100][0][2] < 64.8
    assert temporal.stabilize(frames, 1920, 1080, config.configure(CFG, temporal_smoothing=False)) == frames


def simulate_fill(frames, window, cfg):
    """Second writing of the tracked gap fill, on tuples, for single steps."""
    out = {f: list(map(tuple, r)) for f, r in frames.items()}
    tracks = []
    for f in sorted(frames):
        cand = []
        for i, (t, last) in enumerate(tracks):
            for j, r in enumerate(frames[f]):
                d = math.dist(((t[0] + t[2]) / 2, (t[1] + t[3]) / 2), ((r[0] + r[2]) / 2, (r[1] + r[3]) / 2)) / max(1, t[2] - t[0], t[3] - t[1], r[2] - r[0], r[3] - r[1])
                cand.append((temporal.overlap(t, r), -d, -(f - last), i, j))
        used_i, used_j, hit = set(), set(), {}
        while cand:
            best = max(cand)
            cand.remove(best)
            if best[3] not in used_i and best[4] not in used_j:
                used_i.add(best[3])
                used_j.add(best[4])
                hit[best[3]] = best[4]
        for i in sorted(hit, key=lambda i: (temporal.overlap(tracks[i][0], frames[f][hit[i]]),), reverse=True):
            t, last = tracks[i]
            for g in range(last + 1, f) if f - last - 1 <= window else ():
                w = (g - last) / (f - last)
                new = tuple(p + (q - p) * w for p, q in zip(t, frames[f][hit[i]]))
                if not temporal.is_repeat(out.get(g, []), new, cfg.temporal_dedupe_iou, cfg.temporal_dedupe_distance):
                    out.setdefault(g, []).append(new)
        tracks = [t for i, t in enumerate(tracks) if i not in hit and f - t[1] <= window] + [(frames[f][hit[i]], f) for i in sorted(hit)] + [(r, f) for j, r in enumerate(frames[f]) if j not in used_j]
    return {f: sorted(map(tuple, r)) for f, r in out.items()}


def test_fill_equals_second_writing():
    rng = random.Random(1)
    for _ in range(60):
        frames = {f: [[x := rng.uniform(0, 900), y := rng.uniform(0, 500), x + rng.uniform(5, 60), y + rng.uniform(5, 40)] for _ in range(rng.randint(1, 3))] for f in rng.sample(range(1, 40), 9)}
        got = {f: sorted(map(tuple, r)) for f, r in temporal.fill_gaps(frames, 6, "interpolate", CFG).items()}
        assert got == simulate_fill(frames, 6, CFG)


def balanced(weights, shards):
    """Second writing: the lightest shard takes the next item."""
    loads, out = [0] * shards, []
    for item, weight in sorted(weights, key=lambda x: (-(x[1] or 0), x[0])):
        k = loads.index(min(loads))
        loads[k] += weight or 0
        out.append((item, k))
    return out


def test_shards(spark):
    rows = [(i, (i * 7919) % 90 + 1) for i in range(3000)] + [(3001, None), (3002, 0)]
    for given in (rows, [(i, w) for i, w in enumerate((7, 5, 4, 3, 1))], [(5, 3), (5, 3), (5, 3), (6, 3)], []):
        items = spark.createDataFrame(given, "item_id long, weight long")
        got = sharding.assign_shards(items, 4)
        assert got.columns == ["item_id", "weight", "shard_id"]
        assert sorted((r["item_id"], r["shard_id"]) for r in got.collect()) == sorted(balanced(given, 4))


def test_passes():
    assert [sharding.default_batch(n) for n in (640, 1920, 2560, 3840, 5120)] == [16, 8, 4, 3, 2]
    one = sharding.detection_passes(config.configure(config.PlateConfig(), detect_batch_size=0))
    assert len(one) == 1 and one[0]["batch"] == 1 and one[0]["augment"] is False
    two = sharding.detection_passes(config.configure(config.TRUCK_PLATES, {"secondary_detection_enabled": True}))
    assert [(p["imgsz"], p["conf"], p["augment"], p["batch"]) for p in two] == [(5120, 0.10, False, 1), (5120, 0.07, True, 1)]


def test_cascade(spark):
    videos = spark.createDataFrame([("a", "/v/mapped.mp4"), ("b", "/v/gone.mp4"), ("c", "/v/depotnorth.mp4"), ("d", "/v/7.mp4"), ("e", "/v/8_x.mp4"), ("f", "/v/zzz.mp4")], "video_id string, path string")
    cameras = spark.createDataFrame([("7",), ("8",), ("c1",)], "camera_id string")
    mapping = spark.createDataFrame([("mapped", "c1"), ("gone.mp4", "missing"), ("Depot-North", "c1"), ("Depot", "c9")], "key string, camera_id string")
    got = {r["video_id"]: (r["camera_id"], r["method"]) for r in matching.exact_match(videos, cameras, mapping).collect()}
    assert got == {"a": ("c1", "mapping"), "b": (None, "none"), "c": ("c1", "fuzzy"), "d": ("7", "stem"), "e": ("8", "prefix"), "f": (None, "none")}


def test_fuzzy_tie_rejects(spark):
    videos = spark.createDataFrame([("a", "/v/depot.mp4")], "video_id string, path string")
    mapping = spark.createDataFrame([("depot1x", "c"), ("depot2x", "c")], "key string, camera_id string")
    assert matching.fuzzy_keys(videos, mapping).count() == 0


def test_top_with_margin_of_a_single_camera(spark):
    r = matching.top_with_margin(spark.createDataFrame([("v", "c", 0.4)], "video_id string, camera_id string, score double")).first()
    assert r["margin"] == pytest.approx(0.4)


def test_ncc(spark):
    x, y = [1.0, 2.0, 5.0, 3.0], [2.0, 2.5, 4.0, 1.0]
    arrays = [F.array(*[F.lit(v) for v in q]) for q in (x, y, [3.0] * 4)]
    r = one(spark, matching.ncc(arrays[0], arrays[1]), matching.ncc(arrays[0], arrays[2]))
    assert r[0] == pytest.approx(np.corrcoef(x, y)[0, 1]) and r[1] == 0.0


def test_images():
    rng = np.random.default_rng(0)
    img = rng.integers(0, 255, (40, 60, 3), dtype=np.uint8)
    out = images.blur_in_place(img, [(5, 5, 30, 30), (20, 20, 50, 39)], 7)
    assert (out[:5] == img[:5]).all() and (out[10:20, 10:20] != img[10:20, 10:20]).any()
    assert (images.blur_in_place(np.full((9, 9), 77, np.uint8), [(0, 0, 9, 9)], 31) == 77).all()
    assert images.kernel(5).sum() == pytest.approx(1)
    flat = images.box_blur(np.arange(25, dtype=np.uint8).reshape(5, 5), 1, 1)
    assert flat[2, 2] == 12
    assert images.ncc(img, img) == pytest.approx(1, abs=1e-5) and images.ncc(np.ones((3, 3)), img[:3, :3, 0]) == 0.0
    two = np.r_[np.full(50, 20), np.full(50, 200)].astype(np.uint8)
    assert 20 <= images.otsu(two) < 200
    assert images.signature(img, [(0, 0, 30, 20), (0, 0, 1, 1)]).shape == (48,)
    assert (images.draw_boxes(img, [(5, 5, 20, 20)])[5, 5] == (0, 0, 255)).all()


def test_blur_frames_status(spark):
    rows = [("v", 1, 4, 4, 1, bytes(range(16)), [[0, 0, 4, 4]]), ("v", 2, 4, 4, 1, b"short", None)]
    df = spark.createDataFrame(rows, "video_id string, frame_no int, height int, width int, channels int, pixels binary, rects array<array<int>>")
    got = {r["frame_no"]: r for r in pixels.blur_frames(df, "gaussian", 3).collect()}
    assert got[1]["status"] == "ok" and got[2]["status"] == "bad frame" and bytes(got[2]["pixels"]) == b"short"


def test_files(spark, tmp_path):
    (tmp_path / "videos/sub").mkdir(parents=True)
    for n in ("v10.mp4", "v2.MP4", "sub/v3.avi", "x.txt"):
        (tmp_path / "videos" / n).write_bytes(b"x")
    got = [r["path"].rsplit("/videos/", 1)[1] for r in files.scan_videos(spark, str(tmp_path / "videos")).collect()]
    assert got == ["sub/v3.avi", "v2.MP4", "v10.mp4"]
    assert files.scan_videos(spark, str(tmp_path / "videos"), recursive=False).count() == 2
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels/a_1.txt").write_text("0 0.5 0.5 0.1 0.1\n\n1 0.2 0.2 0.1\n")
    (tmp_path / "labels/a_b_1.txt").write_text("0 0.5 0.5 0.2 0.2")
    lines = files.read_label_lines(spark, str(tmp_path / "labels"))
    assert {(r["video_id"], r["bw"]) for r in labels.detections(lines).collect()} == {("a", 0.1), ("a_b", 0.2)}
    assert {r["status"] for r in labels.rejected(lines).collect()} == {"blank", "too few tokens"}
    (tmp_path / "cams").mkdir()
    (tmp_path / "cams/c1.json").write_text(json.dumps({"imageWidth": 100, "imageHeight": 50, "shapes": [{"points": [[1.5, 2.5], [10.5, 20.2]]}, {"points": [[1, 1], [1, 1]]}]}))
    (tmp_path / "cams/bad.json").write_text("{")
    cams = files.read_cameras(spark, str(tmp_path / "cams")).collect()
    assert [(c["camera_id"], [tuple(x) for x in c["boxes"]]) for c in cams] == [("c1", [(2, 2, 10, 20)])]
    (tmp_path / "map.json").write_text('{"a": "c1.json", "b": "c2"}')
    assert {tuple(r) for r in files.read_mapping(spark, str(tmp_path / "map.json")).collect()} == {("a", "c1"), ("b", "c2")}


def test_detect_ladder(spark):
    rows = [("v", i, bytes([i])) for i in range(4)]
    df = spark.createDataFrame(rows, "video_id string, frame_no int, pixels binary").coalesce(1)

    def make():
        def run(batch, device):
            if len(batch) > 1 or (batch[0] == b"\x02" and device == "gpu") or batch[0] == b"\x03":
                raise RuntimeError
            return [[(0, 0.5, 0.5, 0.1, 0.1)] for _ in batch]

        return run

    assert {r["frame_no"]: r["status"] for r in codecs.detect(df, make).collect()} == {0: "retried", 1: "retried", 2: "cpu", 3: "failed"}


def test_decode_and_encode(spark):
    def decoder(path, last):
        if "bad" in path:
            raise OSError
        for k in range(1, 6):
            yield k, 2, 2, 1, bytes([k] * 4)

    videos = spark.createDataFrame([("a", "a.mp4", 3), ("b", "bad.mp4", None)], "video_id string, path string, last_frame int")
    frames = codecs.decode(videos, decoder)
    assert {(r["video_id"], r["frame_no"], r["status"]) for r in frames.collect()} == {("a", 1, "ok"), ("a", 2, "ok"), ("a", 3, "ok"), ("b", 0, "failed")}
    done = codecs.encode(frames.filter("status = 'ok'"), lambda path, rows, fps: sum(1 for _ in rows), "/out", 25.0)
    assert [tuple(r) for r in done.collect()] == [("a", "/out/a.mp4", 3, "ok")]


def matcher_scores(sf_dir):
    """(image, camera): signature score or None, and NCC, by brute force."""
    rows = pq.read_table(f"{sf_dir}/embeddings.parquet", columns=["vec_id", "label", "embedding"]).to_pylist()
    sign, centred, first = {}, {}, {}
    for r in sorted(rows, key=lambda r: r["vec_id"]):
        x = np.array(r["embedding"], float)
        g = np.rint((x - x.min()) / ((x.max() - x.min()) or 1) * 255).astype(np.uint8).reshape(8, 8)
        sign[r["vec_id"]], centred[r["vec_id"]] = images.signature(g, [[0, 0, 8, 4], [0, 4, 8, 8]]), x - x.mean()
        first.setdefault(r["label"], r["vec_id"])
    out = {}
    for i in sign:
        for camera, t in first.items():
            a, b = sign[i], sign[t]
            fast = None if a is None or b is None or len(a) != len(b) else float(np.dot(a.astype(np.float32).astype(float), b.astype(np.float32).astype(float)))
            norms = np.linalg.norm(centred[i]) * np.linalg.norm(centred[t])
            out[i, camera] = fast, float(centred[i] @ centred[t] / norms) if norms else 0.0
    return out


def test_force_best_has_no_threshold(spark, sf_dir):
    best = {}
    for (i, camera), (fast, slow) in matcher_scores(sf_dir).items():
        best[i] = max(best.get(i, -2.0), slow if fast is None else fast)
    got = {r["video_id"]: r for r in catalogue.QUERIES["force_best_match_all"](spark, sf_dir).collect()}
    assert set(got) == set(best) and all(r["camera_id"] is not None for r in got.values())
    assert all(got[i]["score"] == pytest.approx(best[i], abs=2e-6) for i in best)


def test_signature_and_ncc_disagreements_are_rejected(spark, sf_dir):
    fast, slow = {}, {}
    for (i, camera), (f, n) in sorted(matcher_scores(sf_dir).items()):
        for best, score in ((fast, f), (slow, n)):
            if score is not None and (i not in best or round(score, 9) > best[i][1]):
                best[i] = camera, round(score, 9)
    want = {i: (fast[i][0], min(fast[i][1], slow[i][1])) for i in fast if fast[i][0] == slow[i][0]}
    got = {r["video_id"]: (r["camera_id"], r["score"]) for r in catalogue.QUERIES["signature_matchers_agree"](spark, sf_dir).collect()}
    print(f"agree: {len(got)} of {len(slow)}")
    assert 0 < len(got) < len(slow) and set(got) == set(want)
    assert all(got[i][0] == c and got[i][1] == pytest.approx(s, abs=2e-6) for i, (c, s) in want.items())


def test_steps_resume(spark):
    rows = [("v", f, 0, 10.0 + f, 10.0, 50.0 + f, 40.0) for f in (1, 4, 9)]
    df = spark.createDataFrame(rows, "video_id string, frame_no int, box_idx int, x1 double, y1 double, x2 double, y2 double")
    videos = spark.createDataFrame([("v", "/d/v.mp4", 1920, 1080), ("w", "/d/w.mp4", 1920, 1080)], "video_id string, path string, width int, height int")
    matches = spark.createDataFrame([("v", "c")], "video_id string, camera_id string")
    cameras = spark.sql("SELECT 'c' AS camera_id, 960 AS image_width, 540 AS image_height, array(named_struct('x1', 1, 'y1', 2, 'x2', 101, 'y2', 52)) AS boxes")
    seen, asked = [], []
    made = steps.default_steps(lambda k: (asked.append(k), df)[1], videos, matches, cameras)
    out = steps.run_steps(made, start=2, keep=lambda n, d: (seen.append(n), d)[1]).collect()
    assert seen == [2, 3, 4] and asked == [2, 4]
    assert [(r["video_id"], r["frame_no"], r["x1"], r["y1"], r["x2"], r["y2"]) for r in out if r["step"] == 3] == [("v", None, 0, 0, 208, 110)]
    assert {r["frame_no"] for r in out if r["step"] == 4} == set(range(1, 10))
    with pytest.raises(ValueError):
        steps.run_steps(made, start=5)
    assert steps.blur_plan(df, config.CAR_PLATES, 1920, 1080).count() == 3


def test_cascade_of_matchers(spark):
    videos = spark.createDataFrame([(i, i in (2, 3)) for i in range(1, 8)], "video_id int, masked boolean")
    table = lambda rows: spark.createDataFrame(rows, "video_id int, camera_id string, score double")
    fast, slow, best = table([(1, "x", 0.9), (2, "a", 0.8), (3, "a", 0.8), (4, "b", 0.7)]), table([(2, "a", 0.6), (3, "c", 0.6), (4, "z", 0.9), (5, "d", 0.5)]), table([(i, "f", 0.1) for i in range(1, 7)])
    asked = []

    def by(name, rows):
        def run(df):
            asked.append((name, sorted(r["video_id"] for r in df.collect())))
            return rows.join(df.select("video_id"), "video_id", "left_semi")

        return run

    exact = spark.createDataFrame([(1, "e"), (2, None)], "video_id int, camera_id string")
    got = {r["video_id"]: (r["camera_id"], r["method"], r["score"]) for r in matching.cascade(videos, exact, by("fast", fast), by("slow", slow), by("best", best)).collect()}
    assert got == {1: ("e", "exact", None), 2: ("a", "agreed", 0.6), 3: (None, "none", None), 4: ("b", "fast", 0.7), 5: ("d", "ncc", 0.5), 6: ("f", "forced", 0.1), 7: (None, "none", None)}
    assert asked == [("fast", [2, 3]), ("slow", [2, 3]), ("fast", [4, 5, 6, 7]), ("slow", [5, 6, 7]), ("best", [6, 7])]


def test_config():
    c = config.configure(CFG, {"imgsz": 99, "blur_radius": 3, "model_path": "x"}, blur_radius=5, imgsz=None)
    assert (c.imgsz, c.blur_radius) == (99, 5)
    with pytest.raises(ValueError, match="other"):
        config.configure(CFG, {"imgsz": 99, "other": 1})
    assert config.configure(config.FaceConfig(), {"detection_conf_thresh": 0.2, "detect_batch_size": None}).conf == 0.2


@pytest.mark.parametrize("name,default", [("CAR_PLATES", "car"), ("TRUCK_PLATES", "truck")])
def test_config_file_values(tmp_path, name, default):
    """Every setting of a step, written under the files' names, comes back as that step's settings."""
    cfg = getattr(config, name)
    to_file = {v: k for k, v in config.FILE_KEYS.items()}
    lines = [f"{to_file.get(f, f)}: {'null' if v is None else v}" for f, v in vars(cfg).items()] + ["save_frames: False"]
    (tmp_path / "step.yaml").write_text("\n".join(lines))
    yaml = pytest.importorskip("yaml")
    assert yaml and config.configure(config.PlateConfig(), config.load_yaml(str(tmp_path / "step.yaml"))) == cfg


def test_stream_equals_batch(spark, tmp_path):
    from maskwright.streaming import tracks

    rows = pd.DataFrame([("v", f, 0, 10.0 * f, 0.0, 10.0 * f + 20, 20.0) for f in (1, 3, 4, 8)] + [("w", 2, 0, 0.0, 0.0, 5.0, 5.0)], columns=["video_id", "frame_no", "box_idx", "x1", "y1", "x2", "y2"])
    schema = "video_id string, frame_no int, box_idx int, x1 double, y1 double, x2 double, y2 double"
    for k, part in enumerate((rows[rows.frame_no <= 3], rows[rows.frame_no > 3])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{k}"))
    src = tmp_path / "src"
    src.mkdir()
    for k in range(2):
        for f in (tmp_path / f"in{k}").glob("*.parquet"):
            f.rename(src / f"{k}-{f.name}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    q = tracks.stream_gap_fill(stream, CFG).writeStream.format("memory").queryName("filled").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r["video_id"], r["frame_no"], r["x1"]) for r in spark.table("filled").collect()}
    batch = temporal.temporal_folds(spark.createDataFrame(rows, schema), CFG, ("fill",))
    assert got == {(r["video_id"], r["frame_no"], r["x1"]) for r in batch.collect()}


def test_outputs_on_files(spark, tmp_path):
    from maskwright.sources import files

    for step in ("step1_plate_a", "step2_truck_a", "step3_osd_a", "step3_osd_b"):
        (tmp_path / step).mkdir()
        (tmp_path / step / "x.mp4").write_bytes(b"1")
    assert files.clear_steps(spark, str(tmp_path), "_a", 2) == ["step2_truck_a", "step3_osd_a"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["step1_plate_a", "step3_osd_b"]
    regions = spark.createDataFrame([("v", f, 0, 1.0, 2.0, 3.0, 4.0) for f in (3, 1, 2)], "video_id string, frame_no int, box_idx int, x1 double, y1 double, x2 double, y2 double")
    files.write_regions(regions, str(tmp_path / "regions"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "regions")).collect())) == sorted(map(tuple, regions.collect()))
    files.write_json(regions, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 1
    cams = tmp_path / "cams"
    cams.mkdir()
    for name in ("7.png", "7.jpg", "8.bmp", "8.json", "9.txt"):
        (cams / name).write_bytes(name.encode())
    assert sorted((r["camera_id"], bytes(r["content"])) for r in files.camera_images(spark, str(cams)).collect()) == [("7", b"7.jpg"), ("8", b"8.bmp")]
    videos = spark.createDataFrame([("a",), ("b",), ("c",)], "video_id string")
    done = spark.createDataFrame([("a", 5), ("b", 0)], "video_id string, length int")
    assert sorted(r[0] for r in files.only_missing(videos, done).collect()) == ["b", "c"]
    assert files.only_missing(videos, done, overwrite=True).count() == 3
    one = tmp_path / "one.mp4"
    one.write_bytes(b"x")
    assert [r["video_id"] for r in files.scan_videos(spark, str(one)).collect()] == ["one"]
    assert sharding.workers(8, 4, 3) == 3 and sharding.workers(0, 4, 3) == 1 and sharding.workers(2, 0, 3) == 1


def test_redact_in_one_task(spark, tmp_path):
    def decoder(path, last):
        if path == "bad":
            raise OSError(path)
        for f in range(1, 5):
            yield f, 8, 8, 1, bytes(range(64)) if path == "plain" else bytes(64 * [f]) + b""

    def encoder(path, frames, fps):
        n = 0
        with open(f"{path}.txt", "w") as out:
            for frame, h, w, c, pixels in frames:
                n += 1
                out.write(f"{frame} {pixels.hex()}\n")
        return n

    videos = spark.createDataFrame([(1, "plain", 3), (2, "bad", None), (3, "none", None)], "video_id int, path string, last_frame int")
    rects = spark.createDataFrame([(1, 2, 0, 0, 4, 4, 3), (1, None, 4, 4, 8, 8, 5), (2, 1, 0, 0, 4, 4, 3)], "video_id int, frame_no int, x1 int, y1 int, x2 int, y2 int, kernel int")
    got = {r["video_id"]: (r["path"], r["frames"], r["status"]) for r in codecs.redact(videos, rects, decoder, encoder, str(tmp_path)).collect()}
    assert got == {1: (f"{tmp_path}/1.mp4", 3, "ok"), 2: (f"{tmp_path}/2.mp4", 0, "failed"), 3: ("none", 0, "passthrough")}
    from maskwright.functions import images

    img = np.frombuffer(bytes(range(64)), np.uint8).reshape(8, 8)
    lines = [x.split() for x in (tmp_path / "1.mp4.txt").read_text().splitlines()]
    for frame, pixels in lines:
        want = images.blur_in_place(img, [(4, 4, 8, 8)], 5)
        want = images.blur_in_place(want, [(0, 0, 4, 4)], 3) if frame == "2" else want
        assert bytes.fromhex(pixels) == want.tobytes()
