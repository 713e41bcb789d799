"""DuckDB SQL of the folds over a video's frames, as text; a second writing that the queries are held against.

Every stage reads a table (video_id, frame_no, boxes) and gives common table expressions, the last
of which has the same columns. A fold is a recursive table that carries the tracks as lists; greedy
pairs come from a reduction over the sorted candidates.
"""

from __future__ import annotations

BOX = ("x1", "y1", "x2", "y2")


def _d(x) -> str:
    return f"{x!r}::DOUBLE"


def _box(a: str, **more: str) -> str:
    return "{" + ", ".join([f"'{n}': {a}.{n}" for n in BOX] + [f"'{k}': {v}" for k, v in more.items()]) + "}"


def _center(a: str) -> tuple[str, str]:
    return f"(({a}.x1 + {a}.x2) / 2)", f"(({a}.y1 + {a}.y2) / 2)"


def _side(a: str) -> str:
    return f"greatest(1.0::DOUBLE, {a}.x2 - {a}.x1, {a}.y2 - {a}.y1)"


def _area(a: str) -> str:
    return f"(greatest(0.0::DOUBLE, {a}.x2 - {a}.x1) * greatest(0.0::DOUBLE, {a}.y2 - {a}.y1))"


def _overlap(a: str, b: str) -> str:
    inter = f"(greatest(0.0::DOUBLE, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0.0::DOUBLE, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)))"
    return f"(CASE WHEN {inter} > 0 THEN {inter} / ({_area(a)} + {_area(b)} - {inter}) ELSE 0.0::DOUBLE END)"


def _apart(a: str, b: str) -> str:
    """Distance of the centres."""
    (ax, ay), (bx, by) = _center(a), _center(b)
    return f"sqrt(({bx} - {ax}) * ({bx} - {ax}) + ({by} - {ay}) * ({by} - {ay}))"


def _similar(r: str, candidate: str, min_iou: float, distance: float) -> str:
    return f"({_overlap(r, candidate)} >= {_d(min_iou)} OR {_apart(r, candidate)} / {_side(candidate)} <= {_d(distance)})"


def _candidates(before: str, now: str, gap: str, cfg, growth: float) -> str:
    a, b = f"{before}[i]", f"{now}[j]"
    far = f"({_apart(a, b)} / greatest({_side(a)}, {_side(b)}))"
    row = f"{{'s': {_overlap(a, b)}, 'f': 0.0::DOUBLE - {far}, 'g': 0 - greatest(1, {gap}), 'i': i, 'j': j}}"
    every = f"flatten(list_transform(range(1, len({before}) + 1), lambda i: list_transform(range(1, len({now}) + 1), lambda j: {row})))"
    return f"list_filter({every}, lambda c: c.s >= {_d(float(cfg.match_iou))} OR 0.0::DOUBLE - c.f <= {_d(float(cfg.match_distance))} + (0 - c.g - 1) * {_d(float(growth))})"


def _greedy(candidates: str) -> str:
    free = "len(list_filter(a, lambda p: p.i = x[1].i OR p.j = x[1].j)) = 0"
    return f"CASE WHEN len({candidates}) = 0 THEN [] ELSE list_reduce(list_transform(list_reverse_sort({candidates}), lambda c: [c]), lambda a, x: CASE WHEN {free} THEN list_concat(a, x) ELSE a END) END"


def _sorted(boxes: str) -> str:
    cx, cy = _center("b")
    return f"list_transform(list_sort(list_transform({boxes}, lambda b, k: {{'cx': round({cx}, 3), 'cy': round({cy}, 3), 'k': k, 'b': b}})), lambda s: s.b)"


def _unpaired(side: str, index: str) -> str:
    return f"len(list_filter(pairs, lambda p: p.{side} = {index})) = 0"


def packed(table: str, name: str) -> str:
    """Rows (video_id, frame_no, box_idx, x1..y2) as lists of boxes."""
    return f"{name} AS (SELECT video_id, frame_no, list({{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} ORDER BY box_idx) AS boxes FROM {table} GROUP BY ALL)"


def fill(p: str, t: str, cfg) -> str:
    w = cfg.gap_fill_window
    track = _box("b", seen="q.frame_no")
    at = "(f - tracks[p.i].seen)::DOUBLE / (frame_no - tracks[p.i].seen)::DOUBLE"
    if cfg.gap_fill_mode == "nearest":
        made = ", ".join(f"'{n}': CASE WHEN {at} <= 0.5 THEN tracks[p.i].{n} ELSE boxes[p.j].{n} END" for n in BOX)
    else:
        made = ", ".join(f"'{n}': tracks[p.i].{n} + (boxes[p.j].{n} - tracks[p.i].{n}) * ({at})" for n in BOX)
    steps = f"flatten(list_transform(pairs, lambda p: CASE WHEN frame_no - tracks[p.i].seen - 1 BETWEEN 1 AND {w} THEN list_transform(range(tracks[p.i].seen + 1, frame_no), lambda f: {{'f': f, {made}}}) ELSE [] END))"
    clash = f"len(list_filter(list_concat(a, allb), lambda r: r.f = x[1].f AND {_similar('r', 'x[1]', cfg.temporal_dedupe_iou, cfg.temporal_dedupe_distance)})) > 0"
    now = lambda j: _box(f"boxes[{j}]", seen="frame_no")
    return f"""{p}v AS (SELECT video_id, flatten(list(list_transform(boxes, lambda b: {_box('b', f='frame_no::BIGINT')}) ORDER BY frame_no)) AS allb FROM {t} GROUP BY video_id),
{p}o AS (SELECT video_id, frame_no::BIGINT AS frame_no, boxes, row_number() OVER (PARTITION BY video_id ORDER BY frame_no) AS n FROM {t}),
{p}r AS (SELECT q.video_id, q.n, list_transform(q.boxes, lambda b: {track}) AS tracks, []::STRUCT(f BIGINT, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE)[] AS made FROM {p}o q WHERE q.n = 1
 UNION ALL SELECT video_id, n, list_concat(list_concat(list_filter(tracks, lambda k, i: {_unpaired('i', 'i')} AND frame_no - k.seen <= {w}),
  list_transform(list_sort(list_transform(pairs, lambda p: {{'i': p.i, 'j': p.j}})), lambda p: {now('p.j')})), list_transform(list_filter(range(1, len(boxes) + 1), lambda j: {_unpaired('j', 'j')}), lambda j: {now('j')})),
  list_reduce(list_concat([made], list_transform(steps, lambda m: [m])), lambda a, x: CASE WHEN {clash} THEN a ELSE list_concat(a, x) END)
 FROM (SELECT *, {steps} AS steps FROM (SELECT *, {_greedy('cand')} AS pairs FROM (
  SELECT q.video_id, q.n, q.frame_no, q.boxes, r.tracks, r.made, v.allb, {_candidates('r.tracks', 'q.boxes', 'q.frame_no - r.tracks[i].seen', cfg, cfg.growth_gap)} AS cand FROM {p}r r JOIN {p}o q ON q.video_id = r.video_id AND q.n = r.n + 1 JOIN {p}v v ON v.video_id = r.video_id)))),
{p}m AS (SELECT video_id, unnest(range(1, len(made) + 1)) AS k, made FROM (SELECT video_id, arg_max(made, n) AS made FROM {p}r GROUP BY video_id)),
{p}g AS (SELECT video_id, made[k].f AS frame_no, list({_box('made[k]')} ORDER BY k) AS more FROM {p}m GROUP BY ALL),
{p} AS (SELECT video_id, frame_no::INTEGER AS frame_no, list_concat(coalesce(boxes, []), coalesce(more, [])) AS boxes FROM {p}o FULL JOIN {p}g USING (video_id, frame_no))"""


def carry(p: str, t: str, cfg) -> str:
    w = cfg.carry_forward_window
    lost = f"list_filter(tracks, lambda k, i: {_unpaired('i', 'i')} AND f - k.seen BETWEEN 1 AND {w})"
    clash = f"len(list_filter(a, lambda r: {_similar('r', 'x[1]', cfg.temporal_dedupe_iou, cfg.temporal_dedupe_distance)})) > 0"
    now = lambda j: _box(f"boxes[{j}]", seen="f")
    none = "[]::STRUCT(x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE"
    return f"""{p}b AS (SELECT video_id, min(frame_no)::BIGINT AS lo, max(frame_no)::BIGINT + {w} AS hi FROM {t} GROUP BY video_id),
{p}r AS (SELECT video_id, lo - 1 AS f, hi, {none}, seen BIGINT)[] AS tracks, {none})[] AS here FROM {p}b
 UNION ALL SELECT video_id, f, hi, list_concat(list_concat(list_transform(pairs, lambda p: {now('p.j')}), lost), list_transform(list_filter(range(1, len(boxes) + 1), lambda j: {_unpaired('j', 'j')}), lambda j: {now('j')})),
  list_reduce(list_concat([boxes], list_transform(lost, lambda m: [{_box('m')}])), lambda a, x: CASE WHEN {clash} THEN a ELSE list_concat(a, x) END)
 FROM (SELECT *, {lost} AS lost FROM (SELECT *, {_greedy('cand')} AS pairs FROM (SELECT *, {_candidates('tracks', 'boxes', 'f - tracks[i].seen', cfg, cfg.growth_carry)} AS cand FROM (
  SELECT r.video_id, r.f + 1 AS f, r.hi, r.tracks, coalesce(q.boxes, {none})[]) AS boxes FROM {p}r r LEFT JOIN {t} q ON q.video_id = r.video_id AND q.frame_no = r.f + 1 WHERE r.f < r.hi))))),
{p} AS (SELECT video_id, f::INTEGER AS frame_no, {_sorted('here')} AS boxes FROM {p}r WHERE len(here) > 0)"""


def stabilize(p: str, t: str, cfg, width: int = 1920, height: int = 1080) -> str:
    a = min(1.0, max(0.0, cfg.smoothing_alpha))
    wide = f"greatest(greatest(0.0::DOUBLE, b.x2 - b.x1) + {_d(2.0 * cfg.pad_px)}, greatest(0.0::DOUBLE, b.x2 - b.x1) * {_d(1 + 2 * cfg.pad_ratio)}, {_d(float(cfg.min_width))})"
    high = f"greatest(greatest(0.0::DOUBLE, b.y2 - b.y1) + {_d(2.0 * cfg.pad_px)}, greatest(0.0::DOUBLE, b.y2 - b.y1) * {_d(1 + 2 * cfg.pad_ratio)}, {_d(float(cfg.min_height))})"
    cx, cy = _center("b")
    parts = ((cx, "-", wide, width), (cy, "-", high, height), (cx, "+", wide, width), (cy, "+", high, height))
    grown = "{" + ", ".join(f"'{n}': least(greatest(0.0::DOUBLE, {c} {sign} {size} / 2), {_d(float(top))})" for n, (c, sign, size, top) in zip(BOX, parts)) + "}"
    mate = "prev[list_filter(pairs, lambda p: p.j = j)[1].i]"
    smooth = "{" + ", ".join(f"'{n}': {mate}.{n} * {_d(1 - a)} + b.{n} * {_d(a)}" for n in BOX) + "}"
    return f"""{p}o AS (SELECT video_id, frame_no, list_transform(boxes, lambda b: {grown}) AS boxes, row_number() OVER (PARTITION BY video_id ORDER BY frame_no) AS n FROM {t}),
{p}r AS (SELECT video_id, n, frame_no, {_sorted('boxes')} AS made FROM {p}o WHERE n = 1
 UNION ALL SELECT video_id, n, frame_no, {_sorted(f"list_transform(boxes, lambda b, j: CASE WHEN {_unpaired('j', 'j')} THEN b ELSE {smooth} END)")}
 FROM (SELECT *, {_greedy('cand')} AS pairs FROM (SELECT q.video_id, q.n, q.frame_no, q.boxes, r.made AS prev, {_candidates('r.made', 'q.boxes', '1', cfg, 0.0)} AS cand FROM {p}r r JOIN {p}o q ON q.video_id = r.video_id AND q.n = r.n + 1))),
{p} AS (SELECT video_id, frame_no, made AS boxes FROM {p}r)"""


def rows(t: str) -> str:
    """A table of lists as rows, rounded to 6 digits (halves up)."""
    columns = ", ".join(f"floor(boxes[k].{n} * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE AS {n}" for n in BOX)
    return f"SELECT video_id, frame_no, (k - 1)::INTEGER AS box_idx, {columns} FROM (SELECT *, unnest(range(1, len(boxes) + 1)) AS k FROM {t})"
