"""Names, paths and small conversions as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File extensions of videos, per step.
EXTENSIONS = (".mp4", ".avi", ".mov", ".mkv", ".wmv", ".flv", ".m4v")
EXTENSIONS_SHORT = (".mp4", ".mov", ".avi", ".mkv", ".m4v")
MASKED_MARK = "_time_location_masked"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    """Last extension with its dot, lowered; empty for none and for names that begin with their only dot."""
    return F.lower(F.regexp_extract(file_name(path), r"^.+?(\.[^.]*)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def is_video(path: Column, extensions=EXTENSIONS) -> Column:
    return extension(path).isin(*extensions)


def is_already_masked(path: Column) -> Column:
    return F.lower(stem(path)).contains(MASKED_MARK)


def natural_key(s: Column) -> Column:
    """Array that orders strings naturally: digit runs by value, the rest as it is."""
    return F.transform(F.regexp_extract_all(s, F.lit(r"\d+|\D+"), F.lit(0)), lambda t: F.when(t.rlike(r"^\d"), F.lpad(t, 20, "0")).otherwise(t))


def normalize(name: Column) -> Column:
    """Stem without anything but letters and digits, lowered (Unicode)."""
    return F.regexp_replace(F.lower(stem(name)), r"(?U)[\W_]+", "")


def number_prefix(s: Column) -> Column:
    """Leading digits, null for none."""
    found = F.regexp_extract(s, r"^(\d+)", 1)
    return F.when(found != "", found)


def common_substring(a: Column, b: Column) -> Column:
    """Length of the longest common substring.

    One pass over the ends of substrings of a: the longest that ends at j is at most one longer
    than the best so far, so one search in b per letter decides.
    """
    ends = F.when(F.length(a) > 0, F.sequence(F.lit(1), F.length(a))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(ends, F.lit(0), lambda best, j: F.when(F.contains(b, F.substring(a, j - best, best + 1)), best + 1).otherwise(best))


def input_tag(name: Column) -> Column:
    """Tag of an input folder's name."""
    cut = F.when(F.lower(name).startswith("videos"), F.regexp_replace(F.substring(name, 7, 1 << 30), r"^[_\- ]+", "")).otherwise(name)
    kept = F.when(cut == "", name).otherwise(cut)
    return F.lower(F.regexp_replace(F.regexp_replace(kept, "[^0-9A-Za-z]+", "_"), "^_+|_+$", ""))


def output_tag(name: Column, explicit: Column, smoke: Column) -> Column:
    tag = input_tag(name)
    automatic = F.when(tag != "", F.concat(F.lit("_"), tag)).otherwise(F.lit(""))
    return F.when(F.coalesce(explicit, F.lit("")) != "", F.concat(F.lit("_"), explicit)).when(smoke, F.concat(automatic, F.lit("_smoke"))).otherwise(automatic)


def batch_size(imgsz: Column, explicit: Column | None = None) -> Column:
    by_size = F.when(imgsz >= 5120, 2).when(imgsz >= 3840, 3).when(imgsz >= 2560, 4).when(imgsz >= 1920, 8).otherwise(16)
    return by_size if explicit is None else F.when(explicit.isNull(), by_size).otherwise(F.greatest(F.lit(1), explicit))


def frame_number(path: Column) -> Column:
    """Last part of the stem after an underscore, as int; null if it isn't one."""
    return F.element_at(F.split(stem(path), "_"), -1).try_cast("int")


def video_of_label(path: Column) -> Column:
    """Stem of a label file without the frame number: the exact video id."""
    return F.regexp_replace(stem(path), "_[^_]*$", "")


def frame_rate(fraction: Column) -> Column:
    """Frames per second from a fraction like 30000/1001; null if it can't be read or isn't positive."""
    parts = F.split(fraction, "/")
    top, below = F.get(parts, F.lit(0)).try_cast("double"), F.coalesce(F.get(parts, F.lit(1)), F.lit("1")).try_cast("double")
    rate = F.when(below != 0, top / F.when(below != 0, below))
    return F.when(rate > 0, rate)


def frame_count(nb_frames: Column, duration: Column, fps: Column, decoder: Column) -> Column:
    """Best estimate of a video's frames: probed, from its duration, from the decoder, or 1."""
    return F.coalesce(
        F.when(nb_frames > 0, nb_frames),
        F.when((duration > 0) & (fps > 0), F.greatest(F.lit(1), F.rint(duration * fps).cast("long"))),
        F.when(decoder > 0, decoder),
        F.lit(1).cast("long"),
    )


def id_list(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, ","), lambda x: F.trim(x) != ""), lambda x: F.trim(x).cast("int"))


def step_folder(step: int, tag: str) -> str:
    return {1: "step1_plate", 2: "step2_truck", 3: "step3_osd", 4: "step4_face"}[step] + tag
