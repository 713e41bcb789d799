"""Matching of videos to camera templates: by name, by fuzzy name and by image."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskwright.functions import names as N

#: Template tables are small reference data; they're broadcast up to this many rows and hash-joined beyond.
BROADCAST_ROWS = 10_000


def small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def substrings(text: Column, least: int) -> Column:
    """The distinct substrings of at least `least` characters."""
    n = F.length(text)
    starts = F.when(n >= least, F.sequence(F.lit(1), n - least + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(least), n - i + 1), lambda k: F.substring(text, i, k)))))


def fuzzy_keys(videos: DataFrame, mapping: DataFrame, least: int = 3) -> DataFrame:
    """(video_id, fuzzy_id, score): the camera of the key that shares the longest substring with the name.

    Ties for the best score match nothing, even if both keys name the same camera. Names are
    normalised and looked up once per distinct name: the keys' substrings are counted first, so a
    substring that many keys have is one row, and names meet them by equality; names and keys are
    never paired.
    """
    keys = mapping.select(N.normalize(F.col("key")).alias("norm"), "camera_id").filter("norm <> '' AND NOT norm RLIKE '^[0-9]+$'")
    named = videos.select("video_id", N.normalize(F.col("path")).alias("name")).filter("name <> ''")
    parts = keys.withColumn("part", F.explode(substrings(F.col("norm"), least)))
    parts = parts.groupBy("part").agg(F.count("*").alias("n"), F.max("norm").alias("norm"), F.max("camera_id").alias("camera_id"))
    asked = named.select("name").distinct().withColumn("part", F.explode(substrings(F.col("name"), least)))
    # of the longest shared substrings, all must be of one key only
    by_length = asked.join(parts, "part").groupBy("name", F.length("part").alias("score"))
    by_length = by_length.agg(F.max("n").alias("n"), F.min("norm").alias("lo"), F.max("norm").alias("hi"), F.max("camera_id").alias("camera_id"))
    best = by_length.groupBy("name").agg(F.max(F.struct("score", "n", "lo", "hi", "camera_id")).alias("b")).filter("b.n = 1 AND b.lo = b.hi")
    return named.join(best.select("name", F.col("b.camera_id").alias("fuzzy_id"), F.col("b.score").alias("score")), "name").drop("name")


def exact_match(videos: DataFrame, cameras: DataFrame, mapping: DataFrame, least: int = 3) -> DataFrame:
    """video_id, camera_id, method. A mapped name is final even if its camera is unknown; a fuzzy hit on
    an unknown camera falls through to the stem and the number prefix."""
    known = small(cameras.select("camera_id").distinct())
    keys = small(mapping.groupBy("key").agg(F.max("camera_id").alias("mapped")))
    v = videos.select("video_id", "path", N.file_name(F.col("path")).alias("name"), N.stem(F.col("path")).alias("stem"))
    v = v.join(keys.withColumnRenamed("mapped", "m1"), v["name"] == F.col("key"), "left").drop("key")
    v = v.join(keys.withColumnRenamed("mapped", "m2"), v["stem"] == F.col("key"), "left").drop("key")
    v = v.withColumn("mapped", F.coalesce("m1", "m2")).drop("m1", "m2")
    final = v.filter("mapped IS NOT NULL").join(known.withColumnRenamed("camera_id", "c"), F.col("mapped") == F.col("c"), "left").select("video_id", F.col("c").alias("camera_id"), F.lit("mapping").alias("method"))
    rest = v.filter("mapped IS NULL")
    fuzzy = fuzzy_keys(rest, mapping, least).select("video_id", "fuzzy_id")
    rest = rest.join(fuzzy, "video_id", "left").withColumn("prefix", N.number_prefix(F.col("stem")))
    for column, name in (("fuzzy_id", "c1"), ("stem", "c2"), ("prefix", "c3")):
        rest = rest.join(known.withColumnRenamed("camera_id", name), F.col(column) == F.col(name), "left")
    method = F.when(F.col("c1").isNotNull(), "fuzzy").when(F.col("c2").isNotNull(), "stem").when(F.col("c3").isNotNull(), "prefix").otherwise("none")
    rest = rest.select("video_id", F.coalesce("c1", "c2", "c3").alias("camera_id"), method.alias("method"))
    return final.withColumn("method", F.when(F.col("camera_id").isNull(), "none").otherwise(F.col("method"))).unionByName(rest)


def candidates(videos: DataFrame, cameras: DataFrame) -> DataFrame:
    """Cameras of a video's size, or all cameras for a video whose size none has."""
    cams = small(cameras)
    sized = videos.join(cams, (videos["width"] == cams["image_width"]) & (videos["height"] == cams["image_height"]))
    other = videos.join(small(cameras.select("image_width", "image_height").distinct()), (F.col("width") == F.col("image_width")) & (F.col("height") == F.col("image_height")), "left_anti")
    return sized.unionByName(other.join(cams))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, not in every use within lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def centred(a: Column) -> Column:
    mean = F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)
    return let(mean, lambda m: F.transform(a, lambda x: x - m))


def ncc(a: Column, b: Column) -> Column:
    """Normalised cross-correlation of two images as arrays; 0 for a constant one."""
    return F.coalesce(dot(unit(a), unit(b)), F.lit(0.0))


def unit(a: Column) -> Column:
    """Centred image of norm 1 (null for a constant one), so that scores are plain dot products."""
    return let(centred(a), lambda c: let(F.sqrt(dot(c, c)), lambda n: F.when(n >= 1e-6, F.transform(c, lambda x: x / n))))


def top_with_margin(scores: DataFrame, order: str = "camera_id", runner_up: float = 0.0) -> DataFrame:
    """Best camera of each video with its lead over the second; ties keep the cameras' order."""
    w = Window.partitionBy("video_id").orderBy(F.desc("score"), order)
    ranked = scores.withColumns({"place": F.row_number().over(w), "second": F.lead("score", 1, runner_up).over(w)})
    return ranked.filter("place = 1").withColumn("margin", F.col("score") - F.col("second")).drop("place", "second")


def accept(best: DataFrame, least: float, margin: float) -> DataFrame:
    return best.filter((F.col("score") >= least) & (F.col("margin") >= margin))


def agree(a: DataFrame, b: DataFrame) -> DataFrame:
    """Videos for which two matchers name the same camera, with the lower score."""
    other = b.select("video_id", "camera_id", F.col("score").alias("score_b"))
    return a.join(other, ["video_id", "camera_id"]).select("video_id", "camera_id", F.least("score", "score_b").alias("score"))


def force_best(videos: DataFrame, fast: DataFrame, slow: DataFrame) -> DataFrame:
    """Best by the fast score, else the slow one, else 0.0; no threshold."""
    f = fast.select("video_id", F.col("camera_id").alias("fc"), F.col("score").alias("fs"))
    s = slow.select("video_id", F.col("camera_id").alias("sc"), F.col("score").alias("ss"))
    j = videos.select("video_id").join(f, "video_id", "left").join(s, "video_id", "left")
    return j.select("video_id", F.coalesce("fc", "sc").alias("camera_id"), F.coalesce("fs", "ss", F.lit(0.0)).alias("score"))


def cascade(videos: DataFrame, exact: DataFrame, fast, slow, forced) -> DataFrame:
    """(video_id, camera_id, method, score) of every video(video_id, masked), the first that applies:

    exact: its camera in exact(video_id, camera_id). agreed: it carries a mask already, and both image
    matchers name one camera. fast, ncc: it doesn't, and that matcher accepts a camera. forced: the
    best camera without a threshold, never for a masked video. none: nothing applies.
    fast(videos), slow(videos) and forced(videos) give the accepted best (video_id, camera_id, score) of
    the videos they're asked for, so each stage works on what is still open.
    """
    def stage(df, method):
        return df.select("video_id", "camera_id", F.lit(method).alias("method"), F.col("score").cast("double").alias("score"))

    def without(df, *done):
        for d in done:
            df = df.join(d.select("video_id"), "video_id", "left_anti")
        return df

    found = stage(exact.filter("camera_id IS NOT NULL").withColumn("score", F.lit(None)), "exact")
    rest = without(videos.select("video_id", "masked"), found)
    masked, open_ = rest.filter("masked"), rest.filter("NOT masked")
    agreed = stage(agree(fast(masked), slow(masked)), "agreed")
    quick = stage(fast(open_), "fast")
    open_ = without(open_, quick)
    ncc_ = stage(slow(open_), "ncc")
    open_ = without(open_, ncc_)
    best = stage(forced(open_), "forced")
    none = without(rest, agreed, quick, ncc_, best).select("video_id", F.lit(None).cast(exact.schema["camera_id"].dataType).alias("camera_id"), F.lit("none").alias("method"), F.lit(None).cast("double").alias("score"))
    out = found
    for part in (agreed, quick, ncc_, best, none):
        out = out.unionByName(part)
    return out


def area_mean(box_scores: DataFrame) -> DataFrame:
    """Scores of boxes averaged by their area."""
    return box_scores.groupBy("video_id", "camera_id").agg((F.sum(F.col("score") * F.col("area")) / F.sum("area")).alias("score"))


def method_text(name: str, score: Column, margin: Column) -> Column:
    return F.format_string(f"{name} score=%.4f margin=%.4f", score, margin)
