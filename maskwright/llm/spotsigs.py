"""Document fingerprints by SpotSigs; DataFrame functions only.

A spot signature is a common word (the anchor) with the chain of the next two content words after it,
the common words in between left out. A document's fingerprint is the set of its signatures;
natural-language passages have many, while lists and menus have few. Texts are lowered and the
punctuation in PUNCTUATION is removed before. A text without any signature has its distinct words
as its set instead, so that lists and short notes have a fingerprint too.

Sets are compared by Jaccard likeness, pruned by their lengths: with lengths a <= b the likeness
is at most a / b, so below the wanted likeness the sets needn't be looked at. near_pairs() deals
documents to partitions by set length, so that only neighbouring partitions meet.

Null and empty texts have the empty set; two empty sets have likeness 1. Equal texts, repeated
rows included, have equal fingerprints. Rows of equal id are ordered by text. An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to a in is that it for was on with as be by are this at from "
    "der die und den von zu das sich mit auf des für im ist dem nicht ein eine als "
    "de la le et les en un du une que pour est qui dans sur par au pas avec "
    "el y los las se del por con su una no para es al lo"
).split()
PUNCTUATION = ".,;:!?%&$*#|\"()[]{}<>"
#: Documents that a bucket of neighbouring ids should have, and up to how many buckets their table is broadcast.
BUCKET_ROWS = 1000
BROADCAST_BUCKETS = 100_000
QUANTILES = 64


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def signatures(text: Column) -> Column:
    """The sorted distinct 64-bit hashes of a text's spot signatures (or words, if it has none).

    The words are written out with a line end after each content word, so every line holds the
    common words before a content word and that word; each of them is an anchor of that word and
    the next line's. Common words after the last content word have no chain. Every step is linear
    in the text.
    """
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), PUNCTUATION, "")
    words = F.filter(F.split(plain, r"\s+"), lambda w: w != "")
    lines = F.split(F.array_join(F.transform(words, lambda w: F.concat(w, F.when(w.isin(*sorted(set(ANCHORS))), F.lit(" ")).otherwise(F.lit("\n")))), ""), "\n")

    def spots(line: Column, following: Column) -> Column:
        chain = F.concat(F.lit(" "), F.substring_index(line, " ", -1), F.lit(" "), F.substring_index(following, " ", -1))
        anchors = _let(F.split(line, " "), lambda a: F.slice(a, 1, F.size(a) - 1))
        return F.when((F.instr(line, " ") > 0) & following.isNotNull(), _let(chain, lambda c: F.transform(anchors, lambda a: F.xxhash64(F.concat(a, c))))).otherwise(F.array().cast("array<bigint>"))

    # what follows the last line end isn't a line
    whole = _let(lines, lambda x: F.slice(x, 1, F.size(x) - 1))
    found = _let(whole, lambda x: F.flatten(F.zip_with(x, F.slice(x, 2, F.greatest(F.size(x), F.lit(1))), spots)))
    return _let(found, lambda x: F.sort_array(F.array_distinct(F.when(F.size(x) > 0, x).otherwise(F.transform(words, lambda w: F.xxhash64(w))))))


def fingerprint(sigs: Column) -> Column:
    """Digest of a signature set: its length and an md5."""
    return F.concat(F.size(sigs).cast("string"), F.lit("-"), F.md5(F.array_join(F.transform(sigs, lambda x: x.cast("string")), ",")))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness of two sets, 0 where their lengths alone keep it below `least`."""
    low, high = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return (
        F.when(high == 0, F.lit(1.0))
        .when((low == 0) | (low.cast("double") < high.cast("double") * least), F.lit(0.0))
        .otherwise(both.cast("double") / (F.size(a) + F.size(b) - both).cast("double"))
    )


def id_buckets(docs: DataFrame, id_col: str, rows: int) -> Column:
    """Buckets of neighbouring ids, ascending, of about `rows` rows; ids of any distribution are cut at quantiles first."""
    n, low, high = docs.agg(F.count("*"), F.min(id_col), F.max(id_col)).first()
    if not n or low is None or low == high:
        return F.lit(0).cast("long")
    marks = sorted({int(x) for x in docs.approxQuantile(id_col, [i / QUANTILES for i in range(1, QUANTILES)], 0.002)} | {low})
    parts = max(1, round(n / len(marks) / rows))
    tops = marks[1:] + [high + 1]
    a, t = F.array(*[F.lit(int(x)).cast("long") for x in marks]), F.array(*[F.lit(int(x)).cast("long") for x in tops])
    k = F.greatest(F.size(F.filter(a, lambda x: x <= F.col(id_col))), F.lit(1))
    start, top = F.element_at(a, k), F.element_at(t, k)
    within = F.floor((F.col(id_col) - start).cast("double") * parts / F.greatest(top - start, F.lit(1)).cast("double"))
    return F.coalesce((k.cast("long") - 1) * parts + F.least(F.greatest(within, F.lit(0)), F.lit(parts - 1)), F.lit(-1).cast("long"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with the next one's text, by descending id; after the last comes the first.

    Ids are dealt to buckets of neighbours; a bucket's first document also goes to the bucket
    above it, as the next of its last one. So every text is shuffled once (a few twice), and no
    task sees more than its bucket. Columns: id, text, sigs, next_text, next_sigs.
    """
    base = docs.select(F.col(id_col).alias("ss_id"), F.coalesce(F.col(text_col), F.lit("")).alias("ss_text"))
    placed = base.withColumn("ss_bucket", id_buckets(base.select("ss_id"), "ss_id", BUCKET_ROWS))
    tops = placed.groupBy("ss_bucket").agg(F.max("ss_id").alias("ss_top"))
    up = Window.orderBy("ss_bucket")
    lowest = F.min("ss_bucket").over(Window.partitionBy())
    tops = tops.select(F.col("ss_bucket").alias("t_bucket"), "ss_top", F.coalesce(F.lead("ss_bucket").over(up), lowest).alias("ss_above"))
    from maskwright.llm.common import cut

    tops = cut(tops)
    if tops.count() <= BROADCAST_BUCKETS:
        tops = F.broadcast(tops)
    joined = placed.join(tops, F.col("ss_bucket") == F.col("t_bucket"), "left")
    own = F.struct(F.col("ss_bucket").alias("b"), F.lit(0).alias("f"))
    also = F.struct(F.col("ss_above").alias("b"), F.lit(1).alias("f"))
    sent = joined.withColumn("ss_to", F.explode(F.when(F.col("ss_id").eqNullSafe(F.col("ss_top")), F.array(own, also)).otherwise(F.array(own))))
    rows = sent.select(F.col("ss_to.b").alias("ss_b"), F.col("ss_to.f").alias("ss_f"), "ss_id", "ss_text").repartition("ss_b")
    rows = rows.withColumn("ss_sigs", signatures(F.col("ss_text")))
    w = Window.partitionBy("ss_b").orderBy("ss_f", F.col("ss_id").desc_nulls_last(), "ss_text")
    return (
        rows.withColumns({"ss_next_text": F.lead("ss_text").over(w), "ss_next_sigs": F.lead("ss_sigs").over(w)})
        .filter("ss_f = 0")
        .select(F.col("ss_id").alias(id_col), F.col("ss_text").alias("text"), F.col("ss_sigs").alias("sigs"), F.col("ss_next_text").alias("next_text"), F.col("ss_next_sigs").alias("next_sigs"))
    )


def edited(text: Column, following: Column) -> Column:
    """The text with its last half replaced by as much of the start of the following one."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness."""
    rows = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "sigs", "next_sigs", signatures(F.col("edited")).alias("edited_sigs"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("sigs")).alias("fingerprint"), fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        F.size("sigs").alias("n_signatures"),
    )


def near_pairs(docs: DataFrame, least: float = 0.75) -> DataFrame:
    """Pairs of fingerprints with a likeness of at least `least`, one row per pair of different sets.

    Rows (a, b, likeness) hold the smallest ids that have the two sets; class_members() lists the
    other ids. Sets are dealt to length partitions whose bounds grow by 1 / least, so partners lie
    in the same or the next one. Within them, sets meet on the signatures of their prefix by
    ascending frequency: of n signatures, partners share one of the rarest n - ceil(n * least) + 1.
    """
    sets = class_members(docs).groupBy("ss_fp").agg(F.min("doc_id").alias("id"), F.min_by("sigs", "doc_id").alias("sigs")).filter(F.size("sigs") > 0)
    freq = sets.select(F.explode("sigs").alias("sig")).groupBy("sig").count()
    rare = sets.select("id", F.explode("sigs").alias("sig")).join(freq, "sig").filter("count > 1")
    n = F.size("sigs")
    keep = n - F.ceil(n * F.lit(least)) + 1
    order = rare.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("count", "sig"))).alias("shared"))
    prefix = sets.join(order, "id").withColumn("alone", n - F.size("shared"))
    prefix = prefix.withColumn("head", F.slice("shared", 1, F.greatest(keep - F.col("alone"), F.lit(0)).cast("int"))).withColumn("part", F.floor(F.log(n.cast("double")) / F.log(F.lit(1 / least))))
    heads = prefix.select("id", "part", n.alias("n"), F.explode("head.sig").alias("sig"))
    one, two = heads, heads.select(F.col("id").alias("id2"), F.col("n").alias("n2"), "sig", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    pairs = one.join(two, ["part", "sig"]).filter((F.col("id") != F.col("id2")) & (F.least("n", "n2") >= F.greatest("n", "n2") * F.lit(least)))
    pairs = pairs.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()
    sides = sets.select("id", "sigs")
    found = pairs.join(sides.select(F.col("id").alias("a"), F.col("sigs").alias("sa")), "a").join(sides.select(F.col("id").alias("b"), F.col("sigs").alias("sb")), "b")
    return found.select("a", "b", likeness(F.col("sa"), F.col("sb"), least).alias("likeness")).filter(F.col("likeness") >= least)


def class_members(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and set of every document."""
    sigs = docs.select("doc_id", signatures(F.col("text")).alias("sigs"))
    return sigs.withColumn("ss_fp", fingerprint(F.col("sigs")))
