"""Mixing sources to target weights by systematic sampling; DataFrame functions only.

Every source gets a target number of words: its weight's share of all words, but at most
``cap`` times its own words, the excess going to the other sources by weight. A document is
expected ``target / source_size`` times. Documents are laid on a line in a fixed order, each as
long as its expected copies; one random offset is added and a document is emitted once for each
integer boundary that its piece crosses.

A document of more than 1 / LARGE of its source's words would move the words taken by too much, so
these documents (fewer than LARGE in a source) are laid on a line of their own first; the others'
rate is then what is left of the target by what is left of the words, from 0 to ``cap``. So a source's
words miss the target by about the largest of the other documents, 1 / LARGE of its words, unless the large ones
alone miss by more than the others can make up for.

The order within a source goes by size class first, so that documents of like size share the
boundaries and the words taken come near the target, then by the md5 of the id. The position on
the line is the rank times the expected copies, as these are equal on a line. The rank
comes from counts of small groups (source, size class, md5 prefix), so a source of any size is
dealt over many tasks.

Nulls: a null text has size 0; a null source is a source of its own, the last. Empty tables give
no rows. Repeated rows count as rows of their own. Columns other than the id, text and source
are ignored by mix_plan() and kept by mix_documents().
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskwright.llm.common import cut

WORD = r"[^\x20\x09-\x0D]+"
#: Weights that the sources, in order, take in turn.
WEIGHTS = (1, 2, 3)
CAP = 3
SEED = 7
#: Documents of more than this part of their source's words are dealt first.
LARGE = 100
#: Rows that one rank group should have at most, on average.
GROUP_ROWS = 2000
#: Up to this many sources their table is broadcast.
BROADCAST_SOURCES = 20_000


def offset(seed: int = SEED) -> float:
    """The run's one random offset, in [0, 1)."""
    return round(random.Random(seed).random(), 9)


def size_class() -> Column:
    """Size classes of about a quarter of a power of two: the number of binary digits and the two after the first."""
    digits = F.bin(F.col("mix_size"))
    return F.concat(F.lpad(F.length(digits).cast("string"), 2, "0"), F.rpad(F.substring(digits, 2, 2), 2, "0"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """sizes(mix_source, source_size, source_docs) with each source's target.

    The sources are filled by weight until each reaches its cap: in ascending order of
    cap * size / weight, the first source whose ratio is not below the level that the words and
    weights left over give decides the level. Windows here are over one row per source.
    """
    order = [F.col("mix_source").isNull(), F.col("mix_source")]
    ws = F.array(*[F.lit(int(w)) for w in weights])
    everything = Window.partitionBy()
    ranked = sizes.withColumn("mix_weight", F.element_at(ws, ((F.row_number().over(Window.orderBy(*order)) - 1) % len(weights) + 1).cast("int")))
    by_ratio = Window.orderBy(F.col("mix_ratio"), *order)
    filled = (
        ranked.withColumn("mix_ratio", (cap * F.col("source_size")).cast("double") / F.col("mix_weight").cast("double"))
        .withColumn("mix_capped", F.sum(cap * F.col("source_size")).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("mix_open", F.sum("mix_weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("mix_total", F.sum("source_size").over(everything))
        .withColumn("mix_level", (F.col("mix_total") - F.coalesce("mix_capped", F.lit(0))).cast("double") / F.col("mix_open").cast("double"))
        .withColumn("mix_level", F.min(F.when(F.col("mix_level") <= F.col("mix_ratio"), F.struct("mix_ratio", "mix_level"))).over(everything)["mix_level"])
    )
    most = (cap * F.col("source_size")).cast("double")
    return filled.select("mix_source", "source_size", F.least(most, F.coalesce(F.col("mix_level") * F.col("mix_weight"), most)).alias("target"))


def mix_plan(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, cap=CAP, seed=SEED) -> DataFrame:
    """One row per document: id, mix_source, size, source_size, target, copies."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col), F.col(source_col).alias("mix_source"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("mix_size"))
    # one pass over the texts; what follows reads ids and sizes
    base = cut(base.withColumn("mix_class", size_class()).withColumn("mix_key", F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))))
    sizes = base.groupBy("mix_source").agg(F.sum("mix_size").alias("source_size"), F.count("*").alias("source_docs"))
    total, n_sources = sizes.agg(F.coalesce(F.sum("source_docs"), F.lit(0)), F.count("*")).first()
    targets = source_targets(sizes, weights, cap)
    t = targets.select(F.col("mix_source").alias("t_source"), "source_size", "target")
    if n_sources <= BROADCAST_SOURCES:
        t = F.broadcast(t)
    base = base.join(t, F.col("mix_source").eqNullSafe(F.col("t_source"))).drop("t_source")
    u = F.lit(offset(seed))
    crossed = lambda rank, r: (F.floor(F.col(rank) * F.col(r) + u) - F.floor((F.col(rank) - 1) * F.col(r) + u)).cast("long")

    # the large documents, fewer than LARGE of each source
    large = F.col("mix_size") * LARGE > F.col("source_size")
    by_size = Window.partitionBy("mix_source").orderBy(F.desc("mix_size"), "mix_key", id_col)
    r = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    first = base.filter(large).withColumns({"mix_r": r, "mix_rank": F.row_number().over(by_size)}).withColumn("copies", crossed("mix_rank", "mix_r"))
    first = cut(first.select(id_col, "mix_source", "mix_size", "source_size", "target", "copies"))
    taken = first.groupBy(F.col("mix_source").alias("f_source")).agg(F.sum(F.col("copies") * F.col("mix_size")).alias("mix_taken"), F.sum("mix_size").alias("mix_large"))
    if n_sources <= BROADCAST_SOURCES:
        taken = F.broadcast(taken)
    rest = base.filter(~large).join(taken, F.col("mix_source").eqNullSafe(F.col("f_source")), "left").drop("f_source")
    words = F.col("source_size") - F.coalesce("mix_large", F.lit(0))
    left = (F.col("target") - F.coalesce("mix_taken", F.lit(0)).cast("double")) / words.cast("double")
    rest = rest.withColumn("mix_r", F.when(words > 0, F.least(F.greatest(left, F.lit(0.0)), F.lit(float(cap)))).otherwise(r))

    digits = max(1, math.ceil(math.log(max(total / GROUP_ROWS, 1), 16)))
    group = ["mix_source", "mix_class", "mix_head"]
    rest = rest.withColumn("mix_head", F.substring("mix_key", 1, digits))
    within = Window.partitionBy(*group).orderBy("mix_key", id_col, "mix_size")
    ranked = rest.withColumn("mix_rank", F.row_number().over(within))
    # ranks of the groups: first over the classes of a source, then over the heads of a class
    heads = rest.groupBy(*group).agg(F.count("*").alias("mix_n"))
    classes = heads.groupBy("mix_source", "mix_class").agg(F.sum("mix_n").alias("mix_class_n"))
    classes = classes.withColumn("mix_class_before", F.coalesce(F.sum("mix_class_n").over(Window.partitionBy("mix_source").orderBy("mix_class").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    heads = heads.withColumn("mix_head_before", F.coalesce(F.sum("mix_n").over(Window.partitionBy("mix_source", "mix_class").orderBy("mix_head").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    a, b = heads.alias("a"), classes.alias("b")
    starts = a.join(b, F.col("a.mix_source").eqNullSafe(F.col("b.mix_source")) & (F.col("a.mix_class") == F.col("b.mix_class"))).select(
        F.col("a.mix_source").alias("s_source"), F.col("a.mix_class").alias("s_class"), F.col("a.mix_head").alias("s_head"), (F.col("mix_head_before") + F.col("mix_class_before")).alias("mix_before")
    )
    others = (
        ranked.join(starts, F.col("mix_source").eqNullSafe(F.col("s_source")) & (F.col("mix_class") == F.col("s_class")) & (F.col("mix_head") == F.col("s_head")))
        .withColumn("mix_rank", F.col("mix_rank") + F.col("mix_before"))
        .withColumn("copies", crossed("mix_rank", "mix_r"))
    )
    columns = [id_col, "mix_source", F.col("mix_size").alias("size"), "source_size", "target", "copies"]
    return first.select(*columns).unionByName(others.select(*columns))


def mix_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: every document as often as the plan says, with its columns, whatever their names.

    Rows of equal id, source and size are interchangeable in the plan, so their copies are summed
    before the join and dealt out again by row number.
    """
    def keyed(df, doc_id, source, size):
        return df.withColumns({
            "mix_k1": F.coalesce(doc_id.cast("string"), F.lit("")),
            "mix_k2": F.concat(F.when(source.isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce(source, F.lit(""))),
            "mix_k3": size,
        })

    keys = ["mix_k1", "mix_k2", "mix_k3"]
    plan = keyed(mix_plan(docs, seed=seed), F.col("doc_id"), F.col("mix_source"), F.col("size")).groupBy(*keys).agg(F.sum("copies").alias("mix_copies"), F.count("*").alias("mix_rows"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mix_row"))
    text = F.col("mix_row.text")
    rows = keyed(rows, F.col("mix_row.doc_id"), F.col("mix_row.source"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"))
    joined = rows.join(plan.filter("mix_copies > 0"), keys)
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(text))
    each = F.floor(F.col("mix_copies") / F.col("mix_rows")) + F.when(turn <= F.col("mix_copies") % F.col("mix_rows"), 1).otherwise(0)
    copies = joined.withColumn("mix_each", each.cast("int")).filter("mix_each > 0")
    return copies.select("mix_row", F.explode(F.array_repeat(F.lit(0), F.col("mix_each"))).alias("mix_i")).select("mix_row.*")
