"""What the two text models share: folds, hashed words, scoring over whole tables; and the bounded fit of the toxicity model."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import _LOWER, mix, prefix_hash, release, span_hash, text_bytes, word_spans

#: Bytes of text that are worked on at once.
CHUNK = 1_500_000
#: Labelled texts of more bytes are not fitted on, which bounds what meets in one task.
FIT_BYTES = 200_000


def fold(id_col, modulus: int):
    """crc32 of the id as text, modulo the given number."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(modulus))


def fit_on_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, limit: int, fit):
    """fit(rows, rate) on at most `limit` labelled documents outside the held-out fold, half of them of each label if there are enough.

    The choice is by a hash of the id, so it is the same on every run. Its size is bounded by the
    parameter and FIT_BYTES, so it may be broadcast and meet in one task, where the model is fitted; only the
    model comes to the driver. rows are (text, label, lang) by id; repeated labels and rows of an id count
    once, by the least text. rate is that of label 1 among all labels outside the fold.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), modulus) != held_out)).groupBy("doc_id").agg(F.max(label).alias("y"))
    key = F.xxhash64("doc_id", F.lit(label))
    half = limit // 2
    parts = [known.filter(F.col("y") == y).orderBy(key, "doc_id").limit(half) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    rate = known.agg(F.avg(F.col("y").cast("double"))).first()[0] or 0.0

    def run(batches):
        rows = []
        for batch in batches:
            rows += zip(*(batch.column(i).to_pylist() for i in range(4)))
        rows.sort(key=lambda r: (r[0], r[1] or ""))
        model = fit([(text or "", int(y), lang) for _, text, y, lang in rows], rate)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])
        del rows, model
        release()

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    known = docs.select("doc_id", "text", lang.alias("lang")).filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= FIT_BYTES)
    sample = known.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "y", "lang")).alias("r")).select("doc_id", "r.text", F.col("r.y").cast("int").alias("y"), "r.lang")
    found = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(bytes(found[0][0])) if found else fit([], rate)


def chunks(column):
    """(first row, bytes, offsets) of a few texts of an Arrow column at a time; texts stay whole."""
    k, n = 0, len(column)
    while k < n:
        size, top = 0, k
        while top < n and (top == k or size < CHUNK):
            size += len(column[top].as_buffer()) if column[top].is_valid else 0
            top += 1
        yield (k, *text_bytes(column[k:top]))
        k = top


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of all words (A-Z as a-z), and where each text's words begin."""
    starts, ends, first = word_spans(data, offsets)
    return span_hash(prefix_hash(data, _LOWER), starts, ends), starts, ends, first


def score_table(docs: DataFrame, score, modulus: int, held_out: int, threshold: float, column: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted; score(Arrow column) gives a number from 0 to 1 per text, or per value of the given column."""

    def run(batches):
        for batch in batches:
            s = np.asarray(score(batch.column(1)), float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], ["doc_id", "score", "predicted"])
        release()

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), column).mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), modulus) == held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def as_column(texts) -> pa.Array:
    return pa.array(list(texts), pa.string())
