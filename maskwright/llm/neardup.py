"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors are normalised; each hash table quantises a number of random Gaussian projections,
floor((a.x + b) / WIDTH), and vectors whose quantised projections all agree share a bucket. Within
buckets every pair is checked by its exact cosine in double precision. For unit vectors a cosine
of c is a distance of sqrt(2 - 2c), from which the chance p1 that one projection agrees follows;
p2 is the same for unrelated (orthogonal) vectors. The number of projections grows with the logarithm of
the number of vectors, so that unrelated vectors seldom meet, and the number of tables is such
that a pair at the threshold itself is found with the probability RECALL (closer ones with a
higher one).

Equal vectors are one class with a multiplicity. A bucket of more than BLOCK classes is cut into
blocks, and each pair of blocks is a group of its own, so a common vector's neighbourhood is dealt
over many tasks. No pairs are emitted from them: a group adds up links and gives a spanning
forest. A pair that meets in several tables counts in the first one only.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, as do
vectors of different lengths. An empty table gives no rows. Repeated rows are vectors of their
own, equal ones. Further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import components, cut, mix

THRESHOLD = 0.9
RECALL = 0.97
WIDTH = 2.5
BLOCK = 1024
SMALL = 48
SEED = 11


def agree(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised projection of two vectors at this distance agrees."""
    if distance <= 0:
        return 1.0
    r = width / distance
    return 1 - 2 * 0.5 * math.erfc(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def parameters(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Projections per table and number of tables for n vectors."""
    p1, p2 = agree(math.sqrt(2 - 2 * threshold)), agree(math.sqrt(2))
    m = max(4, math.ceil(math.log(4 * max(n, 2)) / -math.log(p2)))
    return m, math.ceil(math.log(1 - recall) / math.log(1 - p1**m))


class Hasher:
    """Bucket keys of unit vectors for every table."""

    def __init__(self, dim: int, m: int, tables: int, seed: int = SEED):
        rng = np.random.default_rng([seed, dim, m, tables])
        self.m, self.tables = m, tables
        self.a = rng.normal(size=(dim, m * tables))
        self.b = rng.uniform(0, WIDTH, m * tables)
        self.salt = rng.integers(1, 2**63, (1, tables, m), dtype=np.uint64) | np.uint64(1)
        self.table = mix(np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(dim))

    def keys(self, x: np.ndarray) -> np.ndarray:
        """One 64-bit key per vector and table."""
        q = np.floor((x @ self.a + self.b) / WIDTH).astype(np.int64).astype(np.uint64)
        h = (mix(q.reshape(len(x), self.tables, self.m) * np.uint64(0xD6E8FEB86659FD93)) * self.salt).sum(2, dtype=np.uint64)
        return mix(h + self.table)


_hashers: dict[tuple, Hasher] = {}


def hasher(dim: int, m: int, tables: int) -> Hasher:
    if (dim, m, tables) not in _hashers:
        _hashers[dim, m, tables] = Hasher(dim, m, tables)
    return _hashers[dim, m, tables]


def unit(raw: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: which vectors have it, and them as unit vectors."""
    by: dict[int, list[int]] = {}
    for i, r in enumerate(raw):
        by.setdefault(len(r), []).append(i)
    out = {}
    for size, at in by.items():
        x = np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), size // 8)
        x = x / np.abs(x).max(1, keepdims=True)  # so that no square over- or underflows
        out[size // 8] = np.array(at), x / np.linalg.norm(x, axis=1, keepdims=True)
    return out


def usable(column) -> list[bytes | None]:
    """The vectors' bytes as doubles, or None for those that can't link."""
    out = []
    for v in column:
        x = None
        if v.is_valid and len(v) and v.values.null_count == 0:
            x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64) + 0.0  # -0.0 is 0.0
            x = x.tobytes() if np.isfinite(x).all() and x.any() else None
        out.append(x)
    return out


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector."""

    def prepare(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(usable(batch.column(1)), pa.binary())], ["vec_id", "vec"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec")).mapInArrow(prepare, "vec_id long, vec binary")
    rows = cut(rows.select("vec_id", "vec", F.md5("vec").alias("digest")))
    classes = cut(rows.filter("vec IS NOT NULL").groupBy("digest").agg(F.min("vec_id").alias("id"), F.count("*").alias("times"), F.first("vec").alias("vec")))
    m, tables = parameters(classes.count(), threshold, recall)

    def bucket(batches):
        for batch in batches:
            raw = batch.column(1).to_pylist()
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for dim, (at, x) in unit(raw).items():
                for k in range(0, len(at), 256):
                    keys = hasher(dim, m, tables).keys(x[k : k + 256])
                    who = np.repeat(ids[at[k : k + 256]], tables)
                    table = np.tile(np.arange(tables, dtype=np.int32), len(keys))
                    yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(who), pa.array(table)], ["key", "id", "tab"])

    keys = cut(classes.select("id", "vec").mapInArrow(bucket, "key long, id long, tab int"))
    # a table of its own, so that Spark can split the join at hot buckets
    full = cut(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    parts = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("id", "key"), F.col("parts")).cast("int")
    members = keys.join(full, "key").withColumn("parts", parts).withColumn("own", own)
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    members = members.select("key", "tab", "id", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    grouped = members.join(classes.select("id", "vec", "times"), "id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id")
    grouped = grouped.select("key", "i", "j", "id", "tab", "own", "vec", "times")

    def links(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            t = t.combine_chunks()
            k, i, j = (t.column(c).to_numpy() for c in ("key", "i", "j"))
            new = np.flatnonzero((k[1:] != k[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            end = int(new[-1]) if len(new) else 0  # the last group may go on
            held = t.slice(end)
            if end:
                yield from _links(t.slice(0, end), m, tables, threshold)
        if held is not None and held.num_rows:
            yield from _links(held, m, tables, threshold)

    found = cut(grouped.mapInArrow(links, "a long, b long, n long"))
    counts = found.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    comp = components(found.filter("b IS NOT NULL").select("a", "b"))
    per_class = (
        classes.select("digest", "id", "times")
        .join(counts.select(F.col("a").alias("id"), "n"), "id", "left")
        .join(comp, "id", "left")
        .select(F.col("digest").alias("c_digest"), (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    out = rows.select("vec_id", "digest").join(per_class, F.col("digest") == F.col("c_digest"), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _links(t: pa.Table, m: int, tables: int, threshold: float):
    """Link counts (a, null, n) and joining edges (a, b, null) of whole groups."""
    ids, tab, own, times = (t.column(c).to_numpy() for c in ("id", "tab", "own", "times"))
    k, bi, bj = (t.column(c).to_numpy() for c in ("key", "i", "j"))
    raw = t.column("vec").to_pylist()
    starts = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]) | (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])) + 1, [len(ids)]])
    sizes = np.diff(starts)
    group = np.repeat(np.arange(len(sizes)), sizes)
    adds: list[tuple[np.ndarray, np.ndarray]] = []
    edges: list[tuple[np.ndarray, np.ndarray]] = []

    def first_only(p, q, keys, index):
        """Of pairs (rows p, q) those that share no bucket in an earlier table."""
        keep = np.ones(len(p), bool)
        for a in range(0, len(p), 20_000):
            x, y = p[a : a + 20_000], q[a : a + 20_000]
            same = keys[index[x]] == keys[index[y]]
            keep[a : a + 20_000] = same.argmax(1) == tab[x]
        return keep

    for dim, (at, x) in unit(raw).items():
        where = np.full(len(ids), -1)
        where[at] = np.arange(len(at))
        # small groups: the rows at distance s within a group, for all groups at once
        small = at[sizes[group[at]] <= SMALL]
        if len(small):
            keys, index = None, None
            g = group[small]
            for s in range(1, SMALL):
                pair = np.flatnonzero(g[s:] == g[:-s])
                if len(pair) == 0:
                    break
                p, q = small[pair], small[pair + s]
                cos = np.einsum("ij,ij->i", x[where[p]], x[where[q]])
                # a pair of a block with itself is met in the group (i, i), not in (i, j)
                ok = (cos >= threshold) & ((own[p] != own[q]) | (bi[p] == bj[p]))
                p, q = p[ok], q[ok]
                if len(p):
                    if keys is None:
                        keys, index = hasher(dim, m, tables), where
                        keys = _all_keys(keys, x)
                    ok = first_only(p, q, keys, index)
                    p, q = p[ok], q[ok]
                    adds += [(ids[p], times[q]), (ids[q], times[p])]
                    edges.append((ids[p], ids[q]))
        for n in np.flatnonzero(sizes > SMALL):
            rows = np.arange(starts[n], starts[n + 1])
            rows = rows[where[rows] >= 0]
            if len(rows) < 2:
                continue
            v = x[where[rows]]
            near = v @ v.T >= threshold
            if bi[rows[0]] != bj[rows[0]]:
                near &= own[rows][:, None] != own[rows][None, :]
            label = np.arange(len(rows))
            np.fill_diagonal(near, True)
            while True:  # the least row reachable
                new = np.where(near, label[None, :], len(rows)).min(1)
                new = new[new]
                if (new == label).all():
                    break
                label = new
            edges.append((ids[rows], ids[rows[label]]))
            p, q = np.nonzero(np.triu(near, 1))
            if len(p):
                keys = _all_keys(hasher(dim, m, tables), v)
                keep = np.ones(len(p), bool)
                for a in range(0, len(p), 20_000):
                    same = keys[p[a : a + 20_000]] == keys[q[a : a + 20_000]]
                    keep[a : a + 20_000] = same.argmax(1) == tab[rows[0]]
                p, q = rows[p[keep]], rows[q[keep]]
                adds += [(ids[p], times[q]), (ids[q], times[p])]
    if adds:
        who, inverse = np.unique(np.concatenate([a for a, _ in adds]), return_inverse=True)
        n = np.bincount(inverse, np.concatenate([b for _, b in adds])).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(who), pa.nulls(len(who), pa.int64()), pa.array(n)], ["a", "b", "n"])
    if edges:
        e = np.unique(np.stack([np.concatenate([a for a, _ in edges]), np.concatenate([b for _, b in edges])]), axis=1)
        e = e[:, e[0] != e[1]]
        yield pa.RecordBatch.from_arrays([pa.array(e[0]), pa.array(e[1]), pa.nulls(e.shape[1], pa.int64())], ["a", "b", "n"])


def _all_keys(h: Hasher, x: np.ndarray) -> np.ndarray:
    return np.concatenate([h.keys(x[k : k + 256]) for k in range(0, len(x), 256)])
