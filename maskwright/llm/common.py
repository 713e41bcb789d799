"""What the operators of this subpackage share: tables, lineage cuts, word and shingle hashes."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from maskwright.session import ship_package

#: Rows of one Arrow batch; whole texts can be long.
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tune(spark: SparkSession) -> None:
    """Send the code to the executors and keep Arrow batches of texts small; a batch size that the user chose stays."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) == 10000:
        spark.conf.set(key, str(ARROW_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; in local mode a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="mw-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it back: its lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/mw-{uuid.uuid4().hex}"
    df.write.parquet(path)
    tidy(spark)
    return spark.read.schema(df.schema).parquet(path)


#: Seconds between two calls of tidy() that do something.
TIDY_EVERY = 1.0
_tidied = 0.0


def tidy(spark: SparkSession) -> None:
    """Let the driver collect its garbage and give native memory back to the system.

    Shuffle files and broadcasts that nothing needs any more stay until the driver's JVM happens to
    collect its garbage, and what its many threads have freed stays with them: a job of hundreds of
    stages would fill disks and the driver's memory with them. Nothing is done while the driver's
    heap is below a quarter of what it may take.
    """
    global _tidied
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    heap = jvm.Runtime.getRuntime()
    if time.monotonic() - _tidied < TIDY_EVERY or heap.totalMemory() < heap.maxMemory() // 4:
        return
    gc.collect()
    jvm.System.gc()
    with contextlib.suppress(Exception):  # other JVMs have no such command
        call = next(m for m in jvm.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        args = gateway.new_array(jvm.Object, 4)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        call.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    release()
    _tidied = time.monotonic()


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a table that cut() wrote and nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/mw-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def release() -> None:
    """Give memory that a task has freed back to the system: Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no malloc_trim
        ctypes.CDLL("libc.so.6").malloc_trim(0)


# --- words and shingles, vectorised over the bytes of many texts -------------------------------

_RNG = np.random.default_rng(20240917)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)
_STEP = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0] = 1
        k = 1
        while k < size:
            have[k : 2 * k] = have[:k] * np.uint64(pow(base, k, 2**64))
            k *= 2
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit hash."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray, lut: np.ndarray = _BYTE) -> np.ndarray:
    """Prefix sums with which the hash of any span follows from two entries."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.multiply(lut[data], powers(_BASE, len(data)), out=out[1:])
    np.cumsum(out[1:], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((prefix[end] - prefix[start]) * powers(_BASE_INV, len(prefix))[start] + (end - start).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and for each text how many words come before it."""
    inside = ~_SPACE[data]
    prev, nxt = np.zeros(len(data), bool), np.zeros(len(data), bool)
    prev[1:], nxt[:-1] = inside[:-1], inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    prev[cuts] = False
    nxt[cuts - 1] = False
    starts = np.flatnonzero(inside & ~prev)
    ends = np.flatnonzero(inside & ~nxt) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the offsets of its texts; a null is an empty text."""
    texts = [x.as_buffer() if x.is_valid else b"" for x in column]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(memoryview(x)) for x in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def shingles(column, width: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word shingles.

    A-Z count as a-z. A text of fewer words is one shingle; a text without words has none.
    """
    out: list[np.ndarray] = []
    k, n = 0, len(column)
    while k < n:  # a few MB of text at a time
        size, top = 0, k
        while top < n and (top == k or size < 2_000_000):
            size += len(column[top].as_buffer()) if column[top].is_valid else 0
            top += 1
        data, offsets = text_bytes(column[k:top])
        starts, ends, first = word_spans(data, offsets)
        words = span_hash(prefix_hash(data, _LOWER), starts, ends)
        grams = np.zeros(len(words), np.uint64)
        for j in range(width):
            grams[: max(0, len(words) - j)] += words[j:] * np.uint64(int(_STEP[j % 5]) + 2 * (j // 5))
        grams = mix(grams + np.uint64(width))
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= width:
                out.append(np.unique(grams[a : b - width + 1]))
            elif b > a:
                short = np.array([b - a], np.uint64)
                for j in range(b - a):
                    short = mix(short + words[a + j : a + j + 1] * _STEP[j % 5])
                out.append(short)
            else:
                out.append(np.empty(0, np.uint64))
        k = top
    return out


# --- connected components ------------------------------------------------------------------------


#: Up to this many edges (16 bytes each) components are found in one task.
LOCAL_EDGES = 400_000


def components(edges: DataFrame, rounds: int = 60, local: int = LOCAL_EDGES) -> DataFrame:
    """Smallest id reachable from each id of edges(a, b): rows (id, component).

    So few edges that they surely fit a task's memory are united there. Any number beyond takes
    large-star and small-star steps in turn, each one aggregation on the node's id, so a hub costs
    a row per neighbour and nothing is gathered; every round's edges are written to the shared
    folder. Raises if they have not settled after the given rounds.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    kind = e.schema["u"].dataType
    if e.count() <= local:

        def unite(batches):
            root: dict = {}

            def find(x):
                top = x
                while root.setdefault(top, top) != top:
                    top = root[top]
                while root[x] != top:
                    root[x], x = top, root[x]
                return top

            for batch in batches:
                for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    u, v = find(u), find(v)
                    if u != v:
                        root[max(u, v)] = min(u, v)
            ids = list(root)
            kinds = to_arrow_type(kind)
            for k in range(0, len(ids), 50_000):
                part = ids[k : k + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, kinds), pa.array([find(x) for x in part], kinds)], ["id", "component"])

        return cut(e.coalesce(1).mapInArrow(unite, f"id {kind.simpleString()}, component {kind.simpleString()}"))
    before = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        # large star: neighbours above u point to u's least neighbour
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: neighbours not above u point to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))
        new = cut(large.join(least, "u").select(F.explode(pairs).alias("s")).select("s.u", "s.v").filter("u <> v").distinct())
        state = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_cut(e)
        e = new
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id").unionByName(roots)
