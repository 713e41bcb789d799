"""Removal of repeated passages by suffix sorting.

Every byte covered by a string of `length` bytes that also starts anywhere else goes. Texts are
UTF-8 bytes; matches never cross texts. The suffix arrays are built by two-stage sorting: only
suffixes smaller than their successors are sorted directly, the others are induced from them by
scanning the buckets of first bytes in order; then neighbours' common prefixes are taken.

So that suffixes needn't be sorted all together, each start of a string is assigned to an anchor,
the GRAM-byte string of least hash within it. Equal strings have equal anchors at equal places, so
only starts with the same anchor are sorted together, and a start whose anchor occurs nowhere else
needs no sorting. Consecutive starts of one anchor form a run, whose bytes travel once; of a run's
suffixes only those at its starts are sorted, and the few from which these are induced. Equal runs
are one run with a weight. A group of runs that is larger than BUFFER is cut into pieces of STEP
starts, grouped by the bytes that all strings of a piece have, and pieces of a group that's still
too large into single strings; so no group is too large for a task.

Two lengths can be asked for at once: anchors then go by the shorter one, and runs carry the bytes
that the longer one needs. repeat_digests() judges by LENGTH bytes and also tells how much of a
text is in passages that repeat (PASSAGE bytes, about 50 words); remove_repeats() takes out the latter.

Documents of one text are all copies of each other: of `length` bytes and more, all of it goes.

Null and empty texts have 0 bytes and nothing to remove. Texts of any length are handled whole.
Repeated rows are documents of equal text. Texts are told apart by their digests, so rows without an
id and different texts of one id are treated like all others. An empty table gives no rows. Further columns are
ignored (remove_repeats() keeps them, whatever their names).
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import _BASE_INV, cut, drop_cut, mix, powers, prefix_hash, release

LENGTH = 400
#: A passage of about 50 words: 50 times four letters and a space.
PASSAGE = 250
GRAM = 64
#: Bytes of a group that are sorted together, of the groups that are sorted in one go, and the
#: starts of a piece of a larger group.
BUFFER = 400_000
BATCH = 1_600_000
STEP = 32
#: Neighbours whose prefixes are compared in one go.
CHUNK = 1 << 16
_END = 255  # never part of UTF-8


# --- two-stage suffix sorting ---------------------------------------------------------------------


def suffix_array(data: np.ndarray, depth: int = LENGTH, wanted: np.ndarray | None = None) -> np.ndarray:
    """Order of the suffixes of data by their first `depth` bytes at least (ties are in any order).

    With a mask of wanted starts, only those are ordered, and the suffixes from which they're induced.
    """
    n = len(data)
    kind = np.int32 if n < 2**30 else np.int64  # places take most of the memory here
    if n == 0:
        return np.empty(0, kind)
    # a suffix is smaller than its successor if the next different byte is larger; the last one isn't
    # (the end counts as smaller than any byte)
    change = np.flatnonzero(data[1:] != data[:-1]).astype(kind)
    small = np.zeros(n, bool)
    if len(change):
        rising = (data[1:] > data[:-1])[change]
        small[: change[-1] + 1] = np.repeat(rising, np.diff(change, prepend=kind(-1)))
    del change
    if wanted is None:
        needed = np.ones(n, bool)
    else:  # a larger suffix follows from its successor, and so on up to the next smaller one
        ends = np.flatnonzero(wanted & ~np.append(wanted[1:], False))
        smaller = np.append(np.flatnonzero(small), n - 1).astype(kind)
        following = smaller[np.searchsorted(smaller[:-1], ends)]
        steps = np.zeros(n + 1, kind)
        np.add.at(steps, ends, 1)
        np.add.at(steps, following + 1, -1)
        needed = wanted | (np.cumsum(steps, out=steps)[:n] > 0)
        del ends, smaller, following, steps
    direct = np.flatnonzero(small & needed).astype(kind)
    raw = data.tobytes()
    # by two bytes first, so that the long keys of few suffixes at a time are held (the last suffix isn't among them)
    two = data[direct].astype(np.uint16) << 8 | data[direct + 1]
    by_two = np.argsort(two, kind="stable").astype(kind)
    direct, two = direct[by_two], two[by_two]
    cuts = [0, *(np.flatnonzero(two[1:] != two[:-1]) + 1).tolist(), len(direct)]
    del two, by_two
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a > 1:
            direct[a:b] = sorted(direct[a:b].tolist(), key=lambda i: raw[i : i + depth])
    # buckets by first byte: first the induced suffixes, then the sorted ones
    sorted_in = np.split(direct, np.searchsorted(data[direct], np.arange(1, 256)))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if needed[n - 1]:
        induced[data[n - 1]].append(np.array([n - 1], kind))  # the smallest suffix of its bucket
    large = needed & ~small
    out = [np.empty(0, kind)]

    def induce(found: np.ndarray) -> np.ndarray:
        """Puts the larger predecessors of these suffixes into their buckets; gives those of the same bucket."""
        before = found[found > 0] - 1
        before = before[large[before]]
        first = data[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(np.diff(first)) + 1
        same = np.empty(0, kind)
        if len(before):
            for part in np.split(before, cuts):
                if data[part[0]] == now:
                    same = part
                else:
                    induced[data[part[0]]].append(part)
        return same

    for now in range(256):
        wave = np.concatenate(induced[now]) if induced[now] else np.empty(0, kind)
        while len(wave):  # runs of one byte induce within their bucket
            out.append(wave)
            wave = induce(wave)
        if len(sorted_in[now]):
            out.append(sorted_in[now])
            induce(sorted_in[now])
    return np.concatenate(out)


def common_prefixes(data: np.ndarray, order: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """For each length whether a suffix of the order has so long a common prefix with the one before it.

    Prefixes are compared by the difference of running sums of hashed bytes (64 bits).
    """
    longest = max(lengths)
    prefix = prefix_hash(np.concatenate([data, np.full(longest, _END, np.uint8)]))
    a, b = order[1:], order[:-1]
    inverse = powers(_BASE_INV, len(prefix))
    out = [np.zeros(len(order), bool) for _ in lengths]
    for at in range(0, len(a), CHUNK):
        a_, b_ = a[at : at + CHUNK], b[at : at + CHUNK]
        ia, ib, pa_, pb = inverse[a_], inverse[b_], prefix[a_], prefix[b_]
        for same, k in zip(out, lengths):
            same[at + 1 : at + 1 + len(a_)] = (prefix[a_ + k] - pa_) * ia == (prefix[b_ + k] - pb) * ib
    return out


def repeated_starts(contents: list[bytes], lengths: tuple[int, ...] = (LENGTH,), counts: list[int] | None = None) -> list[list[np.ndarray]]:
    """For each length and content the starts of strings of that length that also start elsewhere in the contents.

    counts says how many starts of a content count, from its first byte on (by default all).
    """
    if counts is None:
        counts = [max(0, len(c) - min(lengths) + 1) for c in contents]
    data = np.frombuffer(b"".join(c + bytes([_END]) for c in contents), np.uint8)
    begins = np.cumsum([0] + [len(c) + 1 for c in contents])
    steps = np.zeros(len(data) + 1, np.int32)  # no more than one content's starts at a time
    np.add.at(steps, begins[:-1], 1)
    np.add.at(steps, begins[:-1] + np.array(counts, np.int64), -1)
    wanted = np.cumsum(steps, out=steps)[:-1] > 0
    del steps
    order = suffix_array(data, max(lengths), wanted)
    order = order[wanted[order]]
    out = []
    for length, same in zip(lengths, common_prefixes(data, order, lengths)):
        hit = np.zeros(len(data), bool)
        hit[order[same]] = True
        hit[order[np.flatnonzero(same) - 1]] = True
        # strings that would run over a content's end hold its end mark, and no start before it does
        out.append([np.flatnonzero(hit[a : max(a, min(a + n, b - length))]) for a, b, n in zip(begins[:-1], begins[1:], counts)])
    return out


# --- anchors and runs -------------------------------------------------------------------------------


def sliding_argmin(x: np.ndarray, window: int) -> np.ndarray:
    """Position of the leftmost value of each window whose upper 32 bits are least."""
    n = len(x) - window + 1
    # the upper half of the value, then the position
    low = np.uint64(32)
    packed = x >> low << low | np.arange(len(x), dtype=np.uint64)
    size = 1
    while size * 2 <= window:
        packed = np.minimum(packed[:-size], packed[size:])
        size *= 2
    rest = window - size
    packed = np.minimum(packed[:n], packed[rest : rest + n])
    return (packed & np.uint64(0xFFFFFFFF)).astype(np.int64)


def runs(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text's strings of `length` bytes: each run's anchor hash, first start, number of starts, and the anchor's place from the first start.

    Of grams with equal upper halves of their hashes the leftmost counts, whatever surrounds the
    string, so equal strings have their anchor at the same place.
    """
    prefix = prefix_hash(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = mix((prefix[at + GRAM] - prefix[at]) * powers(_BASE_INV, len(prefix))[at])
    anchor = sliding_argmin(grams, length - GRAM + 1)
    new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(anchor)))
    return grams[anchor[first]], first, count, anchor[first] - first


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    """(h, t64, many): the distinct anchors of each text of `length` bytes at least."""

    def run(batches):
        for batch in batches:
            hs, ts, manys = [], [], []
            for text in batch.column(0):
                if not text.is_valid or len(text.as_buffer()) < length:
                    continue
                raw = text.as_buffer()
                h, _, _, _ = runs(np.frombuffer(raw, np.uint8), length)
                h, times = np.unique(h, return_counts=True)
                hs.append(h.view(np.int64))
                t64 = int.from_bytes(hashlib.md5(raw).digest()[:8], "big", signed=True)
                ts.append(np.full(len(h), t64))
                manys.append(times > 1)
            if hs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in (hs, ts, manys)], ["h", "t64", "many"])
        release()

    return docs.select("text").filter(F.octet_length("text") >= length).mapInArrow(run, "h long, t64 long, many boolean")


def _runs_of(texts: DataFrame, length: int, longest: int) -> DataFrame:
    """From texts(tkey, text, hs): runs whose anchor is in hs.

    Rows (key, pid, content, place, n, weight, tkey, starts): one row per text and distinct run, with
    all starts of the run in it; n is the number of strings of a run, whose bytes go on for
    `longest` bytes from the last one's start, as far as the text does.
    """

    def run(batches):
        for batch in batches:
            rows = {k: [] for k in ("key", "pid", "content", "place", "n", "weight", "tkey", "starts")}
            for tkey, text, hs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                raw = memoryview(text.as_buffer())
                h, first, count, place = runs(np.frombuffer(raw, np.uint8), length)
                wanted = np.isin(h, hs.values.to_numpy().view(np.uint64))
                mine: dict[bytes, int] = {}
                for k in np.flatnonzero(wanted).tolist():
                    s, n = int(first[k]), int(count[k])
                    content = raw[s : s + n + longest - 1]
                    pid = hashlib.md5(content).digest()
                    at = mine.get(pid)
                    if at is None:
                        mine[pid] = len(rows["key"])
                        for name, value in zip(rows, (int(h[k].view(np.int64)), pid, bytes(content), int(place[k]), n, 1, tkey, [s])):
                            rows[name].append(value)
                    else:
                        rows["weight"][at] += 1
                        rows["starts"][at].append(s)
            types = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows))
        release()

    return texts.mapInArrow(run, "key long, pid binary, content binary, place int, n int, weight long, tkey binary, starts array<int>")


def _sorted_groups(contents: DataFrame, length: int, longest: int) -> DataFrame:
    """contents(key, pid, content, n, weight), groups of a key at most BUFFER bytes: (pid, hits, far).

    hits are the starts of repeated strings of `length` bytes, far those of `longest` bytes.
    """

    def run(batches):
        held, size, last = [], 0, None

        def flush():
            found = repeated_starts([c for _, c, _, _ in held], (length, longest), [n for _, _, n, _ in held])
            rows: dict = {"pid": [], "hits": [], "far": []}
            for (pid, c, n, w), near, far in zip(held, *found):
                if w > 1:
                    near, far = np.arange(n), np.arange(max(0, min(n, len(c) - longest + 1)))
                if len(near):
                    for name, value in zip(rows, (pid, near.astype(np.int32), far.astype(np.int32))):
                        rows[name].append(value)
            types = [pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows))

        for batch in batches:
            for key, pid, content, n, weight in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if key != last and size >= BATCH:
                    yield flush()
                    held, size = [], 0
                last = key
                held.append((pid, content, n, weight))
                size += len(content)
        if held:
            yield flush()
        held = []
        release()

    return contents.select("key", "pid", "content", "n", "weight").repartition("key").sortWithinPartitions("key").mapInArrow(run, _HITS)


_HITS = "pid binary, hits array<int>, far array<int>"


def _pieces(contents: DataFrame, step: int, length: int, longest: int) -> DataFrame:
    """Contents cut into pieces of `step` starts: (key, sid, pid, content, place, n, weight, parent, off).

    key and sid come from the bytes that all strings of a piece have: strings of other pieces differ.
    """

    def run(batches):
        for batch in batches:
            rows = {k: [] for k in ("key", "sid", "pid", "content", "place", "n", "weight", "parent", "off")}
            for parent, content, place, count, weight in zip(*(batch.column(c).to_pylist() for c in range(5))):
                a = 0
                while a < count:
                    j = (place - a) // step  # starts with the anchor j * step .. j * step + step - 1 bytes on
                    b = min(count, place - j * step + 1)
                    mark = j.to_bytes(8, "big", signed=True)
                    sid = hashlib.md5(content[place - j * step : place - j * step - step + 1 + length] + mark).digest()
                    piece = content[a : b - 1 + longest]
                    values = (int.from_bytes(sid[:8], "little", signed=True), sid, hashlib.md5(piece + mark).digest(), piece, place - a, b - a, weight, parent, a)
                    for name, value in zip(rows, values):
                        rows[name].append(value)
                    a = b
            types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows))

    return contents.select("pid", "content", "place", "n", "weight").mapInArrow(run, "key long, sid binary, pid binary, content binary, place int, n int, weight long, parent binary, off int")


def _merged(rows: DataFrame) -> DataFrame:
    """Equal contents of a key as one, with the sum of their weights."""
    return rows.groupBy("key", "pid").agg(F.first("content").alias("content"), F.first("place").alias("place"), F.first("n").alias("n"), F.sum("weight").alias("weight"))


def _single_hits(pieces: DataFrame, longest: int) -> DataFrame:
    """(pid, hits, far) of pieces of one start each: counts tell which strings repeat."""
    strings = pieces.groupBy("sid", "pid").agg(F.sum("weight").alias("weight"), F.first(F.length("content") >= longest).alias("whole"))
    again = strings.groupBy("sid").agg(F.sum("weight").alias("total")).filter("total > 1").select("sid")
    start, none = F.array(F.lit(0)), F.array().cast("array<int>")
    return strings.join(again, "sid").select("pid", start.alias("hits"), F.when(F.col("whole") & (F.col("weight") > 1), start).otherwise(none).alias("far"))


def _hits(contents: DataFrame, length: int, longest: int, tables: list[DataFrame], pieces_next: bool = True) -> DataFrame:
    """(pid, hits, far) for contents(key, pid, content, place, n, weight) of groups of any size.

    Tables that were written for it are added to `tables`.
    """
    # a table of its own, so that Spark can split the join at hot keys
    groups = cut(contents.groupBy("key").agg(F.sum(F.length("content")).alias("bytes"), F.count("*").alias("rows")))
    sized = cut(contents.join(groups, "key"))
    tables += [groups, sized]
    last = F.least(F.col("n"), F.length("content") - longest + 1)
    every = lambda k: F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(F.array().cast("array<int>")).cast("array<int>")
    alone = sized.filter("rows = 1 AND weight > 1").select("pid", every(F.col("n")).alias("hits"), every(last).alias("far"))
    cold = sized.filter(f"rows > 1 AND bytes <= {BUFFER}")
    hot = sized.filter(f"rows > 1 AND bytes > {BUFFER}")
    found = alone.unionByName(_sorted_groups(cold, length, longest))
    if hot.limit(1).count():
        pieces = cut(_pieces(hot, STEP if pieces_next else 1, length, longest))
        tables.append(pieces)
        deeper = _hits(_merged(pieces), length, longest, tables, False) if pieces_next else _single_hits(pieces, longest)
        moved = lambda c: F.transform(c, lambda s: s + F.col("off")).alias(c)
        hit = pieces.select("pid", "parent", "off").join(deeper, "pid").select(F.col("parent").alias("pid"), moved("hits"), moved("far"))
        gathered = lambda c: F.flatten(F.collect_list(c)).alias(c)
        found = found.unionByName(hit.groupBy("pid").agg(gathered("hits"), gathered("far")))
    return found


# --- whole tables --------------------------------------------------------------------------------


def removed_spans(docs: DataFrame, length: int, longest: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(base, spans). base: doc_id, tkey, n_bytes, sha, copies of every row; spans: doc_id, tkey, text, cuts, far_cuts.

    cuts holds begins and ends of the bytes in repeated strings of `length` bytes, alternately, for
    texts without copies that have any; far_cuts those of strings of `longest` bytes.
    """
    longest = longest or length

    def describe(batches):
        for batch in batches:
            keys, sizes, shas = [], [], []
            for text in batch.column(1):
                raw = text.as_buffer() if text.is_valid else b""
                keys.append(hashlib.md5(raw).digest())
                sizes.append(len(memoryview(raw)))
                shas.append(hashlib.sha256(raw).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(shas)], ["doc_id", "tkey", "n_bytes", "sha"])
        release()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    base = cut(docs.mapInArrow(describe, "doc_id long, tkey binary, n_bytes long, sha string"))
    texts = cut(base.groupBy("tkey").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")))

    anchors = cut(_anchors(docs, length))
    again = anchors.groupBy("h").agg(F.min("t64").alias("lo"), F.max("t64").alias("hi"), F.max("many").alias("many")).filter("lo <> hi OR many").select("h")
    per_text = anchors.select("h", "t64").join(again, "h").groupBy("t64").agg(F.collect_set("h").alias("hs"))
    t64 = F.conv(F.hex(F.substring("tkey", 1, 8)), 16, -10).cast("long")
    per_text = texts.select(F.col("tkey").alias("key"), "rep", t64.alias("t64")).join(per_text, "t64").drop("t64")
    # one row of each text (of its least id, or all of them if none has an id)
    keyed = docs.withColumn("tkey", F.unhex(F.md5(F.encode("text", "utf-8"))))
    chosen = cut(keyed.join(per_text, (F.col("tkey") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("doc_id", "tkey", "text", "hs"))
    drop_cut(anchors)

    rows = cut(_runs_of(chosen.select("tkey", "text", "hs"), length, longest))
    hits = cut(_hits(_merged(rows), length, longest, done := []))
    for old in done:
        drop_cut(old)

    def spread(batches):
        for batch in batches:
            starts = batch.column(1)
            owner = np.repeat(np.arange(len(starts)), starts.value_lengths().to_numpy())  # of each start, its row
            moved = [_moved(*_around(batch.column(c), k), owner, starts.flatten().to_numpy()) for c, k in ((2, length), (3, longest))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), *moved], ["tkey", "cuts", "far_cuts"])
        release()

    marks = rows.select("tkey", "starts", "pid").join(hits, "pid").select("tkey", "starts", "hits", "far").mapInArrow(spread, "tkey binary, cuts array<int>, far_cuts array<int>")
    gathered = lambda c: F.flatten(F.collect_list(c)).alias(c)
    marks = marks.groupBy("tkey").agg(gathered("cuts"), gathered("far_cuts"))
    # of copies nothing stays anyway
    single = marks.join(texts.filter("copies = 1").select("tkey"), "tkey", "left_semi")
    spans = chosen.select("doc_id", "tkey", "text").join(single, "tkey")
    return base.join(texts.select("tkey", "copies"), "tkey"), spans


def _around(starts: pa.ListArray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """What strings of `length` bytes at each row's starts cover: begins and ends side by side, and each row's number of spans.

    Spans that touch are one.
    """
    row = np.repeat(np.arange(len(starts)), starts.value_lengths().to_numpy())
    at = starts.flatten().to_numpy()
    order = np.lexsort((at, row))
    row, at = row[order], at[order]
    new = np.append(True, (row[1:] != row[:-1]) | (np.diff(at) > length))[: len(at)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    return np.stack([at[first], at[last] + length], 1).astype(np.int32), np.bincount(row[first], minlength=len(starts))


def _moved(spans: np.ndarray, per_row: np.ndarray, owner: np.ndarray, by: np.ndarray) -> pa.ListArray:
    """For each start the spans of its row, moved by it, as begins and ends alternately."""
    n = per_row[owner]
    ends = np.cumsum(n)
    which = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n) + np.repeat((np.cumsum(per_row) - per_row)[owner], n)
    values = (spans[which] + np.repeat(by, n)[:, None]).astype(np.int32).reshape(-1)
    return pa.ListArray.from_arrays(pa.array(np.append(0, 2 * ends).astype(np.int32)), pa.array(values))


def merge_cuts(cuts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of alternating begins and ends."""
    pairs = np.unique(cuts.reshape(-1, 2), axis=0)
    out: list[tuple[int, int]] = []
    for a, b in pairs.tolist():
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(raw, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def repeat_digests(docs: DataFrame, length: int = LENGTH, passage: int = PASSAGE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared for every document.

    The first go by `length`; n_shared counts the bytes in repeated strings of `passage` bytes.
    """
    base, spans = removed_spans(docs, passage, length)

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, key, text, cuts, far in zip(*(batch.column(c) for c in range(5))):
                raw = memoryview(text.as_buffer())
                shared, found = merge_cuts(cuts.values.to_numpy()), merge_cuts(far.values.to_numpy())
                rows.append((doc_id.as_py(), key.as_py(), sum(b - a for a, b in found), len(found), hashlib.sha256(without(raw, found)).hexdigest(), sum(b - a for a, b in shared)))
            columns = list(zip(*rows)) or [[]] * 6
            types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["mw_id", "mw_key", "n_removed", "n_spans", "kept", "n_shared"])
        release()

    part = spans.select("doc_id", "tkey", "text", "cuts", "far_cuts").mapInArrow(run, "mw_id long, mw_key binary, n_removed long, n_spans long, kept string, n_shared long")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    shared = (F.col("copies") > 1) & (F.col("n_bytes") >= passage)
    empty = hashlib.sha256(b"").hexdigest()
    return base.join(part, F.col("doc_id").eqNullSafe(F.col("mw_id")) & (F.col("tkey") == F.col("mw_key")), "left").select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(empty)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
        F.when(shared, F.col("n_bytes")).otherwise(F.coalesce("n_shared", F.lit(0))).cast("long").alias("n_shared"),
    )


def remove_repeats(docs: DataFrame, length: int = PASSAGE) -> DataFrame:
    """docs without the repeated bytes in their texts; bytes left over of a character that was cut go too.

    n_chars, if there is such a column, follows the text. A document of which nothing is left keeps
    its row, with an empty text. Of equal texts nothing is left, as each repeats the other.
    """
    base, spans = removed_spans(docs, length)
    tag = uuid.uuid4().hex[:12]  # a name of its own for every column that is added for the join
    key, at, key2, at2, kept = (f"mw_{x}_{tag}" for x in ("key", "id", "key2", "id2", "kept"))

    def run(batches):
        for batch in batches:
            texts = [without(memoryview(t.as_buffer()), merge_cuts(c.values.to_numpy())).decode("utf-8", "ignore") for t, c in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], [at2, key2, kept])
        release()

    part = spans.select("doc_id", "tkey", "text", "cuts").mapInArrow(run, f"{at2} long, {key2} binary, {kept} string")
    copies = base.filter(f"copies > 1 AND n_bytes >= {length}").select(F.col("doc_id").alias(at2), F.col("tkey").alias(key2), F.lit("").alias(kept)).distinct()
    changed = copies.unionByName(part)
    keyed = docs.withColumns({key: F.unhex(F.md5(F.encode(F.coalesce("text", F.lit("")), "utf-8"))), at: F.col("doc_id").cast("long")})
    out = keyed.join(changed, F.col(at).eqNullSafe(F.col(at2)) & (F.col(key) == F.col(key2)), "left").withColumn("text", F.coalesce(kept, "text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(kept).isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
