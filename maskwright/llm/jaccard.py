"""N-gram Jaccard join: an exact metric-space join of documents by their word shingles.

Jaccard distance d is a metric, so distances to pivots bound distances between documents. With a
least similarity of 0.75 two documents link if d <= 0.25 = E. The steps:

1. Documents with equal shingle sets are one class; only classes go on.
2. Shingles are counted over the whole table. A shingle that no other class has can't be shared,
   and a class links only if at least three quarters of its shingles are shared with others; the
   rest is done. (Copies only raise counts, which keeps more classes than needed.)
3. Linked classes share one of the rarest n - ceil(0.75 n) + 1 shingles of each, by (frequency,
   hash). The pivot of a shingle is the class with the least hash that has it there. Each class
   meets the least of its shingles' pivots, which settles most copies. Then the classes of every
   shingle that aren't all connected yet are brought to its pivot, with their exact distances to
   it; those within E link to it. Classes of one pivot are a region.
4. A member goes on only if one of another component lies within its windows: distances to the
   pivot that differ by E at most, and a size that allows a link. The rest is joined recursively: new
   pivots are drawn from the members; each member belongs to the Voronoi cell of its nearest
   pivot and is also put into the cells of earlier pivots p with
   d(x, p) <= d(x, nearest) + 2E, as only those can hold partners of it. Cells are regions again.
5. A region of at most OUTRIGHT members is joined outright, without emitting pairs: members of
   different components are compared if |d(x, p) - d(y, p)| <= E and their sizes allow a link.
   Regions that Voronoi cells can't divide (all members far from each other) are, after ROUNDS
   rounds, joined like this too, in pairs of blocks dealt over tasks.

Nothing is dropped on the way, and no cap applies. Shingles are told apart by 48-bit hashes and
classes by 64 bits of their sets' digests: of 1e10 different sets a few would be taken for one.
Between such classes distances and links are exact.

Null texts and texts without words have no shingles and link with nothing. A text of fewer words
than a shingle is one shingle. Repeated rows are equal documents. An empty table gives no rows.
Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import components, cut, drop_cut, release, shared_dir, shingles

WIDTH = 5
E = 0.25
#: Tokens of a map block and of a count bucket (bounds memory of a task, not of the input).
BLOCK_TOKENS = 800_000
BUCKET_TOKENS = 1_500_000
#: Bits of a shingle's hash that tell its bucket first.
TOP_BITS = 16
TOPS = 1 << TOP_BITS
#: Members of a block, and of a region that is compared outright, in pairs of blocks; pivots drawn
#: in a larger region, and rounds of that.
BLOCK = 256
OUTRIGHT = 2048
PIVOTS = 8
ROUNDS = 3


def linked(both: int, a: int, b: int) -> bool:
    return 100 * both >= 75 * (a + b - both)


def document_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, and the class id: 64 bits of the set's digest (null for an empty set)."""

    def run(batches):
        for batch in batches:
            sets = shingles(batch.column(1), width)
            digest = [class_id(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.int64())], ["doc_id", "n_shingles", "set_id"])
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, set_id long")


def class_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.md5(s.tobytes()).digest()[:8], "little", signed=True)


def _shared_shingles(docs: DataFrame, total: int, width: int) -> DataFrame:
    """Classes that may link: set_id, n, tokens (their shared shingles, sorted), prefix (where they must meet others).

    Map tasks gather blocks of documents and deal their shingles by hash range to buckets, as
    arrays of 32 low bits and a document number. Buckets find the shingles of several classes and
    send them back to the blocks.
    """
    wide = min(TOPS, max(8, math.ceil(total / BUCKET_TOKENS)))
    bounds = (np.arange(wide + 1, dtype=np.int64) * TOPS + wide - 1) // wide  # of the top 16 bits
    # a table of so many shingles that one value of the top bits has too many is cut by further bits
    fine = max(1, math.ceil(total / TOPS / BUCKET_TOKENS))
    buckets = wide * fine
    out_schema = "block long, bucket int, docs binary, counts binary, low binary, doc binary"

    def spread(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held, tokens, seen = [], 0, set()

        def flush():
            nonlocal held, tokens, seen, number
            block = part * 1_000_000 + number
            number += 1
            n = np.array([len(s) for s, _ in held], np.uint32)
            digests = np.array([d for _, d in held], np.int64).tobytes()
            flat = np.concatenate([s for s, _ in held])
            doc = np.repeat(np.arange(len(held), dtype=np.uint16), n)
            top = (flat >> np.uint64(64 - TOP_BITS)).astype(np.int64)
            low = (flat >> np.uint64(32 - TOP_BITS)) & np.uint64(0xFFFFFFFF)
            part_of = ((low * np.uint64(fine)) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(top * fine + part_of, kind="stable")
            per = np.bincount(top * fine + part_of, minlength=TOPS * fine)
            low, doc = low.astype(np.uint32)[order], doc[order]
            at = np.concatenate([[0], np.cumsum(per)])
            # with one part, a bucket is a range of the top bits; else it's a part of one value
            cuts = at[bounds] if fine == 1 else at
            rows = {"block": [block], "bucket": [block % buckets], "docs": [n.tobytes() + digests], "counts": [None], "low": [None], "doc": [None]}
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                a, b = cuts[k], cuts[k + 1]
                rows["block"].append(block)
                rows["bucket"].append(k)
                rows["docs"].append(None)
                rows["counts"].append((per[bounds[k] : bounds[k + 1]] if fine == 1 else per[k : k + 1]).astype(np.uint32).tobytes())
                rows["low"].append(low[a:b].tobytes())
                rows["doc"].append(doc[a:b].tobytes())
            held, tokens, seen = [], 0, set()
            types = [pa.int64(), pa.int32()] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows))

        for batch in batches:
            for s in shingles(batch.column(0), width):
                digest = class_id(s)
                if len(s) and digest not in seen:
                    seen.add(digest)
                    held.append((s, digest))
                    tokens += len(s)
                    if tokens >= BLOCK_TOKENS or len(held) >= 65000:
                        yield flush()
        if held:
            yield flush()
        release()

    def count(table: pa.Table) -> pa.Table:
        block = table.column("block").to_numpy()
        bucket = table.column("bucket")[0].as_py()
        known = [(b, d) for b, d in zip(block.tolist(), table.column("docs").to_pylist()) if d is not None]
        blocks, tops, lows, docs_, sizes = [], [], [], [], []
        span = np.arange(bounds[bucket], bounds[bucket + 1], dtype=np.uint64) if fine == 1 else np.array([bucket // fine], np.uint64)
        for b, c, low, doc in zip(block.tolist(), *(table.column(x) for x in ("counts", "low", "doc"))):
            if c.is_valid:
                c = np.frombuffer(c.as_buffer(), np.uint32)
                blocks.append(b)
                tops.append(np.repeat(span, c) << np.uint64(32))
                lows.append(np.frombuffer(low.as_buffer(), np.uint32))
                docs_.append(np.frombuffer(doc.as_buffer(), np.uint16))
                sizes.append(len(lows[-1]))
        rows = {"block": [b for b, _ in known], "docs": [d for _, d in known], "token": [None] * len(known), "doc": [None] * len(known), "grade": [None] * len(known)}
        if blocks:
            token = np.concatenate(tops) | np.concatenate(lows)
            source = np.repeat(np.arange(len(blocks), dtype=np.int32), sizes)
            doc = np.concatenate(docs_)
            order = np.argsort(token, kind="stable")
            token, source, doc = token[order], source[order], doc[order]
            new = np.concatenate([[True], token[1:] != token[:-1]])
            times = np.diff(np.append(np.flatnonzero(new), len(token)))
            df = np.repeat(times, times)
            shared = df > 1
            token, source, doc, df = token[shared], source[shared], doc[shared], df[shared]
            grade = np.minimum(255, np.floor(8 * np.log2(df))).astype(np.uint8)
            order = np.argsort(source, kind="stable")
            token, doc, grade = token[order], doc[order], grade[order]
            at = np.concatenate([[0], np.cumsum(np.bincount(source, minlength=len(blocks)))])
            low = (token & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            top = (token >> np.uint64(32)).astype(np.uint16)
            for i, b in enumerate(blocks):
                x, y = at[i], at[i + 1]
                if y > x:
                    rows["block"].append(b)
                    rows["docs"].append(None)
                    rows["token"].append(top[x:y].tobytes() + low[x:y].tobytes())
                    rows["doc"].append(doc[x:y].tobytes())
                    rows["grade"].append(grade[x:y].tobytes())
        types = [pa.int64()] + [pa.binary()] * 4
        release()
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows))

    def choose(table: pa.Table) -> pa.Table:
        n, ids, tokens, docs_, grades = None, None, [], [], []
        for d, t, doc, g in zip(*(table.column(x) for x in ("docs", "token", "doc", "grade"))):
            if d.is_valid:
                raw = d.as_py()
                m = len(raw) // 12
                n, ids = np.frombuffer(raw, np.uint32, m), np.frombuffer(raw[4 * m :], np.int64)
            else:
                doc, raw = np.frombuffer(doc.as_buffer(), np.uint16), t.as_buffer()
                m = len(doc)
                tokens.append(np.frombuffer(raw, np.uint16, m).astype(np.uint64) << np.uint64(32) | np.frombuffer(raw, np.uint32, m, 2 * m))
                docs_.append(doc)
                grades.append(np.frombuffer(g.as_buffer(), np.uint8))
        rows = {"set_id": [], "n": [], "tokens": [], "prefix": []}
        if tokens:
            token, doc, grade = np.concatenate(tokens), np.concatenate(docs_), np.concatenate(grades)
            shared = np.bincount(doc, minlength=len(n))
            may = 4 * shared >= 3 * n.astype(np.int64)
            ok = may[doc]
            token, doc, grade = token[ok], doc[ok], grade[ok]
            order = np.lexsort((token, grade, doc))
            token, doc = token[order], doc[order]
            at = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(n)))])
            for i in np.flatnonzero(may & (shared > 0)).tolist():
                mine, size = token[at[i] : at[i + 1]], int(n[i])
                keep = size // 4 + 1 - (size - len(mine))
                if keep > 0:
                    rows["set_id"].append(int(ids[i]))
                    rows["n"].append(size)
                    rows["prefix"].append(mine[:keep].astype(np.int64))
                    rows["tokens"].append(np.sort(mine).tobytes())
        types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        release()
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows))

    spread_out = docs.select("text").mapInArrow(spread, out_schema)
    back = spread_out.groupBy("bucket").applyInArrow(count, "block long, docs binary, token binary, doc binary, grade binary")
    return back.groupBy("block").applyInArrow(choose, "set_id long, n long, tokens binary, prefix array<long>").dropDuplicates(["set_id"])


def _distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs(x, p) with their distance d, whether they link, and the size of x.

    sets is bucketed by set_id, so only the pairs move to it; the shingles of x then move to p,
    with those of the pivots alone, as a join whose hot pivots Spark can split.
    """
    a = sets.select(F.col("set_id").alias("x"), F.col("n").alias("nx"), F.col("tokens").alias("tx"))
    b = sets.select(F.col("set_id").alias("p"), F.col("n").alias("np"), F.col("tokens").alias("tp"))
    pivots = pairs.select("p").distinct().join(b, "p")

    def run(batches):
        for batch in batches:
            x, p, nx, np_, tx, tp = batch.columns
            both = [_both(a.as_buffer(), b.as_buffer()) for a, b in zip(tx, tp)]
            d = [1 - k / (m + n - k) for k, m, n in zip(both, nx.to_pylist(), np_.to_pylist())]
            link = [linked(k, m, n) for k, m, n in zip(both, nx.to_pylist(), np_.to_pylist())]
            yield pa.RecordBatch.from_arrays([x, p, nx, pa.array(d, pa.float64()), pa.array(link, pa.bool_())], ["x", "p", "n", "d", "link"])
        release()

    return pairs.join(a, "x").join(pivots, "p").select("x", "p", "nx", "np", "tx", "tp").mapInArrow(run, "x long, p long, n long, d double, link boolean")


def _bucketed(sets: DataFrame) -> tuple[DataFrame, str]:
    """sets as a table bucketed by set_id in the shared folder, and the table's name."""
    spark = sets.sparkSession
    name = f"mw_sets_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = sets.repartition(n, "set_id").write.bucketBy(n, "set_id").option("path", f"{shared_dir(spark)}/mw-{name}")
    writer.format("parquet").saveAsTable(name)
    return spark.table(name), name


def _both(a, b) -> int:
    a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 0:
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


def _in_windows(members: DataFrame) -> DataFrame:
    """Members(region, x, comp, d, n) that a member of another component may link with.

    By the triangle inequality partners' distances to the pivot differ by E at most, and their
    sizes by a factor of 4/3; so with bins of these widths a partner is in the same or the next bin.
    """
    binned = members.withColumns({"db": F.floor((F.col("d") + 1e-12) / E).cast("int"), "sb": F.floor(F.log(F.col("n").cast("double")) / math.log(4 / 3) + 1e-9).cast("int")})
    spans = binned.groupBy("region", "db", "sb").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    near = F.array(F.lit(-1), F.lit(0), F.lit(1))
    around = spans.select("region", "db", "sb", "lo", "hi", F.explode(near).alias("i")).select("region", (F.col("db") + F.col("i")).alias("db"), "sb", "lo", "hi", F.explode(near).alias("j"))
    around = around.groupBy("region", "db", (F.col("sb") + F.col("j")).alias("sb")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo <> hi")
    return binned.join(around.select("region", "db", "sb"), ["region", "db", "sb"]).drop("db", "sb")


def _joined_outright(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (x, p) between members(region, x, comp, d) of different components, found in blocks of a region."""
    sized = members.join(members.groupBy("region").agg(F.count("*").alias("size")), "region")
    parts = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    rows = sized.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("x"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("region", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "x", "comp", "d")
    rows = rows.join(sets.select(F.col("set_id").alias("x"), "n", "tokens"), "x")
    rows = rows.repartition("region", "i", "j").sortWithinPartitions("region", "i", "j").select("region", "i", "j", "own", "x", "comp", "d", "n", "tokens")

    def run(batches):
        key, group = None, []
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in range(9))):
                if row[:3] != key:
                    out += _block(group)
                    key, group = row[:3], []
                group.append(row)
            yield _edges(out)
        yield _edges(_block(group))

    return rows.mapInArrow(run, "x long, p long")


def _edges(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], ["x", "p"])


def _block(group) -> list[tuple[int, int]]:
    """Links that join components within one pair of blocks."""
    out, root = [], {}

    def find(c):
        while root.get(c, c) != c:
            c = root[c]
        return c

    group = sorted(group, key=lambda r: r[6])
    sets = [np.frombuffer(r[8], np.uint64) for r in group]
    for a, r in enumerate(group):
        for b in range(a + 1, len(group)):
            s = group[b]
            if s[6] - r[6] > E + 1e-9:  # sorted by distance to the pivot: the window ends here
                break
            if (r[3] == s[3] and r[1] != r[2]) or 4 * min(r[7], s[7]) < 3 * max(r[7], s[7]):
                continue
            if (x := find(r[5])) != (y := find(s[5])) and linked(_both(sets[a], sets[b]), r[7], s[7]):
                root[max(x, y)] = min(x, y)
                out.append((r[4], s[4]))
    return out


def similarity_classes(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    spark = docs.sparkSession
    found = cut(document_sets(docs, width))
    total = found.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    sets, name = _bucketed(_shared_shingles(docs, total, width))
    try:
        links = _links_of(sets)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    # classes back to documents: the least doc_id stands for a class
    # (a table of its own, so that Spark can split the joins at classes of many copies or links)
    classes = cut(found.filter("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("rep")))
    a = classes.select(F.col("set_id").alias("x"), F.col("rep").alias("a"))
    b = classes.select(F.col("set_id").alias("p"), F.col("rep").alias("b"))
    comp = components(links.join(a, "x").join(b, "p").select("a", "b"))
    drop_cut(links)
    reps = classes.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("set_id", F.coalesce("component", "rep").alias("component_id"))
    return found.join(reps, "set_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _links_of(sets: DataFrame) -> DataFrame:
    """Links (x, p) that connect the classes of every component, as a table; the files of sets go."""
    used = [sets]

    def held(df):
        used.append(cut(df))
        return used[-1]

    # each class meets the least pivot of its rare shingles first; ids are hashes, so the least is any
    posts = sets.select(F.col("set_id").alias("x"), F.explode("prefix").alias("t"))
    tops = posts.groupBy("t").agg(F.count("*").alias("k"), F.min("x").alias("p")).filter("k > 1").select("t", "p")
    posts = held(posts.join(held(tops), "t"))
    first = posts.groupBy("x").agg(F.min("p").alias("p")).filter("x <> p")
    links = held(_distances(first, sets).filter("link").select("x", "p"))

    # regions: the classes that share a rare shingle, around its pivot, where some aren't connected yet
    comp = components(links.select(F.col("x").alias("a"), F.col("p").alias("b")))
    known = posts.join(comp.withColumnRenamed("id", "x"), "x", "left").withColumn("comp", F.coalesce("component", "x"))
    open_ = known.groupBy("t").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("t")
    # counted shingles are tables of their own, so that Spark can split the joins at hot ones
    pairs = posts.join(held(open_), "t").filter("x <> p").select("x", "p").distinct()
    near = held(_distances(pairs, sets))
    links = links.unionByName(near.filter("link").select("x", "p"))
    members = near.select(F.xxhash64("p").alias("region"), "x", "d", "n")

    for turn in range(ROUNDS + 1):
        comp = components(links.select(F.col("x").alias("a"), F.col("p").alias("b")))
        labelled = members.join(comp.withColumnRenamed("id", "x"), "x", "left").withColumn("comp", F.coalesce("component", "x")).drop("component")
        active = held(_in_windows(labelled))
        active = active.join(active.groupBy("region").agg(F.count("*").alias("size")), "region")
        small = active if turn == ROUNDS else active.filter(F.col("size") <= OUTRIGHT)
        more = [_joined_outright(small.select("region", "x", "comp", "d"), sets)]
        large = active.filter(F.col("size") > OUTRIGHT) if turn < ROUNDS else None
        rest = 0 if large is None else large.count()
        if rest:
            large = large.drop("comp")
            drawn = F.pmod(F.xxhash64("x", "region", F.lit(turn)), F.col("size")) < PIVOTS
            pivots = large.filter(drawn).select("region", F.col("x").alias("p"))
            cells = held(large.select("region", "x").join(pivots, "region").filter("x <> p"))
            dist = held(_distances(cells.select("x", "p").distinct(), sets))
            cells = held(cells.join(dist.select("x", "p", "d", "n"), ["x", "p"]))
            more.append(dist.filter("link").select("x", "p"))
            home = cells.groupBy("region", "x").agg(F.min(F.struct("d", "p")).alias("home"))
            cells = cells.join(home, ["region", "x"]).join(pivots.select("region", F.col("p").alias("x")), ["region", "x"], "left_anti")
            mine = F.col("p") == F.col("home.p")
            window = (F.col("p") < F.col("home.p")) & (F.col("d") <= F.col("home.d") + 2 * E + 1e-9)
            split = held(cells.filter(mine | window))
            grown = split.groupBy("region").agg(F.count("*").alias("cells"), F.countDistinct("x").alias("was"))
            split = split.join(grown, "region")
            # a region that its cells don't divide stays one region, less its pivots
            child = split.filter("cells <= 2 * was").select(F.xxhash64("region", "p").alias("region"), "x", "d", "n")
            whole = split.filter("cells > 2 * was").filter(mine).join(pivots.groupBy("region").agg(F.min("p").alias("one")), "region")
            whole = whole.join(dist.select("x", F.col("p").alias("one"), F.col("d").alias("to_one")), ["x", "one"]).select("region", "x", F.col("to_one").alias("d"), "n")
            # regions for which no pivot was drawn stay as they are
            none = large.select("region", "x", "d", "n").join(pivots.select("region").distinct(), "region", "left_anti")
            members = held(child.unionByName(whole).unionByName(none))
        new = more[0]
        for m in more[1:]:
            new = new.unionByName(m)
        links = held(links.unionByName(new).distinct())
        if not rest:
            break

    for old in used:
        if old is not links:
            drop_cut(old)
    return links


def keep_first(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """docs with one document of each component: the one whose id names it.

    Rows of that id with equal texts are one document; those with different texts stay, as do rows
    without an id.
    """
    kept = similarity_classes(docs, width).filter("doc_id = component_id").select("doc_id").distinct()
    # the ids are dealt out for the join already, so this costs a sort only
    once = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return once.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))
