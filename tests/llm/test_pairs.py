"""Jaccard join, embedding near-duplicates and repeated passages against brute force."""

import hashlib
import random

import numpy as np
import pytest

from maskwright.llm import jaccard, neardup, suffixes

from .test_words import shingle_set


class Forest(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def near_texts(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    common = [rng.choice(vocab) for _ in range(60)]
    texts = []
    for _ in range(n):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, 120))]
        if rng.random() < 0.4:
            base = common[: rng.randint(20, 60)] + base[: rng.randint(1, 30)]
        texts.append(base)
        for _ in range(rng.choice([0, 0, 1, 4])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts.append(copy)
    return [" ".join(t) for t in texts]


def check_jaccard(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, set_id string, x int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similarity_classes(df).collect()}
    sets = {r[0]: shingle_set(r[1]) for r in rows}
    f = Forest()
    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                f.join(i, j)
    assert got == {i: (len(sets[i]), f.find(i)) for i in ids}


def test_jaccard_join(spark):
    texts = near_texts(1, 120) + ["", None, "   ", "a b", "A  b", "w " * 3000, "w " * 3001]
    check_jaccard(spark, [(i, t, "clash", 1) for i, t in enumerate(texts)])


def test_jaccard_join_recursive(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    monkeypatch.setattr(jaccard, "OUTRIGHT", 4)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(jaccard, "BUCKET_TOKENS", 300)
    check_jaccard(spark, [(i, t, "clash", 1) for i, t in enumerate(near_texts(7, 60))])


def test_jaccard_join_with_buckets_below_the_top_bits(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TOP_BITS", 3)
    monkeypatch.setattr(jaccard, "TOPS", 8)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(jaccard, "BUCKET_TOKENS", 40)
    check_jaccard(spark, [(i, t, "clash", 1) for i, t in enumerate(near_texts(11, 50))])


def test_jaccard_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.similarity_classes(df).count() == 0


def test_jaccard_repeated_rows_and_keep_first(spark):
    rows = [(3, "a b c d e f g"), (3, "a b c d e f g"), (5, "a b c d e f g"), (7, "other words here"), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["component_id"] for r in jaccard.similarity_classes(df).collect()) == [3, 3, 3, 7, 8]
    assert sorted(r["doc_id"] for r in jaccard.keep_first(df).collect()) == [3, 7, 8]


def check_vectors(spark, rows, recall=0.95):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, label int")
    got = {r["vec_id"]: r for r in neardup.near_duplicates(df).collect()}
    ok = {i: np.array(v, np.float32).astype(float) for i, v, *_ in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    f, links = Forest(), dict.fromkeys((r[0] for r in rows), 0)
    for i in ok:
        for j in ok:
            if i != j and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] / np.linalg.norm(ok[i]) / np.linalg.norm(ok[j]) >= 0.9:
                links[i] += 1
                f.join(i, j)
    assert all(got[i]["n_links"] <= links[i] for i in links)
    assert sum(r["n_links"] for r in got.values()) >= recall * sum(links.values())
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())
    return got, links, f


def test_vectors(spark):
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for _ in range(40):
        v = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 6))):
            rows.append((i, [float(x) for x in v + rng.normal(0, 0.05, 16)], 0, 1))
            i += 1
    same = [float(x) for x in rng.normal(size=16)]
    rows += [(i + k, same, 0, 1) for k in range(5)]
    rows += [(900, None, 0, 1), (901, [], 0, 1), (902, [0.0] * 16, 0, 1), (903, [float("nan")] * 16, 0, 1), (904, [None] + [1.0] * 15, 0, 1), (905, [1.0, 2.0], 0, 1), (906, [2.0, 4.0], 0, 1)]
    got, links, f = check_vectors(spark, rows)
    for k in range(900, 905):
        assert got[k]["n_links"] == 0 and got[k]["component_id"] == k
    assert got[906]["component_id"] == 905
    assert all(got[i + k]["n_links"] == 4 for k in range(5))


def test_vectors_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "SMALL", 6)
    rng = np.random.default_rng(5)
    v = rng.normal(size=24)
    rows = [(k, [float(x) for x in v + rng.normal(0, 0.12, 24)], 0, 1) for k in range(90)]
    got, links, f = check_vectors(spark, rows)
    assert len({r["component_id"] for r in got.values()}) == len({f.find(k) for k in range(90)})
    assert neardup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    at = {}
    for d, b in enumerate(raw):
        for s in range(len(b) - length + 1):
            at.setdefault(b[s : s + length], []).append((d, s))
    gone = [np.zeros(len(b), bool) for b in raw]
    for found in at.values():
        if len(found) > 1:
            for d, s in found:
                gone[d][s : s + length] = True
    return raw, gone


def repeat_texts():
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice("abcdefgh é漢") for _ in range(n))
    passage, passage2 = letters(900), letters(450)
    texts = [letters(rng.randint(0, 300)) + passage + letters(rng.randint(0, 300)) for _ in range(12)]
    texts += [letters(500) + passage2[: rng.randint(300, 450)] + letters(100) for _ in range(8)]
    copy = letters(700)
    texts += [copy, copy, copy, "short", "short", "", None, "ab" * 600, "x" * 1500, "Is it. " * 200, letters(390)]
    return texts


def kept_bytes(raw, gone):
    return [np.frombuffer(b, np.uint8)[~g].tobytes() for b, g in zip(raw, gone)]


def check_repeats(spark, rows, schema="doc_id long, text string"):
    """Digests by LENGTH and PASSAGE, and the texts left by PASSAGE, against every string of these lengths."""
    texts = [r[1] for r in rows]
    raw, gone = brute_repeats(texts, suffixes.LENGTH)
    _, shared = brute_repeats(texts, suffixes.PASSAGE)
    df = spark.createDataFrame(rows, schema)
    runs = [int(np.diff(np.concatenate([[0], g.astype(int)])).clip(0).sum()) for g in gone]
    want = [(r[0], len(b), int(g.sum()), n, hashlib.sha256(k).hexdigest(), int(h.sum())) for r, b, g, n, k, h in zip(rows, raw, gone, runs, kept_bytes(raw, gone), shared)]
    got = [tuple(r) for r in suffixes.repeat_digests(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    out = suffixes.remove_repeats(df)
    assert out.columns == df.columns
    left = [(r[0], *r[2:], k.decode("utf-8", "ignore")) for r, k in zip(rows, kept_bytes(raw, shared))]
    assert sorted(((r[0], *r[2:], r[1] or "") for r in out.collect()), key=repr) == sorted(left, key=repr)


@pytest.mark.parametrize("buffer,step", [(400_000, 32), (2_000, 8), (500, 4)])
def test_repeats(spark, monkeypatch, buffer, step):
    monkeypatch.setattr(suffixes, "BUFFER", buffer)
    monkeypatch.setattr(suffixes, "BATCH", 3 * buffer)
    monkeypatch.setattr(suffixes, "STEP", step)
    check_repeats(spark, [(i, t, 1, "k", i, "m") for i, t in enumerate(repeat_texts())], "doc_id long, text string, h int, tkey string, mw_id int, mw_kept string")


def test_repeats_of_rows_with_null_and_repeated_ids(spark):
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared, again, other, copy = letters(600), letters(500), letters(700), letters(800)
    rows = [(None, letters(90) + shared), (1, shared + letters(120)), (None, again + letters(50) + again), (None, letters(900))]
    rows += [(2, letters(30) + other), (2, letters(1500)), (2, other + letters(400)), (3, letters(450)), (None, copy), (None, copy), (None, letters(40) + copy)]
    rows += [(3, letters(10) + letters(500)), (None, None), (None, "short")]
    check_repeats(spark, rows)


def test_passages_shorter_than_the_digest_length(spark):
    rng = random.Random(9)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    p = letters(320)
    rows = [(i, letters(200 + i) + p + letters(210 - i)) for i in range(9)] + [(20, letters(249)), (21, letters(100) + "z" + p[40:280] + "z" + letters(100))]
    check_repeats(spark, rows)
    got = {r["doc_id"]: r for r in suffixes.repeat_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i]["n_removed"] == 0 and 320 <= got[i]["n_shared"] < 330 for i in range(9)) and got[21]["n_shared"] == 0


def test_repeats_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.repeat_digests(df).count() == 0


def test_suffix_array():
    rng = random.Random(2)
    for k in range(60):
        b = bytes(rng.choice([97, 98, 99, 255, 32]) for _ in range(rng.randint(0, 200))) if k % 3 else (b"ab" * 50 + b"aaaa" * 10 + b"b") * 2
        order = suffixes.suffix_array(np.frombuffer(b, np.uint8), 1000)
        assert order.tolist() == sorted(range(len(b)), key=lambda i: b[i:])


def prose(seed, n_bytes):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    return " ".join(rng.choice(vocab) for _ in range(n_bytes // 6)).encode()


@pytest.mark.parametrize("lengths", [(suffixes.PASSAGE, suffixes.LENGTH), (suffixes.PASSAGE, suffixes.PASSAGE)])
def test_sorting_runs_takes_little_memory(lengths):
    """A batch of runs as large as a task sorts at once: executors run two such tasks beside a heap."""
    import tracemalloc

    rng, text = random.Random(3), prose(3, 2_000_000)
    contents, counts = [], []
    while sum(counts) < 150_000:
        n = rng.randint(20, 150)
        a = rng.randrange(len(text) - 600)
        contents.append(text[a : a + n + max(lengths) - 1])
        counts.append(n)
    suffixes.repeated_starts(contents, lengths, counts)  # tables of powers stay
    tracemalloc.start()
    try:
        suffixes.repeated_starts(contents, lengths, counts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40 * sum(map(len, contents))


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_wanted_starts_against_sets(monkeypatch, chunk):
    from collections import Counter

    monkeypatch.setattr(suffixes, "CHUNK", chunk)
    rng = random.Random(chunk)
    for _ in range(60):
        letters = rng.choice([b"a", b"ab", b"abc\xc3\xa9", b"\x00\x01\xfe"])
        contents = [bytes(rng.choice(letters) for _ in range(rng.randint(4, 40))) for _ in range(rng.randint(1, 6))]
        counts = [rng.randint(0, len(c) - 3) for c in contents]
        found = suffixes.repeated_starts(contents, (4, 6), counts)
        for length, got in zip((4, 6), found):
            starts = [[s for s in range(n) if s + length <= len(c)] for c, n in zip(contents, counts)]
            times = Counter(c[s : s + length] for c, own in zip(contents, starts) for s in own)
            assert [x.tolist() for x in got] == [[s for s in own if times[c[s : s + length]] > 1] for c, own in zip(contents, starts)]
