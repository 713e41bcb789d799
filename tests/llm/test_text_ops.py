"""BPE, chat, mixing, fingerprints, licences and the two classifiers."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskwright.llm import bpe, chat, licenses, mixing, queries, spotsigs, suffixes, textmodel, toxicity
from maskwright.llm.quality import PairwiseRanker
from maskwright.llm.toxicity import ToxicityNet

@pytest.fixture(scope="module")
def P():
    return pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def reference_encoder(P):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(queries.BPE_RANKS), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_reference(spark, reference_encoder, P):
    rng = random.Random(1)
    bits = ["a", "the", "ing", " ", "é", "ß", "漢", "😀", "\n", "  ", "'s", "1", "!!", "aaaa", "Ω", "<|endoftext|>", "tionth", "erhe"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(400)] + [None, "", "ab" * 20000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    rows = bpe.encode_decode(df, P.path(queries.BPE_RANKS), P.PATTERN, keep_ids=True).collect()
    for r in rows:
        text = texts[r["doc_id"]] or ""
        ids = reference_encoder.encode_ordinary(text)
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_small_vocabularies_equal_plain_merges():
    rng = random.Random(5)
    for _ in range(20):
        tokens = [bytes([b]) for b in range(256)]
        while len(tokens) < 290:
            merged = rng.choice(tokens[97:101] + tokens[256:]) + rng.choice(tokens[97:101] + tokens[256:])
            if merged not in tokens and len(merged) < 9:
                tokens.append(merged)
        codec = bpe.BytePairCodec({t: i for i, t in enumerate(tokens)}, r"\w+")
        for _ in range(100):
            piece = bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 30)))
            assert codec.encode_piece(piece) == codec.merge(piece)


def test_chat_round_trip():
    for text in ["", "\\", "\\\\", "### ", "</turn>", r"\### Assistant: </turn> ok", " </turn>\n### user: <turn> x </turn>\n", "a\nb: <turn> c"]:
        for role in ["user", "", "### x: <turn> \\"]:
            made, a, b = chat.format_turn(role, text)
            assert chat.read_turns(made + made) == [(role, text)] * 2
            assert chat.unescape(made[a:b]) == text


def test_chat_layouts():
    m = chat.DEFAULT
    want = [("user", "hi"), ("assistant", "yo")]
    assert m.turns({"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}], "id": 4}) == want
    assert m.turns({"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]}) == want
    assert m.turns({"prompt": "hi", "completion": "yo"}) == want
    assert m.turns({"instruction": "hi", "output": "yo", "input": None}) == want
    assert m.turns({"odd": 1}) is None


def test_chat_query(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (2, 0, None, "### x"), (1, 2, "assistant", "é</turn>"), (None, 0, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.digest_conversations(chat.format_records(chat.turn_records(df))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("user\n\nassistant\nb\nassistant\né</turn>\n") and got[1]["n_turns"] == 3
    assert (got[1]["loss_chars"], got[1]["loss_sha256"]) == (9, sha("bé</turn>"))
    assert got[2]["turns_sha256"] == sha("\n### x\n") and got[2]["loss_chars"] == 0
    assert None in got
    bad = spark.createDataFrame([(1, 0, "{"), (2, 0, '{"odd": 1}')], "conv_id long, turn long, record string")
    assert all(r["problem"] for r in chat.format_records(bad).collect())
    assert chat.digest_conversations(chat.format_records(chat.turn_records(df.limit(0)))).count() == 0


def fill(sizes, weights=(1, 2, 3), cap=3):
    """Targets by repeated sharing out."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in order if s not in capped]
        w = sum(weight[s] for s in rest)
        share = {s: (total - sum(capped.values())) * weight[s] / w for s in rest} if rest else {}
        over = [s for s in rest if share[s] > cap * sizes[s]]
        if not over:
            return {**capped, **share}
        capped |= {s: cap * sizes[s] for s in over}


def test_mixing(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 30, 400])), rng.choice(["a", "a", "a", "b", "c", None]), 0) for i in range(900)]
    rows += [(5000, "x y", "tiny", 0), (5001, None, "empty", 0), (5001, None, "empty", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    got = mixing.mix_plan(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = fill(sizes)
    for s in sizes:
        mine = [r for r in got if r["mix_source"] == s]
        assert all(r["target"] == pytest.approx(want[s]) and r["source_size"] == sizes[s] and r["copies"] <= 3 for r in mine)
        assert abs(sum(r["copies"] * r["size"] for r in mine) - want[s]) <= 2 * max(r["size"] for r in mine) + 1
    assert sorted(map(tuple, mixing.mix_plan(df).collect()), key=str) == sorted(map(tuple, got), key=str)
    docs = mixing.mix_documents(df)
    assert docs.columns == df.columns
    assert docs.count() == sum(r["copies"] for r in got)
    assert mixing.mix_plan(df.limit(0)).count() == 0


def spots(text):
    plain = "".join(c for c in text.lower() if c not in spotsigs.PUNCTUATION)
    w = plain.split()
    stop = set(spotsigs.ANCHORS)
    found = set()
    for i, x in enumerate(w):
        rest = [y for y in w[i + 1 :] if y not in stop][:2]
        if x in stop and len(rest) == 2:
            found.add((x, *rest))
    return found or set(w)


def test_spotsigs(spark):
    rng = random.Random(6)
    vocab = "the of red green der und haus la casa y blue over tree, Stone. river".split()
    texts = {i * 3: " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 90))) for i in range(60)}
    texts |= {500: "", 501: None, 502: "list | of | | list", 503: texts[0], 504: "é漢 the 😀 x y"}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, sigs int")
    got = {r["doc_id"]: r for r in spotsigs.compare_edited(df).collect()}
    ids = sorted(texts, reverse=True)

    def like(a, b):
        a, b = spots(a), spots(b)
        return 1.0 if not a and not b else len(a & b) / len(a | b)

    for k, i in enumerate(ids):
        text, after = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["n_signatures"] == len(spots(text))
        assert r["near_edited"] == pytest.approx(like(text, edited)) and r["near_next"] == pytest.approx(like(text, after))
    assert got[503]["fingerprint"] == got[0]["fingerprint"]
    one = spotsigs.compare_edited(df.filter("doc_id = 3")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert spotsigs.compare_edited(df.limit(0)).count() == 0


def test_spotsigs_of_very_long_texts(spark):
    texts = ["the " * 100_000, "the " * 100_000 + "red house", "house " * 100_000, "the red house " * 50_000 + "of"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["n"] for r in df.select("doc_id", F.size(spotsigs.signatures(F.col("text"))).alias("n")).collect()}
    assert got == {i: len(spots(t)) for i, t in enumerate(texts[:1] + ["the red house"] + texts[2:3] + ["the red house " * 3])}


def test_spotsigs_buckets_and_pairs(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "BUCKET_ROWS", 3)
    df = spark.createDataFrame([(i * i, f"the stone{i} river{i % 7} of tree{i % 5} blue") for i in range(60)], "doc_id long, text string")
    got = {r["doc_id"]: r["next_text"] for r in spotsigs.with_next(df).collect()}
    rows = dict(df.collect())
    ids = sorted(rows, reverse=True)
    assert got == {i: rows[ids[(k + 1) % len(ids)]] for k, i in enumerate(ids)}
    sets = {i: spots(t) for i, t in rows.items()}
    want = {(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.4 * len(sets[a] | sets[b]) and sets[a] != sets[b]}
    assert {(r["a"], r["b"]) for r in spotsigs.near_pairs(df, 0.4).collect()} == want


def test_licenses(spark):
    texts = ["Text.\nReleased under the MIT License.\nMore text here.", "licensed under cc by-nc 4.0", "nothing", "", None, "x " * 50000 + "\n" + licenses.TEMPLATES["GPL-3.0"], licenses.TEMPLATES["MIT-grant"].replace(" the ", "\nthe ")]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, license string")
    got = [r for r in sorted(licenses.scan(df).collect())]
    assert [r["license"] for r in got] == ["MIT", "CC-BY-NC-4.0", None, None, None, "GPL-3.0", "MIT-grant"]
    assert got[0]["dice"] == 1.0 and got[2]["dice"] == 0.0
    assert licenses.scan(df.limit(0)).count() == 0


def brute_scan(text):
    """(licence, Dice, names) by plain sets over lines, whole text and windows."""
    found = []
    whole = licenses.words_of(text or "")
    pieces = [(licenses.words_of(line), None) for line in (text or "").split("\n")] + ([(whole, None)] if "\n" in (text or "") else [])
    for name, template in licenses.TEMPLATES.items():
        n = len(licenses.words_of(template))
        starts = {max(0, i - place) for a, place in licenses.anchors_of(template) for i in range(len(whole) - 1) if f"{whole[i]} {whole[i + 1]}" == a}
        pieces += [(whole[k : k + n], name) for k in starts]
    for w, only in pieces:
        b = {f"{x} {y}" for x, y in zip(w, w[1:])}
        for name, template in licenses.TEMPLATES.items():
            t = set(licenses.bigrams_of(template))
            if b and only in (None, name) and 2 * len(b & t) / (len(b) + len(t)) >= licenses.LEAST:
                found.append((-2 * len(b & t) / (len(b) + len(t)), name))
    return (min(found)[1] if found else None, -min(found)[0] if found else 0.0, ",".join(sorted({n for _, n in found})), len(found))


def test_licenses_wrapped_and_within_lines(spark):
    rng = random.Random(3)
    filler = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 8))) for _ in range(n))
    wrapped = lambda t, k: "\n".join(" ".join(t.split()[i : i + k]) for i in range(0, len(t.split()), k))
    names = list(licenses.TEMPLATES)
    texts = [f"{filler(300)}\n# {wrapped(licenses.TEMPLATES[n], 9)}\n{filler(400)}" for n in names]
    texts += [f"{filler(200)} {licenses.TEMPLATES[n]} {filler(250)}" for n in names]
    texts += [licenses.TEMPLATES["MIT-text"].replace("Software", "Program"), f"{filler(60)} permission notice {filler(60)}", "permission notice", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted(licenses.scan(df).collect())
    for r, t in zip(got, texts):
        name, dice, every, n = brute_scan(t)
        assert (r["license"], r["licenses"], r["n_matches"]) == (name, every, n) and r["dice"] == pytest.approx(dice)
    for k, n in enumerate(names):
        assert n in got[k]["licenses"].split(",") and n in got[k + len(names)]["licenses"].split(",")


def test_license_bounds():
    for n in range(1, 60):
        lo, hi = licenses.bounds(n)
        ok = [k for k in range(1, 400) if 2 * min(k, n) / (k + n) >= licenses.LEAST]
        assert (lo, hi) == (min(ok), max(ok))


def test_folds(spark):
    got = spark.range(200).select("id", textmodel.fold(F.col("id"), 4).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 4 for r in got)


def auc(s, y):
    rank = np.argsort(np.argsort(s)) + 1.0
    p = y == 1
    return (rank[p].sum() - p.sum() * (p.sum() + 1) / 2) / p.sum() / (~p).sum()


@pytest.mark.parametrize("query,modulus,fold,label,least", [("op4_toxicity", 4, 2, "toxic", 0.85), ("op9_quality", 3, 1, "quality", 0.95)])
def test_classifiers_on_held_out_rows(spark, query, modulus, fold, label, least):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in getattr(queries, query)(spark, sf).collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % modulus == fold) and 0 <= r["score"] <= 1 for i, r in rows.items())
    held = [(rows[r["doc_id"]]["score"], r[label]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r["doc_id"]]["held_out"]]
    assert auc(np.array([s for s, _ in held]), np.array([y for _, y in held])) > least


def test_tabulated_scores_are_the_networks():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(120)]
    rows = []
    for i in range(160):
        words = [rng.choice(vocab) for _ in range(rng.randint(1, 40))] + (["Vile,", "slur"] if i % 3 == 0 else [])
        rows.append((" ".join(words), int(i % 3 == 0), "en"))
    net = ToxicityNet().fit(rows, 0.3)
    texts = [r[0] for r in rows[:40]] + ["", None, "unseen qqq zzz", "a", "(vile) slur!!"]
    column = textmodel.as_column(texts)
    plain = []
    for t in texts:
        words, _ = toxicity.word_rows(*textmodel.text_bytes(textmodel.as_column([t])))
        plain.append(float(net._pool(words)[0] @ net.out + net.out_bias))
    assert np.allclose(net._raw(column), plain, atol=1e-3)
    assert np.allclose(net.slim().score(column), 1 / (1 + np.exp(-np.clip(net.scale[0] * np.array(plain) + net.scale[1], -30, 30))), atol=1e-3)


def test_models_take_anything():
    column = textmodel.as_column(["", None, "w " * 30000, "éé"])
    rows = [("bad idiot text " * 5, 1, "en"), ("fine calm text " * 5, 0, "en")] * 60
    for model in (ToxicityNet().fit(rows, 0.5), PairwiseRanker().fit(rows, 0.5), ToxicityNet().fit([], 0.0), PairwiseRanker().fit([], 0.0)):
        s = model.score(column)
        assert len(s) == 4 and np.isfinite(s).all() and s[0] == s[1]


def test_pipeline_columns(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert re.fullmatch(r"\w+", name)


def test_pipeline_against_brute_force(spark, sf_dir, reference_encoder):
    """Every stage on what the one before kept, held against plain Python; run() gives the same rows."""
    from collections import Counter

    import corpus_pipeline
    from maskwright.llm.common import cut, table
    from tests.llm.test_pairs import Forest, brute_repeats, kept_bytes

    docs = table(spark, sf_dir, "documents")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(cut(stage(spark, tables[-1], sf_dir)))
    given, clean, one, cut_, mixed = ([tuple(r) for r in t.collect()] for t in tables[:5])
    key = lambda r: repr(r)

    net = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scores = net.score(textmodel.as_column([r[1] for r in given]))
    limits = net.thresholds
    assert sorted(clean, key=key) == sorted((r for r, s in zip(given, scores) if s < limits.get(r[2], limits[None])), key=key)

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, forest = {}, Forest()
    for r in clean:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(lower))
        sets[r[0]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) > 0:
                forest.join(a, b)
    roots = {i: forest.find(i) for i in sets}
    least = {root: min(i for i in roots if roots[i] == root) for root in set(roots.values())}
    assert sorted(one, key=key) == sorted((r for r in clean if least[roots[r[0]]] == r[0]), key=key)

    raw, gone = brute_repeats([r[1] for r in one], suffixes.PASSAGE)
    left = [(r[0], k.decode("utf-8", "ignore")) for r, k in zip(one, kept_bytes(raw, gone))]
    assert sorted((r[0], r[1] or "") for r in cut_) == sorted(left)
    assert all(r[4] == len(r[1] or "") for r in cut_)

    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(tables[3]).collect()}
    assert Counter(mixed) == Counter({r: copies[r[0]] for r in cut_ if copies[r[0]]})

    done = tables[5].collect()
    texts = {r[0]: r[1] or "" for r in mixed}
    assert Counter(r["doc_id"] for r in done) == Counter(r[0] for r in mixed)
    for r in done:
        ids = reference_encoder.encode_ordinary(texts[r["doc_id"]])
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert Counter(map(repr, corpus_pipeline.run(spark, sf_dir).collect())) == Counter(map(repr, done))


@pytest.mark.parametrize("name", ["op1_ngram_jaccard", "op2_embedding_neardup", "op3_suffix_dedup", "op5_mixing", "op7_chat_format", "op10_license_scan"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    import duckdb

    from maskwright.llm.sql import ORACLES

    db = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    want = db.execute(ORACLES[name])
    names = sorted(d[0] for d in want.description)
    order = [[d[0] for d in want.description].index(n) for n in names]
    got = getattr(queries, name)(spark, sf_dir)
    assert sorted(got.columns) == names
    assert sorted(map(repr, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(repr, (tuple(r[i] for i in order) for r in want.fetchall())))


def test_mix_keeps_columns_of_any_name_and_comes_near_its_targets(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(["w"] * (rng.randint(1, 60) if i % 50 else 900)), f"s{i % 3}" if i % 7 else None, "keepme", i, "a", 2) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_source string, mix_row long, `a.b` string, size int")
    out = mixing.mix_documents(df)
    assert out.columns == df.columns
    got = out.collect()
    plan = {r["doc_id"]: r for r in mixing.mix_plan(df).collect()}
    by_id = {r[0]: r for r in rows}
    taken: dict = {}
    for r in got:
        assert tuple(r) == by_id[r["doc_id"]]
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
    for r in plan.values():
        assert abs(taken[r["mix_source"]] / r["target"] - 1) < 0.02 and 0 <= r["copies"] <= 3
    assert sum(r["copies"] for r in plan.values()) == len(got)


def test_chat_layouts_say_the_same(spark):
    rows = [(i, t, r, x, "clash") for i in range(40) for t, (r, x) in enumerate([("system", "be <turn> good"), ("user", "\\### hi"), ("assistant", None), ("human", "a"), ("gpt", ""), (None, "b"), ("user", "é漢😀"), ("assistant", "c </turn>\n")])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    records = chat.mixed_records(df)
    marks = {chat.DEFAULT.of(__import__("json").loads(r["record"])) for r in records.collect()}
    assert len(marks) >= 7
    done = chat.format_records(records)
    assert done.filter("problem IS NOT NULL").count() == 0
    got = [tuple(r)[1:] for r in chat.digest_conversations(done).collect()]
    plain = [tuple(r)[1:] for r in chat.digest_conversations(chat.format_records(chat.turn_records(df))).collect()]
    assert len(got) == 40 and set(got) == set(plain) and len(set(got)) == 1
    assert chat.digest_conversations(chat.format_records(chat.mixed_records(df.limit(0)))).count() == 0
