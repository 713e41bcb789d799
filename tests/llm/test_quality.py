"""The quality model learns from every labelled row outside the held-out fold."""

import random
import zlib

import numpy as np
import pytest

from maskwright.llm import quality, textmodel


def noisy(n, rng):
    """Rows whose labels go by marks and digits, but not always."""
    rows = []
    for i in range(n):
        good = rng.random() < 0.6
        odd = 0.15 if good else 0.3
        words = [rng.choice(["##", "12", "a1", "%"]) if rng.random() < odd else rng.choice(["tree", "stone", "of", "River,", "going."]) for _ in range(rng.randint(5, 40))]
        rows.append((i, " ".join(words), int(good)))
    return rows


def tables(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")


def held(i):
    return zlib.crc32(str(i).encode()) % quality.MODULUS == quality.HELD_OUT


def test_threshold_is_that_of_all_learned_rows(spark):
    rows = noisy(9000, random.Random(3))
    got = {r["doc_id"]: r for r in quality.score_documents(*tables(spark, rows)).collect()}
    learned = [(got[i], y) for i, _, y in rows if not held(i)]
    assert len(learned) > 5500
    good = sum(y for _, y in learned)
    scores = sorted((r["score"] for r, _ in learned), reverse=True)
    least = min(r["score"] for r, _ in learned if r["predicted"])
    # as many rows are kept as there are good labels, but for rows that tie at the threshold
    assert least == scores[good] and sum(s > least for s in scores) <= good < sum(r["predicted"] for r, _ in learned)
    assert sum(s == least for s in scores) < 30


def test_texts_of_any_length_are_learned_from(spark):
    rng = random.Random(4)
    rows = [(i, " ".join([rng.choice(["tree", "stone", "River,", "of"]) + ("#1" if i % 2 else "") for _ in range(300)]) + " " + "x " * 100_000, 1 - i % 2) for i in range(24)]
    assert all(len(t) > 200_000 for _, t, _ in rows)
    got = {r["doc_id"]: r["score"] for r in quality.score_documents(*tables(spark, rows)).collect()}
    assert min(got[i] for i, _, y in rows if y) > max(got[i] for i, _, y in rows if not y)


def test_model_is_that_of_all_pairs(spark):
    rows = noisy(1500, random.Random(5))
    docs, labels = tables(spark, rows)
    known = [r for r in rows if not held(r[0])]
    x, y = quality.features(textmodel.as_column([r[1] for r in known])), np.array([r[2] for r in known])
    model = quality.train(quality.feature_table(docs), labels)
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.std, x.std(0) + 1e-9)
    for q, found in zip(quality.CUTS, model.cuts):
        exact = np.quantile(x, q, axis=0, method="inverted_cdf")
        assert (found >= exact).all() and (found <= exact + np.abs(exact) / 2000 + 1e-300).all()
    z, s = model.expand(x), model.strength(x, model.w)
    lose = quality.sigmoid(s[y == 0][None, :] - s[y == 1][:, None])
    slope = (lose.sum(0) @ z[y == 0] - lose.sum(1) @ z[y == 1]) / lose.size + quality.RIDGE * model.w
    assert np.abs(slope).max() < 1e-5 and np.abs(model.w).max() > 0.1
    assert model.threshold == np.sort(s)[(y == 0).sum() - 1]
    assert abs(model.scale * s.std() - 1) < 1e-6
    local = quality.PairwiseRanker().fit([r[1:] for r in known], y.mean())
    assert np.allclose(local.w, model.w, atol=1e-5)


@pytest.mark.parametrize("partitions", [1, 40])
def test_partial_sums_are_added_in_levels(spark, monkeypatch, partitions):
    monkeypatch.setattr(quality, "PARTIALS", 3)
    x = np.random.default_rng(8).normal(0, 1, (300, quality.FIGURES))
    rows = spark.createDataFrame([(i % 2, bytearray(r.tobytes())) for i, r in enumerate(x)], "y int, figures binary").repartition(partitions)
    over = quality.over_table(rows)
    counts, sums = over(lambda v, y: (np.bincount(y, minlength=2), v.sum(0)), quality.add)
    assert counts.tolist() == [150, 150] and np.allclose(sums, x.sum(0))
    assert quality.over_table(rows.limit(0))(lambda v, y: (v.sum(0),), quality.add) is None


def test_quantiles_of_any_doubles():
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(0, 1, (500, 3)), np.zeros((60, 3)), [[-1e300, 1e-310, -0.0]]])
    y = (rng.random(len(x)) < 0.3).astype(int)
    weight = np.array([0.5, 2.0])
    found = quality.quantiles(lambda work, merge: merge(work(x[:200], y[:200]), work(x[200:], y[200:])), lambda v: v, 3, (0.01, 0.5, 0.9), weight, 16, 4)
    for c in range(3):
        order = np.argsort(x[:, c], kind="stable")
        below = np.cumsum(weight[y[order]]) / weight[y].sum()
        assert found[c].tolist() == [x[order, c][np.searchsorted(below, q - 1e-9)] for q in (0.01, 0.5, 0.9)]


def test_far_strengths_keep_their_pairs():
    """Sums over partners by the grid equal those by all pairs, with merged parts that lie apart."""
    rng = np.random.default_rng(7)
    s, y = np.concatenate([rng.normal(0, 2, 300), rng.normal(60, 1, 200)]), np.tile([0, 1], 250)
    low, counts, sums = quality.add_counts(quality.strength_counts(s[300:], y[300:]), quality.strength_counts(s[:300], y[:300]))
    got = np.interp(s / quality.NODE, np.arange(counts.shape[1]) + low, quality.from_partners(counts[1], quality.sigmoid, quality.NODE))
    assert np.allclose(got, quality.sigmoid(s[:, None] - s[y == 1][None, :]).sum(1), atol=1e-2)
    assert counts[2:].sum() == 500 and np.allclose(sums, [500, s.sum(), (s * s).sum()])
