"""Words, shingles, components."""

import re

import numpy as np
import pyarrow as pa
import pytest

from maskwright.llm import common

TEXTS = ["", None, "  \n", "One two", "a b c d e", "A b C d e f g a b c d e", "x y z　w q r", "é ü 漢字 ñ \t b\x0bc \r d", "w " * 5000]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_shingles_equal_brute_force():
    got = common.shingles(pa.array(TEXTS, pa.string()))
    sets = [shingle_set(t) for t in TEXTS]
    assert [len(g) for g in got] == [len(s) for s in sets]
    for a in range(len(TEXTS)):
        for b in range(len(TEXTS)):
            assert len(np.intersect1d(got[a], got[b])) == len(sets[a] & sets[b])


@pytest.mark.parametrize("local", [0, 1000])
def test_components(spark, local):
    edges = [(5, 4), (4, 3), (9, 8), (8, 7), (7, 9), (20, 3), (3, 20), (6, 6), (30, 31), (31, 32), (32, 33), (33, 34), (34, 35)] + [(100, 100 + k) for k in range(1, 50)]
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long"), local=local).collect()}
    want = {5: 3, 4: 3, 3: 3, 20: 3, 9: 7, 8: 7, 7: 7} | dict.fromkeys(range(30, 36), 30) | dict.fromkeys(range(100, 150), 100)
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long"), local=local).count() == 0
