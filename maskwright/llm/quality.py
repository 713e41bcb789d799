"""Document quality by Bradley-Terry pairwise ranking.

A document is described by figures of its whole text (kinds of characters, lengths and variety of
words, repeated words and lines, marks attached to words). They are worked out once per document and written as
a narrow table, from which the model is learned and the scores are taken. A weight vector is learned by
logistic loss on the differences of features, as in Bradley and Terry's model, over all pairs of a good and a
poor document: every labelled document outside the held-out fold counts, however many or long they are. A document's strength is its
features times the weights; the threshold is the strength quantile, over those documents weighted to
the labels' own rate, at the rate of poor documents. Scores are the logistic function of the
strength above the threshold, so a score of 0.5 or more means keep.

The pairs are never listed. What a document gets from all partners depends on its strength and on how many
partners have which strength, so a round (Newton's method) takes two passes over the rows: one counts strengths per class on a
grid of NODE, each shared linearly by its two nodes, the other sums gradient and curvature with
functions of strength that are interpolated on that grid (the partners' mean is off by 1e-5 at most). Means, deviations and
quantiles are of all rows, too; the cuts at quantiles are rounded up to 12 binary places, the threshold isn't rounded.

Null and empty texts get the features of an empty text. Texts are never cut. Ties and repeated
rows score alike; rows without an id are scored and never held out. Of an id's repeated labels the greatest counts; all rows of the id
are learned from. Without labels of both kinds, as with empty tables, all scores are 0.5. An
empty table of documents gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm import textmodel
from maskwright.llm.common import cut, drop_cut, release

#: Figures of a text.
FIGURES = 22
#: Strengths are counted on a grid of this width; so many of its cells at least make one of the curvature's.
NODE = 1 / 128
CELLS = 32
#: Weight of the squared weights beside the mean loss of a pair; Newton's rounds end when no weight moves by more than SETTLED.
RIDGE = 1e-3
SETTLED = 1e-6
ROUNDS = 50
CUTS = (0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98)
#: While there are more partial sums than these, tasks add up about so many each before they come to the driver.
PARTIALS = 8
THRESHOLD = 0.5
MODULUS, HELD_OUT = 3, 1
_UPPER, _LOW, _DIGIT, _MARK, _STOP = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = True
_LOW[97:123] = True
_DIGIT[48:58] = True
_MARK[[ord(c) for c in "#$%&*|<>{}[]=+~^\\@_/"]] = True
_STOP[[ord(c) for c in ".,;:!?"]] = True


def features(column) -> np.ndarray:
    """One row of figures per text of an Arrow string column."""
    out = []
    for _, data, offsets in textmodel.chunks(column):
        words, starts, ends, first = textmodel.hashed_words(data, offsets)
        classes = [np.concatenate([[0], np.cumsum(m[data])]) for m in (_UPPER, _LOW, _DIGIT, _MARK, _STOP)]
        high = np.concatenate([[0], np.cumsum(data >= 128)])
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        marked = np.concatenate([[0], np.cumsum(_MARK[data[np.maximum(ends - 1, 0)]])])
        lengths = np.concatenate([[0], np.cumsum(ends - starts)])
        squares = np.concatenate([[0], np.cumsum((ends - starts) ** 2)])
        same = np.zeros(len(words) + 1, np.int64)
        if len(words) > 1:
            same[2:] = np.cumsum(words[1:] == words[:-1])
        for i in range(len(offsets) - 1):
            a, b, f, g = offsets[i], offsets[i + 1], first[i], first[i + 1]
            n, m = max(1, b - a), max(1, g - f)
            _, times = np.unique(words[f:g], return_counts=True)
            top = np.sort(times)[::-1][:10]
            line_share = (lines[b] - lines[a]) / m
            again = 0.0
            if lines[b] - lines[a] > 1:
                parts = data[a:b].tobytes().split(b"\n")
                again = 1 - len(set(parts)) / len(parts)
            mean = (lengths[g] - lengths[f]) / m
            spread = np.sqrt(max(0.0, (squares[g] - squares[f]) / m - mean * mean))
            out.append([
                *[(c[b] - c[a]) / n for c in classes], (high[b] - high[a]) / n,
                (marked[g] - marked[f]) / m, mean, spread, np.log1p(g - f), np.log1p(b - a),
                len(times) / m, len(times) / np.sqrt(m), (top[0] if len(top) else 0) / m, top.sum() / m,
                (same[g] - same[min(f + 1, g)]) / m, line_share, again, m / n, (times == 1).sum() / m,
                float(g - f < 20), float(g - f < 60),
            ])
    return np.array(out, float).reshape(len(column), FIGURES)


def add(a: tuple, b: tuple) -> tuple:
    return tuple(p + q for p, q in zip(a, b))


def sigmoid(t):
    return 1 / (1 + np.exp(-np.clip(t, -700, 700)))


def slope(t):
    return sigmoid(t) * sigmoid(-t)


# --- quantiles of all rows -------------------------------------------------------------------------


def ordered(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the given doubles."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63) == 1, ~bits, bits | np.uint64(1 << 63))


def digit_weights(values: np.ndarray, weight: np.ndarray, prefix: np.ndarray, shift: int, bits: int) -> np.ndarray:
    """Per column, prefix and next digit the weight of the rows that begin so."""
    key = ordered(np.ascontiguousarray(values))
    begin = key >> np.uint64(shift + bits) if shift + bits < 64 else np.zeros_like(key)
    code = ((key >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64) + (np.arange(key.shape[1]) << bits)
    each = np.broadcast_to(weight[:, None], key.shape)
    out = np.zeros((*prefix.shape, 1 << bits))
    for k in range(prefix.shape[1]):
        same = begin == prefix[:, k]
        out[:, k] = np.bincount(code[same], each[same], key.shape[1] << bits).reshape(-1, 1 << bits)
    return out


def quantiles(over, values, columns: int, shares, weight: np.ndarray, bits: int, rounds: int) -> np.ndarray:
    """Per column of values(x) and share the least value at or below which that share of the rows' weight lies.

    weight is that of each label. The value is found digit by digit from its leading bits, a pass each; bits that the rounds
    don't reach are ones.
    """
    prefix, below = np.zeros((columns, len(shares)), np.uint64), np.zeros((columns, len(shares)))
    total = None
    for k in range(1, rounds + 1):
        found = over(lambda x, y: (digit_weights(values(x), weight[y], prefix, 64 - k * bits, bits),), add)[0]
        total = found[0, 0].sum() if total is None else total
        sums = below[..., None] + found.cumsum(-1)
        aim = np.maximum(np.asarray(shares) * total * (1 - 1e-12), 1e-300)
        last = (found > 0).cumsum(-1).argmax(-1)
        digit = np.minimum((sums < aim[None, :, None]).sum(-1), last)
        below += np.where(np.arange(1 << bits) < digit[..., None], found, 0).sum(-1)
        prefix = (prefix << np.uint64(bits)) | digit.astype(np.uint64)
    rest = 64 - rounds * bits
    key = prefix if not rest else (prefix << np.uint64(rest)) | np.uint64((1 << rest) - 1)
    return np.where(key >> np.uint64(63) == 1, key ^ np.uint64(1 << 63), ~key).view(np.float64)


# --- sums over all pairs ---------------------------------------------------------------------------


def strength_counts(s: np.ndarray, y: np.ndarray) -> tuple:
    """First cell, then per cell of the grid: rows of label 0 and 1 shared by neighbouring nodes, rows of label 0 and 1; sums of s."""
    at = s / NODE
    cell = np.floor(at)
    low = int(cell.min())
    part, cell = at - cell, (cell - low).astype(np.int64)
    size = int(cell.max()) + 2
    rows = [y == 0, y == 1]
    shared = [np.bincount(cell[r], 1 - part[r], size) + np.bincount(cell[r] + 1, part[r], size) for r in rows]
    return low, np.array([*shared, *(np.bincount(cell[r], minlength=size) for r in rows)]), np.array([len(s), s.sum(), (s * s).sum()])


def add_counts(a: tuple, b: tuple) -> tuple:
    low = min(a[0], b[0])
    out = np.zeros((4, max(p[0] + p[1].shape[1] for p in (a, b)) - low))
    for p in (a, b):
        out[:, p[0] - low : p[0] - low + p[1].shape[1]] += p[1]
    return low, out, a[2] + b[2]


def from_partners(count: np.ndarray, f, width: float) -> np.ndarray:
    """At each node k the sum of count[j] * f((k - j) * width) over all j."""
    n = len(count)
    size = 1 << (3 * n).bit_length()
    kernel = f(np.arange(1 - n, n) * width)
    return np.fft.irfft(np.fft.rfft(count, size) * np.fft.rfft(kernel, size), size)[n - 1 : 2 * n - 1]


def mean_loss(w: np.ndarray, counts: tuple) -> float:
    poor, good = counts[1][:2]
    return float(good @ from_partners(poor, lambda t: np.logaddexp(0, -t), NODE)) / (good.sum() * poor.sum()) + RIDGE / 2 * float(w @ w)


class PairwiseRanker:
    """Strengths learned from preference pairs."""

    def __init__(self):
        self.w = None

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -4, 4)
        steps = [(x > cut).astype(float) for cut in self.cuts]
        return np.hstack([z, z * z, *steps])

    def strength(self, x: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Row by row, so that equal rows have equal strengths wherever they stand."""
        return (self.expand(x) * w).sum(1)

    def fit(self, rows, rate: float) -> PairwiseRanker:
        """Learn from rows (text, label, ...) at hand; rate is that of label 1 among all labels."""
        y = np.array([r[1] for r in rows], int)
        x = features(textmodel.as_column([r[0] for r in rows]))
        blocks = [(x[k : k + 1000], y[k : k + 1000]) for k in range(0, len(y), 1000)]
        return self.learn(lambda work, merge: functools.reduce(merge, [work(*b) for b in blocks]) if blocks else None, rate)

    def learn(self, over, rate: float) -> PairwiseRanker:
        """over(work, merge) gives work(features, labels) of every block of rows, merged, or None without rows."""
        found = over(lambda x, y: (np.bincount(y, minlength=2).astype(float), x.sum(0)), add)
        if found is None or found[0].min() == 0:
            return self
        labelled, total = found
        mean = total / labelled.sum()
        squares = over(lambda x, y: (((x - mean) ** 2).sum(0),), add)[0]
        self.mean, self.std = mean, np.sqrt(squares / labelled.sum()) + 1e-9
        self.cuts = list(quantiles(over, lambda x: x, FIGURES, CUTS, np.ones(2), 8, 3).T)
        w = np.zeros(FIGURES * (2 + len(CUTS)))
        counts = self.count(over, w)
        for _ in range(ROUNDS):
            move, loss = self.newton(over, w, counts), mean_loss(w, counts)
            for _ in range(20):
                tried = self.count(over, w - move)
                if mean_loss(w - move, tried) <= loss + 1e-5:  # the grid's own error is below that
                    break
                move = move / 2
            w, counts = w - move, tried
            if np.abs(move).max() <= SETTLED:
                break
        n, s, squares = counts[2]
        self.scale = 1 / (np.sqrt(max(0.0, squares / n - (s / n) ** 2)) + 1e-9)
        weight = np.array([1 - rate, rate]) * n / labelled
        self.threshold = float(quantiles(over, lambda x: self.strength(x, w)[:, None], 1, [1 - rate], weight, 16, 4)[0, 0])
        self.w = w
        return self

    def count(self, over, w: np.ndarray) -> tuple:
        return over(lambda x, y: strength_counts(self.strength(x, w), y), add_counts)

    def newton(self, over, w: np.ndarray, counts: tuple) -> np.ndarray:
        """The step that Newton's method takes from w; curvatures are those at coarser cells, so it is never negative."""
        low, (poor, good, poor_rows, good_rows), _ = counts
        pairs = good_rows.sum() * poor_rows.sum()
        # how a row is pulled by all partners: a poor one by the good ones, a good one by the poor ones
        pull = np.array([from_partners(good, sigmoid, NODE), -from_partners(poor, lambda t: sigmoid(-t), NODE)]) / pairs
        step = max(CELLS, -(-len(poor) // 256))
        cell = (low + np.arange(len(poor))) // step - low // step
        cells = int(cell[-1]) + 1
        apart = slope((np.arange(cells)[:, None] - np.arange(cells)) * step * NODE) / pairs
        curve = np.array([apart @ np.bincount(cell, good_rows, cells), apart @ np.bincount(cell, poor_rows, cells)])

        def work(x, y):
            z = self.expand(x)
            at = self.strength(x, w) / NODE
            spot = np.arange(pull.shape[1]) + low
            pulled = np.where(y == 1, np.interp(at, spot, pull[1]), np.interp(at, spot, pull[0]))
            where = np.floor(at).astype(np.int64) // step - low // step
            sums = np.zeros((2 * cells, z.shape[1]))
            code = y * cells + where
            order = np.argsort(code, kind="stable")
            own, first = np.unique(code[order], return_index=True)
            sums[own] = np.add.reduceat(z[order], first, axis=0)
            return pulled @ z, (z * curve[y, where][:, None]).T @ z, sums

        gradient, curvature, sums = over(work, add)
        cross = sums[cells:].T @ apart @ sums[:cells]
        curvature = curvature - cross - cross.T + RIDGE * np.eye(len(w))
        return np.linalg.solve(curvature, gradient + RIDGE * w)

    def score(self, column) -> np.ndarray:
        return self.score_figures(features(column))

    def score_figures(self, x: np.ndarray) -> np.ndarray:
        if self.w is None:
            return np.full(len(x), 0.5)
        s = (self.strength(x, self.w) - self.threshold) * self.scale
        return 1 / (1 + np.exp(-np.clip(3 * s, -30, 30)))


# --- tables ----------------------------------------------------------------------------------------


def figures(column) -> np.ndarray:
    """The features that a binary Arrow column holds."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, FIGURES)


def feature_table(docs: DataFrame) -> DataFrame:
    """doc_id and features (as bytes) of every document; a written table."""

    def run(batches):
        for batch in batches:
            x = features(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "figures"])
        release()

    return cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, figures binary"))


def over_table(rows: DataFrame):
    """The passes of learn() over a table (y, figures). Partial sums are added in the order of their bytes, which is the same on every run."""
    many = rows.rdd.getNumPartitions()

    def over(work, merge):
        def run(batches):
            found = None
            for batch in batches:
                if batch.num_rows:
                    part = work(figures(batch.column(1)), batch.column(0).to_numpy().astype(np.int64))
                    found = part if found is None else merge(found, part)
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], ["part"])
            del found
            release()

        def gather(batches):
            found = sorted(p for batch in batches for p in batch.column(0).to_pylist())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(functools.reduce(merge, map(pickle.loads, found)))], pa.binary())], ["part"])

        parts, left = rows.mapInArrow(run, "part binary"), many
        while left > PARTIALS:
            left = -(-left // PARTIALS)
            parts = parts.repartition(left).mapInArrow(gather, "part binary")
        found = sorted(bytes(r[0]) for r in parts.collect())
        return functools.reduce(merge, map(pickle.loads, found)) if found else None

    return over


def train(table: DataFrame, labels: DataFrame) -> PairwiseRanker:
    """Learn from all labelled rows of a feature_table() outside the held-out fold."""
    usable = F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (textmodel.fold(F.col("doc_id"), MODULUS) != HELD_OUT)
    known = labels.filter(usable).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("y"))
    rate = known.agg(F.avg(F.col("y").cast("double"))).first()[0] or 0.0
    rows = cut(table.join(known, "doc_id").sortWithinPartitions("doc_id", "figures").select("y", "figures"))
    model = PairwiseRanker().learn(over_table(rows), rate)
    drop_cut(rows)
    return model


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= THRESHOLD) for every document."""
    table = feature_table(docs)
    shared = docs.sparkSession.sparkContext.broadcast(train(table, labels))
    return textmodel.score_table(table, lambda column: shared.value.score_figures(figures(column)), MODULUS, HELD_OUT, THRESHOLD, "figures")
