"""Toxicity by a convolutional text classifier, trained in numpy.

Words (whitespace-separated, A-Z lowered, also once without punctuation at their ends) are hashed
into an embedding table; filters of several widths run over the embeddings and each filter's
largest value over the whole text goes into a logistic layer. Training takes a bounded sample of
labelled documents (SAMPLE), scoring takes every word of every text. As a filter of width w is a
sum of w products of an embedding with a slice of the filter, those products are tabulated per
table row before scoring, so each word costs a few additions.

Scores are probabilities that label 1 holds. `thresholds` holds one per language, calibrated on
the sample to catch the given share of toxic documents (a language with few labels has the common
one). They're part of decisions (filter_toxic) only: language is never an input of a score.

Null and empty texts are scored like a text without words (the network's bias). Texts of any length
are scored whole, a few MB of words at a time per text. Repeated rows and
ties score alike; rows without an id are scored and never held out. Without labels of both kinds, as with empty tables, every score is 0. An
empty table of documents gives no rows. Further columns are ignored by score_documents() and kept
by filter_toxic(), whatever their names; a missing or null lang has the common threshold.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm import textmodel

#: Most labelled documents that the network is fitted on.
SAMPLE = 4000
ROWS = 1 << 16
#: A word is the sum of the table rows of itself and of its first so many bytes.
PARTS = (1 << 30, 4, 5)
DIM = 12
INIT = 0.02
WIDTHS = (1, 2, 3)
FILTERS = 10
EPOCHS = 10
#: Table rows that fewer documents of the sample have are not learned.
LEAST_DOCS = 3
RARE = 0
THRESHOLD = 0.3
MODULUS, HELD_OUT = 4, 2
_PUNCT = np.zeros(256, bool)
_PUNCT[[ord(c) for c in ".,;:!?\"'()[]{}*#%&$<>-_"]] = True


def word_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all words (one column per part), and where each text's words begin.

    Punctuation at a word's ends is not part of it. The parts are the word and its first bytes, by
    which inflected forms of a stem share what is learned.
    """
    starts, ends, first = textmodel.word_spans(data, offsets)
    for _ in range(3):
        longer = ends - starts > 1
        starts = starts + (longer & _PUNCT[data[np.minimum(starts, max(len(data) - 1, 0))]])
        longer = ends - starts > 1
        ends = ends - (longer & _PUNCT[data[np.maximum(ends - 1, 0)]])
    prefix = textmodel.prefix_hash(data, textmodel._LOWER)
    parts = []
    for k, most in enumerate(PARTS):
        h = textmodel.span_hash(prefix, starts, np.minimum(ends, starts + most)) + np.uint64(0x9E3779B97F4A7C15 * k % 2**64)
        parts.append(textmodel.mix(h) & np.uint64(ROWS - 1))
    return np.stack(parts, axis=1).astype(np.int64), first


class ToxicityNet:
    """Embedding -> convolutions -> max over the text -> logistic layer."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.emb = rng.normal(0, INIT, (ROWS, DIM))
        self.conv = [rng.normal(0, 0.3, (w, DIM, FILTERS)) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS) for _ in WIDTHS]
        self.out = rng.normal(0, 0.1, len(WIDTHS) * FILTERS)
        self.out_bias = 0.0
        self.thresholds: dict[str | None, float] = {None: THRESHOLD}
        self.tables = self.rows_of = None
        self.scale = (1.0, 0.0)
        self.empty = False

    # -- training

    def fit(self, rows: list[tuple[str, int, str | None]], rate: float, seed: int = 0, share: float = 0.9) -> ToxicityNet:
        y = np.array([r[1] for r in rows], float)
        if len(y) == 0 or y.min() == y.max():
            self.empty = True
            return self
        docs = []
        for text, _, _ in rows:
            column = textmodel.as_column([text])
            docs.append(word_rows(*textmodel.text_bytes(column))[0])
        # table rows that few of the documents have stay zero: they'd only add noise to the maxima
        seen = np.zeros(ROWS, np.int64)
        for words in docs:
            seen[np.unique(words)] += 1
        self.emb[seen < LEAST_DOCS] = 0
        docs = [np.where(seen[words] < LEAST_DOCS, RARE, words) for words in docs]
        self.emb[RARE] = 0
        rng = np.random.default_rng(seed)
        held = rng.random(len(docs)) < 0.25  # for calibration only
        # both labels weigh the same, however many documents have them
        weight = 0.5 / (1 - y.mean()), 0.5 / y.mean()
        params = [self.emb, *self.conv, *self.bias, self.out]
        accum = [np.full(p.shape, 0.05) for p in params]
        accum_b = 0.05
        speed = 0.05
        for epoch in range(EPOCHS):
            step = speed * (1 - epoch / (EPOCHS + 2))
            for i in rng.permutation(np.flatnonzero(~held)):
                words = docs[i]
                feats, where = self._pool(words)
                keep = (rng.random(len(feats)) > 0.2) / 0.8
                z = float(feats * keep @ self.out + self.out_bias)
                err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]) * weight[int(y[i])]
                g_out = err * feats * keep + 1e-5 * self.out
                back = err * self.out * keep * (feats > 0)
                accum_b += err * err
                self.out_bias -= step * err / np.sqrt(accum_b)
                accum[-1] += g_out * g_out
                self.out -= step * g_out / np.sqrt(accum[-1])
                for k, w in enumerate(WIDTHS):
                    g = back[k * FILTERS : (k + 1) * FILTERS]
                    pos = where[k]
                    if pos is None or not g.any():
                        continue
                    accum[1 + len(WIDTHS) + k] += g * g
                    self.bias[k] -= step * g / np.sqrt(accum[1 + len(WIDTHS) + k])
                    for j in range(w):
                        at = words[np.minimum(pos + j, len(words) - 1)]  # filters x parts
                        live = pos + j < len(words)
                        e = self.emb[at].sum(1) * live[:, None]
                        g_conv = (e * g[:, None]).T
                        g_emb = (self.conv[k][j] * g[None, :]).T * live[:, None]
                        accum[1 + k][j] += g_conv * g_conv
                        self.conv[k][j] -= step * g_conv / np.sqrt(accum[1 + k][j])
                        for part in at.T:
                            np.add.at(accum[0], part, g_emb * g_emb)
                            np.subtract.at(self.emb, part, step * g_emb / np.sqrt(accum[0][part]))
            self.emb[RARE] = 0
        self._tabulate()
        self._calibrate([r for r, h in zip(rows, held) if h], rate, share)
        return self

    def _calibrate(self, rows, rate: float, share: float) -> None:
        """Scale the scores to the rate of toxic documents among all labels, then set the thresholds.

        A language's threshold keeps the given share of its toxic documents above it, but is not
        below the score at which toxic and clean documents are equally many.
        """
        z = self._raw(textmodel.as_column([r[0] for r in rows]))
        y = np.array([r[1] for r in rows], float)
        if len(y) < 20 or y.min() == y.max():
            return
        weight = np.where(y == 1, rate / y.mean(), (1 - rate) / (1 - y.mean()))
        a, b = 1.0, 0.0
        for _ in range(400):
            err = (1 / (1 + np.exp(-np.clip(a * z + b, -30, 30))) - y) * weight
            a, b = a - 0.2 * float((err * z).mean() / max(1.0, (z * z).mean())), b - 0.5 * float(err.mean())
        self.scale = (a, b)
        scores = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        for lang in {r[2] for r in rows} - {None}:
            s = np.sort(scores[[r[2] == lang and r[1] == 1 for r in rows]])
            if len(s) >= 20:
                self.thresholds[lang] = float(np.clip(s[int((1 - share) * len(s))], THRESHOLD, 0.5))

    def _pool(self, words: np.ndarray):
        feats, where = np.zeros(len(WIDTHS) * FILTERS), []
        if len(words) == 0:
            return feats, [None] * len(WIDTHS)
        e = self.emb[words].sum(1)
        for k, w in enumerate(WIDTHS):
            total = np.zeros((len(words), FILTERS)) + self.bias[k]
            for j in range(min(w, len(words))):
                total[: len(words) - j] += e[j:] @ self.conv[k][j]
            at = total.argmax(0)
            where.append(at)
            feats[k * FILTERS : (k + 1) * FILTERS] = np.maximum(total[at, np.arange(FILTERS)], 0)
        return feats, where

    # -- scoring

    def _tabulate(self) -> None:
        """Tables of the rows that were learned only; rows_of gives a row's place in them, 0 being that of all others."""
        learned = np.flatnonzero(self.emb.any(1))
        self.rows_of = np.zeros(ROWS, np.int32)
        self.rows_of[learned] = np.arange(1, len(learned) + 1)
        emb = np.vstack([np.zeros((1, DIM)), self.emb[learned]])
        self.tables = [[(emb @ c[j]).astype(np.float32) for j in range(len(c))] for c in self.conv]

    def slim(self) -> ToxicityNet:
        """Without what only training needs."""
        self.emb = self.conv = None
        return self

    def _products(self, i: int, j: int, each: np.ndarray) -> np.ndarray:
        found = self.tables[i][j][each[:, 0]]
        for k in range(1, len(PARTS)):
            found = found + self.tables[i][j][each[:, k]]
        return found

    def score(self, column) -> np.ndarray:
        if self.empty:
            return np.zeros(len(column))
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self._raw(column) + b, -30, 30)))

    def _raw(self, column) -> np.ndarray:
        """The logistic layer's sums."""
        out = np.zeros(len(column))
        for k, data, offsets in textmodel.chunks(column):
            rows, first = word_rows(data, offsets)
            rows = self.rows_of[rows].astype(np.int64)
            n = len(offsets) - 1
            feats = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
            full = np.flatnonzero(first[1:] > first[:-1])
            if len(full):
                # words recur: their products are added up once for each distinct one
                _, at, which = np.unique(rows[:, 0] << 32 | rows[:, 1] << 16 | rows[:, 2], return_index=True, return_inverse=True)
                each = rows[at]
                last = np.repeat(first[1:][full], (first[1:] - first[:-1])[full])  # of each word, where its text ends
                for i, w in enumerate(WIDTHS):
                    total = self._products(i, 0, each)[which] + self.bias[i].astype(np.float32)
                    for j in range(1, w):
                        if len(rows) > j:
                            inside = (np.arange(len(rows) - j) + j < last[: len(rows) - j]).astype(np.float32)
                            total[:-j] += self._products(i, j, each)[which[j:]] * inside[:, None]
                    feats[full, i * FILTERS : (i + 1) * FILTERS] = np.maximum(np.maximum.reduceat(total, first[:-1][full], axis=0), 0)
            out[k : k + n] = feats.astype(float) @ self.out + self.out_bias
        return out


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> ToxicityNet:
    return textmodel.fit_on_sample(docs, labels, "toxic", MODULUS, HELD_OUT, limit, lambda rows, rate: ToxicityNet().fit(rows, rate).slim())


def score_documents(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= THRESHOLD) for every document."""
    net = train(docs, labels, limit)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    return textmodel.score_table(docs, lambda column: shared.value.score(column), MODULUS, HELD_OUT, THRESHOLD)


def filter_toxic(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """The documents whose score is below their language's threshold, with all their columns.

    Languages without a threshold of their own use the common one.
    """
    net = train(docs, labels, limit)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index("text"), docs.columns.index("lang") if "lang" in docs.columns else None

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            s = shared.value.score(batch.column(at[0]))
            limits = shared.value.thresholds
            langs = [None] * batch.num_rows if at[1] is None else batch.column(at[1]).to_pylist()
            most = np.array([limits.get(x, limits[None]) for x in langs])
            yield batch.filter(pa.array(s < most))
        textmodel.release()

    return docs.mapInArrow(run, docs.schema)
