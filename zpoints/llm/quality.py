"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature has a lookup table over its bins, and a few chosen pairs of
features have tables over pairs of coarse bins. The tables are learned by
cyclic boosting: round after round, each feature in turn gets a shallow tree
(three cuts at most) fitted to the current gradient, whose leaf values are
added to its table; then the pairs in turn get two-by-two trees. A text's
score is the logistic function of the sum of its table entries, so scoring is
a few vectorised look-ups and additions per row.

Features are language-neutral statistics of the whole text. Tables are fitted
on the driver from a bounded sample of labelled rows (``max_labelled``); only
their numeric features reach it. Texts are scored where they lie, without a shuffle.

Defined cases: a null text is the empty text, and an empty text has all
statistics zero and gets the model's score for that; rows are scored one by
one, so repeated rows and null ids are scored like any other; without labels of
both classes the model scores 0.5 everywhere; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import DOUBLE, LONG, held_out, labelled_sample, schema

FEATURES = ("log_words", "log_chars", "word_length", "longest_word", "upper", "letters", "digits", "stops", "marks",
            "symbols", "bars", "bangs", "distinct_words", "distinct_pairs", "equal_neighbours", "top_word",
            "capitalised", "short_words", "line_words", "repeated_lines", "one_word_lines")

_KIND = np.zeros(256, np.int64)  # 0 other, 1 upper, 2 lower or beyond ASCII, 3 digit, 4 .,;: 5 symbol 6 | 7 ! 8 quote or dash
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[192:] = 1, 2, 3, 2
for _c, _k in ((b".,;:?", 4), (b"#$%&*+/<=>@[]\\^_`{}~", 5), (b"|", 6), (b"!", 7), (b"'\"()-", 8)):
    _KIND[list(_c)] = _k


def features(text: str) -> list[float]:
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    kind = np.bincount(_KIND[raw], minlength=9)
    letters = max(int(kind[1] + kind[2]), 1)
    solid = max(sum(map(len, words)), 1)
    count = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split("\n") if x.strip()]
    firsts = [w[0] for w in words]
    return [
        math.log1p(n), math.log1p(len(text)), solid / n, min(max(map(len, words)), 200),
        kind[1] / letters, letters / solid, kind[3] / solid, kind[4] / n, kind[8] / n,
        kind[5] / solid, kind[6] / n, kind[7] / n, len(count) / n, pairs / max(n - 1, 1),
        sum(map(str.__eq__, words, words[1:])) / n, max(count.values()) / n,
        sum(map(str.isupper, firsts)) / n, sum(len(w) <= 3 for w in words) / n,
        math.log1p(n / max(len(lines), 1)), 1 - len(set(lines)) / max(len(lines), 1),
        sum(" " not in x.strip() for x in lines) / max(len(lines), 1),
    ]


@dataclass
class Model:
    """edges[j]: inner bin edges of feature j; main[j]: its table; pairs: (i, j, table over coarse bins)."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    base: float
    main: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.main):
            total += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        wide = {j: np.searchsorted(self.coarse[j], x[:, j], side="right") for p in self.pairs for j in p[:2]}
        for i, j, table in self.pairs:
            total += table[wide[i], wide[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    """Inner edges between quantiles: midpoints of neighbouring distinct values, at most bins - 1."""
    q = np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1], method="nearest"))
    distinct = np.unique(v)
    at = np.searchsorted(distinct, q)
    return np.unique([(distinct[k] + distinct[k + 1]) / 2 for k in at if k + 1 < len(distinct)])


def _segments(g: np.ndarray, h: np.ndarray, least: float, ridge: float) -> np.ndarray:
    """Leaf values per bin of the best tree of depth two over ordered bins with gradients g and hessians h."""
    def best_cut(lo, hi):
        gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
        if not len(gl):
            return None
        gs, hs = g[lo:hi].sum(), h[lo:hi].sum()
        gain = gl**2 / (hl + ridge) + (gs - gl)**2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
        gain[(hl < least) | (hs - hl < least)] = -1.0
        k = int(np.argmax(gain))
        return lo + k + 1 if gain[k] > 1e-9 else None

    cuts = [0, len(g)]
    first = best_cut(0, len(g))
    if first is not None:
        cuts += [first, *[c for c in (best_cut(0, first), best_cut(first, len(g))) if c is not None]]
    cuts = sorted(cuts)
    out = np.zeros(len(g))
    for lo, hi in zip(cuts, cuts[1:]):
        out[lo:hi] = -g[lo:hi].sum() / (h[lo:hi].sum() + ridge)
    return out - (out * h).sum() / max(h.sum(), 1e-12)


def _quadrants(g: np.ndarray, h: np.ndarray, least: float, ridge: float) -> tuple[np.ndarray, float]:
    """The best two-by-two tree over a table of coarse bins: its leaf values per cell, and its gain."""
    gc, hc = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    gt, ht = gc[-1, -1], hc[-1, -1]
    a, b = gc[:-1, :-1], hc[:-1, :-1]
    parts = [(a, b), (gc[:-1, -1:] - a, hc[:-1, -1:] - b), (gc[-1:, :-1] - a, hc[-1:, :-1] - b)]
    parts.append((gt - a - parts[1][0] - parts[2][0], ht - b - parts[1][1] - parts[2][1]))
    gain = sum(np.where(q > 0, p**2 / (q + ridge), 0.0) for p, q in parts) - gt**2 / (ht + ridge)
    out = np.zeros_like(g)
    if not gain.size:
        return out, 0.0
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    for (p, q), where in zip(parts, (np.s_[:i + 1, :j + 1], np.s_[:i + 1, j + 1:], np.s_[i + 1:, :j + 1],
                                     np.s_[i + 1:, j + 1:])):
        if q[i, j] >= least:
            out[where] = -p[i, j] / (q[i, j] + ridge)
    return out, float(gain[i, j])


def fit(x: np.ndarray, y: np.ndarray, *, bins: int = 48, coarse_bins: int = 8, rounds: int = 120, pair_rounds: int = 40,
        n_pairs: int = 6, rate: float = 0.15, least: float = 2.0, ridge: float = 1.0) -> Model:
    """Cyclic boosting of the main tables, then of the ``n_pairs`` pairs whose first tree gains most."""
    d = x.shape[1]
    edges, coarse = [_edges(x[:, j], bins) for j in range(d)], [_edges(x[:, j], coarse_bins) for j in range(d)]
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    main = [np.zeros(len(e) + 1) for e in edges]
    fine = [np.searchsorted(edges[j], x[:, j], side="right") for j in range(d)]
    wide = [np.searchsorted(coarse[j], x[:, j], side="right") for j in range(d)]
    total = np.full(len(y), base)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j in range(d):
            g, h = slopes()
            size = len(main[j])
            leaf = rate * _segments(np.bincount(fine[j], g, size), np.bincount(fine[j], h, size), least, ridge)
            main[j] += leaf
            total += leaf[fine[j]]

    def table(i, j, v):
        m = len(coarse[j]) + 1
        return np.bincount(wide[i] * m + wide[j], v, (len(coarse[i]) + 1) * m).reshape(-1, m)

    g, h = slopes()
    gains = sorted(((_quadrants(table(i, j, g), table(i, j, h), least, ridge)[1], -i, -j)
                    for i in range(d) for j in range(i)), reverse=True)
    pairs = [(-i, -j, np.zeros((len(coarse[-i]) + 1, len(coarse[-j]) + 1))) for gain, i, j in gains[:n_pairs] if gain > 0]
    for _ in range(pair_rounds):
        for i, j, t in pairs:
            g, h = slopes()
            leaf = rate * _quadrants(table(i, j, g), table(i, j, h), least, ridge)[0]
            t += leaf
            total += leaf[wide[i], wide[j]]
    return Model(edges, coarse, base, main, pairs)


def neutral() -> Model:
    d = len(FEATURES)
    return Model([np.zeros(0)] * d, [np.zeros(0)] * d, 0.0, [np.zeros(1)] * d, [])


def learn(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 20_000) -> Model:
    """The model of ``labels.quality`` from at most ``max_labelled`` labelled rows outside the held-out fold."""
    names = [f"f{j}" for j in range(len(FEATURES))]

    def rows(batches):
        for pdf in batches:
            f = np.array([features(t or "") for t in pdf["text"]], float).reshape(-1, len(FEATURES))
            out = pd.DataFrame(f, columns=names)
            out.insert(0, "y", pdf["y"].to_numpy())
            yield out

    sample = labelled_sample(docs, labels, "quality", max_labelled).select("text", "y")
    got = sample.mapInPandas(rows, schema(y=DOUBLE, **dict.fromkeys(names, DOUBLE))).toPandas()
    got = got.sort_values(list(got.columns))
    y = (got["y"] > 0.5).to_numpy(float)
    if len(got) == 0 or y.min() == y.max():
        return neutral()
    return fit(got[names].to_numpy(float), y)


def score_documents(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3,
                    max_labelled: int = 20_000) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher is better), predicted (score >= threshold) of every row of ``docs``."""
    model = learn(docs, labels, max_labelled=max_labelled)

    def run(batches):
        for batch in batches:
            f = np.array([features(t or "") for t in batch.column(1).to_pylist()], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(f))], ["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, schema(doc_id=LONG, score=DOUBLE))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
