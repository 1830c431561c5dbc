"""Gradient-boosted trees, isotonic calibration and samples to fit them on."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 64
UNITS = 1_000_000


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class BoostedTrees:
    """Logistic boosting of trees that ask one question per level, so a row's leaf is a number of ``depth`` bits."""

    rounds: int = 60
    depth: int = 4
    rate: float = 0.2
    shrink: float = 2.0
    start: float = 0.0
    trees: list[tuple[list[int], list[float], np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> BoostedTrees:
        weight = np.ones(len(y)) if weight is None else weight
        rate = np.clip(np.average(y, weights=weight) if len(y) else 0.0, 1e-4, 1 - 1e-4)
        self.start, self.trees = float(np.log(rate / (1 - rate))), []
        if len(np.unique(y)) < 2:
            return self
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
        bins = [np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)]  # bin > b: the value is over cut b
        margin = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = sigmoid(margin)
            g, h = weight * (y - p), weight * p * (1 - p)
            leaf = np.zeros(len(y), np.int64)
            questions: list[int] = []
            limits: list[float] = []
            for level in range(self.depth):
                best = 1e-9, -1, -1
                for f, found in enumerate(bins):
                    place = leaf * BINS + found
                    gs = np.bincount(place, g, (1 << level) * BINS).reshape(-1, BINS).cumsum(1)
                    hs = np.bincount(place, h, (1 << level) * BINS).reshape(-1, BINS).cumsum(1)
                    right = (gs[:, -1:] - gs) ** 2 / (hs[:, -1:] - hs + self.shrink)
                    gain = (gs**2 / (hs + self.shrink) + right - gs[:, -1:] ** 2 / (hs[:, -1:] + self.shrink)).sum(0)[: len(cuts[f])]
                    if len(gain) and gain.max() > best[0]:
                        best = float(gain.max()), f, int(gain.argmax())
                if best[1] < 0:
                    break
                questions.append(best[1])
                limits.append(float(cuts[best[1]][best[2]]))
                leaf |= (bins[best[1]] > best[2]).astype(np.int64) << level
            if not questions:
                break
            size = 1 << len(questions)
            values = self.rate * np.bincount(leaf, g, size) / (np.bincount(leaf, h, size) + self.shrink)
            self.trees.append((questions, limits, values))
            margin += values[leaf]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for questions, limits, values in self.trees:
            leaf = np.zeros(len(x), np.int64)
            for level, (f, limit) in enumerate(zip(questions, limits)):
                leaf |= (x[:, f] > limit).astype(np.int64) << level
            out += values[leaf]
        return out


@dataclass
class Isotonic:
    """The rising step function nearest to the labels, by pooling neighbours that fall."""

    at: np.ndarray
    value: np.ndarray

    @classmethod
    def fit(cls, score: np.ndarray, y: np.ndarray) -> Isotonic:
        if not len(score):
            return cls(np.zeros(1), np.full(1, 0.5))
        keys, which = np.unique(score, return_inverse=True)
        sums, sizes = np.bincount(which, y).tolist(), np.bincount(which).tolist()
        pools: list[list[float]] = []  # sum, size, first key
        for i, (s, n) in enumerate(zip(sums, sizes)):
            pools.append([s, n, i])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                s_, n_, _ = pools.pop()
                pools[-1][0] += s_
                pools[-1][1] += n_
        ends = [p[2] for p in pools[1:]] + [len(keys)]
        at, value = [], []
        for (s, n, first), end in zip(pools, ends):
            at += [keys[int(first)], keys[int(end) - 1]]
            value += [(s + 0.01) / (n + 0.02)] * 2
        return cls(np.array(at), np.array(value))

    def __call__(self, score: np.ndarray) -> np.ndarray:
        """Linear between the pools."""
        return np.interp(score, self.at, self.value)


def out_of_fold(x: np.ndarray, y: np.ndarray, fold: np.ndarray, make) -> np.ndarray:
    """Margins of models that have not seen the row's fold."""
    out = np.zeros(len(y))
    for f in np.unique(fold):
        out[fold == f] = make().fit(x[fold != f], y[fold != f]).margin(x[fold == f])
    return out


def part(column: Column, salt: str) -> Column:
    """A hash of ``column`` as a whole number below UNITS."""
    return F.pmod(F.xxhash64(column, F.lit(salt)), F.lit(UNITS))


def bounded_sample(rows: DataFrame, key: str, limit: int, salt: str) -> DataFrame:
    """About ``limit`` rows by a hash of ``key``, or all if they are fewer; small enough to broadcast."""
    n = rows.count()
    place = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(salt)), 11)  # of 2^53, so that no share rounds to nothing
    return rows if n <= limit else rows.where(place < int((1 << 53) * limit / n))


def sampled_rows(docs: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """One row of ``docs`` for each ``key`` of ``chosen``, the least, with the columns of both.

    Repeated rows meet on the map side first, so a key with many of them costs and weighs no more than another.
    """
    others = [c for c in docs.columns if c != key]
    rows = docs.join(F.broadcast(chosen), key)
    return rows.groupBy(*chosen.columns).agg(F.min(F.struct(*others)).alias("_row")).select(*chosen.columns, "_row.*")
