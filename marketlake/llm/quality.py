"""Document quality by co-training a classifier of the text with one of the page's metadata."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import query, table
from .kernels import SliceHasher, by_size, fold_case, per_row, runs, utf8, words
from .steps import Steps
from .trees import BoostedTrees, Isotonic, bounded_sample, out_of_fold, part, sampled_rows, sigmoid

SAMPLE = 20_000  # labelled rows that the model is fitted on
ROUNDS = 3
SURE = 0.97  # probability from which a view's label is passed to the other
EXCHANGED = 4_000  # about as many pseudo-labels a view gives in the first round, of all rows it is sure of; n times in the nth
PSEUDO_WEIGHT = 0.5
SOURCES, LANGS = 16, 8  # columns for hashed names
THRESHOLD = 0.5


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[*chars]] = True
    return out


UPPER, LINE_END = _class(bytes(range(65, 91))), _class(b"\n")
CLASSES = (UPPER, _class(b"!?"), _class(b"#$%&*^~_=+<>{}[]\\@"), _class(b"|"), _class(b"0123456789"), _class(b".,;:'\"()-"), _class(b" "))
STOP = _class(b".!?")


def _distinct(keys: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct keys of each row."""
    order = np.argsort(keys, kind="stable")
    order = order[np.argsort(rows[order], kind="stable")]
    k, r = keys[order], rows[order]
    new = np.append(True, (k[1:] != k[:-1]) | (r[1:] != r[:-1])) if len(k) else np.zeros(0, bool)
    return np.bincount(r[new], minlength=n).astype(np.float64)


def text_features(raw: np.ndarray, offsets: np.ndarray, hasher: SliceHasher) -> np.ndarray:
    """Dense features of each whole text: signs, repetition and shape of words and lines."""
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    data = fold_case(raw)
    starts, ends, rows = words(data, offsets)
    bounds = runs(rows, n)
    count = np.maximum(np.diff(bounds), 1)
    keys = hasher(data, starts, ends)
    again = np.zeros(len(keys), bool)
    again[1:] = (keys[1:] == keys[:-1]) & (rows[1:] == rows[:-1])
    pairs = keys.copy()
    pairs[:-1] += keys[1:] * np.uint64(3)
    breaks = np.zeros(256, bool)
    breaks[10] = True
    line_starts, line_ends, line_rows = words(data, offsets, breaks)
    line_count = np.maximum(np.bincount(line_rows, minlength=n), 1)
    lines = hasher(data, line_starts, line_ends)
    ends_well = STOP[raw[line_ends - 1]] if len(raw) else np.zeros(0, bool)
    return np.column_stack([
        *(per_row(c[raw], offsets) / size for c in CLASSES),
        per_row(again, bounds) / count, _distinct(keys, rows, n) / count, _distinct(pairs, rows, n) / count,
        per_row(ends - starts, bounds) / count, per_row(UPPER[raw[starts]], bounds) / count if len(raw) else np.zeros(n),
        per_row(STOP[raw[ends - 1]], bounds) / count if len(raw) else np.zeros(n),
        _distinct(lines, line_rows, n) / line_count, np.bincount(line_rows, ends_well, n) / line_count, np.log1p(np.diff(bounds)),
    ])


def metadata_features(raw: np.ndarray, offsets: np.ndarray, source: list, lang: list, n_chars: np.ndarray) -> np.ndarray:
    """Where a page comes from, and its length and layout; no words."""
    n = len(offsets) - 1
    hot = np.zeros((n, SOURCES + LANGS))
    for i, (s, l) in enumerate(zip(source, lang)):
        hot[i, zlib.crc32(str(s).encode()) % SOURCES] = 1
        hot[i, SOURCES + zlib.crc32(str(l).encode()) % LANGS] = 1
    lines = per_row(LINE_END[raw], offsets) + 1
    size = np.diff(offsets)
    return np.column_stack([hot, np.log1p(np.maximum(n_chars, 0)), np.log(lines), np.log1p(size / lines), size / np.maximum(n_chars, 1)])


@dataclass
class CoTrained:
    """Two calibrated views and the weights that combine them."""

    views: list[BoostedTrees]
    calibrations: list[Isotonic]
    weights: np.ndarray

    def scores(self, xs: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Probability of good quality, and that of each view."""
        each = [c(v.margin(x)) for v, c, x in zip(self.views, self.calibrations, xs)]
        return sigmoid(_logits(each) @ self.weights), each


def _logits(each: list[np.ndarray]) -> np.ndarray:
    p = np.clip(np.column_stack(each), 1e-3, 1 - 1e-3)
    return np.column_stack([np.ones(len(p)), np.log(p / (1 - p))])


def _combine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; a view never counts against its own label."""
    w = np.array([0.0, 1.0, 0.0])
    for _ in range(25):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(3)
        w = w + np.linalg.solve(h, x.T @ (y - p) - (w - np.array([0.0, 1.0, 0.0])))
    return np.append(w[:1], np.maximum(w[1:], 0))


@dataclass
class View:
    """One view's trees and their calibration."""

    trees: BoostedTrees
    calibration: Isotonic

    def sure(self, x: np.ndarray) -> np.ndarray:
        """1 or 0 where the view is sure of a row's label, else -1."""
        p = self.calibration(self.trees.margin(x))
        return np.where(p >= SURE, 1, np.where(p <= 1 - SURE, 0, -1)).astype(np.int32)


Given = tuple[list[np.ndarray], np.ndarray]  # features of both views, and labels


def co_train(xs: list[np.ndarray], y: np.ndarray, fold: np.ndarray, exchange: Callable[[list[View], float, int], list[Given]], rounds: int = ROUNDS) -> CoTrained:
    """Views are refitted each round with unlabelled rows of which the other view is sure.

    ``exchange`` takes the views, the share of good rows and a number, and returns the rows that each view labels.
    Each round's labels are given afresh. Calibration and weights come from margins of models that have not seen
    the rows' fold.
    """
    make = lambda: BoostedTrees(rounds=40)
    extra = [(x[:0], y[:0]) for x in xs]

    def fit(view: int, rows: np.ndarray) -> BoostedTrees:
        more, label = extra[view]
        weight = np.append(np.ones(rows.sum()), np.full(len(label), PSEUDO_WEIGHT))
        return make().fit(np.concatenate([xs[view][rows], more]), np.append(y[rows], label), weight)

    everyone = np.ones(len(y), bool)
    share = float(y.mean()) if len(y) else 0.5
    alone = [Isotonic.fit(out_of_fold(x, y, fold, make), y) for x in xs]
    for turn in range(1, rounds + 1):
        given = exchange([View(fit(v, everyone), alone[v]) for v in (0, 1)], share, turn * EXCHANGED)
        extra = [(given[1 - v][0][v], given[1 - v][1]) for v in (0, 1)]
    margins = [np.zeros(len(y)) for _ in range(2)]
    for f in np.unique(fold):
        for view in (0, 1):
            margins[view][fold == f] = fit(view, fold != f).margin(xs[view][fold == f])
    calibrations = [Isotonic.fit(m, y) for m in margins]
    weights = _combine(_logits([c(m) for c, m in zip(calibrations, margins)]), y)
    return CoTrained([fit(v, everyone) for v in (0, 1)], calibrations, weights)


def _views(columns: list[pa.Array], hasher: SliceHasher) -> list[np.ndarray]:
    """Features of both views from text, source, lang and the number of code points."""
    raw, offsets = utf8(columns[0])
    n_chars = columns[3].to_numpy(zero_copy_only=False).astype(np.float64)
    meta = metadata_features(raw, offsets, columns[1].to_pylist(), columns[2].to_pylist(), n_chars)
    return [text_features(raw, offsets, hasher), meta]


def _inputs(docs: DataFrame) -> list:
    """What the views read, under names longer than any column's; a missing column is null."""
    text = lambda c: (F.col(c) if c in docs.columns else F.lit(None)).cast("string")
    found = text("text"), text("source"), text("lang"), F.length(F.coalesce(text("text"), F.lit(""))).cast("long")
    mark = "_" * (1 + max(map(len, docs.columns)))
    return [c.alias(f"{mark}{i}") for i, c in enumerate(found)]


def _featured(docs: DataFrame, column: str, kind: str) -> DataFrame:
    """``column``, and features of both views as ``a`` and ``b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SliceHasher()
        for batch in by_size(batches, 1):
            lists = [pa.array(list(x), pa.list_(pa.float64())) for x in _views(batch.columns[1:], hasher)]
            yield pa.RecordBatch.from_arrays([batch.columns[0], *lists], [column, "a", "b"])

    return docs.select(F.col(column).cast(kind), *_inputs(docs)).mapInArrow(run, f"{column} {kind}, a array<double>, b array<double>")


def _matrices(found: list) -> list[np.ndarray]:
    """Features of collected rows."""
    empty = [pa.array([""])] * 3 + [pa.array([0])]
    widths = [x.shape[1] for x in _views(empty, SliceHasher())]
    return [np.array([r[c] for r in found], np.float64).reshape(-1, w) for c, w in zip("ab", widths)]


def unlabelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``place, a, b`` of the different features of all rows without a label; place is a hash of 53 bits.

    Copies are one row, so that a group of them weighs no more than another text. Texts are not shuffled.
    """
    rows = _featured(docs, "doc_id", "long").join(known.select("doc_id"), "doc_id", "left_anti").select("a", "b").distinct()
    return rows.select(F.shiftrightunsigned(F.xxhash64("a", "b"), 11).alias("place"), "a", "b")


def exchange_over(pool: DataFrame) -> Callable[[list[View], float, int], list[Given]]:
    """Labels from a pass over all of ``pool`` (place, a, b): of the rows that a view is sure of, those of lowest place.

    Both labels in the proportion of the labelled rows. About ``limit`` rows of a view reach the driver.
    """

    def exchange(views: list[View], share: float, limit: int) -> list[Given]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if n := batch.num_rows:
                    xs = [batch.column(c).flatten().to_numpy().reshape(n, -1) for c in "ab"]
                    new = [pa.array(v.sure(x)) for v, x in zip(views, xs)]
                    yield pa.RecordBatch.from_arrays([*batch.columns, *new], ["place", "a", "b", "y0", "y1"])

        sure = pool.mapInArrow(run, "place long, a array<double>, b array<double>, y0 int, y1 int")
        many = sure.agg(*(F.count_if(F.col(f"y{v}") == label).alias(f"n{v}{label}") for v in (0, 1) for label in (0, 1))).first()
        given = []
        for v in (0, 1):
            shares = 1 - share, share
            n = min(limit, *(int(many[f"n{v}{label}"] / max(shares[label], 0.01)) for label in (0, 1)))
            bounds = [min(1 << 53, int((1 << 53) * n * shares[label] / max(many[f"n{v}{label}"], 1))) for label in (0, 1)]
            chosen = sure.where(" or ".join(f"y{v} = {label} and place < {bounds[label]}" for label in (0, 1)))
            found = sorted(chosen.collect(), key=lambda r: (r.place, r.a, r.b))
            given.append((_matrices(found), np.array([r[f"y{v}"] for r in found], np.float64)))
        return given

    return exchange


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> CoTrained:
    """A model from ``docs`` (doc_id, text, and source and lang where there are) and ``labels`` (doc_id, quality).

    Fitted on about ``sample`` labelled rows, chosen by a hash of doc_id, and on pseudo-labels: each round the views
    label all rows without a label and exchange those of which they are sure, ``EXCHANGED`` times the round's number.
    Of several labels of a doc_id the smallest counts, of several rows the least; a null doc_id has no label.
    Without labels of both kinds every text has their share.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
    chosen = bounded_sample(known, "doc_id", sample, "quality").withColumn("role", part(F.col("doc_id"), "fold"))
    docs = docs.select(*[c for c in ("doc_id", "text", "source", "lang") if c in docs.columns])
    one = sampled_rows(docs, chosen, "doc_id").withColumn("role", F.col("role") * 2 + F.col("y"))
    found = _featured(one, "role", "long").collect()
    y, fold = np.array([r.role % 2 for r in found], np.float64), np.array([r.role // 2 % 3 for r in found], np.int64)
    steps = Steps(docs.sparkSession)
    pool = steps.keep(unlabelled(docs, known))
    model = co_train(_matrices(found), y, fold, exchange_over(pool))
    steps.drop_from(0)
    return model


def score(docs: DataFrame, model: CoTrained) -> DataFrame:
    """``docs`` with ``quality`` (probability), ``text_quality``, ``metadata_quality`` and ``good``, from whole texts.

    A null text counts as empty. All rows and other columns stay; columns of these four names are replaced.
    """
    docs = docs.drop("quality", "text_quality", "metadata_quality", "good")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    names = [*docs.columns, "quality", "text_quality", "metadata_quality", "good"]
    n = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SliceHasher()
        for batch in by_size(batches, n):
            p, each = model.scores(_views(batch.columns[n:], hasher))
            new = [pa.array(x) for x in (p, *each, p >= THRESHOLD)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *new], names)

    scored = f"{kinds}, quality double, text_quality double, metadata_quality double, good boolean"
    return docs.select("*", *_inputs(docs)).mapInArrow(run, scored)


@query("op6_co_training")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", "quality", "text_quality", "metadata_quality", "good")
