"""Toxicity scores: boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import query, table
from .kernels import LOWER, SliceHasher, by_size, fold_case, mix, per_row, runs, utf8, words
from .trees import BoostedTrees, Isotonic, bounded_sample, out_of_fold, part, sampled_rows

SAMPLE = 20_000  # labelled rows that the model is fitted on
LEXICON = 5_000  # entries
THRESHOLD = 0.7
STEMS = (4, 5, 6, 7, 8)  # bytes of word beginnings that count as entries besides whole words
NEAR = 6  # words between an insult and the person addressed

# The second person in English, German, French and Spanish.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deiner euch euer ihr sie tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros vuestra vuestro"
).split()
# Signs that stand for letters.
LEET = bytes.maketrans(b"013457@$!|+", b"oieastasiit")

BETWEEN = np.ones(256, bool)  # what is not part of a word: letters and all of UTF-8's longer signs are
BETWEEN[0x80:] = False
for _low, _high in ((ord("a"), ord("z")), (ord("A"), ord("Z"))):
    BETWEEN[_low : _high + 1] = False
IS_LETTER = ~BETWEEN
IS_SIGN = np.zeros(256, bool)
IS_SIGN[[*b"013457@$!|+*"]] = True


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[*chars]] = True
    return out


CLASSES = (_class(bytes(range(65, 91))), _class(b"!"), _class(b"?"), _class(b".,;:'\"()-"), _class(b"0123456789"), _class(b"#$%&*@^_~|<>=+/\\"))


class Words:
    """Words of a batch with the keys under which a lexicon may have them."""

    def __init__(self) -> None:
        self.hash = SliceHasher()
        self.second = self._of(SECOND_PERSON)

    def _of(self, texts: list[str]) -> np.ndarray:
        data, offsets = utf8(pa.array(texts, pa.string()))
        return np.sort(self.keys(fold_case(data), *words(data, offsets, BETWEEN)[:2])[0])

    def keys(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Hashes of whole words and of their beginnings; a shorter word has none of the latter (0)."""
        whole, *parts = self.hash.beginnings(data, starts, ends, *STEMS)
        return [whole, *(np.where(ends - starts >= n, mix(key + np.uint64(n)), np.uint64(0)) for n, key in zip(STEMS, parts))]


def _found(keys: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Place of each key in the sorted entries, -1 if absent."""
    if not len(entries):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(entries, keys), len(entries) - 1)
    return np.where(entries[at] == keys, at, -1)


@dataclass
class Lexicon:
    """Sorted keys of words and beginnings with their weights."""

    keys: np.ndarray
    weights: np.ndarray


class Features:
    """Dense features of each text of a batch."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon, self.words = lexicon, Words()

    def _weights(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.words.keys(data, starts, ends)
        best = np.zeros(len(starts))
        for found in keys:
            at = _found(found, self.lexicon.keys)
            best = np.maximum(best, np.where(at >= 0, self.lexicon.weights[at] if len(self.lexicon.keys) else 0, 0))
        return best, keys[0]

    def _hidden(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signs inside words per text, and the weight of entries that they hide."""
        n = len(offsets) - 1
        inside = np.zeros(len(data), bool)
        if len(data) > 2:
            inside[1:-1] = IS_SIGN[data[1:-1]] & IS_LETTER[data[:-2]] & IS_LETTER[data[2:]]
        weight = np.zeros(n)
        if inside.any():
            starts, ends, rows = words(data, offsets)
            sums = np.append(0, np.cumsum(inside))
            some = np.flatnonzero(sums[ends] > sums[starts])
            plain = [data[a:b].tobytes().translate(LEET).replace(b"*", b"").strip(b".,;:'\"()-#%&?") for a, b in zip(starts[some], ends[some])]
            if plain:
                flat = LOWER[np.frombuffer(b"".join(plain), np.uint8)]
                stops = np.cumsum([len(x) for x in plain])
                begins = stops - [len(x) for x in plain]
                full = stops > begins
                found, _ = self._weights(flat, begins[full], stops[full])
                np.add.at(weight, rows[some][full], found)
        return per_row(inside, offsets), weight

    def __call__(self, column: pa.Array) -> np.ndarray:
        raw, offsets = utf8(column)
        data = fold_case(raw)
        n = len(column)
        size = np.maximum(np.diff(offsets), 1)
        starts, ends, rows = words(raw, offsets, BETWEEN)
        bounds = runs(rows, n)
        count = np.maximum(np.diff(bounds), 1)
        weight, whole = self._weights(data, starts, ends)
        hit = weight > 0
        person = _found(whole, self.words.second) >= 0
        near = np.zeros(len(starts), bool)
        spots = np.flatnonzero(person)
        if len(spots):
            for i in np.flatnonzero(hit):
                j = np.searchsorted(spots, i)
                around = spots[max(0, j - 1) : j + 1]
                near[i] = bool(np.any((np.abs(around - i) <= NEAR) & (rows[around] == rows[i])))
        hits, total = per_row(hit, bounds), per_row(weight, bounds)
        best = np.zeros(n)
        np.maximum.at(best, rows, weight)
        signs, hidden = self._hidden(raw, offsets)
        shares = [per_row(c[raw], offsets) / size for c in CLASSES]
        return np.column_stack([
            hits, hits / count, total / count, best, total / np.maximum(hits, 1), per_row(near, bounds), per_row(near, bounds) / count,
            per_row(person, bounds) / count, *shares, signs / size, hidden, np.log1p(np.diff(bounds)),
        ])


N_FEATURES = 8 + len(CLASSES) + 3


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each word or beginning, by label."""
    split = Words()
    for batch in by_size(batches, "text"):
        data, offsets = utf8(batch.column("text"))
        starts, ends, rows = words(data, offsets, BETWEEN)
        label = batch.column("y").to_numpy(zero_copy_only=False).astype(bool)
        out: list[np.ndarray] = []
        for keys in split.keys(fold_case(data), starts, ends):
            pairs = np.unique(np.column_stack([keys, rows.astype(np.uint64)]), axis=0)
            out.append(pairs[pairs[:, 0] != 0])
        pairs = np.concatenate(out)
        keys, which = np.unique(pairs[:, 0], return_inverse=True)
        toxic = np.bincount(which, label[pairs[:, 1].astype(np.int64)], len(keys)).astype(np.int64)
        clean = np.bincount(which, minlength=len(keys)) - toxic
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(toxic), pa.array(clean)], ["key", "a", "b"])


def learn_lexicon(rows: DataFrame, limit: int = LEXICON) -> Lexicon:
    """Words and beginnings that stand in more toxic texts than chance explains. ``rows``: text, y."""
    sizes = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    counts = rows.mapInArrow(_count_task, "key long, a long, b long").groupBy("key").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (clean + 1))
    sure = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    strong = counts.withColumn("odds", odds).withColumn("sure", sure).where(f"sure >= 2.7 and odds >= 1.5 and a >= {max(2, toxic // 100)}")
    best = strong.orderBy(F.desc("sure"), "key").limit(limit).select("key", "odds").collect()
    keys = np.array([r.key for r in best], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Lexicon(keys[order], np.array([r.odds for r in best])[order])


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: BoostedTrees
    calibration: Isotonic

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated, with a hundredth of the plain score, which orders texts within a step."""
        margin = self.trees.margin(x)
        return 0.99 * self.calibration(margin) + 0.01 / (1 + np.exp(-np.clip(margin, -40, 40)))


def _features_task(batches: Iterator[pa.RecordBatch], lexicon: Lexicon, others: list[str]) -> Iterator[pa.RecordBatch]:
    features = Features(lexicon)
    for batch in by_size(batches, "text"):
        x = features(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in others), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))],
            [*others, "x"],
        )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Fitted on about ``sample`` labelled rows, chosen by a hash of doc_id: a half gives the lexicon, the other half the
    trees, whose out-of-fold margins give the calibration. Of several labels of a doc_id the largest counts, of several
    texts the least;
    without labels of both kinds every score is the share of toxic ones.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    chosen = bounded_sample(known.withColumn("role", part(F.col("doc_id"), "role")), "doc_id", sample, "toxic")
    rows = sampled_rows(docs.select("doc_id", "text"), chosen, "doc_id")
    lexicon = learn_lexicon(rows.where("role % 2 = 0").select("text", "y"))
    others = rows.where("role % 2 = 1").select("text", "y", "role")
    found = others.mapInArrow(lambda b: _features_task(b, lexicon, ["y", "role"]), "y int, role long, x array<double>").collect()
    x = np.array([r.x for r in found], np.float64).reshape(-1, N_FEATURES)
    y = np.array([r.y for r in found], np.float64)
    fold = np.array([r.role // 2 % 3 for r in found], np.int64)
    return ToxicityModel(lexicon, BoostedTrees().fit(x, y), Isotonic.fit(out_of_fold(x, y, fold, BoostedTrees), y))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.7 on) for each row, from its whole text alone.

    A null text counts as empty, which has a score like any other. All rows and columns stay, whatever
    their names; columns called score or predicted are replaced.
    """
    docs = docs.drop("score", "predicted")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model.lexicon)
        for batch in by_size(batches, "text"):
            s = np.clip(model.score(features(batch.column("text"))), 0, 1)
            predicted = pa.array((s >= THRESHOLD).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), predicted], [*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, f"{kinds}, score double, predicted int")


def held_out(parts: int, rest: int):
    """Is crc32(doc_id as text) mod ``parts`` equal to ``rest``? False for a null."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == rest, F.lit(False))


def fit_on_training(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    return fit(docs, labels.where(~held_out(3, 1)))


@query("op3_toxicity_trees")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = score(docs, fit_on_training(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")
