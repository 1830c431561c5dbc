"""Language model scores: hashed maximum-entropy model with a class-factored softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import query, table
from .kernels import LOWER, SliceHasher, by_size, runs, utf8, words
from .steps import Steps

HEAD = 1 << 17  # words whose counts travel with the query; rarer ones are joined
CLASSES, SLOTS = 64, 64  # the most frequent words: class and place in it
TAILS = 32  # classes of all other words
CODES = 1024  # what a rare word shows of itself: its last two bytes, hashed
MODELLED = CLASSES * SLOTS
OUTPUTS = CLASSES + TAILS
CONTEXTS = MODELLED + CODES  # what a token is as a context
SKIPS = 2048  # rows for the hashed word before last
STARTS = (0, CONTEXTS, CONTEXTS + SKIPS, CONTEXTS + SKIPS + OUTPUTS**2)  # first rows of the kinds of features
ROWS = STARTS[-1] + OUTPUTS**2
SLOT_ROWS = OUTPUTS * CLASSES  # by the class of the word before, and the class
UPDATES = 2  # each over all training texts
STEP = 0.25  # of a class feature: four are active at once; the one of a slot takes the whole step
PRIOR = 4.0  # tokens' worth of the unigram model in each row
BLOCK = 1 << 14  # weights sent as one row
CHUNK = 1 << 11  # tokens scored at once, so that their logits stay in a core's cache
SUM_CHUNK = 1 << 14  # tokens whose expectations are summed at once
TASK_TOKENS = 1 << 24  # of one task of a pass, or fewer
REPEATS = 32  # rows found more often in a chunk are summed one by one
ADD = 0.1
END = np.uint64(0x656E64)  # key of the end token
KEY_SHIFT = np.uint64(46)  # the first 18 bits of a key lead to its place


class Tokens:
    """Keys and codes of the tokens of a batch: words in lower case, then one end for each text."""

    def __init__(self) -> None:
        self.hash = SliceHasher()

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, offsets = utf8(column)
        data = LOWER[data]
        starts, ends, rows = words(data, offsets)
        n = len(column)
        place = np.arange(len(starts)) + rows
        keys = np.full(len(starts) + n, END, np.uint64)
        keys[place] = self.hash(data, starts, ends)
        tails = np.zeros(len(keys), np.int64)
        if len(starts):
            last = data[ends - 1].astype(np.int64)
            before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.int64)
            tails[place] = ((last * 256 + before) * 0x9E3779B1 >> 12) % CODES
        return keys, tails, runs(rows, n) + np.arange(n + 1)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens = Tokens()
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def merged():
        keys, tails, counts = (np.concatenate(x) for x in zip(*held))
        found, first, which = np.unique(keys, return_index=True, return_inverse=True)
        return found, tails[first], np.bincount(which, counts, len(found)).astype(np.int64)

    def out():
        keys, tails, counts = merged()
        whole = pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(tails), pa.array(counts)], ["key", "tail", "c"])
        for at in range(0, whole.num_rows, 1 << 16):
            yield whole.slice(at, 1 << 16)

    for batch in by_size(batches, "text"):
        keys, tails, _ = tokens(batch.column("text"))
        found, first, counts = np.unique(keys, return_index=True, return_counts=True)
        held.append((found, tails[first], counts))
        size += len(found)
        if size > 1 << 20:
            held = [merged()]
            size = len(held[0][0])
            if size > 1 << 19:
                yield from out()
                held, size = [], 0
    if held:
        yield from out()


def _split(vectors: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """2 ** depth groups of equal weight: each is halved along its main direction."""
    group = np.zeros(len(vectors), np.int64)
    for _ in range(depth):
        for g in np.unique(group):
            at = np.flatnonzero(group == g)
            x = vectors[at] - np.average(vectors[at], axis=0, weights=weight[at])
            _, _, axes = np.linalg.svd((x * weight[at, None]).T @ x)
            order = at[np.argsort(x @ axes[0], kind="stable")]
            half = np.cumsum(weight[order]) * 2 > weight[order].sum() + weight[order[0]] / 2
            group[order] = 2 * g + half
    return group


@dataclass
class Model:
    """Head words by key, their counts, and the weights."""

    keys: np.ndarray  # sorted
    counts: np.ndarray
    place: np.ndarray  # class and slot as slot * CLASSES + class; MODELLED or more for words in tail classes
    tokens: int
    types: int
    code_tokens: np.ndarray  # of the words in tail classes, by code
    code_types: np.ndarray
    code_class: np.ndarray = field(default_factory=lambda: np.arange(CODES) % TAILS)

    def __post_init__(self) -> None:
        """Unigram logits: what the weights start from and shrink to."""
        main = self.place < MODELLED
        word = np.zeros(MODELLED)
        word[self.place[main]] = self.counts[main]
        word = word.reshape(SLOTS, CLASSES).T  # [class, slot]
        self.tail_tokens = np.bincount(self.code_class, self.code_tokens, TAILS)
        self.tail_types = np.bincount(self.code_class, self.code_types, TAILS)
        classes = np.append(word.sum(1), self.tail_tokens + ADD * (self.tail_types + 1))
        self.class_base = np.log(np.maximum(classes, 1e-9) / classes.sum()).astype(np.float32)
        self.slot_base = np.log(np.maximum(word, 1e-9) / np.maximum(word.sum(1, keepdims=True), 1e-9)).astype(np.float32)
        self.class_weights = np.zeros((ROWS, OUTPUTS), np.float32)
        self.slot_weights = np.zeros((SLOT_ROWS, SLOTS), np.float32)
        self.context_class = np.append(np.arange(MODELLED) % CLASSES, CLASSES + self.code_class)
        self.begin = np.searchsorted(self.keys >> KEY_SHIFT, np.arange(1 << 64 - int(KEY_SHIFT), dtype=np.uint64)).astype(np.int32)

    def regrouped(self, seen: np.ndarray) -> Model:
        """With words, and codes, of like successors in one class. ``seen``: successors' classes of each context."""
        weight = seen.sum(1)
        like = np.sqrt((seen + self._share()) / (weight[:, None] + 1))
        words_ = _split(like[:MODELLED], np.ones(MODELLED), CLASSES.bit_length() - 1)
        order = np.lexsort((np.arange(MODELLED), words_))
        place = np.empty(MODELLED, np.int64)
        place[order] = np.arange(MODELLED) % SLOTS * CLASSES + np.arange(MODELLED) // SLOTS
        codes = _split(like[MODELLED:], self.code_tokens + 1, TAILS.bit_length() - 1)
        main = self.place < MODELLED
        new = np.where(main, place[np.where(main, self.place, 0)], self.place)
        return Model(self.keys, self.counts, new, self.tokens, self.types, self.code_tokens, self.code_types, codes)

    def _share(self) -> np.ndarray:
        return np.exp(self.class_base)

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Place among the head words, -1 if absent."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        # The keys are hashes: few begin with the same bits, so the place is at most a few steps from the first of these.
        at = self.begin[keys >> KEY_SHIFT].astype(np.int64)
        most = len(self.keys) - 1
        behind = np.flatnonzero(self.keys[np.minimum(at, most)] < keys)
        while len(behind := behind[at[behind] <= most]):
            at[behind] += 1
            behind = behind[self.keys[np.minimum(at[behind], most)] < keys[behind]]
        at = np.minimum(at, most)
        return np.where(self.keys[at] == keys, at, -1)

    def events(self, keys: np.ndarray, codes: np.ndarray, bounds: np.ndarray):
        """For each token: place in the head, class, slot (-1 in a tail class), rows of the features, slot row."""
        at = self.look_up(keys)
        place = np.where(at >= 0, self.place[at] if len(self.place) else MODELLED, MODELLED)
        main = place < MODELLED
        here = np.where(main, place, MODELLED + codes)
        edge = here[bounds[1:] - 1]  # the end token's context stands before each text
        before = [here]
        for _ in range(4):
            last = np.append(0, before[-1][:-1])
            last[bounds[:-1]] = edge
            before.append(last)
        klass = self.context_class[here]
        kinds = [self.context_class[x] for x in before]
        features = np.column_stack([
            before[1], STARTS[1] + (before[2] * 0x9E3779B1 >> 9) % SKIPS,
            STARTS[2] + kinds[1] * OUTPUTS + kinds[2], STARTS[3] + kinds[3] * OUTPUTS + kinds[4],
        ])
        return at, klass, np.where(main, place // CLASSES, -1), features, kinds[1] * CLASSES + np.minimum(klass, CLASSES - 1)

    def class_logits(self, features: np.ndarray) -> np.ndarray:
        out = self.class_base + self.class_weights[features[:, 0]]
        for f in range(1, features.shape[1]):
            out += self.class_weights[features[:, f]]
        return out

    def factors(self) -> np.ndarray | None:
        """Exponentials of the weights, with the unigram logits in those of the word before. None if products may overflow."""
        x = self.class_weights.copy()
        x[: STARTS[1]] += self.class_base
        most = sum(float(np.abs(x[low:high]).max()) for low, high in zip(STARTS, (*STARTS[1:], ROWS)))
        return np.exp(x) if most < 80 else None

    def class_shares(self, features: np.ndarray, factors: np.ndarray | None, n: np.ndarray | float = 1.0) -> np.ndarray:
        """Probability of each class, ``n`` times: from the product of the weights' ``factors``, which needs no exponential per token."""
        return _softmax(self.class_logits(features), n) if factors is None else _normalised(_products(features, factors), n)

    def class_logs(self, features: np.ndarray, klass: np.ndarray, factors: np.ndarray | None) -> np.ndarray:
        """Log-probability of the given class of each token."""
        at = np.arange(len(klass))
        if factors is None:
            x = self.class_logits(features)
            own = x[at, klass]
            return own - _log_sum(x)
        x = _products(features, factors)
        return np.log(x[at, klass] / (x @ np.ones(x.shape[1], np.float32)))

    def slot_logs(self) -> np.ndarray:
        """Log-probability of each slot by slot row, which holds the class."""
        x = np.tile(self.slot_base, (OUTPUTS, 1)) + self.slot_weights
        return x - _log_sum(x.copy())[:, None]


def _log_sum(x: np.ndarray) -> np.ndarray:
    """Logarithm of each row's sum of exponentials; ``x`` is used up."""
    most = x.max(1, keepdims=True) if len(x) and x.max() > 80 else np.float32(0)  # else nothing overflows
    x -= most
    np.exp(x, out=x)
    return np.log(x @ np.ones(x.shape[1], np.float32)) + np.ravel(most)


def _softmax(x: np.ndarray, n: np.ndarray | float = 1.0) -> np.ndarray:
    if len(x) and x.max() > 80:
        x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    return _normalised(x, n)


def _normalised(x: np.ndarray, n: np.ndarray | float = 1.0) -> np.ndarray:
    """Each row on the scale that makes its sum ``n``."""
    x *= (n / (x @ np.ones(x.shape[1], np.float32)))[:, None]
    return x


def _products(features: np.ndarray, factors: np.ndarray) -> np.ndarray:
    out = factors[features[:, 0]]
    for f in range(1, features.shape[1]):
        out *= factors[features[:, f]]
    return out


def _add_rows(out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """``out[rows] += values`` with repeated rows: frequent ones are summed each, the others in a few passes."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")  # ROWS fit, and 16 bits are sorted by digits
    ranked = rows[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))[: len(rows)]
    count = np.diff(np.append(first, len(rows)))
    frequent = count > REPEATS
    for at, n in zip(first[frequent].tolist(), count[frequent].tolist()):
        out[ranked[at]] += values[order[at : at + n]].sum(0)
    first, count = first[~frequent], count[~frequent]
    by = np.argsort(-count, kind="stable")  # so that the rows found more than k times stand first
    first, count = first[by], count[by]
    total = values[order[first]]
    for k in range(1, count.max(initial=0)):
        n = np.searchsorted(-count, -k)
        total[:n] += values[order[first[:n] + k]]
    out[ranked[first]] += total


def _contexts(features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of ``features``, sorted by the word before, and how often each is found.

    Tokens of one context have one distribution, and sorted contexts read and write the same weights.
    """
    sizes = np.diff((*STARTS, ROWS))
    code = features[:, 0]
    for f in range(1, len(STARTS)):
        code = code * sizes[f] + (features[:, f] - STARTS[f])
    code, n = np.unique(code, return_counts=True)
    kinds = []
    for f in range(len(STARTS) - 1, 0, -1):
        code, rest = np.divmod(code, sizes[f])
        kinds.append(rest + STARTS[f])
    return np.column_stack([code, *kinds[::-1]]), n.astype(np.float32)


def _expect(out: np.ndarray, model: Model, features: np.ndarray, factors: np.ndarray | None) -> None:
    """Adds the expected counts of the tokens' features and classes to ``out``."""
    rows, n = _contexts(features)
    sums = np.zeros((ROWS, OUTPUTS), np.float32)  # of a batch; over batches in double precision
    x = np.empty((SUM_CHUNK, OUTPUTS), np.float32)
    for a in range(0, len(rows), SUM_CHUNK):
        some = rows[a : a + SUM_CHUNK]
        for b in range(0, len(some), CHUNK):
            x[b : b + CHUNK][: len(some) - b] = model.class_shares(some[b : b + CHUNK], factors, n[a + b : a + min(b + CHUNK, len(some))])
        for f in range(rows.shape[1]):
            _add_rows(sums, some[:, f], x[: len(some)])
    out += sums


def _gradient_task(batches: Iterator[pa.RecordBatch], model: Model, expected: bool, words_only: bool) -> Iterator[pa.RecordBatch]:
    """Observed, or expected, counts of the features and outputs over the task's texts, in blocks.

    With ``words_only`` those of the word before alone.

    Only classes are expected here: a slot's distribution depends on its row alone, so the driver has it from
    the rows' counts.
    """
    tokens = Tokens()
    sum_c, sum_s = np.zeros((ROWS, OUTPUTS)), np.zeros(0 if expected else SLOT_ROWS * SLOTS)
    factors = model.factors() if expected else None
    for batch in by_size(batches, "text", 1 << 22):
        keys, tails, bounds = tokens(batch.column("text"))
        _, klass, slot, features, slot_row = model.events(keys, tails, bounds)
        if expected:
            _expect(sum_c, model, features, factors)
            continue
        main = slot >= 0
        for f, (low, high) in enumerate(zip(STARTS[: 1 if words_only else None], (*STARTS[1:], ROWS))):
            sum_c[low:high] += np.bincount((features[:, f] - low) * OUTPUTS + klass, minlength=(high - low) * OUTPUTS).reshape(-1, OUTPUTS)
        if not words_only:
            sum_s += np.bincount(slot_row[main] * SLOTS + slot[main], minlength=sum_s.size)
    flat = np.concatenate([sum_c.ravel(), sum_s]).astype(np.float32)
    salt = TaskContext.get().partitionId() % 4
    starts = range(0, len(flat), BLOCK)
    some = [a for a in starts if flat[a : a + BLOCK].any()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([a // BLOCK for a in some], pa.int64()), pa.array([salt] * len(some), pa.int64()), pa.array([flat[a : a + BLOCK].tobytes() for a in some], pa.binary())],
        ["block", "salt", "data"],
    )


def _sum_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
            part_ = np.frombuffer(data.as_buffer(), np.float32).astype(np.float64)
            sums[block] = sums[block] + part_ if block in sums else part_
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int64()), pa.array([0] * len(sums), pa.int64()), pa.array([x.astype(np.float32).tobytes() for x in sums.values()], pa.binary())],
        ["block", "salt", "data"],
    )


def _sums(model: Model, texts: DataFrame, expected: bool, words_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """What ``_gradient_task`` counts over all of ``texts``, summed in two steps; its size is that of the weights."""
    spark = texts.sparkSession
    schema = "block long, salt long, data binary"
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-model.tokens // TASK_TOKENS))
    parts = texts.select("text").coalesce(int(tasks)).mapInArrow(lambda b: _gradient_task(b, model, expected, words_only), schema)
    parts = parts.repartition("block", "salt").mapInArrow(_sum_task, schema).repartition("block").mapInArrow(_sum_task, schema)
    c, s = ROWS * OUTPUTS, 0 if expected else SLOT_ROWS * SLOTS
    flat = np.zeros(c + s, np.float32)
    for row in parts.collect():  # as large as the weights
        data = np.frombuffer(row.data, np.float32)
        flat[row.block * BLOCK : row.block * BLOCK + len(data)] = data
    return flat[:c].reshape(ROWS, OUTPUTS), flat[c:].reshape(-1, SLOTS)


def _update(model: Model, texts: DataFrame, seen: tuple[np.ndarray, np.ndarray], first: bool) -> None:
    """One gradient update: sums over all texts, made in the tasks, move the weights.

    The step is the gradient, observed less expected, on the scale of iterative scaling: the logarithm of
    their ratio, with a prior of a few tokens in each row, shared by the features that are active at once. ``seen`` are the observed counts, the same in every
    update; in the first one the weights are 0, so the expectation follows from them too.
    """
    seen_c, seen_s = seen
    p = np.exp(model.class_base)
    hope_c = seen_c.sum(1, keepdims=True) * p if first else _sums(model, texts, True)[0]
    hope_s = seen_s.sum(1, keepdims=True) * np.exp(model.slot_logs())
    prior = PRIOR * p
    model.class_weights += (STEP * np.log((seen_c + prior) / (hope_c + prior))).astype(np.float32)
    prior = PRIOR * np.maximum(np.tile(np.exp(model.slot_base), (OUTPUTS, 1)), 1e-9)
    model.slot_weights += np.log((seen_s + prior) / (hope_s + prior)).astype(np.float32)


def count_words(texts: DataFrame) -> DataFrame:
    """``key, tail, c`` of every different token of ``texts`` (text); keys are 64-bit hashes."""
    found = texts.select("text").mapInArrow(_count_task, "key long, tail long, c long")
    return found.groupBy("key").agg(F.first("tail").alias("tail"), F.sum("c").alias("c"))


def fit(counts: DataFrame, docs: DataFrame) -> Model:
    """A model from the token counts of ``docs`` (text); classes and every gradient update read all its texts."""
    head = counts.orderBy(F.desc("c"), "key").limit(HEAD).toPandas()
    main = counts.sparkSession.createDataFrame([(int(k),) for k in head.key[:MODELLED]], "key long")
    tail = counts.join(F.broadcast(main), "key", "left_anti").groupBy("tail").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    all_ = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    keys = head.key.to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    code_tokens, code_types = np.zeros(CODES), np.zeros(CODES)
    for r in tail:
        code_tokens[r.tail], code_types[r.tail] = r.n, r.v
    model = Model(keys[order], head.c.to_numpy(np.int64)[order], order, all_.n, all_.v, code_tokens, code_types)
    if not all_.n:
        return model
    seen = _sums(model, docs, False, words_only=True)[0][:CONTEXTS]
    model = model.regrouped(seen.astype(np.float64))
    seen = _sums(model, docs, False)
    for turn in range(UPDATES):
        _update(model, docs, seen, turn == 0)
    return model


SCORED = "row long, doc_id long, n_tokens long, head_known long, base double, score double, tail_keys array<long>, tail_counts array<long>"


def _score_task(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Sums over the head words, and what is to be joined: the rarer words with their numbers."""
    tokens = Tokens()
    row = TaskContext.get().partitionId() << 33
    bottom = np.log10(model.tokens + ADD * (model.types + 1))
    tail_bottom = np.log10(model.tail_tokens + ADD * (model.tail_types + 1))
    logs = np.append(np.log10(model.counts + ADD), 0.0)
    slot_logs, factors = model.slot_logs(), model.factors()
    for batch in by_size(batches, "text", 1 << 20):
        n = batch.num_rows
        keys, tails, bounds = tokens(batch.column("text"))
        at, klass, slot, features, slot_row = model.events(keys, tails, bounds)
        score = np.empty(len(keys))
        for a in range(0, len(keys), CHUNK):
            score[a : a + CHUNK] = model.class_logs(features[a : a + CHUNK], klass[a : a + CHUNK], factors)
        main = slot >= 0
        score[main] += slot_logs[slot_row[main], slot[main]]
        own = logs[at]  # the rare ones' counts are not known yet: 0
        score = score / np.log(10) + np.where(slot < 0, own - tail_bottom[np.maximum(klass - CLASSES, 0)], 0.0)
        rows = np.repeat(np.arange(n), np.diff(bounds))
        rare = np.flatnonzero(at < 0)
        order = rare[np.lexsort((keys[rare], rows[rare]))]
        new = np.append(True, (keys[order][1:] != keys[order][:-1]) | (rows[order][1:] != rows[order][:-1])) if len(order) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        lists = pa.array(np.searchsorted(rows[order][first], np.arange(n + 1)).astype(np.int32))
        many = np.diff(np.append(first, len(order)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(row + np.arange(n)), batch.column("doc_id"), pa.array(np.diff(bounds)),
                pa.array(np.bincount(rows[at >= 0], minlength=n)), pa.array(np.bincount(rows, own - bottom, n)), pa.array(np.bincount(rows, score, n)),
                pa.ListArray.from_arrays(lists, pa.array(keys[order][first].view(np.int64))), pa.ListArray.from_arrays(lists, pa.array(many)),
            ],
            [c.split()[0] for c in SCORED.split(", ")],
        )
        row += n


def score(docs: DataFrame, training: DataFrame, steps: Steps | None = None) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of each whole text of ``docs`` (doc_id, text).

    Learns from ``training``. A token's probability is that of its class in its context times that within the class:
    for the 4096 most frequent words again by the context, for the others, in classes by their last two bytes, by
    their counts, with a share for unknown words. Classes hold words of like successors. They have weights for the
    word before, the hashed one before that, and for pairs of classes one and three words back.
    ``base_score`` is the smoothed unigram model's. A null or empty text is the end alone; null doc_ids and
    repeated rows are scored like others; without training texts every token is unknown; other columns are ignored.
    """
    steps = steps or Steps(docs.sparkSession)
    texts = lambda df: df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs, training = texts(docs), texts(training)
    counts = steps.keep(count_words(training))
    model = fit(counts, training)
    scored = steps.keep(docs.mapInArrow(lambda b: _score_task(b, model), SCORED))
    rare = scored.select("row", F.explode(F.arrays_zip("tail_keys", "tail_counts")).alias("t")).select("row", F.col("t.tail_keys").alias("key"), F.col("t.tail_counts").alias("n"))
    joined = rare.join(counts.select("key", "c"), "key", "left")
    sums = joined.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + ADD)).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("known")
    )
    more = F.coalesce("more", F.lit(0.0))
    return scored.drop("tail_keys", "tail_counts").join(sums, "row", "left").select(
        "doc_id", "n_tokens", (F.col("head_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"),
    )


@query("op7_maxent_scores")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    found = score(docs, docs.where(rest != 0))
    return found.select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
