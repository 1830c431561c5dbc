import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlake.llm import maxent
from marketlake.llm.maxent import ADD, CLASSES, MODELLED, Tokens, count_words, fit, score

WORD = re.compile("[^\x20\x09-\x0d]+")


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(lowered), None]


def base(pairs, training):
    counts = Counter(w for t in training for w in words_of(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc, text in pairs:
        found = words_of(text)
        total = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in found)
        out.append((doc, len(found), sum(counts[w] > 0 for w in found), n, round(total, 6)))
    return sorted(out, key=repr)


def rows(found):
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")


def test_base_like_brute_force_and_model_is_better(docs, monkeypatch):
    monkeypatch.setattr(maxent, "HEAD", 5000)  # so that many words are joined
    training = docs.where("doc_id % 10 <> 3")
    found = score(docs, training).collect()
    texts = docs.collect()
    assert rows(found) == base([(r.doc_id, r.text) for r in texts], [r.text for r in texts if r.doc_id % 10 != 3])
    held = [r for r in found if r.doc_id % 10 == 3]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.05 * sum(r.n_tokens for r in held)


def test_probabilities_sum_to_one(spark, docs):
    training = docs.where("doc_id % 10 <> 3")
    counts = count_words(training)
    model = fit(counts, training)
    tokens = Tokens()
    known = {int(np.int64(r.key).view(np.uint64)): r for r in counts.collect()}
    text = " ".join((docs.first().text).split()[:40])
    keys, codes, bounds = tokens(pa.array([text]))
    _, _, _, features, slot_row = model.events(keys, codes, bounds)
    logits = model.class_logits(features)
    classes = np.exp(logits - logits.max(1, keepdims=True))
    classes /= classes.sum(1, keepdims=True)
    assert np.allclose(classes.sum(1), 1, atol=1e-5)
    for t in (0, 5, 20):
        total = 0.0
        for k in range(CLASSES):  # every word of the class in this context
            x = model.slot_base[k] + model.slot_weights[slot_row[t] // CLASSES * CLASSES + k]
            p = np.exp(x - x.max())
            total += classes[t, k] * (p / p.sum()).sum()
        top = {int(k) for k in model.keys[model.place < MODELLED]}
        share = np.zeros(maxent.TAILS)
        for key, r in known.items():
            if key not in top:
                k = model.code_class[r.tail]
                share[k] += (r.c + ADD) / (model.tail_tokens[k] + ADD * (model.tail_types[k] + 1))
        share += ADD / (model.tail_tokens + ADD * (model.tail_types + 1))  # one unknown word in each class
        total += (classes[t, CLASSES:] * share).sum()
        assert abs(total - 1) < 1e-4


def test_scores_do_not_read_held_out_texts(docs):
    training = docs.where("doc_id % 10 <> 3")
    other = docs.withColumn("text", F.when(F.col("doc_id") % 10 == 3, F.lit("other words")).otherwise(F.col("text")))
    one = {r.doc_id: r.score for r in score(docs, training).collect()}
    two = {r.doc_id: r.score for r in score(other, other.where("doc_id % 10 <> 3")).collect()}
    assert all(abs(one[d] - two[d]) < 1e-6 * abs(one[d]) for d in one if d % 10 != 3)


def test_odd_rows(documents, odd):
    frame = documents(odd)
    found = score(frame, frame.where("doc_id <> 7")).collect()
    assert rows(found) == base(odd, [t for d, t in odd if d not in (7, None)])
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    nothing = score(frame, frame.limit(0)).collect()
    assert rows(nothing) == base(odd, []) and all(math.isfinite(r.score) for r in nothing)
    assert score(documents([]), frame).count() == 0


def test_every_text_reaches_the_weights(documents):
    texts = [(d, f"left{d} right{d} " * 40) for d in range(24)]  # each text has word pairs of its own
    training = documents(texts)
    model = fit(count_words(training), training)
    tokens = Tokens()
    for _, text in texts:
        _, klass, slot, features, slot_row = model.events(*tokens(pa.array([text])))
        assert (model.class_weights[features[1:-1, 0], klass[1:-1]] != 0).all()
        assert (model.slot_weights[slot_row[1:-1], slot[1:-1]] != 0).all()
        assert (model.class_weights[features[:, 0], klass] > 0).any()
    assert fit_counts(training, model) == 24 * 81


def fit_counts(training, model):
    """Tokens that the gradients of all texts are taken over, observed and expected."""
    seen, hope = (maxent._sums(model, training, expected)[0] for expected in (False, True))
    ends = [*maxent.STARTS, maxent.ROWS]
    sums = [x[a:b].sum() for x in (seen, hope) for a, b in zip(ends, ends[1:])]
    assert np.allclose(sums, sums[0], rtol=1e-4)
    return round(float(sums[0]))


def test_places_and_class_probabilities_without_a_search_or_an_exponential_per_token():
    dice = np.random.default_rng(4)
    keys = np.unique(np.append(dice.integers(0, 1 << 64, 5000, np.uint64, False), np.array([0, (1 << 64) - 1], np.uint64)))
    keys = np.unique(np.append(keys, keys[100] + np.arange(40, dtype=np.uint64)))  # many that begin alike
    counts = np.arange(1, len(keys) + 1)
    codes = np.ones(maxent.CODES)
    model = maxent.Model(keys, counts, np.arange(len(keys)), int(counts.sum()), len(keys), codes, codes)
    asked = np.concatenate([keys, keys[:-1] + np.uint64(1), dice.integers(0, 1 << 64, 999, np.uint64, False)])
    place = {int(k): i for i, k in enumerate(keys)}
    assert model.look_up(asked).tolist() == [place.get(int(k), -1) for k in asked]

    model.class_weights[:] = dice.normal(0, 1, model.class_weights.shape)
    features = np.column_stack([dice.integers(a, b, 3000) for a, b in zip(maxent.STARTS, (*maxent.STARTS[1:], maxent.ROWS))])
    klass = dice.integers(0, maxent.OUTPUTS, 3000)
    factors = model.factors()
    assert np.allclose(model.class_logs(features, klass, factors), model.class_logs(features, klass, None), atol=1e-5)
    assert np.allclose(model.class_shares(features, factors), model.class_shares(features, None), rtol=1e-4, atol=1e-9)
    model.class_weights[5, 5] = 90  # a product could overflow
    assert model.factors() is None and np.isfinite(model.class_logs(features, klass, None)).all()


def test_row_sums_like_one_by_one():
    some = np.random.default_rng(3)
    for times in ([], [1], [1, 2, 3, 2, 1], [maxent.REPEATS + 1, 1, maxent.REPEATS, 2, 5 * maxent.REPEATS]):
        rows = some.permutation(np.repeat(some.permutation(maxent.ROWS)[: len(times)], times))
        values = some.random((len(rows), 3))
        out = np.ones((maxent.ROWS, 3))
        expected = out.copy()
        np.add.at(expected, rows, values)
        maxent._add_rows(out, rows, values)
        assert np.allclose(out, expected, rtol=1e-12)


def test_shares_for_contexts_found_more_than_once():
    x = np.random.default_rng(4).random((5, maxent.OUTPUTS)).astype(np.float32)
    n = np.array([1, 2, 3, 1, 40], np.float32)
    shares = maxent._softmax(x.copy(), n)
    assert shares.dtype == np.float32 and np.allclose(shares.sum(1), n, rtol=1e-5)
    assert np.allclose(shares, maxent._softmax(x.copy()) * n[:, None], rtol=1e-5)
