import random
import re
from math import floor, log

import numpy as np
import pytest

from marketlake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k):
    split = [(d, terms(t)) for d, t in docs]
    total = sum(bool(t) for _, t in split)
    length = sum(len(t) for _, t in split)
    asked = {}
    for i, text in items:
        if i is not None and text is not None:
            asked[i] = min(asked.get(i, text), text)
    out = []
    for item, text in asked.items():
        scores = {}
        for term in set(terms(text)):
            df = sum(term in t for _, t in split)
            w = floor(1000 * log((2 * total + 2) / (2 * df + 1)))
            for row, (d, t) in enumerate(split):
                if (tf := t.count(term)) and d is not None:
                    m = 10 + 90 * len(t) * total // length
                    scores[row] = scores.get(row, 0) + w * (10**9 * tf // (1000 * tf + 8 * m))
        best = sorted((-s, split[row][0]) for row, s in scores.items() if s > 0)[:k]
        out += [(item, rank, d, -s) for rank, (s, d) in enumerate(best, 1)]
    return sorted(out)


def items_of(spark, pairs):
    rows = [(*p, "x", 1, 2) for p in pairs]
    return spark.createDataFrame(rows, "item_id long, text string, rank string, item int, score int")


def texts(seed, n, most=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(150)] + ["Straße", "ÄÖ", "x9", "漢字"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [" ".join(rng.choices(vocabulary, weights, k=rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("shard", [50, 8192])
@pytest.mark.parametrize("block", [100, 1 << 23])
def test_like_brute_force(spark, documents, odd, monkeypatch, shard, block):
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard)
    docs = odd + list(enumerate(texts(1, 500), 100)) + [(50 + i % 4, "w1 W3-w40 w7 w7") for i in range(60)]
    items = list(enumerate(texts(2, 12))) + [(20, "words"), (21, None), (22, ""), (None, "w1"), (23, "unheard of"), (24, "w9 w8"), (24, "w8 w9"), (25, "WORD two_漢字")]
    found = lexical.top_k(documents(docs), items_of(spark, items), 10, block)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(tuple(r) for r in found.collect()) == brute_force(docs, items, 10)


def test_empty(spark, documents):
    docs, items = documents([(1, "a b"), (2, None)]), items_of(spark, [(1, "a")])
    assert [tuple(r)[:3] for r in lexical.top_k(docs, items).collect()] == [(1, 1, 1)]
    assert lexical.top_k(docs.limit(0), items).count() == lexical.top_k(docs, items.limit(0)).count() == 0
    assert lexical.top_k(documents([(1, None), (2, "")]), items).count() == 0


def test_pair_bounds_are_tighter_than_sums():
    """Two terms that are frequent in different documents have a joint bound far below the sum of their maxima."""
    row = {
        "ids": np.arange(4), "sizes": np.full(4, 30), "ranked": np.ones(4, bool), "terms": np.array([0, 1]), "ends": np.array([3, 6]),
        "places": np.array([0, 1, 2, 1, 2, 3]), "counts": np.array([20, 1, 1, 1, 1, 20]),
    }
    shard = lexical.Shard(row, np.array([1000, 1000]), 4, 120)
    shard.add_pair((0, 1))
    joint, bound = shard.pairs[0, 1]
    scores = np.zeros(4, int)
    for places, impacts in shard.lists.values():
        scores[places] += impacts
    assert bound == scores.max() < shard.most[0] + shard.most[1]
    assert sorted(joint) == sorted(scores[1:3])
    assert [int(s) for s in np.sort(shard.search([0, 1], 2, 1)[1])[-2:]] == sorted(scores)[-2:]


def test_long_documents_keep_whole_numbers():
    sizes = np.array([1 << 40, 3, 0])
    assert lexical.length_factor(sizes, 1 << 30, 7 << 40).tolist() == [10 + 90 * n * (1 << 30) // (7 << 40) for n in (1 << 40, 3, 0)]
