import random

from pyspark.sql import functions as F

from marketlake.llm.maxscore import integer_terms, top_k


def brute_force(rows, queries, k):
    out = []
    for own, weights in queries:
        scores = sorted((-sum(a * b for a, b in zip(weights, terms)), i) for i, terms in rows if i != own)
        out += [(own, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_like_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice((0, 0, 0, rng.randint(-900, 900))) for _ in range(40)]) for i in range(3000)]
    rows += [(5000 + i, rows[i % 7][1]) for i in range(50)]  # ties
    frame = spark.createDataFrame(rows, "id long, terms array<long>").repartition(3)
    found = top_k(frame, frame.where("id % 100 = 0"), 10)
    assert sorted(tuple(r) for r in found.collect()) == brute_force(rows, [r for r in rows if r[0] % 100 == 0], 10)


def test_large_weights_stay_exact(spark):
    rows = [(i, [(1 << 30) + i, (1 << 29) - 3 * i]) for i in range(50)]
    frame = spark.createDataFrame(rows, "id long, terms array<long>")
    found = top_k(frame, frame.where("id = 7"), 3)
    assert sorted(tuple(r) for r in found.collect()) == brute_force(rows, [rows[7]], 3)


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(1, [0.5, 1.0]), (2, [nan, 1.0]), (3, None), (4, [None, 1.0]), (None, [1.0, 1.0]), (5, []), (6, [-0.0004, 2.0]), (6, [1.0])]
    frame = spark.createDataFrame(rows, "id long, v array<float>").select("id", integer_terms(F.col("v")).alias("terms"), F.lit("x").alias("score"))
    assert {r.id: r.terms for r in frame.where("terms is not null and id in (1, 5)").collect()} == {1: [512, 1024], 5: []}
    found = sorted(tuple(r) for r in top_k(frame, frame.where("id in (1, 2, 3)"), 10).collect())
    assert found == [(1, 1, 6, 1024 * 2048 - 512), (1, 2, 6, 512 * 1024), (1, 3, 5, 0)]
    assert top_k(frame.limit(0), frame).count() == 0 and top_k(frame, frame.limit(0)).count() == 0
