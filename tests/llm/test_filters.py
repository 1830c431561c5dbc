import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import quality, toxicity
from marketlake.llm.trees import BoostedTrees, Isotonic, bounded_sample, out_of_fold

SF = "/root/testdata/sf0.01"


def test_isotonic_like_brute_force():
    rng = np.random.default_rng(3)
    score = rng.integers(0, 30, 200) / 30
    y = (rng.random(200) < score).astype(float)
    found = Isotonic.fit(score, y)(np.unique(score))
    keys = np.unique(score)
    means = {}  # the greatest of the least means over intervals
    for i in range(len(keys)):
        means[i] = max(min(y[(score >= keys[a]) & (score <= keys[b])].mean() for b in range(i, len(keys))) for a in range(i + 1))
    assert np.allclose(found, [means[i] for i in range(len(keys))], atol=0.02)


def test_trees_learn_a_rule():
    rng = np.random.default_rng(4)
    x = rng.random((2000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = BoostedTrees().fit(x[:1500], y[:1500])
    assert ((model.margin(x[1500:]) > 0) == (y[1500:] > 0)).mean() > 0.97
    assert BoostedTrees().fit(x, np.zeros(2000)).margin(x).max() < -5


@pytest.fixture(scope="module")
def frames(spark):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    return read("documents"), read("labels")


def test_toxicity_held_out(spark, frames):
    docs, labels = frames
    found = toxicity.score(docs, toxicity.fit_on_training(docs, labels))
    rows = found.join(labels, "doc_id").where(toxicity.held_out(3, 1)).collect()
    bad, fine = ([r.score for r in rows if r.toxic == t] for t in (1, 0))
    assert all(0 <= s <= 1 for s in bad + fine)
    assert np.mean([[b > f for f in fine] for b in bad]) > 0.9
    assert sum(r.predicted and not r.toxic for r in rows) <= 2
    assert set(docs.columns) < set(found.columns) and found.count() == docs.count()


def test_toxicity_does_not_read_held_out_labels(spark, frames):
    from pyspark.sql import functions as F

    docs, labels = frames
    other = labels.withColumn("toxic", F.when(toxicity.held_out(3, 1), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda l: sorted((r.doc_id, r.score) for r in toxicity.score(docs.select("doc_id", "text"), toxicity.fit_on_training(docs, l)).collect())
    assert score(labels) == score(other)


def test_quality_held_out(spark, frames):
    docs, labels = frames
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.score(docs, model).join(labels.withColumnRenamed("quality", "label"), "doc_id").where("doc_id % 2 = 1").collect()
    assert sum(r.good != bool(r.label) for r in rows) < 0.06 * len(rows)
    assert sum(not r.good for r in rows if r.label) <= 0.02 * len(rows)


def test_odd_rows(spark, documents, odd, frames):
    docs, labels = frames
    tox, good = toxicity.fit_on_training(docs, labels), quality.fit(docs, labels)
    rows = documents(odd)
    for found, column in ((toxicity.score(rows, tox), "score"), (quality.score(rows, good), "quality")):
        out = found.collect()
        assert len(out) == len(odd) and all(0 <= r[column] <= 1 for r in out) and all(r.node == "x" for r in out)
        assert len({r[column] for r in out if not r.text}) == 1
    assert toxicity.score(documents([]), tox).count() == quality.score(documents([]), good).count() == 0


def test_no_labels(spark, documents, odd, frames):
    _, labels = frames
    rows = documents(odd)
    for known in (labels.limit(0), spark.createDataFrame([(1, 0, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")):
        assert {r.predicted for r in toxicity.score(rows, toxicity.fit(rows, known)).collect()} == {0}
        assert quality.score(rows, quality.fit(rows, known)).count() == len(odd)


def test_a_repeated_document_weighs_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    one = labels.where("toxic = 0 and quality is not null").orderBy("doc_id").first().doc_id
    more = docs.unionByName(docs.where(F.col("doc_id") == one).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n"))
    for module, column in ((toxicity, "score"), (quality, "quality")):
        single, repeated = ({r.doc_id: r[column] for r in module.score(docs, module.fit(d, labels)).collect()} for d in (docs, more))
        assert max(abs(single[d] - repeated[d]) for d in single) < 0.02


def test_small_shares_are_no_empty_samples(spark, monkeypatch):
    rows = spark.range(200_000).withColumnRenamed("id", "doc_id")
    assert 150 < bounded_sample(rows, "doc_id", 200, "s").count() < 250
    monkeypatch.setattr(type(rows), "count", lambda self: 40_000_000_000_000)  # as of a table of that size
    sample = bounded_sample(rows, "doc_id", 20_000, "s")
    monkeypatch.undo()
    bound = int((1 << 53) * 20_000 / 40_000_000_000_000)
    assert bound > 4_000_000 and str(bound) in sample._jdf.queryExecution().analyzed().toString()


def plain_co_training(xs, y, fold, pool, many, rounds):
    """Co-training over rows (place, a, b), one by one."""
    make = lambda: BoostedTrees(rounds=40)
    share, given = y.mean(), {0: [], 1: []}
    for turn in range(rounds):
        sure = {}
        for v in (0, 1):
            more = given[1 - v]
            x = np.array([*xs[v], *(r[0][v] for r in more)])
            trees = make().fit(x, np.array([*y, *(r[1] for r in more)]), np.array([1.0] * len(y) + [quality.PSEUDO_WEIGHT] * len(more)))
            curve = Isotonic.fit(out_of_fold(xs[v], y, fold, make), y)
            p = [curve(trees.margin(np.array([r[1 + v]])))[0] for r in pool]
            good, bad = ([r for r, q in zip(pool, p) if keep(q)] for keep in (lambda q: q >= quality.SURE, lambda q: q <= 1 - quality.SURE))
            n = min(many * (turn + 1), int(len(good) / max(share, 0.01)), int(len(bad) / max(1 - share, 0.01)))
            take = lambda rows, want: [r for r in rows if r[0] < 2**53 * want / max(len(rows), 1)]
            sure[v] = sorted([*((r, 1.0) for r in take(good, n * share)), *((r, 0.0) for r in take(bad, n * (1 - share)))])
        given = {v: [((r[1], r[2]), label) for r, label in sure[v]] for v in (0, 1)}
    return given


@pytest.mark.parametrize("many", [60, 100_000])
def test_co_training_like_a_plain_loop(spark, frames, monkeypatch, many):
    docs, labels = frames
    known = labels.where("doc_id % 2 = 0 and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("y"))
    rows = quality._featured(docs, "doc_id", "long").join(known, "doc_id").orderBy("doc_id").collect()
    xs, y, fold = quality._matrices(rows), np.array([float(r.y) for r in rows]), np.array([r.doc_id // 2 % 3 for r in rows])
    pool = quality.unlabelled(docs, known)
    monkeypatch.setattr(quality, "EXCHANGED", many)
    asked = []

    def watched(views, share, limit):
        asked.append(quality.exchange_over(pool)(views, share, limit))
        return asked[-1]

    quality.co_train(xs, y, fold, watched)
    plain = plain_co_training(xs, y, fold, [(r.place, list(r.a), list(r.b)) for r in pool.collect()], many, quality.ROUNDS)
    assert all(len(given[0][1]) for given in asked)  # the text view is sure of some rows in each round
    for v in (0, 1):
        (a, b), label = asked[-1][v]
        assert [((list(i), list(j)), k) for i, j, k in zip(a, b, label)] == plain[v]


def test_pool_is_all_rows_without_a_label(spark, frames):
    docs, labels = frames
    known = labels.where("quality is not null").select("doc_id").distinct()
    twice = docs.unionByName(docs).unionByName(docs.withColumn("doc_id", F.lit(None).cast("long")).limit(1))
    rest = docs.join(known, "doc_id", "left_anti").count()
    assert 0.9 * rest < quality.unlabelled(docs, known).count() <= quality.unlabelled(twice, known).count() <= rest + 1
