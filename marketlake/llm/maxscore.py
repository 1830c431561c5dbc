"""Exact top-k search by MaxScore over integer term weights."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import query, table
from .steps import Steps

BLOCK = 1024  # queries sent to the executors at once
SHARD = 8192  # rows whose postings are traversed together
STEP = 12  # terms probed between two looks at the threshold
EXACT = float(1 << 53)


def integer_terms(vector: Column, scale: int = 1024) -> Column:
    """``floor(scale * x)`` per component; null if the vector or a component is null or not finite."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    terms = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return F.when(F.forall(vector, number), terms)


def _matrix(terms: list, width: int) -> np.ndarray:
    """Postings: one row per term, one column per vector; missing terms weigh 0."""
    out = np.zeros((width, len(terms)), np.int64)
    for i, row in enumerate(terms):
        out[: len(row), i] = row[:width]
    return out


class Shard:
    """Postings of some rows with the bounds of each term."""

    def __init__(self, ids: np.ndarray, postings: np.ndarray) -> None:
        self.ids, self.postings = ids, postings
        self.low, self.high = postings.min(1), postings.max(1)
        self.most = float(np.abs(postings).max(initial=0))

    def search(self, own_id: int, weights: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the rows that score ``floor`` or more and are among the k best here.

        Terms are taken by falling spread of what they can add. The essential ones are those
        without which a row can still reach the threshold; their postings are traversed for all
        rows, the others probed only for rows whose bound stays at the threshold.
        """
        kind = np.float64 if float(np.abs(weights).sum()) * self.most < EXACT else np.int64
        postings, weights = self.postings.astype(kind, copy=False), weights.astype(kind)
        a, b = weights * self.low, weights * self.high
        best, spread = np.maximum(a, b), np.abs(a - b)
        order = np.argsort(-spread, kind="stable")
        rest = np.append(np.cumsum(best[order][::-1])[::-1], 0)  # bound of the terms from each place on
        alive = np.flatnonzero(self.ids != own_id)
        if floor == -np.inf and len(alive) > 4 * k:  # a first threshold from a few rows
            some = alive[: 4 * k]
            floor = np.partition(weights @ postings[:, some], -k)[-k]
        gains = np.cumsum(spread[order])  # a row without any of the first n terms' gains falls this short
        essential = int(np.searchsorted(gains, rest[0] - floor, "right")) + 1 if floor > -np.inf else len(order)
        done = min(max(STEP, essential), len(order))
        partial = weights[order[:done]] @ postings[np.ix_(order[:done], alive)] if len(alive) else np.zeros(0, kind)
        while True:
            keep = partial + rest[done] >= floor
            alive, partial = alive[keep], partial[keep]
            if done == len(order) or not len(alive):
                break
            terms = order[done : done + STEP]
            partial = partial + weights[terms] @ postings[np.ix_(terms, alive)]
            done += len(terms)
        top = np.lexsort((self.ids[alive], -partial))[:k]
        return self.ids[alive[top]], partial[top].astype(np.int64)


def _search_shards(batches: Iterator[pa.RecordBatch], query_ids: np.ndarray, weights: np.ndarray, k: int):
    """The k best of the task's rows for each query of a block."""
    held: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2 for _ in query_ids]
    floors = np.full(len(query_ids), -np.inf)

    def take(ids: list, terms: list) -> None:
        if not ids:
            return
        shard = Shard(np.array(ids, np.int64), _matrix(terms, weights.shape[1]))
        if float(np.abs(weights).sum(1).max(initial=0)) * shard.most < EXACT:
            shard.postings = shard.postings.astype(np.float64)
        for q, own in enumerate(query_ids):
            found, scores = shard.search(own, weights[q], k, floors[q])
            if len(found):
                found, scores = np.append(held[q][0], found), np.append(held[q][1], scores)
                top = np.lexsort((found, -scores))[:k]
                held[q] = found[top], scores[top]
                if len(top) == k:
                    floors[q] = scores[top[-1]]

    ids: list = []
    terms: list = []
    for batch in batches:
        ids += batch.column("id").to_pylist()
        terms += batch.column("terms").to_pylist()
        if len(ids) >= SHARD:
            take(ids, terms)
            ids, terms = [], []
    take(ids, terms)
    for q, (found, scores) in enumerate(held):
        if len(found):
            own = np.full(len(found), query_ids[q])
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(found), pa.array(scores)], ["query_id", "id", "score"])


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The k highest inner products of each query: ``query_id, rank, id, score``.

    Both sides have ``id`` (long) and ``terms`` (array of long); rows with a null in either take
    no part, an id is never a candidate for itself, ties go to the smaller id, and of several
    query rows with one id the smallest vector asks. Vectors of other lengths are filled up with
    zeros. Queries are stored, pass through the driver partition by partition and travel in blocks of 1024.
    Each block's results are stored before the next is taken, so no plan holds more than one block; each task
    keeps k rows per query, and the merge reads k rows per query and task.
    """
    whole = lambda df: df.select("id", "terms").where("id is not null and terms is not null")
    rows, asked = whole(rows), whole(queries).groupBy("id").agg(F.min("terms").alias("terms"))
    spark = rows.sparkSession
    steps, kept = Steps(spark), Steps(spark)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    waiting = steps.keep(asked).toLocalIterator()
    results = []
    while block := list(islice(waiting, BLOCK)):
        ids = np.array([r.id for r in block], np.int64)
        weights = _matrix([r.terms for r in block], max(len(r.terms) for r in block)).T

        def search(batches, ids=ids, weights=weights):
            return _search_shards(batches, ids, weights, k)

        found = rows.mapInArrow(search, "query_id long, id long, score long")
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        results.append(kept.keep(ranked.select("query_id", "rank", "id", "score")))
    steps.drop_from(0)
    schema = "query_id long, rank int, id long, score long"
    return spark.read.schema(schema).parquet(*kept.paths) if results else spark.createDataFrame([], schema)


SQL = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as t
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id as vec_id,
           list_inner_product(q.t::double[], c.t::double[])::bigint as score
    from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0
), placed as (
    select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from placed where rank <= 10
"""


@query("op8_maxscore_topk", SQL)
def op8(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("id"), integer_terms(F.col("embedding")).alias("terms")
    )
    found = top_k(vectors, vectors.where("id % 100 = 0"), 10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
