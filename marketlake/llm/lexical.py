"""Ranked lexical search: MaxScore whose bounds are tightened by term-pair intersection lists."""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import query, table
from .kernels import LOWER, by_size, utf8, words
from .steps import Steps

BLOCK = 1 << 23  # bytes of terms that are asked for at once; they travel to all tasks
SHARD_DOCS = 8192
SHARD_POSTINGS = 1 << 21
LONG = 1 << 63

BETWEEN = np.zeros(256, bool)
BETWEEN[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

POSTINGS = "docs long, words long, ids array<long>, sizes array<long>, terms array<int>, ends array<long>, places array<int>, counts array<long>"


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Terms of a text column as bytes, A-Z in lower case, and the row of each.

    A term is a run of ASCII letters and digits and of anything beyond ASCII.
    """
    data, offsets = utf8(column)
    data = LOWER[data]
    starts, ends, rows = words(data, offsets, BETWEEN)
    bounds = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    kept = np.ascontiguousarray(data[~BETWEEN[data]])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(bounds), pa.py_buffer(kept)]), rows


def asked_terms(items: DataFrame) -> DataFrame:
    """``item_id, terms`` (distinct, as bytes) of each item that has an id and a term.

    Of several rows with one id the smallest text asks.
    """
    single = items.where("item_id is not null").groupBy("item_id").agg(F.min("text").alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text"):
            terms, rows = terms_of(batch.column("text"))
            bounds = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            lists = [sorted(set(terms[a:b].to_pylist())) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(lists, pa.list_(pa.binary()))], ["item_id", "terms"])

    schema = f"item_id {single.schema['item_id'].dataType.simpleString()}, terms array<binary>"
    return single.mapInArrow(split, schema).where(F.size("terms") > 0)


def blocks_of(asked: DataFrame, most: int = BLOCK) -> Iterator[list]:
    """Items in blocks whose terms have about ``most`` bytes; the driver holds one block at a time."""
    block, size = [], 0
    for row in asked.toLocalIterator():
        own = sum(map(len, row.terms)) + 8 * len(row.terms)
        if block and size + own > most:
            yield block
            block, size = [], 0
        block.append(row)
        size += own
    if block:
        yield block


def _shard(parts: list[tuple]) -> pa.RecordBatch:
    """One row: the postings of some documents, by term."""
    firsts = np.append(0, np.cumsum([len(p[0]) for p in parts]))
    ids = pa.concat_arrays([p[0] for p in parts])
    sizes = np.concatenate([p[1] for p in parts])
    codes = np.concatenate([p[2] for p in parts])
    places = np.concatenate([p[3] + first for p, first in zip(parts, firsts)])
    counts = np.concatenate([p[4] for p in parts])
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    last = np.append(codes[1:] != codes[:-1], True) if len(codes) else np.zeros(0, bool)
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([int((sizes > 0).sum())]),
            pa.array([int(sizes.sum())]),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            one(sizes, pa.int64()),
            one(codes[last], pa.int32()),
            one(np.flatnonzero(last) + 1, pa.int64()),
            one(places[order], pa.int32()),
            one(counts[order], pa.int64()),
        ],
        ["docs", "words", "ids", "sizes", "terms", "ends", "places", "counts"],
    )


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Index of the whole texts of ``docs`` (doc_id, text) over the terms of ``vocabulary``, in shards.

    A row per shard: its documents with a term and all their terms, then ids and sizes in terms of its documents,
    and the postings of term after term (``terms``, ``ends``): place of the document and occurrences. Terms are
    compared by their bytes.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.large_binary())
        parts, n_docs, n_postings = [], 0, 0
        for batch in by_size(batches, "text"):
            terms, rows = terms_of(batch.column("text"))
            codes = pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy(zero_copy_only=False)
            hit = codes >= 0
            pairs, counts = np.unique(codes[hit].astype(np.int64) * batch.num_rows + rows[hit], return_counts=True)
            sizes = np.bincount(rows, minlength=batch.num_rows).astype(np.int64)
            parts.append((batch.column("doc_id"), sizes, pairs // batch.num_rows, pairs % batch.num_rows, counts))
            n_docs, n_postings = n_docs + batch.num_rows, n_postings + len(pairs)
            if n_docs >= SHARD_DOCS or n_postings >= SHARD_POSTINGS:
                yield _shard(parts)
                parts, n_docs, n_postings = [], 0, 0
        if parts:
            yield _shard(parts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(index, POSTINGS)


def document_counts(index: DataFrame) -> dict[int, int]:
    """Documents that hold each term of the vocabulary, over all shards."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, ends in zip(batch.column("terms"), batch.column("ends")):
                n = np.diff(ends.values.to_numpy(zero_copy_only=False), prepend=0)
                yield pa.RecordBatch.from_arrays([terms.values, pa.array(n)], ["term", "df"])

    found = index.select("terms", "ends").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r.term: r.df for r in found.collect()}


def term_weight(n_docs: int, df: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A document's m: 10 and its size in ninetieths of the mean size."""
    if 90 * int(sizes.max(initial=0)) * n_docs >= LONG:
        return np.array([10 + 90 * int(n) * n_docs // n_terms for n in sizes], np.int64)
    return 10 + 90 * sizes * n_docs // max(1, n_terms)


class Shard:
    """Postings of some documents with their impacts, and the intersection lists of the pairs that are asked for.

    A pair's list holds the documents with both terms and their joint impacts. Its bound, the most that the two
    terms add to any document, is the joint maximum or that of one term alone; it is at most the sum of the two
    terms' maxima, and most often far below it.
    """

    def __init__(self, row: dict, weights: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.ids = row["ids"]
        factor = length_factor(row["sizes"], n_docs, n_terms)
        terms = np.repeat(row["terms"], np.diff(row["ends"], prepend=0))
        keep = row["ranked"][row["places"]]
        terms, places, counts = terms[keep], row["places"][keep], row["counts"][keep]
        impacts = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * factor[places]))
        starts = np.flatnonzero(np.diff(terms, prepend=-1))
        self.lists = {
            int(terms[a]): (places[a:b], impacts[a:b]) for a, b in zip(starts, np.append(starts[1:], len(terms)))
        }
        self.most = {t: int(i.max()) for t, (_, i) in self.lists.items()}
        self.pairs: dict[tuple[int, int], tuple[np.ndarray, int]] = {}

    def add_pair(self, pair: tuple[int, int]) -> None:
        if pair in self.pairs or pair[0] not in self.lists or pair[1] not in self.lists:
            return
        short, long = sorted(pair, key=lambda t: len(self.lists[t][0]))
        joint = self.of(long, self.lists[short][0])
        both = joint >= 0
        joint = joint[both] + self.lists[short][1][both]
        self.pairs[pair] = joint, max(int(joint.max(initial=0)), self.most[pair[0]], self.most[pair[1]])

    def of(self, term: int, places: np.ndarray) -> np.ndarray:
        """Impacts of a term on documents; -1 where a document lacks it."""
        listed, impacts = self.lists[term]
        at = np.minimum(np.searchsorted(listed, places), len(listed) - 1)
        return np.where(listed[at] == places, impacts[at], -1)

    def search(self, terms: list[int], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of documents scoring ``least`` or more, with all that are among the k best here.

        ``terms`` come by falling weight, two and two as paired. The first of them are essential: a document
        with none of these stays below the threshold by the bounds of the rest. Their postings are traversed;
        the others are probed while a document can still reach the threshold.
        """
        pairs = [tuple(terms[i : i + 2]) for i in range(0, len(terms), 2)]
        here, bounds = [], []  # terms in this shard; bound of each with those behind it, within its pair
        for pair in pairs:
            own = [t for t in pair if t in self.lists]
            if len(own) == 2:
                joint, bound = self.pairs[pair]
                if len(joint) >= k:  # k documents have at least this
                    least = max(least, int(np.partition(joint, -k)[-k]))
                bounds += [(bound, True), (self.most[own[1]], False)]
            else:
                bounds += [(self.most[t], False) for t in own]
            here += own
        rest = [0] * (len(here) + 1)
        for i in range(len(here) - 1, -1, -1):
            bound, paired = bounds[i]
            rest[i] = bound + rest[i + 2 if paired else i + 1]
        least = max(least, 1)
        essential = next((i for i in range(len(here) + 1) if rest[i] < least), len(here))
        scores = np.zeros(len(self.ids), np.int64)
        for t in here[:essential]:
            places, impacts = self.lists[t]
            scores[places] += impacts  # a list names a document once
        alive = np.flatnonzero(scores)
        scores = scores[alive]
        for i in range(essential, len(here)):
            if len(scores) >= k:
                least = max(least, int(np.partition(scores, -k)[-k]))
            keep = scores + rest[i] >= least
            alive, scores = alive[keep], scores[keep]
            if not len(alive):
                break
            scores = scores + np.maximum(self.of(here[i], alive), 0)
        keep = scores >= least
        return self.ids[alive[keep]], scores[keep]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    top = np.lexsort((ids, -scores))[:k]
    return ids[top], scores[top]


def search(index: DataFrame, items: list[list[int]], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``item`` (its place in ``items``), ``doc_id, score``: the k best of each task's shards.

    ``items`` are lists of term codes. The threshold of an item passes from shard to shard.
    """
    ordered = [sorted((t for t in terms if weights[t] > 0), key=lambda t: (-weights[t], t)) for terms in items]
    asked = sorted({(terms[i], terms[i + 1]) for terms in ordered for i in range(0, len(terms) - 1, 2)}, key=itemgetter(0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ordered]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values for c in ("ids", "sizes", "terms", "ends", "places", "counts")}
                row["ranked"], row["ids"] = row["ids"].is_valid(), row["ids"].fill_null(0)
                shard = Shard({c: v.to_numpy(zero_copy_only=False) for c, v in row.items()}, weights, n_docs, n_terms)
                for pair in asked:
                    shard.add_pair(pair)
                for j, terms in enumerate(ordered):
                    least = int(held[j][1][-1]) if len(held[j][1]) == k else 1
                    found, scores = shard.search(terms, k, least)
                    if len(found):
                        held[j] = _best(np.append(held[j][0], found), np.append(held[j][1], scores), k)
        for j, (found, scores) in enumerate(held):
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), j, np.int32)), pa.array(found), pa.array(scores)], ["item", "doc_id", "score"])

    return index.select("ids", "sizes", "terms", "ends", "places", "counts").mapInArrow(run, "item int, doc_id long, score long")


def top_k(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = BLOCK) -> DataFrame:
    """The k documents that score highest for each item: ``item_id, rank, doc_id, score``.

    ``docs`` has doc_id and text, ``items`` item_id and text. Whole texts are indexed; counts are over all
    documents. Only scores above 0 are ranked, ties by the smaller doc_id. Items without id or terms have no rows,
    and of several rows with one item_id the smallest text asks. Each row of ``docs`` is a document of its own,
    repeated or not; null and empty texts have no terms, and rows without a doc_id count in the statistics but
    are not ranked. Without documents or items there are no rows.

    Items come in blocks of ``block_bytes`` of terms, so a block's vocabulary is all that travels to the tasks. For
    each block the texts are indexed over its vocabulary, which is stored, and each block's results are stored before
    the next is taken: a result has k rows per item, and tasks send k rows per item to the merge.
    """
    spark = docs.sparkSession
    steps, kept = Steps(spark), Steps(spark)
    asked = asked_terms(items)
    item_type = asked.schema["item_id"].dataType
    results = []
    for block in blocks_of(steps.keep(asked), block_bytes):
        vocabulary = sorted({bytes(t) for r in block for t in r.terms})
        code = {t: i for i, t in enumerate(vocabulary)}
        index = steps.keep(postings(docs, vocabulary))
        totals = index.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("docs", "words")]).first()
        df = document_counts(index)
        weights = np.array([term_weight(totals.docs, df[i]) if i in df else 0 for i in range(len(vocabulary))], np.int64)
        found = search(index, [[code[bytes(t)] for t in r.terms] for r in block], weights, totals.docs, totals.words, k)
        best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)], f"item int, item_id {item_type.simpleString()}")
        results.append(kept.keep(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")))
        steps.drop_from(1)
    steps.drop_from(0)
    schema = f"item_id {item_type.simpleString()}, rank int, doc_id long, score long"
    return spark.read.schema(schema).parquet(*kept.paths) if results else spark.createDataFrame([], schema)


TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
with d as (select row_number() over () as r, doc_id, {TERMS} as ts from documents where text is not null),
s as (select count(*) as n_docs, sum(len(ts))::bigint as n_terms from d where len(ts) > 0),
i as (select item_id, unnest(list_distinct({TERMS})) as term from benchmark where text is not null and item_id is not null),
p as (select r, term, count(*) as tf from (select r, unnest(ts) as term from d)
      where term in (select term from i) group by r, term),
w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w from p, s group by term, n_docs),
m as (select r, doc_id, 10 + (90 * len(ts) * n_docs) // n_terms as m from d, s),
x as (select item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
      from i join w using (term) join p using (term) join m using (r) where doc_id is not null group by item_id, r, doc_id)
select item_id, rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from x where score > 0)
where rank <= 10
"""


@query("op11_pair_bound_search", SQL)
def op11(spark, sf_dir):
    return top_k(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
