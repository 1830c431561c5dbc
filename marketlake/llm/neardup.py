"""Near-duplicate documents by MinHash with tensored banding."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import query, table
from .kernels import BASE, LOWER, U64, PrimeHasher, by_size, mix, runs, utf8, words
from .steps import Steps, components

SIDE = 8  # collections on each side; SIDE * SIDE tables
ROWS = 2  # minimum hashes in a collection, so 4 in a table's key
PIVOT_ROUNDS = 2
BITS = 1024  # of a set's parity bitmap
SALTS = mix(np.arange(1, 2 * SIDE * ROWS + 1, dtype=U64) * U64(BASE)) | U64(1)


class Shingler:
    """Distinct shingle hashes of each text of a batch, ascending."""

    def __init__(self, size: int) -> None:
        self.size, self.hash = size, PrimeHasher()

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all texts in a row, and the texts' offsets in them."""
        data, offsets = utf8(column)
        data = LOWER[data]
        starts, ends, rows = words(data, offsets)
        hashes, bounds = self.hash(data, starts, ends), runs(rows, len(column))
        rolled = np.zeros(len(hashes), U64)
        for i in range(self.size):
            rolled[: len(hashes) - i] += hashes[i:] * SALTS[i]
        rolled = mix(rolled)
        out = []
        for low, high in zip(bounds[:-1], bounds[1:]):
            if high - low >= self.size:
                found = np.sort(rolled[low : high - self.size + 1])
                out.append(found[np.append(True, found[1:] != found[:-1])])
            elif high > low:  # the whole sequence as one
                whole = (hashes[low:high] * SALTS[: high - low]).sum(dtype=U64) + U64(high - low)
                out.append(mix(np.array([whole], U64)))
            else:
                out.append(np.zeros(0, U64))
        return np.concatenate(out), np.append(0, np.cumsum([len(x) for x in out]))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.append(U64(0), np.cumsum(values, dtype=U64))[bounds])


def _collections(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Keys of the 2 * SIDE collections of each non-empty set: one row per set."""
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    keys = np.zeros((len(heads), 2 * SIDE), U64)
    for i, salt in enumerate(SALTS):
        least = np.minimum.reduceat((values ^ salt) * salt, heads) if len(heads) else np.zeros(0, U64)
        keys[:, i // ROWS] = mix(keys[:, i // ROWS] + least + U64(i + 1))
    return keys


def _bitmaps(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each set, the parity of its hashes in each of BITS classes, 64 to a long."""
    n = len(bounds) - 1
    place = np.repeat(np.arange(n), np.diff(bounds)) * BITS + (values >> U64(64 - BITS.bit_length() + 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=n * BITS) & 1).astype(bool)
    return np.packbits(odd.reshape(n, BITS), axis=1, bitorder="little").view(np.int64)


def _sketch_task(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    shingles = Shingler(size)
    for batch in by_size(batches, "text"):
        values, bounds = shingles(batch.column("text"))
        counts = np.diff(bounds)
        digests = [_sums(mix(values ^ U64(x)), bounds).view(np.int64) for x in (BASE, 1)]
        some = counts > 0
        keys = _collections(values, bounds).view(np.int64)
        lists = pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum(some * 2 * SIDE)).astype(np.int32)), pa.array(keys.ravel())
        )
        bits = pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum(some * (BITS // 64))).astype(np.int32)), pa.array(_bitmaps(values, bounds)[some].ravel())
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts.astype(np.int64)), *(pa.array(x) for x in digests), lists, bits],
            ["doc_id", "n_shingles", "node", "check", "keys", "bits"],
        )


def _sets_task(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    shingles = Shingler(size)
    for batch in by_size(batches, "text"):
        values, bounds = shingles(batch.column("text"))
        node = _sums(mix(values ^ U64(BASE)), bounds).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(node), lists], ["node", "shingles"])


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: int = 80, steps: Steps | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (doc_id, text).

    Links are pairs whose sets of ``shingle``-word shingles have ``100 * intersection >= similarity * union``.
    Texts of one set count as one node, so copies are never compared. A node has 16 keys from 32
    minimum hashes; each pair of a left and a right key is a table's key, 64 tables in all. In each table's
    bucket members are compared with a pivot, two pivots in turn; then members of buckets that still span
    several components are compared across components, those of the largest only with the others, and each pair
    only in the first table that has it. Pairs whose sizes or parity bitmaps rule the similarity out are dropped
    inside the join: each odd class of the two bitmaps together needs a shingle that only one has. All others
    are confirmed on full sets.

    A text without words, or null, has 0 shingles and links with nothing. A null doc_id is its own
    component with ``component_id`` null and ``kept`` true. Repeated rows share a component and are all kept
    if they bear its smallest id. Other columns are ignored; an empty table gives no rows.
    """
    steps = steps or Steps(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, node long, check long, keys array<long>, bits array<long>"
    sketch = steps.keep(docs.mapInArrow(lambda b: _sketch_task(b, shingle), schema))
    start = len(steps.paths)
    nodes = steps.keep(
        sketch.where("n_shingles > 0 and doc_id is not null").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.min("check").alias("check"), F.max("check").alias("other"),
            F.first("n_shingles").alias("n"), F.first("keys").alias("keys"), F.first("bits").alias("bits"),
        )
    )
    if not nodes.where("check <> other").isEmpty():
        raise ValueError("two different shingle sets have one digest")
    table_key = [F.xxhash64(F.lit(i * SIDE + j), F.col("keys")[i], F.col("keys")[SIDE + j]) for i in range(SIDE) for j in range(SIDE)]
    entries = nodes.select("node", F.posexplode(F.array(*table_key)).alias("table", "key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("key")
    members = steps.keep(entries.join(shared, "key"))
    wanted = members.select("node").distinct().join(nodes, "node")
    facts = steps.keep(wanted.select("node", "doc_id", "n", "bits", "keys"))
    sets = steps.keep(
        docs.join(facts.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(lambda b: _sets_task(b, shingle), "node long, shingles array<long>")
        .groupBy("node").agg(F.first("shingles").alias("shingles"))
    )

    def named(name: str) -> DataFrame:
        return facts.select(F.col("node").alias(name), *(F.col(c).alias(f"{name}{c}") for c in ("n", "bits", "keys")))

    total = F.col("an") + F.col("bn")
    odd = reduce(add, (F.bit_count(F.col("abits")[i].bitwiseXOR(F.col("bbits")[i])) for i in range(BITS // 64)))
    possible = (100 * F.least("an", "bn") >= similarity * F.greatest("an", "bn")) & (100 * (total - odd) >= similarity * (total + odd))
    differ = lambda i: F.col("akeys")[i] != F.col("bkeys")[i]
    left, right = F.floor(F.col("table") / SIDE), F.col("table") % SIDE
    first = reduce(and_, ((left <= i) | differ(i) for i in range(SIDE - 1)))
    first &= reduce(and_, ((right <= j) | differ(SIDE + j) for j in range(SIDE - 1)))
    links = steps.keep(members.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0))
    found = links
    for turn in range(PIVOT_ROUNDS + 1):
        placed = members.withColumn("root", F.col("node"))
        if turn:
            roots = components(links, steps)
            placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
            mixed = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
            placed = steps.keep(placed.join(mixed.select("key"), "key", "left_semi"))
        if turn < PIVOT_ROUNDS:
            order = F.struct(F.xxhash64("node", F.lit(turn)), "node", "root")
            pivots = placed.groupBy("key").agg(F.min(order).alias("p")).select("key", F.col("p.node").alias("pivot"), F.col("p.root").alias("proot"))
            pairs = placed.join(pivots, "key").where("root <> proot")
            pairs = pairs.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
            pairs = pairs.join(named("a"), "a").join(named("b"), "b").where(possible).select("a", "b")
        else:
            by_root = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("many"))
            main = by_root.groupBy("key").agg(F.max(F.struct("many", "root")).alias("m")).select("key", F.col("m.root").alias("main"))
            placed = placed.join(main, "key").withColumn("out", F.col("root") != F.col("main"))
            a = placed.where("out").select("key", "table", F.col("root").alias("ar"), F.col("node").alias("a")).join(named("a"), "a")
            b = placed.select("key", "out", F.col("root").alias("br"), F.col("node").alias("b")).join(named("b"), "b")
            once = (F.col("ar") != F.col("br")) & (~F.col("out") | (F.col("a") < F.col("b")))
            pairs = a.join(b, "key").where(once & first & possible)
            pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = steps.keep(pairs.join(found, ["a", "b"], "left_anti"))
        found = found.union(pairs)
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
        both = both.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
        common = F.size(F.array_intersect("sa", "sb"))
        fits = 100 * common >= similarity * (F.size("sa") + F.size("sb") - common)
        links = links.union(steps.keep(both.where(fits).select("a", "b")))
    roots = components(links, steps)
    placed = nodes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    owner = steps.keep(placed.join(smallest, "root").select("node", "component_id"))
    steps.drop_from(start, but_last=True)  # the result reads the sketch and the owners only
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    placed = sketch.select("doc_id", "n_shingles", F.when(linked, F.col("node")).alias("node")).join(owner, "node", "left")
    own = F.coalesce("component_id", "doc_id")
    return placed.select(
        "doc_id", "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept")
    )


SQL = """
with recursive documents_of as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
    from documents
), sets as (
    select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s
    from documents_of
), rows_ as (
    select doc_id, unnest(s) as g from sets
), common as (
    select a.doc_id as u, b.doc_id as v, count(*) as c from rows_ a join rows_ b on a.g = b.g and a.doc_id < b.doc_id group by all
), links as (
    select u, v from common join sets a on a.doc_id = u join sets b on b.doc_id = v
    where 100 * c >= 85 * (len(a.s) + len(b.s) - c)
), both_ways as (
    select u, v from links union select v, u from links
), reached as (
    select doc_id, doc_id as other from sets
    union
    select r.doc_id, b.v from reached r join both_ways b on r.other = b.u
), smallest as (
    select doc_id, min(other) as component_id from reached group by doc_id
)
select doc_id, len(s) as n_shingles, component_id, component_id = doc_id as kept from sets join smallest using (doc_id)
"""


@query("op9_minhash_tensored", SQL)
def op9(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, similarity=85)
