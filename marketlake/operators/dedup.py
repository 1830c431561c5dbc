"""De-duplication and batching.

"First" and "last" need an order: every operator takes one. ``row_number() = 1`` is
planned with a group limit below the shuffle, so each map task sends at most one row per
key and a key with a third of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import non_blank


def _pick(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def _orders(order_by: Sequence[str], reverse: bool) -> list[Column]:
    """``x`` rises and ``-x`` falls, or the other way round."""
    falls = [(name.removeprefix("-"), name.startswith("-") != reverse) for name in order_by]
    return [F.col(name).desc() if down else F.col(name).asc() for name, down in falls]


def keep_first(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the lowest in ``order_by``."""
    return _pick(df, keys, _orders(order_by, reverse=False))


def keep_last(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the highest in ``order_by``."""
    return _pick(df, keys, _orders(order_by, reverse=True))


def dedup_news(df: DataFrame, id_col: str, title_col: str, order_by: Sequence[str]) -> DataFrame:
    """One row per news item, known by its id or else its title; items with neither go."""
    blank = F.lit(None).cast("string")
    key = F.coalesce(
        F.when(F.col(id_col).cast("string") != "", F.col(id_col).cast("string")).otherwise(blank),
        F.when(non_blank(F.col(title_col)), F.col(title_col)).otherwise(blank),
    )
    keyed = df.withColumn("_news_key", key).where(F.col("_news_key").isNotNull())
    return keep_first(keyed, ["_news_key"], order_by).drop("_news_key")


def dedup_report(df: DataFrame, group: str, key: Column) -> DataFrame:
    """Per group: rows, distinct keys and the rows de-duplication drops."""
    counts = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("total_rows"), F.countDistinct(key).alias("kept_rows")
    )
    return counts.withColumn("dropped_rows", F.col("total_rows") - F.col("kept_rows"))


BUCKET_ROWS = 1 << 18  # rows ranked together, until there are MOST_BUCKETS
MOST_BUCKETS = 1024
STEP = 32  # bounds looked at in each of two steps
SAMPLE = 64  # sampled rows for each bucket


def _precedes(bound: Column, names: Sequence[str], falls: Sequence[bool]) -> Column:
    """Does the bound, a struct, come before the row in the order of ``names``? Nulls are lowest."""
    before = F.lit(False)
    for name, down in reversed(list(zip(names, falls))):
        b, r = bound[name], F.col(name)
        lower = F.coalesce(b > r, r.isNull() & b.isNotNull()) if down else F.coalesce(b < r, b.isNull() & r.isNotNull())
        before = lower | (b.eqNullSafe(r) & before)
    return before


def _bounds(rows: DataFrame, names: Sequence[str], order: Sequence[Column], buckets: int, total: int) -> list[Column]:
    """Values between buckets of about equal size, from a sample whose size goes by the number of buckets."""
    sample = rows.select(*names).sample(min(1.0, SAMPLE * buckets / total), seed=0)
    place = F.row_number().over(Window.orderBy(*order))
    chosen = sample.withColumn("_place", place).where(F.col("_place") % SAMPLE == 0).orderBy("_place").limit(MOST_BUCKETS)
    types = {f.name: f.dataType for f in sample.schema.fields}
    return [F.struct(*[F.lit(r[n]).cast(types[n]).alias(n) for n in names]) for r in chosen.collect()]


def with_position(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """0-based ``position`` of each row in the given order.

    The keys alone are read to find how many rows lie between the bounds of about equal buckets; that gives each
    bucket its exact first position, and the rows of a bucket are ranked by themselves. So rows are shuffled once,
    with the columns that are asked for, and nothing is stored. A hash of the row breaks ties, and then the
    task that reads it, so that a value, or a row, that makes up a third of all spreads over several buckets.

    ``df`` must have the same rows in the same tasks each time it is read, as files do.
    """
    names = [name.removeprefix("-") for name in order_by] + ["_tie", "_task"]
    falls = [name.startswith("-") for name in order_by] + [False, False]
    order = [F.col(n).desc() if down else F.col(n).asc() for n, down in zip(names, falls)]
    rows = df.withColumns({"_tie": F.xxhash64(*df.columns), "_task": F.spark_partition_id()})
    total = df.count()
    buckets = min(MOST_BUCKETS, -(-total // BUCKET_ROWS))
    if buckets < 2:
        rank = F.row_number().over(Window.orderBy(*order))
        return rows.withColumn("position", rank.cast("bigint") - 1).drop("_tie", "_task")
    bounds = _bounds(rows, names, order, buckets, total)
    passed = lambda some: F.size(F.filter(some, lambda b: _precedes(b, names, falls)))
    coarse = passed(F.array(*bounds[STEP - 1 :: STEP])) if len(bounds) >= STEP else F.lit(0)
    rows = rows.withColumn("_coarse", coarse)
    fine = passed(F.slice(F.array(*bounds), F.col("_coarse") * STEP + 1, STEP)) if bounds else F.lit(0)
    rows = rows.withColumn("_bucket", F.col("_coarse") * STEP + fine)
    sizes = dict(rows.groupBy("_bucket").count().collect())
    firsts, first = [], 0
    for bucket in range(len(bounds) + 1):
        firsts.append(first)
        first += sizes.get(bucket, 0)
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    position = F.lit(firsts).cast("array<bigint>")[F.col("_bucket")] + rank - 1
    return rows.withColumn("position", position).drop("_tie", "_task", "_coarse", "_bucket")


def assign_batches(df: DataFrame, size: int, order_by: Sequence[str]) -> DataFrame:
    """0-based ``batch`` of ``size`` consecutive rows each; the last may be shorter."""
    if size < 1:
        raise ValueError("batch size must be at least 1")
    return with_position(df, order_by).withColumn(
        "batch", F.floor(F.col("position") / F.lit(size)).cast("bigint")
    )


def batch_lists(df: DataFrame, column: str) -> DataFrame:
    """Each batch as one array in order; a batch is as small as its fixed size."""
    ordered = F.array_sort(F.collect_list(F.struct("position", column)))
    return df.groupBy("batch").agg(
        F.transform(ordered, lambda item: item[column]).alias(f"{column}s")
    )
