"""Positions and batches from the keys alone."""

import os

import pytest
from pyspark.sql import functions as F

from marketlake.operators import dedup

from .conftest import rows


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(dedup, "BUCKET_ROWS", 100)


def values(spark, n=20_000):
    """A third of the rows has one key, a sixth is one and the same row, and some keys are null."""
    name = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 500).cast("string"))
    value = F.when(F.col("id") % 6 == 0, F.lit(1)).otherwise(F.col("id") % 1000)
    return spark.range(0, n, 1, 8).select(name.alias("name"), value.alias("v"), (F.col("v") / 7).alias("d"))


@pytest.mark.parametrize("order", [["name", "v"], ["-name", "v"], ["-d", "-name"], ["v"]])
def test_like_a_sort(spark, small_buckets, order):
    df = values(spark)
    found = dedup.with_position(df, order)
    assert found.columns == [*df.columns, "position"] and dict(found.dtypes)["position"] == "bigint"
    got = sorted(found.collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(20_000))
    keys = [o.removeprefix("-") for o in order]
    by = [F.desc(k) if o.startswith("-") else F.asc(k) for k, o in zip(keys, order)]
    assert [tuple(r[k] for k in keys) for r in got] == [tuple(r[k] for k in keys) for r in df.orderBy(*by).collect()]
    assert rows(found, *df.columns) == rows(df)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), (None, 3)], "k string, v int")
    assert rows(dedup.with_position(df, ["k"])) == [("a", 1, 1), ("b", 2, 2), (None, 3, 0)]
    assert rows(dedup.with_position(df, ["-k"])) == [("a", 1, 1), ("b", 2, 0), (None, 3, 2)]
    assert dedup.with_position(df.limit(0), ["k"]).count() == 0


def test_rows_of_a_hot_key_are_ranked_in_several_tasks(spark, small_buckets):
    df = spark.range(0, 9000, 1, 8).select(F.lit("hot").alias("k"), (F.col("id") % 2).alias("v"))
    plan = dedup.with_position(df, ["k"])
    buckets = plan.select(F.floor(F.col("position") / 300).alias("b"), F.spark_partition_id().alias("t"))
    assert buckets.select("t").distinct().count() > 2
    assert sorted(r.position for r in plan.collect()) == list(range(9000))


def test_only_keys_are_shuffled_and_nothing_is_stored(spark, tmp_path, small_buckets):
    values(spark).withColumn("payload", F.repeat(F.col("v").cast("string"), 20)).write.parquet(f"file:{tmp_path}/t")
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    listed = lambda: sorted(os.listdir(f"{root.removeprefix('file:')}/marketlake")) if os.path.exists(f"{root.removeprefix('file:')}/marketlake") else []
    before = listed()
    table = spark.read.parquet(f"file:{tmp_path}/t").drop("d")
    found = dedup.assign_batches(table, 50, ["name", "v"])
    lists = dedup.batch_lists(found, "v")
    assert lists.count() == 400 and listed() == before
    text = found.select("name", "batch")._jdf.queryExecution().executedPlan().toString()
    shuffled = text[: text.index("Exchange")]
    assert "payload" not in shuffled  # it is hashed where it is read
