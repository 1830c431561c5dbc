"""Loads by key: blank partitions, null keys, many partitions, jobs that die in between."""

import pytest
from pyspark.sql import functions as F

from marketlake.operators import tables
from marketlake.operators.quality import QualityError
from marketlake.schemas import struct
from marketlake.sources import paths

from .conftest import rows


def frame(spark, data):
    return spark.createDataFrame(data, "p string, k int, v int")


def by_p():
    return {"part": F.col("p")}


def test_blank_partition_values_keep_their_rows(spark, place):
    key = ["p", "k"]
    tables.upsert(frame(spark, [("", 1, 1), ("a", 1, 1)]), f"{place}/t", key, ["v"], by_p())
    tables.upsert(frame(spark, [("", 2, 2)]), f"{place}/t", key, ["v"], by_p())
    assert rows(spark.read.parquet(f"{place}/t"), "p", "k", "v") == [("", 1, 1), ("", 2, 2), ("a", 1, 1)]
    assert tables.insert_if_absent(frame(spark, [("", 1, 9), ("", 3, 3)]), f"{place}/t", key, ["v"], by_p()) == 1
    assert spark.read.parquet(f"{place}/t").where("p = ''").count() == 3


def test_null_keys_are_refused(spark, place):
    bad = frame(spark, [("a", None, 1), ("a", None, 2), ("a", 1, 1)])
    for load in (tables.upsert, tables.insert_if_absent):
        with pytest.raises(QualityError, match="1 rows without a value"):  # one row is left of each key
            load(bad, f"{place}/t", ["p", "k"], ["v"])
    assert not paths.exists(spark, f"{place}/t")


def test_thousands_of_partitions_in_a_condition(spark):
    one = spark.createDataFrame([(str(i),) for i in range(5000)] + [(None,)], "p string")
    assert one.where(tables.in_partitions(one.collect(), ["p"])).count() == 5001
    two = one.withColumn("q", F.when(F.col("p") % 3 != 0, F.col("p")))
    some = two.where("p < 2500").collect()
    assert two.where(tables.in_partitions(some, ["p", "q"])).count() == len(some)


def test_upsert_over_a_thousand_partitions(spark, place):
    first = spark.range(1100).select(F.col("id").cast("string").alias("p"), F.lit(1).alias("k"), F.lit(1).alias("v"))
    tables.upsert(first.repartition(2), f"{place}/t", ["p", "k"], ["v"], by_p())
    tables.upsert(first.withColumn("v", F.lit(2)).repartition(2), f"{place}/t", ["p", "k"], ["v"], by_p())
    assert spark.read.parquet(f"{place}/t").agg(F.count("*"), F.sum("v")).first() == (1100, 2200)


def test_a_swap_cut_short_is_finished(spark, place, monkeypatch):
    target = f"{place}/t"
    key = ["p", "k"]
    tables.upsert(frame(spark, [("a", 1, 1), ("b", 1, 1), ("c", 1, 1)]), target, key, ["v"], by_p())
    real = paths.finish_swap

    def dies(spark_, target_, depth):
        if not paths._path(spark_, paths.aside(target_, "ready"))[0].exists(paths._path(spark_, paths.aside(target_, "ready"))[1]):
            return
        name = paths._partition_folders(spark_, paths.aside(target_, "ready"), depth)[0]
        paths.delete(spark_, target_ + name)
        raise KeyboardInterrupt

    monkeypatch.setattr(paths, "finish_swap", dies)
    with pytest.raises(KeyboardInterrupt):
        tables.upsert(frame(spark, [("a", 2, 2), ("b", 1, 5)]), target, key, ["v"], by_p())
    assert spark.read.parquet(target).count() < 3
    monkeypatch.setattr(paths, "finish_swap", real)
    tables.upsert(frame(spark, [("d", 1, 1)]), target, key, ["v"], by_p())
    assert rows(spark.read.parquet(target), "p", "k", "v") == [("a", 1, 1), ("a", 2, 2), ("b", 1, 5), ("c", 1, 1), ("d", 1, 1)]


def test_tables_of_other_types_are_refused(spark, place):
    tables.ensure_table(spark, "types_of", struct("a int, b string"), location=f"{place}/it's")
    with pytest.raises(ValueError, match="exists with columns"):
        tables.ensure_table(spark, "types_of", struct("a bigint, b string"), location=f"{place}/it's")
    spark.sql("drop table types_of")


def test_expired_snapshots_go(spark, place):
    for day in ("2024-01-01", "2024-01-10", "2024-01-17"):
        tables.snapshot(spark.range(3), f"{place}/s", day)
    assert tables.expire_snapshots(spark, f"{place}/s", "2024-01-17") == ["20240101"]
    assert paths.child_folders(spark, f"{place}/s") == ["snapshot_ds=20240110", "snapshot_ds=20240117"]
