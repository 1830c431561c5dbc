"""The physical plans the operators are meant to have."""

import os

import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from marketlake import functions as fn
from marketlake.operators import dedup, filters, joins, reshape, tables
from marketlake.plans import prices, standardize, statements

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = f"file:{tmp_path_factory.mktemp('plans')}/t"
    rows = spark.range(1000).select(
        (F.col("id") % 7).cast("string").alias("ticker"),
        (F.lit(2020) + F.col("id") % 5).cast("int").alias("year"),
        F.lit(1).alias("quarter"),
        F.col("id").cast("double").alias("Net Sales"),
        F.lit(None).cast("double").alias("Sales"),
        F.timestamp_seconds(F.col("id") * 1000).alias("at"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_dedup_limits_groups_before_the_shuffle(table):
    text = plan(dedup.keep_first(table, ["ticker"], ["at"]))
    assert text.count("Exchange") == 1
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_year_filter_reaches_the_scan(table):
    text = plan(filters.for_year(reshape.melt_wide(table.drop("at")), "year", 2021))
    assert "EqualTo(year,2021)" in text and "Exchange" not in text


def test_day_filter_reaches_the_scan_and_prunes_columns(table):
    text = plan(table.where(fn.half_open_day(F.col("at"), "1970-01-03")).select("ticker"))
    assert "GreaterThanOrEqual(at" in text and "LessThan(at" in text
    assert "ReadSchema: struct<ticker:string,at:timestamp>" in text


def test_day_equality_reaches_the_scan(table):
    assert "GreaterThanOrEqual(at" in plan(filters.on_day(table, "at", "1970-01-03"))


def test_price_window_prunes_months(spark, tmp_path):
    raw = spark.createDataFrame([("A", "2024-01-01"), ("A", "2024-02-01")], "ticker string, date string")
    bars = prices.clean_prices(raw).withColumns(prices.month_partition())
    bars.write.partitionBy("trading_month").parquet(f"file:{tmp_path}/p")
    text = plan(prices.bars_between(spark.read.parquet(f"file:{tmp_path}/p"), "2024-02-01", "2024-02-20"))
    assert "PartitionFilters: [isnotnull(trading_month" in text


def test_range_filter_reaches_the_scan(table):
    text = plan(filters.in_range(table, "at", "1970-01-03", "1970-01-05"))
    assert "GreaterThanOrEqual(at" in text and "LessThan(at" in text


def test_statement_load_has_no_shuffle(spark, table):
    long = statements.statement_long(table.drop("at"), "income_statement", "2026-01-01 00:00:00")
    loaded = statements.load_statements(long, statements.loader_mapping(spark), "2026-01-01 00:00:00")
    text = plan(loaded)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "Exchange hash" not in text


def test_articles_are_parsed_once(spark):
    pages = spark.createDataFrame([("cafef", "<p>")], "source string, html string")
    text = fn.parse_articles(pages).where("title <> ''")._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1


def test_overview_reuses_the_partitioning_of_its_sides(spark, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        side = table.select("ticker", F.col("year").cast("string").alias("icb_name2"))
        listed = joins.listing_meta(side, side, ("symbol", "icb_name2"), ("symbol", "exchange"))
        text = plan(joins.enrich(listed.drop("exchange"), listed, ["exchange"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 4


def test_price_cleaning_is_narrow(spark):
    raw = spark.createDataFrame([("a", "2024-01-01", "1")], "ticker string, date string, close string")
    text = plan(prices.clean_prices(raw))
    assert "Exchange" not in text and "Python" not in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"stream_ingest", "ingest_log_skip", "standardize_job"}))
def test_no_query_multiplies_rows(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    if not name.startswith("html_"):
        assert "ArrowEvalPython" not in text


def test_rebalance_splits_a_hot_partition(spark, tmp_path):
    rows = spark.range(0, 400_000, 1, 8).select(
        F.xxhash64("id").alias("v"), F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("part")
    )
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        tables.replace_partitions(rows, f"file:{tmp_path}/t", ["part"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = [f for f in os.listdir(tmp_path / "t" / "part=-1") if f.endswith(".parquet")]
    assert len(files) > 4


def test_hot_key_reaches_the_shuffle_once_per_task(spark, tmp_path):
    spark.range(0, 300_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"), "id"
    ).write.parquet(f"file:{tmp_path}/t")
    table = spark.read.parquet(f"file:{tmp_path}/t")
    last = dedup.keep_last(table, ["k"], ["id"])
    assert last.count() == 200_001
    assert last.where("k = 'HOT'").first()["id"] == 299_997


def test_small_upsert_does_not_shuffle_the_target(spark, tmp_path, monkeypatch):
    seen = []
    real = tables.replace_partitions
    monkeypatch.setattr(tables, "replace_partitions", lambda df, *a, **k: seen.append(plan(df)) or real(df, *a, **k))
    df = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("_o"))
    for _ in range(2):
        tables.upsert(df, f"file:{tmp_path}/t", ["k"], ["_o"], {"p": F.col("k") % 3})
    assert "Exchange hash" not in seen[1] and "BroadcastHashJoin" in seen[1]
    assert spark.read.parquet(f"file:{tmp_path}/t").count() == 100


def test_partitioned_writes_are_not_sorted(spark, tmp_path):
    spark.sql(f"CREATE TABLE unsorted (v BIGINT, p BIGINT) USING parquet PARTITIONED BY (p) LOCATION 'file:{tmp_path}/t'")
    try:
        text = spark.sql("EXPLAIN INSERT INTO unsorted SELECT id, id % 40 FROM range(400)").first()[0]
        assert "Sort" not in text
    finally:
        spark.sql("DROP TABLE unsorted")
    # More partitions than a task has writers for at once.
    table = tables.replace_partitions(spark.range(0, 400, 1, 1).select("id", (F.col("id") % 40).alias("p")), f"file:{tmp_path}/u", ["p"], False)
    assert table.groupBy("p").count().where("count = 10").count() == 40 and table.where("id % 40 = p").count() == 400


def test_standardising_does_not_shuffle_the_table(spark, tmp_path, monkeypatch):
    seen = []
    real = tables.replace_partitions
    root = f"file:{tmp_path}"
    rows = [("a", "IS"), ("b", "IS"), ("a", "BL"), ("c", "CF")]
    real(spark.createDataFrame(rows, "ind_name string, report_code string"), f"{root}/t", ["report_code"])

    def replace(df, path, partition_by, rebalance=True):
        seen.append((rebalance, plan(df)))
        return real(df, path, partition_by, rebalance)

    monkeypatch.setattr(tables, "replace_partitions", replace)
    mapping = spark.createDataFrame([("a", "A")], "raw_ind_name string, std_ind_name string")
    standardize.standardize_table(spark, f"{root}/t", mapping, f"{root}/m", f"{root}/s", "2026-01-15", ["report_code"])
    assert [r for r, _ in seen] == [False] and "Exchange hash" not in seen[0][1]
    found = spark.read.parquet(f"{root}/t").select("ind_name", "report_code").collect()
    assert sorted(map(tuple, found)) == [("A", "BL"), ("A", "IS"), ("b", "IS"), ("c", "CF")]
