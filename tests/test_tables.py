import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from marketlake.operators import tables
from marketlake.plans import standardize, statements
from marketlake.operators.quality import QualityError
from marketlake.schemas import struct
from marketlake.sources import paths

from .conftest import rows



def bars(spark, *data):
    return spark.createDataFrame(data, "ticker string, day string, close double, _o int")


def month():
    return {"month": F.substring("day", 1, 7)}


def test_upsert_is_idempotent_and_last_wins(spark, place):
    target = f"{place}/t"
    first = bars(spark, ("A", "2024-01-01", 1.0, 1), ("A", "2024-01-01", 2.0, 2), ("B", "2024-02-01", 3.0, 1))
    tables.upsert(first, target, ["ticker", "day"], ["_o"], month())
    change = bars(spark, ("A", "2024-01-01", 9.0, 1), ("C", "2024-01-02", 4.0, 1))
    for _ in range(2):
        out = tables.upsert(change, target, ["ticker", "day"], ["_o"], month())
    assert rows(out, "ticker", "day", "close") == [
        ("A", "2024-01-01", 9.0), ("B", "2024-02-01", 3.0), ("C", "2024-01-02", 4.0)
    ]


def test_upsert_leaves_other_partitions_alone(spark, place, tmp_path):
    target = f"{place}/t"
    tables.upsert(bars(spark, ("A", "2024-01-01", 1.0, 1), ("B", "2024-02-01", 3.0, 1)), target, ["ticker", "day"], ["_o"], month())
    before = os.listdir(tmp_path / "t" / "month=2024-02")
    tables.upsert(bars(spark, ("A", "2024-01-01", 5.0, 1)), target, ["ticker", "day"], ["_o"], month())
    assert os.listdir(tmp_path / "t" / "month=2024-02") == before


def test_partition_folders_keep_their_names(spark, place, tmp_path):
    target, part = f"{place}/t", {"dd": F.substring("day", 9, 2)}
    for close in (1.0, 2.0):
        out = tables.upsert(bars(spark, ("A", "2024-01-01", close, 1)), target, ["ticker", "day"], ["_o"], part)
    assert rows(out, "close") == [(2.0,)]
    assert [f for f in os.listdir(tmp_path / "t") if f.startswith("dd=")] == ["dd=01"]


def test_upsert_of_nothing(spark, place):
    target = f"{place}/t"
    tables.upsert(bars(spark, ("A", "2024-01-01", 1.0, 1)), target, ["ticker", "day"], ["_o"], month())
    out = tables.upsert(bars(spark, ("A", "2024-01-01", 1.0, 1)).where("false"), target, ["ticker", "day"], ["_o"], month())
    assert out.count() == 1


def test_partition_must_follow_from_the_key(spark, place):
    with pytest.raises(AnalysisException):
        tables.upsert(bars(spark, ("A", "2024-01-01", 1.0, 1)), f"{place}/t", ["ticker", "day"], ["_o"], {"p": F.col("close")})


def test_insert_if_absent(spark, place):
    target = f"{place}/t"
    assert tables.insert_if_absent(bars(spark, ("A", "d", 1.0, 2), ("A", "d", 2.0, 1)), target, ["ticker"], ["_o"]) == 1
    assert tables.insert_if_absent(bars(spark, ("A", "d", 7.0, 1), ("B", "d", 3.0, 1)), target, ["ticker"], ["_o"]) == 1
    assert tables.insert_if_absent(bars(spark, ("B", "d", 8.0, 1)), target, ["ticker"], ["_o"]) == 0
    assert rows(spark.read.parquet(target), "ticker", "close") == [("A", 2.0), ("B", 3.0)]


def test_columns_follow_the_target(spark, place):
    for load in (tables.upsert, tables.insert_if_absent):
        target = f"{place}/{load.__name__}"
        load(bars(spark, ("A", "2024-01-01", 1.0, 1)), target, ["ticker", "day"], ["_o"], month())
        fewer = spark.createDataFrame([("B", "2024-01-02", 1)], "ticker string, day string, _o int")
        load(fewer, target, ["ticker", "day"], ["_o"], month())
        assert rows(spark.read.parquet(target), "ticker", "close") == [("A", 1.0), ("B", None)]
        with pytest.raises(ValueError, match="extra"):
            load(fewer.withColumn("extra", F.lit(1)), target, ["ticker", "day"], ["_o"], month())


def test_key_columns_may_stand_anywhere(spark, place):
    def load(*data):
        df = spark.createDataFrame(data, "note string, ticker string, _o int, day string")
        return tables.upsert(df, f"{place}/t", ["day", "ticker"], ["_o"], month())

    load(("n1", "A", 1, "2024-01-01"), ("n2", "B", 1, "2024-01-01"))
    out = load(("n3", "B", 1, "2024-01-01"))
    assert rows(out, "ticker", "day", "note") == [("A", "2024-01-01", "n1"), ("B", "2024-01-01", "n3")]


def test_refresh_may_read_its_own_table(spark, place):
    path = f"{place}/dim"
    tables.full_refresh(spark.range(3), path)
    tables.full_refresh(spark.read.parquet(path).select((F.col("id") * 2).alias("id")), path)
    assert rows(spark.read.parquet(path)) == [(0,), (2,), (4,)]


def test_folder_left_aside_is_put_back(spark, place, tmp_path):
    tables.full_refresh(spark.range(3), f"{place}/dim")
    os.rename(tmp_path / "dim", tmp_path / "_old-dim")
    assert paths.exists(spark, f"{place}/dim")
    assert spark.read.parquet(f"{place}/dim").count() == 3


def test_mapping_with_double_key_is_refused(spark, place):
    mapping = spark.createDataFrame([("a", "x"), ("a", "y")], "raw_ind_name string, std_ind_name string")
    with pytest.raises(QualityError):
        tables.refresh_mapping(mapping, f"{place}/m", "raw_ind_name")
    assert not paths.exists(spark, f"{place}/m")


def test_snapshots_expire_after_seven_days(spark, place):
    for day in ("2026-01-07", "2026-01-08", "2026-01-09"):
        assert tables.snapshot(spark.range(4), place, day) == 4
    assert tables.expire_snapshots(spark, place, "2026-01-15") == ["20260107"]
    assert paths.child_folders(spark, place) == ["snapshot_ds=20260108", "snapshot_ds=20260109"]


def test_empty_table_does_not_replace_a_snapshot(spark, place):
    tables.snapshot(spark.range(4), place, "2026-01-07")
    with pytest.raises(ValueError):
        tables.snapshot(spark.range(0), place, "2026-01-07")
    assert spark.read.parquet(place).count() == 4


def test_loads_into_a_table_just_created(spark, place):
    schema = struct("ticker string, day string, close double, month string")
    for load in (tables.upsert, tables.insert_if_absent):
        target, name = f"{place}/{load.__name__}", f"t_{load.__name__}"
        tables.ensure_table(spark, name, schema, ["month"], target)
        for _ in range(2):
            load(bars(spark, ("A", "2024-01-01", 1.0, 1)), target, ["ticker", "day"], ["_o"], month())
        assert rows(spark.read.parquet(target), "ticker", "close") == [("A", 1.0)]
        assert tables.insert_if_absent(bars(spark, ("A", "x", 1.0, 1)).where("false"), target, ["ticker", "day"], ["_o"], month()) == 0
        spark.sql(f"drop table {name}")


def test_ensure_table_checks_columns(spark, place):
    tables.ensure_table(spark, "t_columns", struct("a int"), location=f"{place}/x")
    with pytest.raises(ValueError):
        tables.ensure_table(spark, "t_columns", struct("b int"), location=f"{place}/x")
    spark.sql("drop table t_columns")


MAPPING = [("red ring", "ring"), ("blue ring", "ring"), ("ring", "ring")]


@pytest.mark.parametrize("parts", [[], ["year"]])
def test_standardize_twice_is_once(spark, place, tmp_path, parts):
    mapping = spark.createDataFrame(MAPPING, "raw_ind_name string, std_ind_name string")
    data = [("red ring", 2023, 1.0), ("ring", 2024, 2.0), ("bolt", 2024, 3.0), ("blue ring", 2023, 4.0)]
    table = spark.createDataFrame(data, "ind_name string, year int, value double")
    table.write.partitionBy(*parts).parquet(f"{place}/bctc")

    def run(day):
        return standardize.standardize_table(spark, f"{place}/bctc", mapping, f"{place}/map", f"{place}/bak", day, parts)

    first = run("2026-01-01")
    assert (first["snapshot_rows"], first["updated_rows"], first["changed_rows"]) == (4, 3, 2)
    assert tuple(first["profile_before"].first()) == (4, 4, 3, 1)
    assert tuple(first["reduction"].first()) == (4, 2, 2, 50.0)
    assert rows(first["top_indicators"]) == [("bolt", 1), ("ring", 3)]
    assert rows(first["still_unmapped"]) == [("bolt", 1)]
    assert rows(first["quality"]) == [("clean", 4)]
    after = rows(spark.read.parquet(f"{place}/bctc"), "ind_name", "value")
    assert after == [("bolt", 3.0), ("ring", 1.0), ("ring", 2.0), ("ring", 4.0)]
    if parts:
        untouched = os.listdir(tmp_path / "bctc" / "year=2024")
        assert untouched
    second = run("2026-01-09")
    assert (second["updated_rows"], second["changed_rows"], second["expired"]) == (3, 0, ["20260101"])
    assert rows(spark.read.parquet(f"{place}/bctc"), "ind_name", "value") == after


def test_standardize_gates(spark, place):
    mapping = spark.createDataFrame(MAPPING, "raw_ind_name string, std_ind_name string")
    spark.createDataFrame([(None, 1.0), ("ring", 2.0)], "ind_name string, value double").write.parquet(f"{place}/bctc")
    args = (spark, f"{place}/bctc", mapping, f"{place}/map", f"{place}/bak", "2026-01-01")
    with pytest.raises(QualityError, match="at least 158"):
        standardize.standardize_table(*args, min_mappings=158)
    with pytest.raises(QualityError, match="1 null"):
        standardize.standardize_table(*args)


def test_fixed_mappings(spark):
    standard, loader = statements.standard_mapping(spark), statements.loader_mapping(spark)
    assert (standard.count(), standard.select("std_ind_name").distinct().count(), loader.count()) == (157, 146, 94)
    known = standard.select("raw_ind_name")
    assert loader.join(known, loader.vi_name == known.raw_ind_name, "left_anti").count() == 0


def test_statement_file_spellings(spark):
    old = spark.createDataFrame(
        [("HPG", "X", "3.0", "2024", "IS", "income", "Net Sales", "1e15")],
        "ticker string, company string, `Report_Quarter ` string, REPORT_YEAR string, statement_type string, `report name` string, ind_name string, value string",
    )
    new = spark.createDataFrame(
        [("HPG", 3, 2024, "IS", "income", "Odd", None)],
        "ticker string, quarter int, year int, report_code string, report_name string, ind_name string, value double",
    )
    mapping = statements.loader_mapping(spark)
    names = ("ticker", "quarter", "year", "report_code", "report_name", "ind_name", "ind_code", "value")
    loaded = [tuple(statements.load_statements(f, mapping, "2026-01-01 00:00:00").select(*names).first()) for f in (old, new)]
    assert loaded == [
        ("HPG", 3, 2024, "IS", "income", "Doanh thu thuần", "NET_SALES", "1000000000000000"),
        ("HPG", 3, 2024, "IS", "income", "Odd", "ODD", "0"),
    ]
