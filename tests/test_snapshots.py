"""Snapshots that refer to files, and counts kept up by change."""

import os

import pytest
from pyspark.sql import functions as F

from marketlake.operators import partials, tables
from marketlake.operators.quality import QualityError
from marketlake.plans import standardize
from marketlake.sources import manifest, paths

from .conftest import rows

DATA = [("a", 1, "x/1"), ("b", 2, "x/1"), ("c", 3, "y z"), ("d", 4, None)]


def frame(spark, data=DATA):
    return spark.createDataFrame(data, "name string, v int, p string")


def files_under(path):
    """Partition folder and name of each data file."""
    return sorted((os.path.basename(d) if "p=" in d else "", f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


@pytest.fixture(params=[["p"], []], ids=["partitioned", "whole"])
def parts(request):
    return request.param


def write(spark, df, target, parts):
    return tables.replace_partitions(df, target, parts) if parts else tables.full_refresh(df, target)


def test_a_snapshot_survives_every_load(spark, place, tmp_path, parts):
    target, root = f"{place}/t", f"{place}/backup"
    write(spark, frame(spark), target, parts)
    assert manifest.take_snapshot(spark, target, root, "2026-01-01")["rows"] == 4
    before = files_under(tmp_path / "t")
    assert not os.path.exists(tmp_path / "backup" / "kept")  # nothing was copied
    change = frame(spark, [("a", 10, "x/1"), ("e", 50, "new")])
    if parts:
        write(spark, change, target, parts)
        assert files_under(tmp_path / "backup" / "kept") != []
    else:
        tables.full_refresh(change, target)
    wanted = sorted(DATA, key=repr)
    assert rows(manifest.read_snapshot(spark, root, "2026-01-01"), "name", "v", "p") == wanted
    assert manifest.take_snapshot(spark, target, root, "2026-01-02")["rows"] == (4 if parts else 2)
    tables.full_refresh(frame(spark, [("z", 0, "x/1")]), target)
    assert rows(manifest.read_snapshot(spark, root, "2026-01-01"), "name", "v", "p") == wanted
    second = rows(manifest.read_snapshot(spark, root, "2026-01-02"), "name", "v", "p")
    assert second == sorted([("a", 10, "x/1"), ("e", 50, "new"), *([("c", 3, "y z"), ("d", 4, None)] if parts else [])], key=repr)
    stored = files_under(tmp_path / "backup" / "kept")
    assert set(before) <= set(stored) and len(stored) == len(set(stored))  # each version exists once
    assert rows(spark.read.parquet(target), "name") == [("z",)]


def test_only_new_files_are_read(spark, place):
    target, root = f"{place}/t", f"{place}/backup"
    tables.replace_partitions(frame(spark), target, ["p"])
    first = manifest.take_snapshot(spark, target, root, "2026-01-01")
    assert first["new_files"] == first["files"] and first["copied_bytes"] == 0
    again = manifest.take_snapshot(spark, target, root, "2026-01-02")
    assert (again["rows"], again["new_files"]) == (4, 0)
    tables.upsert(frame(spark, [("c", 9, "y z")]), target, ["name", "p"], ["v"], {"p": F.col("p")})
    third = manifest.take_snapshot(spark, target, root, "2026-01-03")
    assert (third["rows"], third["new_files"]) == (4, 1)
    tables.insert_if_absent(frame(spark, [("f", 9, "y z")]), target, ["name", "p"], ["v"], {"p": F.col("p")})
    for day, wanted in (("2026-01-01", 3), ("2026-01-02", 3), ("2026-01-03", 9)):
        assert rows(manifest.read_snapshot(spark, root, day).where("name = 'c'"), "v") == [(wanted,)]
        assert manifest.read_snapshot(spark, root, day).count() == 4


def test_a_folder_replaced_between_snapshots_is_not_kept(spark, place, tmp_path):
    target, root = f"{place}/t", f"{place}/backup"
    tables.replace_partitions(frame(spark), target, ["p"])
    manifest.take_snapshot(spark, target, root, "2026-01-01")
    load = lambda v: tables.replace_partitions(frame(spark, [("c", v, "y z")]), target, ["p"])
    load(1)
    kept = files_under(tmp_path / "backup" / "kept")
    load(2)
    load(3)
    assert files_under(tmp_path / "backup" / "kept") == kept


def test_nothing_replaces_nothing(spark, place):
    target, root = f"{place}/t", f"{place}/backup"
    assert tables.replace_partitions(frame(spark).limit(0), f"{place}/none", ["p"]).count() == 0
    tables.replace_partitions(frame(spark), target, ["p"])
    manifest.take_snapshot(spark, target, root, "2026-01-01")
    assert tables.replace_partitions(frame(spark).limit(0), target, ["p"]).count() == 4


def test_lost_files_are_named(spark, place):
    target, root = f"{place}/t", f"{place}/backup"
    tables.replace_partitions(frame(spark), target, ["p"])
    manifest.take_snapshot(spark, target, root, "2026-01-01")
    paths.delete(spark, f"{target}/p=y z")
    with pytest.raises(QualityError, match="1 files of the snapshot.*p=y z"):
        manifest.read_snapshot(spark, root, "2026-01-01")
    with pytest.raises(QualityError, match="no snapshot"):
        manifest.read_snapshot(spark, root, "2026-01-05")


def test_expired_snapshots_release_their_folders(spark, place, tmp_path):
    target, root = f"{place}/t", f"{place}/backup"
    tables.replace_partitions(frame(spark), target, ["p"])
    for day in ("2026-01-01", "2026-01-05", "2026-01-09"):
        manifest.take_snapshot(spark, target, root, day)
        tables.replace_partitions(frame(spark, [("c", int(day[-2:]), "y z")]), target, ["p"])
    assert manifest.drop_snapshots(spark, root, "2026-01-12") == ["20260101"]
    assert manifest.snapshot_days(spark, root) == ["20260105", "20260109"]
    assert len(files_under(tmp_path / "backup" / "kept")) == 2
    for day, wanted in (("2026-01-05", 1), ("2026-01-09", 5)):
        assert rows(manifest.read_snapshot(spark, root, day).where("name = 'c'"), "v") == [(wanted,)]
    assert manifest.drop_snapshots(spark, root, "2026-02-12") == ["20260105", "20260109"]
    assert files_under(tmp_path / "backup" / "kept") == []
    assert spark.read.parquet(target).count() == 4


def test_a_snapshot_of_the_same_day_is_replaced_but_not_by_nothing(spark, place):
    target, root = f"{place}/t", f"{place}/backup"
    tables.full_refresh(frame(spark), target)
    manifest.take_snapshot(spark, target, root, "2026-01-01")
    tables.full_refresh(frame(spark, DATA[:2]), target)
    assert manifest.take_snapshot(spark, target, root, "2026-01-01")["rows"] == 2
    tables.full_refresh(frame(spark).limit(0), target)
    with pytest.raises(ValueError, match="empty"):
        manifest.take_snapshot(spark, target, root, "2026-01-01")
    assert manifest.read_snapshot(spark, root, "2026-01-01").count() == 2
    assert manifest.copy_snapshot(spark, root, "2026-01-01", f"{place}/copy").count() == 2
    with pytest.raises(ValueError, match="are under"):
        manifest.take_snapshot(spark, target, f"{place}/elsewhere", "2026-01-01")


def test_a_job_that_dies_before_the_manifest_loses_no_snapshot(spark, place, monkeypatch):
    """Between the look at the files and the manifest, replaced folders are kept whatever their age."""
    target, root = f"{place}/t", f"{place}/backup"
    tables.replace_partitions(frame(spark), target, ["p"])
    manifest.take_snapshot(spark, target, root, "2026-01-01")
    tables.replace_partitions(frame(spark, [("c", 7, "y z")]), target, ["p"])

    def dies(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(manifest, "_count_rows", dies)
    with pytest.raises(KeyboardInterrupt):
        manifest.take_snapshot(spark, target, root, "2026-01-02")
    monkeypatch.undo()
    tables.replace_partitions(frame(spark, [("c", 8, "y z")]), target, ["p"])
    assert manifest.snapshot_days(spark, root) == ["20260101"]
    assert manifest.take_snapshot(spark, target, root, "2026-01-02")["rows"] == 4
    assert rows(manifest.read_snapshot(spark, root, "2026-01-01").where("name = 'c'"), "v") == [(3,)]


def test_types_of_partitions_are_those_of_the_table(spark, place):
    target, root = f"{place}/t", f"{place}/backup"
    tables.replace_partitions(spark.createDataFrame([("a", 2023), ("b", 2024)], "name string, year int"), target, ["year"])
    manifest.take_snapshot(spark, target, root, "2026-01-01")
    tables.replace_partitions(spark.createDataFrame([("c", 2024)], "name string, year int"), target, ["year"])
    then = manifest.read_snapshot(spark, root, "2026-01-01")
    assert then.schema == spark.read.parquet(target).schema
    assert rows(then) == [("a", 2023), ("b", 2024)]


def counts(spark, target, store):
    found, scanned = partials.partition_counts(spark, target, store, "name")
    return rows(found.groupBy("ind_name").agg(F.sum("record_count")), "ind_name", "sum(record_count)"), scanned


def test_counts_follow_changes(spark, place, parts):
    target, store = f"{place}/t", f"{place}/store"
    direct = lambda: rows(spark.read.parquet(target).groupBy("name").count())
    write(spark, frame(spark, DATA + [(None, 1, "x/1"), ("a", 1, "q")]), target, parts)
    found, scanned = counts(spark, target, store)
    assert found == direct() and scanned == (4 if parts else 1)
    assert counts(spark, target, store) == (direct(), 0)
    write(spark, frame(spark, [("a", 1, "x/1"), ("n", 1, "new")]), target, parts)
    found, scanned = counts(spark, target, store)
    assert found == direct() and scanned == (2 if parts else 1)
    if parts:
        paths.delete(spark, f"{target}/p=y z")
        assert counts(spark, target, store) == (direct(), 0)


def test_counts_with_many_runs(spark, place, monkeypatch):
    target, store = f"{place}/t", f"{place}/store"
    monkeypatch.setattr(partials, "RUNS", 2)
    for i in range(5):
        tables.replace_partitions(frame(spark, [("a", i, "x"), (f"n{i}", i, f"p{i}")]), target, ["p"])
        found, scanned = counts(spark, target, store)
        assert scanned == 2 and len(found) == i + 2 and ("a", 1) in found
    assert len(paths.child_folders(spark, store)) <= partials.RUNS + 1
    now = manifest.identities(manifest.table_files(spark, target))
    twice = partials._stored(spark, store).join(now, ["folder", "identity"], "left_semi").drop("run")
    partials.record(spark, store, twice)  # as by two jobs at once
    assert counts(spark, target, store) == (found, 0)


@pytest.mark.parametrize("by", [["year"], []])
def test_second_day_reads_and_copies_nothing(spark, place, tmp_path, by):
    mapping = spark.createDataFrame([("red ring", "ring"), ("ring", "ring")], "raw_ind_name string, std_ind_name string")
    data = [("red ring", 2023, 1.0), ("ring", 2024, 2.0), ("bolt", 2024, 3.0)]
    spark.createDataFrame(data, "ind_name string, year int, value double").write.partitionBy(*by).parquet(f"{place}/bctc")
    run = lambda day: standardize.standardize_table(spark, f"{place}/bctc", mapping, f"{place}/map", f"{place}/bak", day, by)
    first, second = run("2026-01-01"), run("2026-01-02")
    assert (first["changed_rows"], first["scanned_partitions"]) == (1, 2 if by else 1)
    assert (second["changed_rows"], second["scanned_partitions"], second["snapshot_bytes"]) == (0, 0, 0)
    assert rows(second["top_indicators"]) == [("bolt", 1), ("ring", 2)]
    old = manifest.read_snapshot(spark, f"{place}/bak", "2026-01-01")
    assert rows(old, "ind_name", "value") == [("bolt", 3.0), ("red ring", 1.0), ("ring", 2.0)]
    new = manifest.read_snapshot(spark, f"{place}/bak", "2026-01-02")
    assert rows(new, "ind_name", "value") == rows(spark.read.parquet(f"{place}/bctc"), "ind_name", "value")
