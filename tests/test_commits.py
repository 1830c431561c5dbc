"""Rows and log entries are published together, by one job at a time."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from marketlake.operators import tables
from marketlake.sources import paths
from marketlake.streaming import ingest
from marketlake.streaming.ingest import absent_load, ingest_files, upsert_load

from .conftest import rows

RUN = "2026-01-01 00:00:00"


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(("k,p,v", *lines)) + "\n")


def make_load(kind, target, parts):
    by = {"p": F.col("p")} if parts else None
    return (upsert_load if kind == "upsert" else absent_load)(target, ["k", "p"], partition_by=by)


def run(spark, place, load, **more):
    keep = lambda df: df.select("k", "p", "v", *[c for c in df.columns if c.startswith("_")])
    return ingest_files(spark, f"{place}/lake", f"{place}/log", keep, load, RUN, **more)


def state(spark, place):
    table = lambda name, *columns: rows(spark.read.parquet(f"{place}/{name}"), *columns) if paths.has_data(spark, f"{place}/{name}") else []
    return table("t", "k", "p", "v"), [k.rsplit("/", 1)[1] for (k,) in table("log", "object_key")]


CASES = [("upsert", True), ("upsert", False), ("absent", True), ("absent", False)]


@pytest.mark.parametrize("kind, parts", CASES)
def test_a_job_cut_before_the_rename_leaves_neither(spark, place, tmp_path, monkeypatch, kind, parts):
    load = make_load(kind, f"{place}/t", parts)
    put(tmp_path / "lake", "1.csv", "a,x,1", "b,y,1")
    assert run(spark, place, load) == {"status": "loaded", "files": 1}
    before = state(spark, place)
    assert before == ([("a", "x", "1"), ("b", "y", "1")], ["1.csv"])
    put(tmp_path / "lake", "2.csv", "a,x,2", "c,x,2")

    def dies(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(paths, "swap_partitions", dies)
    with pytest.raises(KeyboardInterrupt):
        run(spark, place, load)
    monkeypatch.undo()
    assert state(spark, place) == before
    assert run(spark, place, load) == {"status": "loaded", "files": 1}
    first = "2" if kind == "upsert" else "1"
    assert state(spark, place) == ([("a", "x", first), ("b", "y", "1"), ("c", "x", "2")], ["1.csv", "2.csv"])
    assert run(spark, place, load) == {"status": "skip", "files": 0}


@pytest.mark.parametrize("kind, parts", CASES)
def test_a_job_cut_after_the_rename_leaves_both(spark, place, tmp_path, monkeypatch, kind, parts):
    load = make_load(kind, f"{place}/t", parts)
    put(tmp_path / "lake", "1.csv", "a,x,1", "b,y,1")
    run(spark, place, load)
    put(tmp_path / "lake", "2.csv", "a,x,2", "c,z,2")
    real = paths._move_files

    def dies(spark_, source, target):
        if source.endswith("/log"):
            raise KeyboardInterrupt
        real(spark_, source, target)

    monkeypatch.setattr(paths, "_move_files", dies)
    with pytest.raises(KeyboardInterrupt):
        run(spark, place, load)
    monkeypatch.undo()
    loads = []
    monkeypatch.setattr(ingest, "_stamped", lambda df, ts: loads.append(1) or df)
    assert run(spark, place, load) == {"status": "skip", "files": 0} and not loads
    first = "2" if kind == "upsert" else "1"
    assert state(spark, place) == ([("a", "x", first), ("b", "y", "1"), ("c", "z", "2")], ["1.csv", "2.csv"])


def test_files_without_rows_are_logged(spark, place, tmp_path):
    load = make_load("upsert", f"{place}/t", True)
    put(tmp_path / "lake", "1.csv", "a,x,1")
    run(spark, place, load)
    put(tmp_path / "lake", "2.csv")
    for kind in ("upsert", "absent"):
        put(tmp_path / "lake", f"{kind}.csv")
        assert run(spark, place, make_load(kind, f"{place}/t", True))["files"] > 0
    assert state(spark, place) == ([("a", "x", "1")], ["1.csv", "2.csv", "absent.csv", "upsert.csv"])


def test_two_loaders_take_turns(spark, place, tmp_path):
    for i in range(4):
        put(tmp_path / "lake", f"{i}.csv", f"a,x,{i}", f"k{i},y,{i}")
    done = []
    load = make_load("upsert", f"{place}/t", True)
    threads = [threading.Thread(target=lambda: done.append(run(spark, place, load, files_per_batch=2, wait=240))) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(d["files"] for d in done) == [0, 4]
    assert state(spark, place) == ([("a", "x", "3"), *[(f"k{i}", "y", f"{i}") for i in range(4)]], [f"{i}.csv" for i in range(4)])


def test_a_second_loader_is_refused(spark, place, tmp_path):
    put(tmp_path / "lake", "1.csv", "a,x,1")
    with paths.lock(spark, paths.aside(f"{place}/log", "lock")):
        with pytest.raises(paths.Busy):
            run(spark, place, make_load("upsert", f"{place}/t", True))
    assert run(spark, place, make_load("upsert", f"{place}/t", True))["files"] == 1


def test_the_lock_of_a_dead_job_is_taken_over(spark, place):
    path = f"{place}/_lock"
    assert paths._take(spark, path, "somebody") and not paths._take(spark, path, "another")
    with pytest.raises(paths.Busy):
        with paths.lock(spark, path, lease=60):
            pass
    time.sleep(2.1)
    with paths.lock(spark, path, lease=1):
        time.sleep(2)  # renewed meanwhile
        with pytest.raises(paths.Busy):
            with paths.lock(spark, path, lease=1):
                pass
    assert not paths.exists(spark, path)


def test_loads_without_a_log_are_as_before(spark, place):
    df = spark.createDataFrame([("a", "x", 1)], "k string, p string, v int")
    tables.upsert(df, f"{place}/t", ["k"], ["v"])
    assert tables.insert_if_absent(df, f"{place}/t", ["k"], ["v"]) == 0
    assert rows(spark.read.parquet(f"{place}/t")) == [("a", "x", 1)]
