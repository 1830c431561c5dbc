"""Files that are cut anywhere, and files of differing headers in one scan."""

import csv
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.quality import QualityError
from marketlake.schemas import struct
from marketlake.sources import blocks, readers
from marketlake.streaming.ingest import ingest_files

from .conftest import rows

SCHEMA = struct("id int, text string, n int")


@pytest.fixture
def small_blocks(spark):
    """Blocks of 20 KB, so that files of some 100 KB are cut often."""
    settings = {"spark.sql.files.maxPartitionBytes": "20k", "spark.sql.files.openCostInBytes": "10k"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def texts(seed, n, marks):
    rng = random.Random(seed)
    out = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    out[n // 3] = 'a "long" text\n' * 8000  # over several blocks
    out[n // 2] = "x" * 30_000
    return out


MARKS = ["a", "b", '"', ",", "\n", "\r\n", " ", '""', ',"', '",', "{", "}", "word "]


def write_csv(path, seed, end, header=("id", "text", "n"), n=1500):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as out:
        out.write("﻿" if seed % 2 else "\n \n")
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(header)
        for i, text in enumerate(texts(seed, n, MARKS)):
            row = {"id": i, "text": text, "n": seed}
            writer.writerow([row.get(c, "") for c in header])


def by_spark(spark, place):
    """Spark's own reader, a task per file."""
    reader = spark.read.schema(SCHEMA).option("header", True).option("multiLine", True)
    return reader.option("escape", '"').csv(place)


def test_csv_like_a_whole_file(spark, place, tmp_path, small_blocks):
    for seed, end in ((1, "\n"), (3, "\r\n"), (5, "\n")):
        write_csv(tmp_path / "c" / f"{seed}.csv", seed, end)
    assert blocks.has_large_files(spark, f"{place}/c")
    found = readers.read_csv_lake(spark, f"{place}/c", SCHEMA, multiline=True, file_columns=True)
    assert found.count() == 4500
    assert rows(found, *SCHEMA.names) == rows(by_spark(spark, f"{place}/c"))
    assert found.select("_file", "_block").distinct().count() > 15  # many tasks read each file
    order = [r.id for r in found.where("n = 3").orderBy("_file", "_block", "_row").collect()]
    assert order == list(range(1500))
    assert readers.read_csv_lake(spark, f"{place}/c", SCHEMA, multiline=True).columns == SCHEMA.names


def test_large_and_small_files_of_differing_headers(spark, place, tmp_path, small_blocks):
    write_csv(tmp_path / "c" / "a.csv", 2, "\n")
    write_csv(tmp_path / "c" / "deep" / "b.csv", 1, "\r\n", ("text", "more", "id"))
    write_csv(tmp_path / "c" / "c.csv", 4, "\n", ("n", "id"), n=20)
    found = readers.read_csv_by_name(spark, f"{place}/c", SCHEMA, multiline=True)
    assert rows(found.where("n = 2")) == rows(by_spark(spark, f"{place}/c/a.csv").where("n = 2"))
    other = by_spark(spark, f"{place}/c/deep").toDF("t", "more", "i").select(F.lit(None).cast("int").alias("id"), F.col("t").cast("string").alias("text"))
    assert found.where("n is null").count() == other.count() == 1500
    assert rows(found.where("n = 4"), "id", "text") == [(i, None) for i in sorted(range(20), key=lambda i: repr((i,)))]


def test_ingest_of_large_files(spark, place, tmp_path, small_blocks):
    write_csv(tmp_path / "c" / "1.csv", 1, "\n")
    loaded = []
    load = lambda df: loaded.append(rows(df, *SCHEMA.names))
    done = ingest_files(spark, f"{place}/c", f"{place}/log", lambda df: df, load, "2026-01-01 00:00:00", schema=SCHEMA, multiline=True)
    assert done == {"status": "loaded", "files": 1} and loaded == [rows(by_spark(spark, f"{place}/c"))]


def test_another_header_is_refused(spark, place, tmp_path, small_blocks):
    write_csv(tmp_path / "c" / "1.csv", 1, "\n", ("id", "n", "text"))
    with pytest.raises(QualityError, match="header"):
        readers.read_csv_lake(spark, f"{place}/c", SCHEMA, multiline=True)


@pytest.mark.parametrize("seed", range(2))
def test_json_like_a_whole_file(spark, place, tmp_path, small_blocks, seed):
    schema = T.StructType.fromDDL("id int, text string, o struct<p: array<struct<q: int>>>, lang string")
    (tmp_path / "j").mkdir()
    for f, indent in ((0, None), (1, 1)):
        items = [
            {"id": i, "text": t, "o": {"p": [{"q": i}, {}]}, **({"lang": None} if i % 3 else {})}
            for i, t in enumerate(texts(seed + f, 1200, [*MARKS, "\\", "[", "]", "é", "\t"]))
        ]
        (tmp_path / "j" / f"{f}.json").write_text(json.dumps(items, indent=indent, ensure_ascii=bool(f)))
    (tmp_path / "j" / "one.json").write_text(' {"id": -1, "text": "{[", "o": {"p": []}}')
    (tmp_path / "j" / "none.json").write_text("[ ]")
    found = readers.read_json_array(spark, f"{place}/j", schema, {"lang": "vi"})
    whole = spark.read.schema(schema).option("multiLine", True).json(f"{place}/j").fillna("vi", ["lang"])
    assert found.count() == 2401
    assert rows(found) == rows(whole)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_state_like_a_machine(end):
    """The state after a line against a plain machine over characters."""
    rng = random.Random(3)
    for _ in range(3000):
        line, inside = "".join(rng.choice(['"', ",", "a", '""', ',"', " "]) for _ in range(rng.randint(0, 12))), rng.random() < 0.5
        state, i = "in" if inside else "start", 0
        while i < len(line):
            c = line[i]
            if state == "in" and c == '"':
                state, i = ("in", i + 1) if line[i + 1 : i + 2] == '"' else ("out", i)
            elif state != "in":
                state = "in" if state == "start" and c == '"' else "start" if c == "," else "out"
            i += 1
        assert blocks.csv_step(line, inside) == (state == "in", 0), (line, inside)


def test_elements_that_are_no_objects_are_left_out(spark, place, tmp_path, small_blocks):
    (tmp_path / "j").mkdir()
    items = [x for i in range(2000) for x in (f"text {{ {i}", i, None, {"id": i})]
    (tmp_path / "j" / "a.json").write_text(json.dumps(items))
    found = readers.read_json_array(spark, f"{place}/j", struct("id int"))
    assert sorted(r.id for r in found.collect()) == list(range(2000))


def test_settings_stay(spark, place, tmp_path):
    for i in range(5):
        write_csv(tmp_path / "c" / f"{i}.csv", i, "\n", (f"a{i}", "id"), n=10)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    found = readers.read_csv_by_name(spark, f"{place}/c")
    assert [spark.conf.get(n) for n in names] == before
    assert sorted(found.columns) == ["a0", "a1", "a2", "a3", "a4", "id"] and found.count() == 50


def test_one_scan_for_all_headers(spark, place, tmp_path):
    for i in range(40):
        write_csv(tmp_path / "c" / f"{i}.csv", i, "\n", (f"a{i}", "id"), n=4)
    plan = readers.read_csv_by_name(spark, f"{place}/c")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Union" not in plan
