"""Repeated deliveries in a stream."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from marketlake.schemas import struct
from marketlake.streaming import once

from .conftest import rows

SCHEMA = struct("k string, v bigint")


def put(folder, name, *pairs):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(["k,v", *[f"{k},{v}" for k, v in pairs]]) + "\n")


def run(spark, place, order="_v", days=30.0):
    shape = lambda df: df.select("k", "v", F.col("v").alias("_v"))
    return once.ingest_once(spark, f"{place}/in", SCHEMA, f"{place}/checkpoint", shape, f"{place}/t", ["k"], [order], days)


def test_later_rows_of_a_key_are_dropped(spark, place, tmp_path):
    put(tmp_path / "in", "1.csv", ("a", 5), ("a", 3), ("b", 1), ("", 7), ("", 6))
    assert run(spark, place) == 1
    put(tmp_path / "in", "2.csv", ("a", 1), ("c", 2), ("", 1))
    assert run(spark, place) == 1
    assert run(spark, place) == 0
    found = spark.read.parquet(f"{place}/t")
    assert rows(found, "k", "v") == [("a", 3), ("b", 1), ("c", 2), (None, 6)]
    assert set(found.columns) == {"k", "v", "batch"}


def test_falling_order_and_expired_memory(spark, place, tmp_path):
    put(tmp_path / "in", "1.csv", ("a", 5), ("a", 9), ("a", ""))
    run(spark, place, "-_v", days=1e-7)
    put(tmp_path / "in", "2.csv", ("a", 1))
    run(spark, place, "-_v", days=1e-7)
    assert rows(spark.read.parquet(f"{place}/t"), "k", "v") == [("a", 1), ("a", 9)]


def test_settings_stay(spark, place, tmp_path):
    before = {k: spark.conf.get(k, None) for k in once.STREAM_SETTINGS}
    put(tmp_path / "in", "1.csv", ("a", 1))
    run(spark, place)
    assert {k: spark.conf.get(k, None) for k in once.STREAM_SETTINGS} == before


def test_first_of_batch_like_a_loop():
    rng = random.Random(1)
    for order in (["v"], ["-v"], ["w", "-v"], []):
        data = [(rng.choice(["a", "b", None]), rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"])) for _ in range(60)]
        batch = pa.RecordBatch.from_pylist([{"k": k, "v": v, "w": w} for k, v, w in data], pa.schema([("k", pa.string()), ("v", pa.int64()), ("w", pa.string())]))
        best = {}
        for row in batch.to_pylist():
            if row["k"] not in best or once._precedes(row, best[row["k"]], once._order(order)):
                best[row["k"]] = row
        names = [o.removeprefix("-") for o in order]
        found = once._first_of_batch(batch, ["k"], once._order(order)).to_pylist()
        assert {r["k"]: [r[n] for n in names] for r in found} == {k: [r[n] for n in names] for k, r in best.items()}
        assert len(found) == len(best)
