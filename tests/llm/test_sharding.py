import collections
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from marketlake.llm import sharding


def hashed(key):
    return xxhash.xxh64(str(key).encode(), seed=42).intdigest() if key is not None else 42


def brute_force(rows, shards, virtual):
    """Rows one by one: (key, shard, slot) as a multiset; rows are (key, carried value)."""
    places = {}
    for node in range(shards * virtual):
        at = hashed(f"shard/{node // virtual}/{node % virtual}") >> 48
        places[at] = min(places.get(at, shards), node // virtual)
    nodes = sorted(places.items())
    order = lambda row: tuple((v is not None, v) for v in row)  # noqa: E731  nulls first
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    asking = collections.defaultdict(list)
    for row in sorted(rows, key=lambda r: (signed(hashed(r[0])), order(r))):
        node = next((i for i, (at, _) in enumerate(nodes) if at >= hashed(row[0]) >> 48), 0)
        asking[node].append(row)
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    slots, out = collections.Counter(), []
    while any(asking.values()):
        target = {}
        for node in range(len(nodes)):
            ahead = [s for _, s in nodes[node:] + nodes[:node] if room[s]]
            target[node] = ahead[0] if ahead else None
        for node in sorted(asking):
            shard = target[node]
            go, asking[node] = asking[node][: room[shard]], asking[node][room[shard] :]
            room[shard] -= len(go)
            for row in go:
                out.append((*row, shard, slots[shard]))
                slots[shard] += 1
    return sorted(out, key=str)


def found(df, shards, virtual=16):
    made = sharding.assign(df, "doc_id", shards, {"crc": F.crc32(F.coalesce("text", F.lit("")).cast("binary"))}, virtual)
    assert made.columns == ["doc_id", "crc", "shard", "slot"]
    return sorted((tuple(r) for r in made.collect()), key=str)


def crc(text):
    return zlib.crc32((text or "").encode())


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_like_brute_force(spark, documents, odd, shards):
    pairs = odd + [(i, f"text {i}") for i in range(100, 700)] + [(77, "the same")] * 300 + [(77, f"row {i}") for i in range(100)]
    assert found(documents(pairs), shards) == brute_force([(d, crc(t)) for d, t in pairs], shards, 16)


def test_counts_and_slots(spark, documents):
    """A key with two thirds of all rows spreads over the shards like any other."""
    rows = found(documents([(7, "a")] * 1000 + [(i, "b") for i in range(503)]), 4)
    by_shard = collections.defaultdict(list)
    for _, _, shard, slot in rows:
        by_shard[shard].append(slot)
    assert sorted(map(len, by_shard.values())) == [375, 376, 376, 376]
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert all(sum(r[0] == 7 and r[2] == s for r in rows) > 100 for s in by_shard)


def test_few_rows_move(spark):
    """A ninth shard takes a ninth of the rows; what else moves is what full shards handed on."""
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    shard = lambda n: {r.doc_id: r.shard for r in sharding.assign(rows, "doc_id", n).collect()}
    eight, nine = shard(8), shard(9)
    moved = [d for d in eight if eight[d] != nine[d]]
    assert sum(nine[d] == 8 for d in moved) in (2222, 2223)
    assert len(moved) < 0.3 * len(eight)


def test_ring_covers_every_place(spark):
    rows = sharding.ring(spark, 5, 7).collect()
    assert sorted(r.place for r in rows) == list(range(sharding.PLACES))
    assert {r.shard for r in rows} == set(range(5))


def test_empty(spark, documents):
    assert found(documents([]), 8) == []
    assert [r[2:] for r in found(documents([(None, None)]), 8)] == [(0, 0)]
