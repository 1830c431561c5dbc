"""Shards by a consistent-hash ring with virtual nodes and bounded loads, in SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import query, table
from .steps import Steps

PLACES = 1 << 16  # places on the ring; at most so many virtual nodes can be told apart
VIRTUAL = 128  # virtual nodes of a shard


def place(hashed: Column) -> Column:
    """Place on the ring of a 64-bit hash: its highest bits."""
    return F.shiftrightunsigned(hashed, 64 - (PLACES.bit_length() - 1)).cast("int")


def ring(spark: SparkSession, shards: int, virtual: int = VIRTUAL) -> DataFrame:
    """``place, node, shard`` of every place: the virtual node that is the first one clockwise from there.

    Nodes are numbered clockwise. Of two nodes on one place that of the smaller shard stays. The size of the ring
    is ``PLACES``, whatever is sharded.
    """
    name = F.concat_ws("/", F.lit("shard"), F.floor(F.col("id") / virtual), F.col("id") % virtual)
    nodes = spark.range(shards * virtual).select(
        place(F.xxhash64(name)).alias("place"), F.floor(F.col("id") / virtual).cast("int").alias("shard")
    )
    nodes = nodes.groupBy("place").agg(F.min("shard").alias("shard"))
    clockwise = Window.orderBy("place")
    arcs = nodes.select(
        "shard",
        F.row_number().over(clockwise).alias("node"),
        (F.lag("place", 1, -1).over(clockwise) + 1).alias("first"),
        F.col("place").alias("last"),
        F.max("place").over(clockwise.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("end"),
    )
    beyond = F.when((F.col("node") == 1) & (F.col("end") < PLACES - 1), F.sequence(F.col("end") + 1, F.lit(PLACES - 1)))
    covered = F.concat(F.sequence("first", "last"), F.coalesce(beyond, F.array().cast("array<int>")))
    return arcs.select("node", "shard", F.explode(covered).alias("place"))


def _one_round(waiting: DataFrame, rooms: DataFrame) -> DataFrame:
    """``node, shard, waiting, target, taken``: waiting keys ask the first shard clockwise that has room.

    A shard takes what it has room for, in the order of the nodes that ask.
    """
    here = waiting.join(rooms, "shard")
    clockwise = Window.orderBy("node")
    some = F.when(F.col("room") > 0, F.col("shard"))
    ahead = F.first(some, ignorenulls=True).over(clockwise.rowsBetween(0, Window.unboundedFollowing))
    around = F.first(some, ignorenulls=True).over(clockwise.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    asked = here.select("node", "shard", "waiting", F.coalesce(ahead, around).alias("target"))
    asked = asked.join(rooms.select(F.col("shard").alias("target"), "room"), "target")
    earlier = Window.partitionBy("target").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("room") - F.coalesce(F.sum("waiting").over(earlier), F.lit(0))
    taken = F.least("waiting", F.greatest(left, F.lit(0))).cast("long")
    return asked.select("node", "shard", "waiting", "target", taken.alias("taken"))


def bounded_loads(demand: DataFrame, shards: int, steps: Steps) -> DataFrame:
    """Where the keys of each node go: ``node, shard, start, end, base``.

    ``demand`` has ``node, shard, keys`` of every virtual node. The loads of the shards are at most one apart.
    The keys of a node, numbered from 0 through all nodes clockwise, go from number ``start`` to before ``end``
    to ``shard``, where the first of them has the slot ``base``. A shard takes its own keys first; those that
    find it full go on clockwise to the next shard with room, and so on. Each round fills another shard or is
    the last, so there are no more rounds than shards; all tables here have at most a row per node and round.
    """
    total = demand.agg(F.coalesce(F.sum("keys"), F.lit(0))).first()[0]
    rooms = steps.spark.range(shards).select(
        F.col("id").cast("int").alias("shard"), (F.lit(total // shards) + (F.col("id") < total % shards).cast("long")).alias("room")
    )
    waiting = demand.select("node", "shard", F.col("keys").alias("waiting"))
    rounds = None
    while True:
        made = steps.keep(_one_round(waiting, rooms).coalesce(1))
        numbered = made.withColumn("round", F.lit(len(steps.paths)))
        rounds = numbered if rounds is None else rounds.unionAll(numbered)
        waiting = made.select("node", "shard", (F.col("waiting") - F.col("taken")).alias("waiting"))
        if waiting.where("waiting > 0").isEmpty():
            break
        used = made.groupBy(F.col("target").alias("shard")).agg(F.sum("taken").alias("used"))
        rooms = rooms.join(used, "shard", "left").select("shard", (F.col("room") - F.coalesce("used", F.lit(0))).alias("room"))
        rooms = steps.keep(rooms.coalesce(1))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    total_of = lambda window: F.coalesce(F.sum("taken").over(window), F.lit(0))
    parts = rounds.where("taken > 0").select(
        "node",
        F.col("target").alias("shard"),
        "taken",
        total_of(before.orderBy("node", "round")).alias("start"),
        total_of(before.partitionBy("target").orderBy("round", "node")).alias("base"),
    )
    return parts.select("node", "shard", "start", (F.col("start") + F.col("taken")).alias("end"), "base")


def assign(df: DataFrame, key: str, shards: int, carry: dict[str, Column] | None = None, virtual: int = VIRTUAL) -> DataFrame:
    """``key``, the columns ``carry`` and the ``shard`` (int) and ``slot`` (long, gapless from 0) of each row.

    A row's place on the ring is a hash of its key as text. Counts of the shards are at most one apart; a key
    whose shard is full goes to the next one clockwise, so most keys stay where the ring alone would put them,
    and another shard moves few. Which keys of a node go on is decided by the order of their hashes, then of
    the key and the carried columns, never by the order of rows.

    Nulls in the key have one place; rows of one key lie together until their shard is full, so a key with a
    third of all rows spreads over several. Equal rows differ in their slots. An empty table gives no rows.
    ``carry`` must not use the names shard and slot. What is written is a row of the key and ``carry`` each;
    it is sorted by ranges, in which equal rows are told apart by their number, and whole rows stay unread.
    """
    spark = df.sparkSession
    steps, kept = Steps(spark), Steps(spark)  # the result reads what is in kept
    carried = carry or {}
    hashed = F.xxhash64(F.col(key).cast("string"))
    values = F.struct(F.col(key).alias("key"), *[c.alias(f"c{i}") for i, c in enumerate(carried.values())])
    rows = df.select(values.alias("value"), hashed.alias("hash"), place(hashed).alias("place"), F.monotonically_increasing_id().alias("row"))
    rows = steps.keep(rows)
    nodes = steps.keep(ring(spark, shards, virtual).coalesce(1))
    placed = rows.join(nodes.select("place", "node"), "place")
    # The table is stored, as another run of the sort may choose other ranges.
    local = F.monotonically_increasing_id()
    order = ["node", "hash", "value", "row"]
    placed = placed.orderBy(*order).select(
        "value", "node", F.shiftright(local, 33).alias("slice"), local.bitwiseAND(F.lit((1 << 33) - 1)).alias("local")
    )
    placed = kept.keep(placed)
    sizes = placed.groupBy("slice").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = kept.keep(sizes.select("slice", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset")).coalesce(1))
    counts = placed.groupBy("node").agg(F.count(F.lit(1)).alias("keys"))
    demand = nodes.select("node", "shard").distinct().join(counts, "node", "left")
    demand = steps.keep(demand.select("node", "shard", F.coalesce("keys", F.lit(0)).alias("keys")).coalesce(1))
    parts = kept.keep(bounded_loads(demand, shards, steps).coalesce(1))
    steps.drop_from(0)
    numbered = placed.join(offsets, "slice").withColumn("number", F.col("offset") + F.col("local"))
    found = numbered.join(parts, "node").where((F.col("number") >= F.col("start")) & (F.col("number") < F.col("end")))
    slot = F.col("base") + F.col("number") - F.col("start")
    named = [F.col(f"value.c{i}").alias(name) for i, name in enumerate(carried)]
    return found.select(F.col("value.key").alias(key), *named, "shard", slot.cast("long").alias("slot"))


@query("op13_bounded_ring")
def op13(spark, sf_dir):
    """All documents in eight shards whose counts are at most one apart; a null text has no bytes."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    carried = {"size": (F.length(text) + 1).cast("long"), "text_crc32": F.crc32(text)}
    found = assign(table(spark, sf_dir, "documents"), "doc_id", 8, carried)
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
