"""Table loads. Each query writes to a folder of its own and returns the table read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import md5_id
from marketlake.operators import tables
from marketlake.operators.dedup import keep_last
from marketlake.schemas import struct
from marketlake.session import new_folder
from marketlake.sources import manifest

from .base import RUN_TS, Tables, check, part_mapping

DAILY_SQL = """
    select 'U' || user_id as ticker, ts::date as trading_date, value as close from events
    qualify row_number() over (partition by user_id, ts::date order by event_id desc) = 1
"""


def daily_closes(t: Tables) -> DataFrame:
    """Last event of each user and day, as a closing price."""
    events = t.events.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        F.to_date("ts").alias("trading_date"),
        F.col("value").alias("close"),
        "event_id",
    )
    return keep_last(events, ["ticker", "trading_date"], ["event_id"])


def by_month() -> dict:
    return {"trading_month": F.date_format("trading_date", "yyyy-MM")}


def table_name() -> str:
    return f"checks_{uuid.uuid4().hex}"


@check(
    "append_positional",
    """select o_orderkey as ticker, o_orderstatus as name, o_totalprice as amount,
              timestamp '2026-01-15 08:00:00' as import_time from orders""",
)
def append_positional(t: Tables) -> DataFrame:
    place, name = new_folder(t.spark, "append_positional"), table_name()
    schema = struct("ticker bigint, name string, amount double, import_time timestamp")
    tables.ensure_table(t.spark, name, schema, location=place)
    tables.append_positional(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), name, RUN_TS)
    t.spark.sql(f"DROP TABLE {name}")
    loaded = t.spark.read.parquet(place)
    return loaded.withColumn("import_time", F.col("import_time").cast("timestamp_ntz"))


@check(
    "append_by_name",
    "select l_orderkey, l_partkey, l_quantity from lineitem where l_quantity > 25 "
    "union all select l_orderkey, l_partkey, l_quantity from lineitem",
)
def append_by_name(t: Tables) -> DataFrame:
    place, name = new_folder(t.spark, "append_by_name"), table_name()
    tables.ensure_table(t.spark, name, struct("l_orderkey bigint, l_partkey bigint, l_quantity double"), location=place)
    tables.append_by_name(t.lineitem.where("l_quantity > 25").select("l_quantity", "l_orderkey", "l_partkey"), name)
    tables.append_by_name(t.lineitem.select("l_partkey", "l_quantity", "l_orderkey"), name)
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.read.parquet(place)


@check(
    "ensure_table",
    "select event_id, user_id, event_type from events",
)
def ensure_table(t: Tables) -> DataFrame:
    place, name = new_folder(t.spark, "ensure_table"), table_name()
    schema = struct("event_id bigint, user_id bigint, event_type string")
    tables.ensure_table(t.spark, name, schema, ["event_type"], place)
    rows = t.events.select(*schema.names)
    rows.write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True)
    tables.ensure_table(t.spark, name, schema, ["event_type"], place)
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.read.parquet(place)


@check(
    "full_refresh",
    """select distinct p_name as raw_ind_name,
              case when split_part(p_name, ' ', 1) in ('red', 'blue') then 'painted ' else 'tempered ' end
              || split_part(p_name, ' ', 2) as std_ind_name
       from part where split_part(p_name, ' ', 1) in ('red', 'blue', 'hot', 'cold')""",
)
def full_refresh(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "mapping")
    mapping = part_mapping(t)
    tables.refresh_mapping(mapping.withColumn("std_ind_name", F.lit("old")), place, "raw_ind_name")
    return tables.refresh_mapping(mapping, place, "raw_ind_name")


@check(
    "upsert_lww",
    f"""with daily as ({DAILY_SQL}),
        old as (select * from daily where trading_date <= date '2024-01-15'),
        new as (select ticker, trading_date, close + 1000 as close from daily where trading_date >= date '2024-01-10')
        select *, strftime(trading_date, '%Y-%m') as trading_month from new
        union all
        select *, strftime(trading_date, '%Y-%m') from old
        where (ticker, trading_date) not in (select (ticker, trading_date) from new)""",
)
def upsert_lww(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "upsert")
    daily = daily_closes(t)
    key = ["ticker", "trading_date"]
    old = daily.where("trading_date <= '2024-01-15'").withColumnRenamed("event_id", "_event")
    new = daily.where("trading_date >= '2024-01-10'").withColumnRenamed("event_id", "_event")
    again = new.withColumn("close", F.lit(-1.0)).withColumn("_event", F.col("_event") - 1)
    tables.upsert(old, place, key, ["_event"], by_month())
    both = new.withColumn("close", F.col("close") + 1000).unionByName(again)
    tables.upsert(both, place, key, ["_event"], by_month())
    return t.spark.read.parquet(place)


@check(
    "upsert_unpartitioned",
    """select o_custkey, coalesce(new_total, old_total) as total from
       (select o_custkey, max(o_totalprice) filter (where o_orderstatus = 'F') as old_total,
               max(o_totalprice) filter (where o_orderstatus <> 'F') as new_total
        from orders group by o_custkey)""",
)
def upsert_unpartitioned(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "upsert_whole")
    rows = t.orders.select("o_custkey", F.col("o_totalprice").alias("total"), F.col("o_totalprice").alias("_order"), "o_orderstatus")
    tables.upsert(rows.where("o_orderstatus = 'F'").drop("o_orderstatus"), place, ["o_custkey"], ["_order"])
    return tables.upsert(rows.where("o_orderstatus <> 'F'").drop("o_orderstatus"), place, ["o_custkey"], ["_order"])


@check(
    "insert_if_absent",
    """with titled as (select doc_id, lang, text, md5(split_part(text, chr(10), 1)) as news_id from documents),
       first_load as (select * from titled where lang <> 'en'
                      qualify row_number() over (partition by news_id order by doc_id) = 1),
       second_load as (select * from titled where news_id not in (select news_id from first_load)
                       qualify row_number() over (partition by news_id order by doc_id) = 1)
       select * from first_load union all select * from second_load""",
)
def insert_if_absent(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "absent")
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    titled = t.documents.select("doc_id", "lang", "text", md5_id(title).alias("news_id"))
    tables.insert_if_absent(titled.where("lang <> 'en'"), place, ["news_id"], ["doc_id"])
    tables.insert_if_absent(titled, place, ["news_id"], ["doc_id"])
    tables.insert_if_absent(titled, place, ["news_id"], ["doc_id"])
    return t.spark.read.parquet(place)


@check(
    "replace_partitions",
    """select o_orderkey, o_totalprice * case when o_orderstatus = 'F' then 2 else 1 end as total,
              o_orderstatus from orders""",
)
def replace_partitions(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "replace")
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("total"), "o_orderstatus")
    tables.replace_partitions(rows, place, ["o_orderstatus"])
    doubled = rows.where("o_orderstatus = 'F'").withColumn("total", F.col("total") * 2)
    tables.replace_partitions(doubled, place, ["o_orderstatus"])
    return tables.replace_partitions(doubled, place, ["o_orderstatus"])


@check(
    "snapshot_count",
    """select 20240115 as snapshot_ds, count(*) as row_count, count(distinct o_orderkey) as orders from orders""",
)
def snapshot_count(t: Tables) -> DataFrame:
    """Two snapshots of one day, of which the second counts, read through its manifest after the table has changed."""
    target, root = new_folder(t.spark, "orders"), new_folder(t.spark, "snapshots")
    tables.replace_partitions(t.orders.where("o_orderstatus = 'F'"), target, ["o_orderstatus"])
    manifest.take_snapshot(t.spark, target, root, "2024-01-15")
    tables.replace_partitions(t.orders, target, ["o_orderstatus"])
    manifest.take_snapshot(t.spark, target, root, "2024-01-15")
    tables.replace_partitions(t.orders.where("o_orderstatus = 'O' and o_totalprice < 0.5 * o_orderkey"), target, ["o_orderstatus"])
    copies = manifest.read_snapshot(t.spark, root, "2024-01-15").withColumn("snapshot_ds", F.lit(20240115))
    return copies.groupBy("snapshot_ds").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("o_orderkey").alias("orders")
    )


@check(
    "snapshot_rows",
    """select 'before' as taken, o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders
       union all select 'after', o_orderkey, o_custkey, o_totalprice + 1, o_orderstatus from orders where o_orderstatus = 'F'
       union all select 'after', o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders where o_orderstatus <> 'F'""",
)
def snapshot_rows(t: Tables) -> DataFrame:
    """Snapshots before and after an upsert, both read after the whole table was replaced."""
    target, root = new_folder(t.spark, "orders"), new_folder(t.spark, "snapshots")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", F.lit(0).alias("_order"))
    key, status = ["o_orderkey", "o_orderstatus"], {"o_orderstatus": F.col("o_orderstatus")}
    tables.upsert(rows, target, key, ["_order"], status)
    manifest.take_snapshot(t.spark, target, root, "2024-01-15")
    finished = rows.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    tables.upsert(finished, target, key, ["_order"], status)
    manifest.take_snapshot(t.spark, target, root, "2024-01-16")
    tables.full_refresh(rows.drop("_order").limit(1), target)
    before, after = (manifest.read_snapshot(t.spark, root, day) for day in ("2024-01-15", "2024-01-16"))
    return before.withColumn("taken", F.lit("before")).unionByName(after.withColumn("taken", F.lit("after")))


@check(
    "snapshot_retention",
    """select distinct strftime(ts, '%Y%m%d') as snapshot_ds from events
       where strftime(ts, '%Y%m%d') < '20240118'""",
)
def snapshot_retention(t: Tables) -> DataFrame:
    days = t.events.select(F.date_format("ts", "yyyyMMdd").alias("snapshot_ds")).distinct()
    return tables.expired(days, "snapshot_ds", "2024-01-25")
