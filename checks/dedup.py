"""De-duplication and batching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators import dedup

from .base import Tables, check


@check(
    "dedup_first",
    """select user_id, day, event_id, event_type, value from
       (select *, ts::date as day from events)
       qualify row_number() over (partition by user_id, day order by event_id) = 1""",
)
def dedup_first(t: Tables) -> DataFrame:
    daily = t.events.withColumn("day", F.to_date("ts"))
    first = dedup.keep_first(daily, ["user_id", "day"], ["event_id"])
    return first.select("user_id", "day", "event_id", "event_type", "value")


@check(
    "dedup_last",
    """select event_type, day, event_id, value from (select *, ts::date as day from events)
       qualify row_number() over (partition by event_type, day order by ts desc, event_id desc) = 1""",
)
def dedup_last(t: Tables) -> DataFrame:
    daily = t.events.withColumn("day", F.to_date("ts"))
    last = dedup.keep_last(daily, ["event_type", "day"], ["ts", "event_id"])
    return last.select("event_type", "day", "event_id", "value")


@check(
    "dedup_composite",
    """select l_partkey, l_suppkey, l_orderkey, l_linenumber, l_extendedprice, l_shipdate from lineitem
       qualify row_number() over (partition by l_partkey, l_suppkey order by l_shipdate desc, l_orderkey desc,
           l_linenumber desc, l_extendedprice desc) = 1""",
)
def dedup_composite(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"]
    return dedup.keep_last(rows, ["l_partkey", "l_suppkey"], order)


@check(
    "news_id_dedup",
    """select conv_id, turn, role, text from conversations
       where role <> 'system' or trim(text) <> ''
       qualify row_number() over (partition by case when role = 'system' then text else conv_id::varchar end
           order by role, turn, conv_id) = 1""",
)
def news_id_dedup(t: Tables) -> DataFrame:
    news = t.conversations.withColumn(
        "id", F.when(F.col("role") != "system", F.col("conv_id").cast("string"))
    )
    unique = dedup.dedup_news(news, "id", "text", ["role", "turn", "conv_id"])
    return unique.select("conv_id", "turn", "role", "text")


@check(
    "dedup_report",
    """select source, count(*) as total_rows, count(distinct md5(text)) as kept_rows,
              count(*) - count(distinct md5(text)) as dropped_rows
       from documents group by source""",
)
def dedup_report(t: Tables) -> DataFrame:
    return dedup.dedup_report(t.documents, "source", F.md5(F.col("text").cast("binary")))


@check(
    "assign_batches",
    """select c_custkey, c_name, position, position // 20 as batch from
       (select c_custkey, c_name, row_number() over (order by c_name, c_custkey) - 1 as position
        from customer)""",
)
def assign_batches(t: Tables) -> DataFrame:
    return dedup.assign_batches(t.customer.select("c_custkey", "c_name"), 20, ["c_name", "c_custkey"])


@check(
    "batch_lists",
    """select batch, string_agg(l_partkey::varchar, ',' order by position) as symbols from
       (select l_partkey, position, position // 5 as batch from
        (select l_partkey, row_number() over (order by l_partkey) - 1 as position
         from (select distinct l_partkey from lineitem))) group by batch""",
)
def batch_lists(t: Tables) -> DataFrame:
    symbols = t.lineitem.select("l_partkey").distinct()
    lists = dedup.batch_lists(dedup.assign_batches(symbols, 5, ["l_partkey"]), "l_partkey")
    texts = F.transform("l_partkeys", lambda k: k.cast("string"))
    return lists.select("batch", F.array_join(texts, ",").alias("symbols"))
