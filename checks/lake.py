"""Lake files: the tables are staged as CSV, JSON, XML or text first, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators import columns, quality
from marketlake.operators.columns import with_source_file
from marketlake.operators.quality import QualityError
from marketlake.schemas import struct
from marketlake.session import new_folder
from marketlake.sources import lake, paths, readers

from .base import Tables, check


@check("csv_roundtrip", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def csv_roundtrip(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "csv")
    schema = struct("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double")
    t.orders.select(*schema.names).write.option("header", True).csv(place)
    return readers.read_csv_lake(t.spark, place, schema)


@check("csv_bom_multiline", "select doc_id, text, lang from documents")
def csv_bom_multiline(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "bom")
    lake.write_lake(t.documents.select("doc_id", "text", "lang"), place, "news", "2024-01-15", "csv", bom=True)
    schema = struct("doc_id bigint, text string, lang string")
    return readers.read_csv_lake(t.spark, f"{place}/news/ds=2024-01-15/batch=0", schema, multiline=True)


@check(
    "csv_by_name",
    """select 'c' || c_custkey as ticker, c_acctbal as close, null::double as volume from customer
       union all select 's' || s_suppkey, s_acctbal, s_nationkey::double from supplier""",
)
def csv_by_name(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "by_name")
    first = t.customer.select(
        F.col("c_acctbal").alias("Close "), F.format_string("c%d", "c_custkey").alias("TICKER")
    )
    second = t.supplier.select(
        F.format_string("s%d", "s_suppkey").alias("ticker"),
        F.col("s_nationkey").alias("volume"),
        F.col("s_acctbal").alias("close"),
    )
    first.write.option("header", True).csv(f"{place}/a folder")
    second.write.option("header", True).csv(f"{place}/b")
    frames = readers.read_csv_by_name(t.spark, place, struct("ticker string, close double, volume double"))
    return frames


@check(
    "json_array_news",
    """select conv_id::varchar as news_id, role as related_ticker, text as news_title,
              case when turn % 2 = 1 then 'en' else 'vi' end as lang_code, 1704067200000 + turn as public_date
       from conversations""",
)
def json_array_news(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "json")
    items = t.conversations.select(
        F.col("conv_id").cast("string").alias("news_id"),
        F.col("role").alias("related_ticker"),
        F.col("text").alias("news_title"),
        F.when(F.col("turn") % 2 == 1, "en").alias("lang_code"),
        (F.lit(1704067200000) + F.col("turn")).alias("public_date"),
    )
    lake.write_json_array(items, place)
    schema = struct("news_id string, related_ticker string, news_title string, lang_code string, public_date bigint")
    return readers.read_json_array(t.spark, place, schema, {"lang_code": "vi"})


@check(
    "json_fields",
    "select event_id, (props->>'$.k')::int as k, props->>'$.none' as none from events",
)
def json_fields(t: Tables) -> DataFrame:
    return readers.extract_json(t.events.select("event_id", "props"), "props", "k int, none string").drop("props")


@check("json_roundtrip", "select doc_id, text, source from documents")
def json_roundtrip(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "jsonl")
    lake.write_json(t.documents.select("doc_id", "text", "source"), place)
    schema = struct("doc_id bigint, text string, source string")
    return readers.read_json_array(t.spark, place, schema, lines=True)


NEWS_NAMESPACE = "http://www.google.com/schemas/sitemap-news/0.9"


@check(
    "sitemap_scan",
    """select url as loc, case when url like '%?%' then '2024-01-' || lpad((length(html) % 28 + 1)::varchar, 2, '0')
              || 'T08:00:00+07:00' end as published from pages""",
)
def sitemap_scan(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "sitemap")
    day = F.format_string("2024-01-%02dT08:00:00+07:00", F.length("html") % 28 + 1)
    news = F.when(F.col("url").contains("?"), F.struct(day.alias("news:publication_date")))
    entries = t.pages.select(F.col("url").alias("loc"), news.alias("news:news"))
    empty = t.pages.select(F.lit(" ").alias("loc"), F.lit(None).cast(entries.schema["news:news"].dataType).alias("news:news"))
    writer = entries.unionByName(empty).write.format("xml").option("rowTag", "url").option("validateName", False)
    writer.option("rootTag", f"urlset xmlns:news='{NEWS_NAMESPACE}'").save(place)
    return readers.read_sitemap(t.spark, place)


@check("rss_scan", "select url as loc from pages")
def rss_scan(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "rss")
    items = t.pages.select(F.col("url").alias("link"), F.col("html").alias("title"))
    items.write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(place)
    return readers.read_rss(t.spark, place)


@check("line_list", "select upper(c_name) as symbol from customer")
def line_list(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "lines")
    lines = t.customer.select(F.concat(F.lit("  "), F.lower("c_name"), F.lit("\xa0")).alias("value"))
    lines.unionByName(t.supplier.select(F.lit(" \t").alias("value"))).write.text(place)
    return readers.read_lines(t.spark, place)


@check("first_non_empty", "select c_custkey from customer")
def first_non_empty(t: Tables) -> DataFrame:
    primary = t.customer.where("c_custkey < 0")
    return readers.first_non_empty(primary, t.customer, t.customer.where("c_custkey = 1")).select("c_custkey")


@check(
    "source_lineage",
    "select 'orders.parquet' as file, count(*) as row_count from orders",
)
def source_lineage(t: Tables) -> DataFrame:
    named = with_source_file(t.orders).withColumn("file", F.regexp_extract("source_file", r"/([a-z]+\.parquet)", 1))
    return named.groupBy("file").agg(F.count(F.lit(1)).alias("row_count"))


@check(
    "lake_partition_write",
    """select event_id, case when event_type = 'click' then -value else value end as value,
              date '2024-01-31' as ds, event_type as batch from events""",
)
def lake_partition_write(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "lake")
    rows = t.events.select("event_id", "value", "event_type")
    lake.write_lake(rows, place, "prices", "2024-01-31", batch="event_type")
    clicks = rows.where("event_type = 'click'").withColumn("value", -F.col("value"))
    lake.write_lake(clicks, place, "prices", "2024-01-31", batch="event_type")
    lake.write_lake(rows.where("event_type = 'none'"), place, "prices", "2024-01-31", batch="event_type")
    return t.spark.read.parquet(f"{place}/prices")


@check(
    "object_keys",
    "select o_orderkey, 'people/date=2026-01-15/batch_' || o_orderkey || '.csv' as key from orders",
)
def object_keys(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", lake.object_keys("people", "2026-01-15", F.col("o_orderkey")).alias("key"))


@check(
    "missing_outputs",
    """select 'bctc/2026-01-15/batch_' || o_orderkey || '.csv' as key from orders
       where o_orderkey not in (select l_orderkey from lineitem where l_orderkey % 50 not in (7, 33))""",
)
def missing_outputs(t: Tables) -> DataFrame:
    """All orders against the batches written: of some the files are listed, the others are named by a load's table."""
    place = new_folder(t.spark, "keys")
    lines = t.lineitem.where("l_orderkey % 50 not in (7, 33)").select("l_partkey", F.col("l_orderkey").alias("b"))
    lake.write_lake(lines.where("b < 200"), place, "bctc", "2026-01-15", "csv", batch="b")
    written = lake.written_keys(t.spark, place, "bctc", "2026-01-15")
    rest = lines.where("b >= 200").select(lake.object_keys("bctc", "2026-01-15", F.col("b")).alias("key"))
    expected = t.orders.select(lake.object_keys("bctc", "2026-01-15", F.col("o_orderkey")).alias("key"))
    return lake.missing_outputs(expected, written.unionByName(rest), "key")


@check(
    "missing_batches",
    "select distinct event_type as batch from events where event_type = 'error'",
)
def missing_batches(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "batches")
    written = t.events.where("event_type <> 'error'").select("event_id", "event_type")
    lake.write_lake(written, place, "prices", "2024-01-31", batch="event_type")
    expected = t.events.select(F.col("event_type").alias("batch")).distinct()
    return lake.missing_outputs(expected, lake.written_batches(t.spark, place, "prices", "2024-01-31"), "batch")


@check(
    "missing_columns",
    "select count(*) as row_count, 'missing columns in price file: [''close'']' as refused from orders",
)
def missing_columns(t: Tables) -> DataFrame:
    """A gate that refuses, as a row."""
    try:
        refused = columns.require_columns(t.orders, ["o_orderkey"]).columns[0]
        columns.require_columns(t.orders, ["o_orderkey", "close"], "price file")
    except ValueError as error:
        refused = str(error)
    return t.orders.agg(F.count(F.lit(1)).alias("row_count")).withColumn("refused", F.lit(refused))


@check("empty_policy", "select count(*) as row_count, 'skipped, refused' as outcome from orders")
def empty_policy(t: Tables) -> DataFrame:
    nothing = t.orders.where("o_orderkey < 0")
    outcome = "kept" if quality.on_empty(nothing, "skip") is not None else "skipped"
    try:
        quality.on_empty(nothing, "error")
    except QualityError:
        outcome += ", refused"
    kept = quality.on_empty(t.orders, "error")
    return kept.agg(F.count(F.lit(1)).alias("row_count")).withColumn("outcome", F.lit(outcome))


@check("csv_keeps_text", "select o_orderkey::varchar as symbol, case when o_orderkey % 2 = 0 then '1e-05' else '007' end as ratio from orders")
def csv_keeps_text(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "text")
    ratio = F.when(F.col("o_orderkey") % 2 == 0, "1e-05").otherwise("007")
    t.orders.select(F.col("o_orderkey").alias("symbol"), ratio.alias("ratio")).write.option("header", True).csv(place)
    return readers.read_csv_by_name(t.spark, place)


@check(
    "compaction_plan",
    """select max(d) as latest, min(d) as first_ds, max(d) filter (where d < last) as last_ds,
              count(*) - 1 as older_dates, count(*) - 1 >= 10 as compact
       from (select d, max(d) over () as last
             from (select distinct strftime(ts, '%Y-%m-%d') as d from events))""",
)
def compaction_plan(t: Tables) -> DataFrame:
    files = t.events.select(F.date_format("ts", "yyyy-MM-dd").alias("ds"))
    return lake.compaction_plan(files)


@check(
    "compaction_rows",
    """select event_id, user_id, value, case when ts::date < date '2024-01-15' then event_type end as event_type
       from events where ts::date < (select max(ts::date) from events)""",
)
def compaction_rows(t: Tables) -> DataFrame:
    """Two headers; a tenth of the rows comes late, behind two blank lines, for dates that are archived by then."""
    root = new_folder(t.spark, "compact")
    daily = t.events.withColumn("ds", F.date_format("ts", "yyyy-MM-dd"))
    held = F.col("event_id") % 10 == 3
    early = daily.where("ds < '2024-01-15'").where(~held).select("event_id", "user_id", "value", "event_type", "ds")
    late = daily.where("ds >= '2024-01-15'").where(~held).select("value", "user_id", "event_id", "ds")
    for part in (early, late):
        part.hint("rebalance", "ds").write.mode("append").option("header", True).partitionBy("ds").csv(root)
    lake.compact_partitions(t.spark, root)
    names = ["event_id", "user_id", "value", "event_type"]
    kind = F.when(F.col("ds") < "2024-01-15", F.col("event_type"))
    rows = daily.where(held).select("ds", F.col("event_id").alias("_order"), F.concat_ws(",", *names[:3], F.coalesce(kind, F.lit(""))).alias("line"))
    tops = rows.select("ds").distinct().select("ds", F.explode(F.arrays_zip(F.array(F.lit(-3), F.lit(-2), F.lit(-1)).alias("o"), F.array(F.lit(""), F.lit(" "), F.lit(",".join(names))).alias("l"))).alias("x"))
    rows = rows.unionByName(tops.select("ds", F.col("x.o").cast("bigint").alias("_order"), F.col("x.l").alias("line")))
    rows.repartition("ds").sortWithinPartitions("ds", "_order").select("ds", "line").write.mode("append").partitionBy("ds").text(root)
    lake.compact_partitions(t.spark, root, min_history=1)
    left = paths.lake_files(t.spark, root).select("ds").distinct().count()
    archived = t.spark.read.option("recursiveFileLookup", True).parquet(f"{root}/{lake.ARCHIVE}").where(F.lit(left == 1))
    return archived.select(
        F.col("event_id").cast("bigint"),
        F.col("user_id").cast("bigint"),
        F.col("value").cast("double"),
        "event_type",
    )
