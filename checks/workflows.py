"""Whole jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake import registry
from marketlake.operators.columns import with_audit
from marketlake.operators.tables import replace_partitions
from marketlake.plans import (
    company,
    macro,
    news,
    prices,
    ratios,
    site_news,
    standardize,
    statements,
)
from marketlake.schemas import NEWS_CSV, NEWS_JSON, PRICE_RAW
from marketlake.session import new_folder
from marketlake.sources import lake, readers
from marketlake.streaming.once import ingest_once
from marketlake.streaming.ingest import absent_load, ingest_files, ingest_stream, upsert_load
from marketlake.vocabulary import LOADER_INDICATORS, STANDARD_INDICATORS, rows

from .base import LONG_SQL, RUN_TS, Tables, bars, check, values_sql, wide_statement
from .scalars import DECODE_SQL
from .tables import DAILY_SQL, daily_closes

BARS = "null::double as open, null::double as high, null::double as low, value as close, null::double as volume"


@check(
    "normalize_prices",
    f"""select 'U' || user_id as ticker, ts::date as trading_date, {BARS} from events
        qualify row_number() over (partition by user_id, ts::date order by event_id) = 1""",
)
def normalize_prices(t: Tables) -> DataFrame:
    return prices.normalize_prices(bars(t), ["_event"]).drop("_event")


@check(
    "daily_prices",
    f"""select 'U' || user_id as ticker, ts::date as trading_date, {BARS} from events
        where ts::date = date '2024-01-20'
        qualify row_number() over (partition by user_id order by event_id) = 1""",
)
def daily_prices(t: Tables) -> DataFrame:
    return prices.daily_prices(prices.clean_prices(bars(t)), "2024-01-20", ["_event"]).drop("_event")


@check(
    "price_window",
    f"""select * from ({DAILY_SQL}) where trading_date between date '2024-01-08' and date '2024-01-20'""",
)
def price_window(t: Tables) -> DataFrame:
    place = new_folder(t.spark, "window")
    closes = daily_closes(t).drop("event_id").withColumns(prices.month_partition())
    table = replace_partitions(closes, place, ["trading_month"])
    return prices.bars_between(table, "2024-01-08", "2024-01-20").drop("trading_month")


@check(
    "index_series",
    f"""select upper(event_type) as ticker, ts::date as trading_date, {BARS} from events
        where event_type <> 'error' and ts::date between date '2024-01-05' and date '2024-01-20'
        qualify row_number() over (partition by event_type, ts::date order by event_id desc) = 1""",
)
def index_series(t: Tables) -> DataFrame:
    raw = t.events.select(
        F.col("event_type").alias("index_code"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("TradingDate "),
        F.col("value").alias("close"),
        F.col("event_id").alias("_event"),
    )
    series = prices.index_series(
        prices.clean_prices(raw), ["_event"], "2024-01-20", "2024-01-05", ["CLICK", "PURCHASE", "SIGNUP", "VIEW"]
    )
    return series.drop("_event")


@check(
    "macro_series_union",
    """select strftime(ts, '%Y-%m-%d') as date, null::double as open, null::double as high, null::double as low,
              value as close, null::double as volume,
              case event_type when 'click' then 'US_BOND_10Y' when 'view' then 'USD_VND' when 'signup' then 'DXY_INDEX'
              end as indicator_type,
              case event_type when 'purchase' then 'GOLD' when 'error' then 'OIL' end as asset_type from events""",
)
def macro_series_union(t: Tables) -> DataFrame:
    kinds = {"click": "us_bond_10y", "view": "usd_vnd", "signup": "dxy_index", "purchase": "xau", "error": "oil"}
    name = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("event_type")]
    raw = t.events.select(F.col("ts").alias("Date"), F.col("value").alias("Close"), F.lit(0).alias("Dividends"), name.alias("kind"))
    return macro.macro_table(raw, F.col("kind"))


@check(
    "macro_mixed_types",
    """select strftime(ts, '%Y-%m-%d') as date, null::double as open, null::double as high, null::double as low,
              case when event_type = 'click' then value end as close, null::double as volume,
              case event_type when 'click' then 'US_BOND_10Y' else 'USD_VND' end as indicator_type
       from events where event_type in ('click', 'view') and ts >= timestamp '2024-01-10'""",
)
def macro_mixed_types(t: Tables) -> DataFrame:
    raw = lambda kind, close: t.events.where(F.col("event_type") == kind).select(F.col("ts").alias("date"), close.alias("close"))
    both = macro.macro_union({"us_bond_10y": raw("click", F.col("value").cast("string")), "usd_vnd": raw("view", F.lit("n/a"))})
    return macro.macro_window(both, "2024-01-10")


SLUG_SQL = "upper(trim(regexp_replace(ind_name, '[^A-Za-z0-9]+', '_', 'g'), '_'))"
STATEMENT_SQL = f"""
    select coalesce(ticker, 'HPG') as ticker, quarter, year, ind_name, {SLUG_SQL} as ind_code, value,
           report_name, report_code, timestamp '2026-01-15 08:00:00' as import_time
    from (select * from ({LONG_SQL})),
         (values ('income_statement', 'IS'), ('balance_sheet', 'BL')) as kinds(report_name, report_code)
    where report_code = 'IS' or ind_name in ('Net Inventories', 'Sales')
"""


def long_statements(t: Tables, year: int | None = None) -> DataFrame:
    wide = wide_statement(t)
    two = wide.drop("Sales deductions", "Tax For the Year")
    return statements.statements_long({"income_statement": wide, "balance_sheet": two}, RUN_TS, "HPG", year)


@check("statement_long", STATEMENT_SQL)
def statement_long(t: Tables) -> DataFrame:
    long = long_statements(t)
    return long.withColumn("import_time", F.col("import_time").cast("timestamp_ntz"))


@check("statement_long_year", f"select * exclude (import_time) from ({STATEMENT_SQL}) where year = 1998")
def statement_long_year(t: Tables) -> DataFrame:
    return long_statements(t, 1998).drop("import_time")


LOADED_SQL = f"""
    select ticker, quarter, year, report_name, report_code, coalesce(vi_name, ind_name) as ind_name,
           coalesce(code, upper(replace(ind_name, ' ', '_'))[1:50]) as ind_code,
           case when value is null then '0' else rtrim(rtrim(format('{{:.4f}}', value), '0'), '.') end as value
    from ({STATEMENT_SQL})
    left join {values_sql(rows(LOADER_INDICATORS), 'm(en_name, vi_name, code)')} on ind_name = en_name
"""


def loaded_statements(t: Tables) -> DataFrame:
    return statements.load_statements(long_statements(t), statements.loader_mapping(t.spark), RUN_TS)


@check("load_statements", LOADED_SQL)
def load_statements(t: Tables) -> DataFrame:
    return loaded_statements(t).drop("import_time")


@check(
    "standardize_job",
    f"""select ticker, year, quarter, report_code, coalesce(std_ind_name, ind_name) as ind_name, value
        from ({LOADED_SQL})
        left join {values_sql(rows(STANDARD_INDICATORS), 's(raw_ind_name, std_ind_name)')}
        on ind_name = raw_ind_name""",
)
def standardize_job(t: Tables) -> DataFrame:
    root = new_folder(t.spark, "warehouse")
    # A task's rows are of one statement kind, so they need no shuffle by kind.
    replace_partitions(loaded_statements(t), f"{root}/bctc", ["report_code"], rebalance=False)
    mapping = statements.standard_mapping(t.spark)
    for day in ("2026-01-15", "2026-01-16"):
        standardize.standardize_table(
            t.spark, f"{root}/bctc", mapping, f"{root}/mapping", f"{root}/backup", day, ["report_code"]
        )
    table = t.spark.read.parquet(f"{root}/bctc")
    return table.select("ticker", "year", "quarter", "report_code", "ind_name", "value")


@check(
    "ratios_union",
    """select coalesce(c_name, 'HPG') as ticker, c_acctbal as roe, c_mktsegment as segment, null::int as nation,
              'quarter' as period_type from customer
       union all select 'VNM', s_acctbal, null, s_nationkey, 'quarter' from supplier""",
)
def ratios_union(t: Tables) -> DataFrame:
    first = t.customer.select(F.col("c_name").alias("ticker"), F.col("c_acctbal").alias("roe"), F.col("c_mktsegment").alias("segment"))
    second = t.supplier.select(F.col("s_acctbal").alias("roe"), F.col("s_nationkey").alias("nation"))
    return ratios.ratios_union({"HPG": first, "VNM": second}, "quarter", RUN_TS).drop("extracted_at")


KINDS = 120
RATIO_SQL = ", ".join(f"case when c_custkey % {KINDS} = {k} then c_nationkey::varchar end as ratio_{k}" for k in range(KINDS))


@check(
    "ratios_folder",
    f"""select c_name as ticker, case when c_custkey % {KINDS} % 3 > 0 then c_custkey::varchar end as period, {RATIO_SQL},
               'quarter' as period_type from customer""",
)
def ratios_folder(t: Tables) -> DataFrame:
    """A file for each of 120 groups of customers, with a ratio of its own, in three orders of columns, one without period."""
    place = new_folder(t.spark, "ratios")
    kind = (F.col("c_custkey") % KINDS).cast("int")

    def line(period: Column, ticker: Column, ratio: Column) -> Column:
        by_order = (F.concat_ws(",", *cells) for cells in ((ratio, ticker), (ticker, period, ratio), (period, ratio, ticker)))
        return F.element_at(F.array(*by_order), kind % 3 + 1)

    header = line(F.lit("period"), F.lit("Ticker "), F.concat(F.lit("ratio_"), kind.cast("string")))
    cells = line(F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_nationkey").cast("string"))
    rows = t.customer.select(kind.alias("kind"), header.alias("header"), cells.alias("line"))
    tops = rows.select("kind", F.lit(0).alias("_order"), F.col("header").alias("line")).distinct()
    lines = tops.unionByName(rows.select("kind", F.lit(1).alias("_order"), "line"))
    lines = lines.repartition("kind").sortWithinPartitions("kind", "_order").select("kind", "line")
    lines.write.partitionBy("kind").text(place)
    return ratios.ratios_folder(t.spark, place, "quarter", RUN_TS).drop("extracted_at")


@check(
    "load_overview",
    """select c_name as ticker, c_mktsegment as overview, rtrim(rtrim(format('{:.10f}', c_acctbal), '0'), '.') as icb_name1,
              '' as icb_name2, null::varchar as icb_name3 from customer""",
)
def load_overview(t: Tables) -> DataFrame:
    lake_rows = t.customer.select(
        F.col("c_name").alias("symbol"),
        F.concat(F.lit("\xa0"), F.col("c_mktsegment"), F.lit(" ")).alias("company_profile"),
        F.col("c_acctbal"),
        F.lit(" ").alias("b"),
        F.lit(None).cast("string").alias("c"),
        F.col("c_nationkey"),
    ).toDF("symbol", "company_profile", "icb_name", "icb_name", "icb_name", "exchange")
    return company.load_overview(lake_rows, RUN_TS).drop("import_time")


def api_news(t: Tables) -> DataFrame:
    """Conversations as news: the role is the ticker, turns are published on following days."""
    return t.conversations.select(
        F.when(F.col("role") != "system", F.col("conv_id").cast("string")).alias("id"),
        F.when(F.col("turn") == 1, F.format_string(" n%d ", "conv_id")).alias("news_id"),
        F.col("text").alias("news_title"),
        F.col("role").alias("related_ticker"),
        F.date_add(F.lit("2025-12-30").cast("date"), F.col("turn").cast("int")).cast("timestamp_ntz").alias("published_date"),
        F.col("text").alias("news_full_content"),
        F.lit("2025-12-30T01:02:03Z").alias("created_at"),
        F.lit("no date").alias("public_date"),
        (F.col("turn") / 4).cast("string").alias("price_change_pct"),
    )


@check(
    "daily_news_clean",
    """select case when turn = 1 then 'n' || conv_id else conv_id::varchar end as news_id, upper(role) as related_ticker,
              text as news_full_content, timestamp '2025-12-30 01:02:03' as created_at, null::date as public_date,
              turn / 4 as price_change_pct, null::varchar as lang_code, date '2025-12-31' as ds
       from conversations where turn = 1 and (role <> 'system' or text <> '')
       qualify row_number() over (partition by case when role <> 'system' then conv_id::varchar else text end
                                  order by role) = 1""",
)
def daily_news_clean(t: Tables) -> DataFrame:
    clean = news.daily_news(api_news(t), "2025-12-31", RUN_TS)
    return clean.select(
        "news_id",
        "related_ticker",
        "news_full_content",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        "public_date",
        "price_change_pct",
        "lang_code",
        "ds",
    )


@check(
    "news_year",
    """select id, text, role, strftime(published, '%Y-%m-%d %H:%M:%S') as published_date from
       (select *, case when role <> 'system' then conv_id::varchar end as id,
               timestamp '2025-12-30' + to_days(turn::int) as published from conversations)
       where published < timestamp '2026-01-01'
       qualify row_number() over (partition by coalesce(id, text) order by role, text) = 1""",
)
def news_year(t: Tables) -> DataFrame:
    archive = news.news_archive(api_news(t), "2025-01-01", "2025-12-31", ["related_ticker", "news_title"])
    return archive.select("id", F.col("news_title").alias("text"), F.col("related_ticker").alias("role"), "published_date")


@check(
    "news_hash_dedup",
    """select md5(title) as news_id, title, text as short_content, doc_id::varchar as source_link, source as source_name from
       (select doc_id, source, text, split_part(text, chr(10), 1) as title from documents)
       where trim(title) <> '' qualify row_number() over (partition by title order by doc_id) = 1""",
)
def news_hash_dedup(t: Tables) -> DataFrame:
    titled = t.documents.select(
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("doc_id").cast("string").alias("link"),
        "source",
        F.col("doc_id").alias("_order"),
        F.col("text").alias("description"),
        *[F.lit(None).cast("string").alias(c) for c in ("ticker", "image", "date")],
    )
    place = new_folder(t.spark, "news")
    table = news.news_from_csv(titled, RUN_TS)
    news.load_news(table, place, ["_order"])
    news.load_news(table, place, ["_order"])
    return t.spark.read.parquet(place).select("news_id", "title", "short_content", "source_link", "source_name")


@check(
    "news_load_both",
    """with json as (select conv_id::varchar as news_id, role as ticker, text as title, 'FiinGroup' as source_name,
                            make_timestamp((1704067200000 + turn * 1000) * 1000) as public_date, null::varchar as short_content
                     from conversations qualify row_number() over (partition by conv_id order by turn, role, text) = 1),
       csv as (select md5(title) as news_id, null::varchar as ticker, title, source as source_name,
                      timestamp '2024-01-05 10:00:00' as public_date, text as short_content
               from (select doc_id, source, text, split_part(text, chr(10), 1) as title from documents)
               where trim(title) <> '' qualify row_number() over (partition by title order by source, text) = 1)
       select * from json union all select * from csv""",
)
def news_load_both(t: Tables) -> DataFrame:
    root = new_folder(t.spark, "news_both")
    items = t.conversations.select(
        F.col("conv_id").cast("string").alias("news_id"),
        F.col("role").alias("related_ticker"),
        F.col("text").alias("news_title"),
        (F.lit(1704067200000) + F.col("turn") * 1000).alias("public_date"),
    )
    lake.write_json_array(items, f"{root}/json")

    from_json = readers.read_json_array(t.spark, f"{root}/json", NEWS_JSON, {"lang_code": "vi"})
    titled = t.documents.select(
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.lit("2024-01-05 10:00:00").alias("date"),
        "source",
        F.col("text").alias("description"),
        *[F.lit(None).cast("string").alias(c) for c in ("ticker", "link", "image")],
    )
    titled.select(*NEWS_CSV.names).write.option("header", True).option("escape", '"').csv(f"{root}/csv")
    from_csv = readers.read_csv_lake(t.spark, f"{root}/csv", NEWS_CSV, multiline=True)
    news.load_news(news.news_from_json(from_json, RUN_TS), f"{root}/table", ["public_date", "ticker", "title"])
    news.load_news(news.news_from_csv(from_csv, RUN_TS), f"{root}/table", ["source_name", "short_content"])
    return t.spark.read.parquet(f"{root}/table").select(
        "news_id", "ticker", "title", "source_name", F.col("public_date").cast("timestamp_ntz").alias("public_date"), "short_content"
    )


@check(
    "site_articles",
    f"""select url, case when url like 'https://%' then 'secure' else 'plain' end as source,
              '2024-02-01' as target_date, '' as publish_time, '{RUN_TS}' as fetched_at,
              {DECODE_SQL.format("trim(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'))")} as title,
              {DECODE_SQL.format("trim(regexp_extract(html, '<div class=.ad.>(.*?)</div>', 1, 's'))")} as sapo
       from (select url, min(html) as html from pages group by url)""",
)
def site_articles(t: Tables) -> DataFrame:
    return _site_articles(t, "time", "2024-02-01").drop("content")


@check(
    "site_articles_of_day",
    f"""select url, case when url like 'https://%' then 'secure' else 'plain' end as source, '2024-02-25' as target_date,
              '25/02' || trim(regexp_extract(html, '<style>(.*?)</style>', 1, 's')) as publish_time,
              {DECODE_SQL.format("trim(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'))")} as title
       from (select url, min(html) as html from pages group by url) where url like '%1%'""",
)
def site_articles_of_day(t: Tables) -> DataFrame:
    """Pages whose address has a 1 print the day; the others print another."""
    day = F.when(F.col("url").contains("1"), "25/02").otherwise("24/02")
    style = F.trim(F.regexp_extract("html", "(?s)<style>(.*?)</style>", 1))
    marked = t.pages.withColumn("html", F.concat(F.lit("<time>"), day, style, F.lit("</time>"), "html"))
    return _site_articles(t, "time", "2024-02-25", marked).select("url", "source", "target_date", "publish_time", "title")


def _site_articles(t: Tables, time: str, day: str, pages: DataFrame | None = None) -> DataFrame:
    pages = t.pages if pages is None else pages
    entries = t.pages.select(F.col("url").alias("loc"), F.lit("none").alias("published"))
    secure = F.col("loc").startswith("https://")
    # Every entry twice: one article per source and address comes of it.
    entries = entries.unionByName(entries)
    wanted = site_news.candidates({"secure": entries.where(secure), "plain": entries.where(~secure)}, {}, day)
    fields = {"title": "h1", "content": "article", "sapo": ".ad", "publish_time": time}
    return site_news.day_articles(wanted, pages, day, RUN_TS, {"secure": fields, "plain": fields})


INGEST_SQL = f"""
    with daily as ({DAILY_SQL}),
    new as (select ticker, trading_date, close + 1000 as close from daily where trading_date >= date '2024-01-10')
    select * from new union all
    select * from daily where trading_date <= date '2024-01-15'
    and (ticker, trading_date) not in (select (ticker, trading_date) from new)
"""


def price_drops(t: Tables) -> tuple[DataFrame, DataFrame]:
    daily = daily_closes(t).select(
        "ticker",
        "trading_date",
        *[F.lit(None).cast("double").alias(c) for c in ("open", "high", "low")],
        "close",
        F.lit(None).cast("double").alias("volume"),
    )
    late = daily.where("trading_date >= '2024-01-10'").withColumn("close", F.col("close") + 1000)
    return daily.where("trading_date <= '2024-01-15'"), late


def price_load(table: str):
    return upsert_load(table, list(prices.KEY), prices.month_partition())


def with_second_rows(drop: DataFrame) -> DataFrame:
    """Each row followed by one of its key with another close, which does not count."""
    twice = drop.withColumn("_n", F.explode(F.array(F.lit(0), F.lit(1))))
    key = ["ticker", "trading_date"]
    other = twice.withColumn("close", F.when(F.col("_n") == 1, F.lit(-5.0)).otherwise(F.col("close")))
    return other.repartition(3, *key).sortWithinPartitions(*key, "_n").drop("_n")


@check("ingest_log_skip", INGEST_SQL)
def ingest_log_skip(t: Tables) -> DataFrame:
    root = new_folder(t.spark, "ingest")
    early, late = price_drops(t)
    steps = (("2024-01-15", early), ("2024-01-16", None), ("2024-01-30", late))
    for day, drop in steps:
        if drop is not None:
            with_second_rows(drop).write.option("header", True).csv(f"{root}/lake/{day}")
        ingest_files(
            t.spark, f"{root}/lake", f"{root}/log", prices.clean_prices, price_load(f"{root}/table"), RUN_TS,
            files_per_batch=2, check=prices.check_header,
        )
    table = t.spark.read.parquet(f"{root}/table")
    loaded = table.where((F.col("loaded_at") == F.lit(RUN_TS).cast("timestamp")) & F.col("source_file").contains("/lake/"))
    return loaded.select("ticker", "trading_date", "close")


ABSENT_SQL = """with titled as (select lang, doc_id, text, md5(split_part(text, chr(10), 1)) as news_id from documents
                       where trim(split_part(text, chr(10), 1)) <> ''),
       first_load as (select * from titled where lang <> 'en'
                      qualify row_number() over (partition by news_id order by doc_id) = 1),
       second_load as (select * from titled where news_id not in (select news_id from first_load)
                       qualify row_number() over (partition by news_id order by doc_id) = 1)
       select news_id, doc_id::varchar as source_link, text as short_content from first_load
       union all select news_id, doc_id::varchar, text from second_load"""


def titled_documents(t: Tables) -> DataFrame:
    """Documents as news files: the first line is the title."""
    return t.documents.select(
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("lang").alias("ticker"),
        F.col("text").alias("description"),
        F.col("doc_id").cast("string").alias("link"),
        *[F.lit(None).cast("string").alias(c) for c in ("image", "source", "date")],
    )


def shape_news(rows: DataFrame) -> DataFrame:
    return news.news_from_csv(rows.withColumn("_doc", F.col("link").cast("bigint")), RUN_TS)


@check("stream_insert_absent", ABSENT_SQL)
def stream_insert_absent(t: Tables) -> DataFrame:
    root, titled = new_folder(t.spark, "stream_news"), titled_documents(t)
    load = absent_load(f"{root}/table", ["news_id"], ["_doc"])
    for drop in (titled.where("ticker <> 'en'"), titled):
        drop.write.mode("append").option("header", True).option("escape", '"').csv(f"{root}/in")
        ingest_stream(t.spark, f"{root}/in", NEWS_CSV, f"{root}/checkpoint", shape_news, load, multiline=True)
    return t.spark.read.parquet(f"{root}/table").select("news_id", "source_link", "short_content")


@check("stream_dedup_state", ABSENT_SQL)
def stream_dedup_state(t: Tables) -> DataFrame:
    """The same by the stream's own memory; the target is not read."""
    root, titled = new_folder(t.spark, "stream_once"), titled_documents(t)
    for drop in (titled.where("ticker <> 'en'"), titled):
        drop.write.mode("append").option("header", True).option("escape", '"').csv(f"{root}/in")
        ingest_once(t.spark, f"{root}/in", NEWS_CSV, f"{root}/checkpoint", shape_news, f"{root}/table", ["news_id"], ["_doc"], multiline=True)
    return t.spark.read.parquet(f"{root}/table").select("news_id", "source_link", "short_content")


@check("stream_ingest", INGEST_SQL)
def stream_ingest(t: Tables) -> DataFrame:
    root = new_folder(t.spark, "stream")
    early, late = price_drops(t)
    steps = (("2024-01-15", early), ("2024-01-16", None), ("2024-01-30", late))
    for day, drop in steps:
        if drop is not None:
            with_second_rows(drop).write.option("header", True).csv(f"{root}/lake/{day}")
        ingest_stream(
            t.spark, f"{root}/lake", PRICE_RAW, f"{root}/checkpoint", prices.clean_prices, price_load(f"{root}/table"),
            files_per_batch=2, run_ts=RUN_TS,
        )
    table = t.spark.read.parquet(f"{root}/table")
    return table.where(F.col("loaded_at").isNotNull()).select("ticker", "trading_date", "close")


@registry.table_function("checks.big_orders")
def big_orders(spark, sf_dir: str, least: float) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").where(F.col("o_totalprice") >= least)


@check(
    "sql_table_function",
    """select 'big' as kind, o_orderkey, o_totalprice from orders where o_totalprice >= 250000
       union all select 'of ' || c_name, o_orderkey, o_totalprice from customer join orders on c_custkey = o_custkey
       where o_totalprice >= c_acctbal * 30 and c_acctbal > 0""",
)
def sql_table_function(t: Tables) -> DataFrame:
    """Called from SQL with a value, and with each customer's columns in a lateral join."""
    name = f"orders_{uuid.uuid4().hex}"
    t.orders.createOrReplaceTempView(name)
    t.customer.createOrReplaceTempView(f"{name}_customer")
    columns = {"o_orderkey": "bigint", "o_totalprice": "double"}
    large = f"select o_orderkey, o_totalprice from {name} where o_totalprice >= least"
    registry.sql_function(t.spark, f"{name}_big", {"least": "double default 250000"}, columns, large)
    registry.sql_function(t.spark, f"{name}_of", {"buyer": "bigint", "least": "double"}, columns, f"{large} and o_custkey = buyer")
    return t.spark.sql(f"""
        select 'big' as kind, o_orderkey, o_totalprice from {name}_big()
        union all
        select concat('of ', c_name), o_orderkey, o_totalprice
        from {name}_customer, lateral {name}_of(least => c_acctbal * 30, buyer => c_custkey) where c_acctbal > 0""")


@check(
    "table_function",
    "select o_orderkey, o_totalprice, timestamp '2026-01-15 08:00:00' as import_time from orders where o_totalprice >= 250000",
)
def table_function(t: Tables) -> DataFrame:
    found = registry.call(t.spark, "checks.big_orders", sf_dir=t.sf_dir, least=250000.0)
    rows_ = with_audit(found.select("o_orderkey", "o_totalprice"), RUN_TS)
    return rows_.withColumn("import_time", F.col("import_time").cast("timestamp_ntz"))


