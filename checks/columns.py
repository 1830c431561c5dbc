"""Projection, filters, unions and the melt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import half_open_day, iso_text
from marketlake.operators import columns, filters
from marketlake.operators.reshape import melt_wide, union_by_name, union_roles
from marketlake.plans.site_news import sitemap_candidates
from marketlake.schemas import struct

from .base import LONG_SQL, RUN_TS, Tables, check, wide_statement


@check("normalize_headers", "select * from orders")
def normalize_headers(t: Tables) -> DataFrame:
    return columns.normalize_headers(t.orders.toDF(*[f" {c.upper()} " for c in t.orders.columns]))


@check(
    "rename_synonyms",
    """select o_orderdate as trading_date, 'C' || o_custkey as ticker, o_totalprice as close,
              o_orderkey from orders""",
)
def rename_synonyms(t: Tables) -> DataFrame:
    raw = t.orders.select(
        F.col("o_orderdate").alias("TradingDate "),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("index_code"),
        F.col("o_totalprice").alias("close"),
        "o_orderkey",
    )
    return columns.rename_synonyms(columns.normalize_headers(raw), columns.PRICE_SYNONYMS)


@check(
    "normalize_symbol",
    "select upper(c_name) as symbol, lower(c_name) as ticker, c_custkey as code from customer",
)
def normalize_symbol(t: Tables) -> DataFrame:
    raw = t.customer.select(F.lower("c_name").alias("ticker"), F.col("c_custkey").alias("code"))
    return columns.normalize_symbol(raw)


@check(
    "rename_positional",
    """select o_orderkey as ticker, o_orderstatus as overview, o_orderpriority as icb_name1,
              o_custkey as icb_name2 from orders""",
)
def rename_positional(t: Tables) -> DataFrame:
    raw = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey", "o_totalprice")
    same_names = raw.toDF("symbol", "company_", "icb_name", "icb_name", "icb_name")
    return columns.rename_positional(same_names, ["ticker", "overview", "icb_name1", "icb_name2"])


@check(
    "conform_schema",
    """select c_custkey::varchar as symbol, null::double as percent, c_acctbal as balance,
              try_cast(c_mktsegment as int) as bad from customer""",
)
def conform_schema(t: Tables) -> DataFrame:
    raw = t.customer.select(
        F.col("c_mktsegment").alias("bad"),
        F.col("c_acctbal").cast("string").alias("balance"),
        F.col("c_custkey").alias("symbol"),
        "c_name",
    )
    return columns.conform(raw, struct("symbol string, percent double, balance double, bad int"))


@check(
    "conform_blank",
    "select s_name as symbol, '' as exchange, s_nationkey as type_info from supplier",
)
def conform_blank(t: Tables) -> DataFrame:
    raw = t.supplier.select("s_acctbal", F.col("s_nationkey").alias("type_info"), F.col("s_name").alias("symbol"))
    return columns.conform(raw, ["symbol", "exchange", "type_info"], missing="")


@check(
    "with_audit",
    """select c_custkey, 'VN' as source_name, timestamp '2026-01-15 08:00:00' as extracted_at,
              date '2026-01-14' as ds from customer""",
)
def with_audit(t: Tables) -> DataFrame:
    tagged = columns.with_tags(t.customer.select("c_custkey"), source_name="VN")
    audited = columns.with_audit(tagged, RUN_TS, "extracted_at", ds="2026-01-14")
    return audited.withColumn("extracted_at", F.col("extracted_at").cast("timestamp_ntz"))


@check(
    "fill_constant",
    """select event_id, coalesce(nullif(event_type, 'error'), 'UNKNOWN') as ticker, 'quarter' as period
       from events""",
)
def fill_constant(t: Tables) -> DataFrame:
    raw = t.events.select("event_id", F.nullif("event_type", F.lit("error")).alias("ticker"))
    return columns.fill_constant(columns.fill_constant(raw, "ticker", "UNKNOWN"), "period", "quarter")


@check(
    "coalesce_id",
    """select d.doc_id, coalesce('label ' || l.quality, d.source) as news_id
       from documents d left join labels l on d.doc_id = l.doc_id""",
)
def coalesce_id(t: Tables) -> DataFrame:
    labels = t.labels.select("doc_id", F.concat(F.lit("label "), F.col("quality").cast("string")).alias("news_id"))
    joined = t.documents.select("doc_id", "source").join(labels, "doc_id", "left")
    return columns.fill_from(joined, "news_id", "source").select("doc_id", "news_id")


@check(
    "number_or_zero",
    """select o_orderkey, case when o_orderstatus = 'F' then o_totalprice else 0 end as amount from orders""",
)
def number_or_zero(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("string")).otherwise(
        F.when(F.col("o_orderstatus") == "O", "NaN").otherwise("none")
    )
    return columns.number_or_zero(t.orders.select("o_orderkey", text.alias("amount")), "amount")


@check(
    "drop_columns",
    "select c_custkey, c_name from customer",
)
def drop_columns(t: Tables) -> DataFrame:
    wide = t.customer.select("c_custkey", "c_name", F.col("c_acctbal").alias("bal_listing"), F.lit("x").alias("seg_listing"))
    return columns.drop_suffix(wide, "_listing")


@check(
    "drop_null_keys",
    """select event_id, event_type, user_id from events where event_type <> 'error' and user_id <> 8""",
)
def drop_null_keys(t: Tables) -> DataFrame:
    raw = t.events.select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.nullif("user_id", F.lit(8).cast("bigint")).alias("user_id"),
    )
    return columns.drop_null(raw, ["event_type", "user_id"])


@check("filter_day", "select event_id, value from events where ts::date = date '2024-01-12'")
def filter_day(t: Tables) -> DataFrame:
    return filters.on_day(t.events, "ts", "2024-01-12").select("event_id", "value")


@check(
    "filter_half_open_day",
    "select event_id, value from events where ts >= date '2024-01-12' and ts < date '2024-01-13'",
)
def filter_half_open(t: Tables) -> DataFrame:
    return t.events.where(half_open_day(F.col("ts"), "2024-01-12")).select("event_id", "value")


@check("filter_range_open", "select o_orderkey, o_orderdate from orders where o_orderdate <= date '1998-06-30'")
def filter_range_open(t: Tables) -> DataFrame:
    """A bound that nobody gives filters nothing."""
    return filters.in_range(t.orders, "o_orderdate", None, "1998-06-30").select("o_orderkey", "o_orderdate")


@check(
    "filter_range",
    """select event_id, 'whole day' as bound from events
       where ts >= date '2008-01-01' and ts < date '2024-01-21'
       union all
       select event_id, 'midnight' from events where ts between date '2024-01-05' and date '2024-01-20'""",
)
def filter_range(t: Tables) -> DataFrame:
    whole = filters.in_range(t.events, "ts", None, "2024-01-20")
    midnight = filters.in_range(t.events, "ts", "2024-01-05", "2024-01-20", whole_end_day=False)
    return union_by_name(
        whole.select("event_id", F.lit("whole day").alias("bound")),
        midnight.select("event_id", F.lit("midnight").alias("bound")),
    )


@check(
    "date_token_match",
    """select o_orderkey, text like '%1997-02-01%' or text like '%01/02%' or text like '%01-02%'
                          or text like '%1/2%' or text like '%1-2%' as contains,
              regexp_matches(' ' || text || ' ',
                  '[^0-9](1997-02-01|01/02|01-02|1/2|1-2)[^0-9]') as exact
       from (select o_orderkey, 'ngày ' || day(o_orderdate) || '/' || month(o_orderdate) || ' lúc 10:00' as text
             from orders)""",
)
def date_token_match(t: Tables) -> DataFrame:
    text = F.format_string("ngày %d/%d lúc 10:00", F.dayofmonth("o_orderdate"), F.month("o_orderdate"))
    return t.orders.select(
        "o_orderkey",
        filters.matches_day(text, "1997-02-01").alias("contains"),
        filters.matches_day(text, "1997-02-01", "exact_date").alias("exact"),
    )


@check(
    "sitemap_candidates",
    """with entries as (
           select o_orderkey as loc, o_orderpriority as source,
                  case when o_orderstatus <> 'P' then strftime(o_orderdate, '%Y-%m-%d') end as published
           from orders),
       marked as (select *, published is null or (source <> '5-LOW' and
                         (published like '%1997-02-01%' or published like '%01-02%' or published like '%1-2%'))
                         as hit
                  from (select loc, source, case when source = '5-LOW' then 'none' else published end as published
                        from entries)),
       sites as (select source, bool_or(hit) as found from marked group by source)
       select loc, source, published from marked join sites using (source) where hit or not found""",
)
def site_candidates(t: Tables) -> DataFrame:
    published = F.when(F.col("o_orderpriority") == "5-LOW", "none").when(
        F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    entries = t.orders.select(
        F.col("o_orderkey").alias("loc"),
        F.col("o_orderpriority").alias("source"),
        published.alias("published"),
    )
    return sitemap_candidates(entries, "1997-02-01")


@check(
    "filter_with_fallback",
    """with marked as (select event_id, event_type, value > 50 and event_type in ('click', 'view') as hit
                       from events),
       groups as (select event_type, bool_or(hit) as found from marked group by event_type)
       select event_id, event_type from marked join groups using (event_type) where hit or not found""",
)
def filter_with_fallback(t: Tables) -> DataFrame:
    keep = (F.col("value") > 50) & F.col("event_type").isin("click", "view")
    return filters.keep_matches_or_all(t.events.select("event_id", "event_type", "value"), "event_type", keep).drop("value")


@check("melt_statement", LONG_SQL)
def melt_statement(t: Tables) -> DataFrame:
    return melt_wide(wide_statement(t))


@check("melt_statement_year", f"select * from ({LONG_SQL}) where year = 1997")
def melt_statement_year(t: Tables) -> DataFrame:
    return filters.for_year(melt_wide(wide_statement(t)), "year", "1997")


@check(
    "melt_mixed_types",
    """select c_custkey::varchar as ticker, 2024 as year, c_nationkey as quarter, ind_name,
              case ind_name when 'balance' then c_acctbal when 'segment' then null else 7 end as value
       from customer, (values ('balance'), ('segment'), ('fixed')) as n(ind_name)""",
)
def melt_mixed_types(t: Tables) -> DataFrame:
    wide = t.customer.select(
        F.col("c_custkey").cast("string"),
        F.lit("2024.0").alias("y"),
        F.col("c_nationkey").cast("string").alias("q"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
        F.lit(" 7 ").alias("fixed"),
    )
    return melt_wide(wide)


@check(
    "union_by_name",
    """select c_name as name, c_acctbal as balance, c_mktsegment as segment, null::varchar as nation from customer
       union all select s_name, s_acctbal, null, 'n' || s_nationkey from supplier""",
)
def union_frames(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(
        F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("nation"),
        F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("name"),
    )
    return union_by_name(customers, suppliers)


@check(
    "people_union",
    """select c_name as name, c_acctbal as share, 'shareholder' as type from customer
       union all select s_name, s_acctbal, 'officer' from supplier""",
)
def people_union(t: Tables) -> DataFrame:
    return union_roles(
        {
            "shareholder": t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("share")),
            "officer": t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("share")),
        },
        "type",
    )


@check(
    "orders_per_day",
    "select strftime(o_orderdate, '%Y-%m-%d') as day, count(*) as row_count from orders group by 1",
)
def orders_per_day(t: Tables) -> DataFrame:
    return t.orders.groupBy(iso_text(F.col("o_orderdate")).alias("day")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
