"""Column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake import functions as fn
from marketlake.plans.company import load_people, people

from .base import RUN_TS, Tables, check

STRIP_SQL = (
    "trim({}, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30)"
    " || chr(31) || ' ' || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194)"
    " || chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201)"
    " || chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288))"
)


@check(
    "clean_symbol",
    "select c_custkey, upper(c_name) as symbol from customer",
)
def clean_symbol(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("\xa0\t"), F.lower("c_name"), F.lit(" 　"))
    return t.customer.select("c_custkey", fn.clean_symbol(padded).alias("symbol"))


@check(
    "strip_text",
    f"select doc_id, {STRIP_SQL.format('text')} as stripped from documents",
)
def strip_text(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("  \xa0"), F.col("text"), F.lit("\n　 "))
    return t.documents.select("doc_id", fn.strip_text(padded).alias("stripped"))


@check(
    "lenient_number",
    """select doc_id, count(*) as words, count(n) as numbers, max(n) as largest
       from (select doc_id, try_cast(w as double) as n
             from (select doc_id, unnest(string_split(text, ' ')) as w from documents))
       group by doc_id""",
)
def lenient_number(t: Tables) -> DataFrame:
    words = t.documents.select("doc_id", F.explode(F.split("text", " ")).alias("w"))
    numbers = words.select("doc_id", fn.lenient_number(F.col("w")).alias("n"))
    return numbers.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("words"), F.count("n").alias("numbers"), F.max("n").alias("largest")
    )


@check(
    "lenient_int",
    """select l_orderkey, l_linenumber, l_partkey, l_extendedprice,
              trunc(l_extendedprice)::int as from_text, null::int as from_flag,
              trunc(-10 * l_discount)::int as negative
       from lineitem""",
)
def lenient_int(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        fn.lenient_int(F.concat(F.lit(" "), F.col("l_extendedprice").cast("string"))).alias("from_text"),
        fn.lenient_int(F.col("l_returnflag")).alias("from_flag"),
        fn.lenient_int((F.col("l_discount") * -10).cast("string")).alias("negative"),
    )


@check(
    "slugify",
    """select doc_id, coalesce(nullif(upper(trim(regexp_replace(text, '[^A-Za-z0-9]+', '_', 'g'), '_')),
              ''), 'UNKNOWN') as slug from documents""",
)
def slugify(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", fn.slugify(F.col("text")).alias("slug"))


@check(
    "fallback_code",
    "select doc_id, replace(upper(replace(text, 'ß', 'SS')), ' ', '_')[1:50] as code from documents",
)
def fallback_code(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", fn.fallback_code(F.col("text")).alias("code"))


@check(
    "lenient_date",
    """select o_orderkey, case when o_orderpriority <> '1-URGENT' then o_orderdate::date end as day
       from orders""",
)
def lenient_date(t: Tables) -> DataFrame:
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("on "), iso))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(iso, F.lit(" 10:11:12")))
        .otherwise(iso)
    )
    return t.orders.select("o_orderkey", fn.lenient_date(text).alias("day"))


@check(
    "lenient_ts",
    """select event_id, case when event_type <> 'error' then date_trunc('second', ts) end as at
       from events""",
)
def lenient_ts(t: Tables) -> DataFrame:
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    return t.events.select("event_id", fn.lenient_timestamp(text).cast("timestamp_ntz").alias("at"))


@check(
    "number_text_4",
    """select l_orderkey, l_linenumber, l_partkey, l_extendedprice,
              rtrim(rtrim(format('{:.4f}', l_extendedprice * l_discount), '0'), '.') as discount_text,
              rtrim(rtrim(format('{:.4f}', -l_tax / 7), '0'), '.') as tax_text
       from lineitem""",
)
def number_text_4(t: Tables) -> DataFrame:
    amounts = {
        "discount_text": F.col("l_extendedprice") * F.col("l_discount"),
        "tax_text": -F.col("l_tax") / 7,
    }
    return fn.with_number_text(t.lineitem, amounts).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", *amounts
    )


@check(
    "people_percent_text",
    """select c_name as ticker, 'holder ' || c_custkey as name, 'Cổ đông' as "position",
              rtrim(rtrim(format('{:.10f}', c_acctbal / 7000), '0'), '.') as percent,
              'shareholder' as type, timestamp '2026-01-15 08:00:00' as import_time from customer
       union all
       select s_name, 'officer ' || s_suppkey, 'nation ' || s_nationkey, '0', 'officer',
              timestamp '2026-01-15 08:00:00' from supplier""",
)
def people_percent_text(t: Tables) -> DataFrame:
    holders = t.customer.select(
        F.col("c_name").alias("symbol"),
        F.concat(F.lit("\xa0holder "), F.col("c_custkey").cast("string")).alias("share_holder"),
        (F.col("c_acctbal") / 7000).alias("share_own_percent"),
    )
    officers = t.supplier.select(
        F.col("s_name").alias("symbol"),
        F.concat(F.lit("officer "), F.col("s_suppkey").cast("string"), F.lit(" ")).alias("officer_name"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("officer_position"),
        F.lit("n/a").alias("officer_own_percent"),
    )
    rows = load_people(people(holders, officers), RUN_TS)
    return rows.withColumn("import_time", F.col("import_time").cast("timestamp_ntz"))


@check(
    "iso_date",
    "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders",
)
def iso_date(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", fn.iso_text(F.col("o_orderdate")).alias("day"))


@check(
    "stringify_timestamps",
    """select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, user_id, event_type, value, props
       from events""",
)
def stringify_timestamps(t: Tables) -> DataFrame:
    return fn.stringify_timestamps(t.events)


@check(
    "epoch_ms",
    """select event_id, case when event_type <> 'signup' then
              make_timestamp((1704067200000 + event_id * 250123) * 1000) end as at from events""",
)
def epoch_ms(t: Tables) -> DataFrame:
    millis = F.when(F.col("event_type") == "signup", F.lit(0)).otherwise(
        F.lit(1704067200000) + F.col("event_id") * 250123
    )
    return t.events.select("event_id", fn.epoch_millis(millis).cast("timestamp_ntz").alias("at"))


@check(
    "path_date",
    """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as ds, 'usd_vnd' as series,
              null::varchar as beyond from orders""",
)
def path_date(t: Tables) -> DataFrame:
    key = F.concat(
        F.lit("global_index/usd_vnd/date="), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/data.csv")
    )
    return t.orders.select(
        "o_orderkey",
        fn.path_date(key).alias("ds"),
        fn.path_segment(key, 1).alias("series"),
        fn.path_segment(key, 9).alias("beyond"),
    )


@check(
    "regex_capture",
    """select o_orderkey, case when o_orderstatus = 'F' then o_custkey::double end as seconds from orders""",
)
def regex_capture(t: Tables) -> DataFrame:
    message = F.when(
        F.col("o_orderstatus") == "F",
        F.concat(F.lit("Lỗi 429: THỬ LẠI SAU  "), F.col("o_custkey").cast("string"), F.lit(" giây")),
    ).otherwise("timeout sau 30 giây")
    return t.orders.select("o_orderkey", fn.retry_after_seconds(message).alias("seconds"))


@check(
    "date_tokens",
    """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || '|' || strftime(o_orderdate, '%d/%m') || '|' ||
              strftime(o_orderdate, '%d-%m') || '|' || day(o_orderdate) || '/' || month(o_orderdate) || '|' ||
              day(o_orderdate) || '-' || month(o_orderdate) as tokens from orders""",
)
def date_tokens(t: Tables) -> DataFrame:
    tokens = F.array_join(fn.date_tokens(F.col("o_orderdate")), "|")
    return t.orders.select("o_orderkey", tokens.alias("tokens"))


# A title may be cut off inside a reference, which then lacks its semicolon.
DECODE_SQL = (
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '&quot;?', '\"', 'g'),"
    " '&copy;?', chr(169), 'g'), '&middot;?', chr(183), 'g'), '&amp;?', '&', 'g')"
)
PAGE_RULES = {"page": {"title": "h1", "content": "article", "sapo": "div.ad", "publish_time": "time"}}


def page_fields(t: Tables) -> DataFrame:
    return fn.parse_articles(
        t.pages.select("page_id", "html", F.lit("page").alias("source")), rules=PAGE_RULES
    )


@check(
    "html_title",
    f"""select page_id, {DECODE_SQL.format("trim(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'))")} as title,
               {DECODE_SQL.format("trim(regexp_extract(html, '<div class=\"ad\">(.*?)</div>', 1, 's'))")} as sapo,
               '' as publish_time
        from pages""",
)
def html_title(t: Tables) -> DataFrame:
    return page_fields(t).select("page_id", "title", "sapo", "publish_time")


@check(
    "html_article",
    f"""select page_id, coalesce(string_agg({DECODE_SQL.format('trim(run)')}, '' order by i), '') as content
        from (select page_id, unnest(runs) as run, generate_subscripts(runs, 1) as i
              from (select page_id, regexp_split_to_array(
                        regexp_extract(html, '<article>(.*)</article>', 1, 's'), '<[^>]*>') as runs
                    from pages))
        group by page_id""",
)
def html_article(t: Tables) -> DataFrame:
    return page_fields(t).select("page_id", "content")
