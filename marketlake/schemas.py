"""Schemas of the lake files and warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def struct(columns: str) -> T.StructType:
    """Schema of ``name type, name type``. Needs no running session, unlike DDL."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# Names and order of the columns of lake files and warehouse tables.
PRICE_COLUMNS = ("ticker", "trading_date", "open", "high", "low", "close", "volume")

# Lake files are read as text and typed afterwards, so that one bad cell does not
# lose its row.
PRICE_RAW = struct(
    "ticker string, trading_date string, open string, high string, low string, "
    "close string, volume string"
)
PRICE = struct(
    "ticker string, trading_date date, open double, high double, low double, "
    "close double, volume double"
)
PRICE_TABLE = struct(
    "ticker string, trading_date date, open double, high double, low double, "
    "close double, volume double, source_file string, loaded_at timestamp"
)
INGEST_LOG = struct("object_key string, processed_at timestamp")

STATEMENT = struct(
    "ticker string, quarter int, year int, ind_name string, ind_code string, value double, "
    "import_time timestamp, report_name string, report_code string"
)
STATEMENT_TABLE = struct(
    "ticker string, quarter int, year int, report_name string, report_code string, "
    "ind_name string, ind_code string, value string, import_time timestamp"
)
INDICATOR_MAPPING = struct("raw_ind_name string, std_ind_name string")
LOADER_MAPPING = struct("en_name string, vi_name string, code string")

LISTING_INDUSTRY = ("symbol", "icb_name2", "icb_name3", "icb_name4")
LISTING_EXCHANGE = ("symbol", "exchange", "type_info", "organ_short_name", "organ_name")
OVERVIEW_COLUMNS = (
    "symbol",
    "company_profile",
    "icb_name2",
    "icb_name3",
    "icb_name4",
    "exchange",
    "type_info",
    "organ_short_name",
    "organ_name",
)
OVERVIEW_TABLE_COLUMNS = ("ticker", "overview", "icb_name1", "icb_name2", "icb_name3")
PEOPLE = struct("symbol string, name string, position string, percent string, type string")

NEWS_API = struct(
    "id string, news_id string, news_title string, author string, friendly_sub_title string, "
    "news_source_link string, created_at string, public_date string, updated_at string, "
    "published_date string, lang_code string, news_short_content string, "
    "news_full_content string, price_change_pct string, related_ticker string"
)
NEWS_DAILY = struct(
    "news_id string, related_ticker string, author string, friendly_sub_title string, "
    "news_source_link string, created_at timestamp, public_date date, updated_at timestamp, "
    "lang_code string, news_short_content string, news_full_content string, "
    "price_change_pct double, fetched_at timestamp, ds date"
)
NEWS_JSON = struct(
    "news_id string, related_ticker string, news_title string, news_sub_title string, "
    "news_short_content string, news_full_content string, news_image_url string, "
    "news_source_link string, lang_code string, public_date bigint, close_price double, "
    "ref_price double, floor double, ceiling double, price_change_pct double"
)
NEWS_CSV = struct(
    "title string, ticker string, description string, link string, image string, "
    "source string, date string"
)
NEWS_TABLE = struct(
    "news_id string, ticker string, title string, sub_title string, short_content string, "
    "full_content string, image_url string, source_link string, source_name string, "
    "lang_code string, public_date timestamp, close_price double, ref_price double, "
    "floor_price double, ceiling_price double, price_change_pct double, import_time timestamp"
)
SITEMAP = T.StructType(
    [
        T.StructField("loc", T.StringType()),
        T.StructField("news:news", struct("news:publication_date string")),
    ]
)
RSS = struct("link string")
