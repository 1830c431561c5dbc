"""News: daily and yearly collections, and the load of all shapes into one table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    clean_symbol,
    epoch_millis,
    lenient_date,
    lenient_number,
    lenient_timestamp,
    md5_id,
    non_blank,
    stringify_timestamps,
    strip_text,
)
from ..operators.columns import (
    conform,
    drop_null,
    fill_from,
    order_columns,
    with_audit,
    with_tags,
)
from ..operators.dedup import dedup_news, keep_last
from ..operators.filters import in_range, on_day
from ..operators.tables import insert_if_absent
from ..schemas import NEWS_API, NEWS_DAILY, NEWS_TABLE

# Fixed value: the provider of the JSON files, as stored in the table.
SOURCE_NAME = "FiinGroup"


def daily_news(
    raw: DataFrame, day: date | str, run_ts: Any, order_by: Sequence[str] = ("related_ticker",)
) -> DataFrame:
    """News published on ``day``, typed; one row per item, then per item and ticker.

    Of an item reported for several tickers the lowest in ``order_by`` is kept; give a
    total order if an item may come twice for one ticker.
    """
    of_day = on_day(raw, "published_date", day) if "published_date" in raw.columns else raw
    texts = conform(stringify_timestamps(of_day), [f.name for f in NEWS_API.fields] + [
        c for c in order_by if c not in NEWS_API.names
    ])
    unique = dedup_news(texts, "id", "news_title", order_by)
    named = fill_from(unique, "news_id", "id")
    keyed = drop_null(named, ("news_id", "related_ticker")).withColumns(
        {
            "news_id": strip_text(F.col("news_id")),
            "related_ticker": clean_symbol(F.col("related_ticker")),
        }
    ).where(non_blank(F.col("related_ticker")))
    typed = keyed.withColumns(
        {
            "created_at": lenient_timestamp(F.col("created_at")),
            "updated_at": lenient_timestamp(F.col("updated_at")),
            "public_date": lenient_date(F.col("public_date")),
            "price_change_pct": lenient_number(F.col("price_change_pct")),
        }
    )
    single = keep_last(typed, ["news_id", "related_ticker"], order_by)
    return conform(with_audit(single, run_ts, "fetched_at", ds=day), NEWS_DAILY)


def news_archive(
    raw: DataFrame,
    start: date | str,
    end: date | str,
    order_by: Sequence[str] = ("related_ticker",),
    whole_end_day: bool = True,
    run_ts: Any = None,
) -> DataFrame:
    """News of a period, one row per item, timestamps as text; all loader fields are kept.

    ``run_ts`` adds the time of the run as ``fetched_at``.
    """
    dated = raw.withColumn("published_date", F.col("published_date").try_cast("timestamp"))
    of_period = in_range(dated, "published_date", start, end, whole_end_day=whole_end_day)
    unique = dedup_news(of_period, "id", "news_title", order_by)
    if run_ts is not None:
        unique = with_audit(unique, run_ts, "fetched_at")
    return stringify_timestamps(unique)


def news_from_csv(df: DataFrame, run_ts: Any) -> DataFrame:
    """Table rows of title-keyed files: the id is the title's md5; blank titles are dropped."""
    titled = df.where(non_blank(F.col("title")))
    shaped = titled.select(
        *order_columns(titled),
        md5_id(F.col("title")).alias("news_id"),
        "ticker",
        "title",
        F.col("description").alias("short_content"),
        F.col("link").alias("source_link"),
        F.col("image").alias("image_url"),
        F.col("source").alias("source_name"),
        lenient_timestamp(F.col("date")).alias("public_date"),
    )
    return _table_rows(with_audit(shaped, run_ts))


def news_from_json(df: DataFrame, run_ts: Any) -> DataFrame:
    """Table rows of id-keyed files with times in milliseconds."""
    shaped = df.select(
        *order_columns(df),
        "news_id",
        F.col("related_ticker").alias("ticker"),
        F.col("news_title").alias("title"),
        F.col("news_sub_title").alias("sub_title"),
        F.col("news_short_content").alias("short_content"),
        F.col("news_full_content").alias("full_content"),
        F.col("news_image_url").alias("image_url"),
        F.col("news_source_link").alias("source_link"),
        "lang_code",
        epoch_millis(F.col("public_date")).alias("public_date"),
        "close_price",
        "ref_price",
        F.col("floor").alias("floor_price"),
        F.col("ceiling").alias("ceiling_price"),
        "price_change_pct",
    )
    keyed = shaped.where(F.col("news_id").isNotNull())
    return _table_rows(with_audit(with_tags(keyed, source_name=SOURCE_NAME), run_ts))


def _table_rows(df: DataFrame) -> DataFrame:
    return conform(df, NEWS_TABLE, keep=order_columns(df))


def load_news(rows: DataFrame, target: str, order_by: Sequence[str]) -> int:
    """Add the items the table lacks; of several with one id the first in ``order_by``."""
    return insert_if_absent(rows, target, ["news_id"], order_by)
