"""Price bars and market indices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_symbol, half_open_day, lenient_date
from ..operators.columns import (
    PRICE_SYNONYMS,
    conform,
    drop_null,
    normalize_headers,
    order_columns,
    rename_synonyms,
    require_columns,
)
from ..operators.dedup import keep_first, keep_last
from ..operators.filters import in_range
from ..operators.quality import QualityError, on_empty
from ..schemas import PRICE, PRICE_COLUMNS
from ..vocabulary import INDEX_START, INDEX_SYMBOLS, PRICE_START

KEY = ("ticker", "trading_date")


def check_header(names: Sequence[str], example: str) -> None:
    """Refuse a price file that lacks a column, for ``read_csv_by_name``.

    Else its rows would replace good prices by nulls.
    """
    known = {PRICE_SYNONYMS.get(n, n) for n in names}
    missing = [c for c in PRICE_COLUMNS if c not in known]
    if missing:
        raise QualityError(f"{example}: columns {missing} are missing")


def price_history(table: DataFrame, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
    """Bars of the price job's window: from 2008 on, unless told otherwise."""
    return in_range(table, "trading_date", start, end, default_start=PRICE_START)


def month_partition() -> dict[str, Column]:
    """Partition of the price tables: a function of the key, so an update stays in place."""
    return {"trading_month": F.date_format("trading_date", "yyyy-MM")}


def bars_between(table: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Bars of a price table from ``start`` to ``end``; other months are not read."""
    months = F.col("trading_month").between(str(start)[:7], str(end)[:7])
    return in_range(table.where(months), "trading_date", start, end)


def clean_prices(
    df: DataFrame, synonyms: Mapping[str, str] = PRICE_SYNONYMS, require: bool = False
) -> DataFrame:
    """Typed bars under the standard headers; rows without ticker or readable date go.

    ``require`` demands all price columns; else absent ones are null. Columns that start
    with ``_`` and ``source_file`` pass through for ordering and lineage.
    """
    named = rename_synonyms(normalize_headers(df), synonyms)
    require_columns(named, PRICE_COLUMNS if require else KEY, "price file")
    keyed = drop_null(named, KEY)
    typed = keyed.withColumns(
        {
            "ticker": clean_symbol(F.col("ticker")),
            "trading_date": lenient_date(F.col("trading_date")),
        }
    ).where(F.col("trading_date").isNotNull())
    lineage = [c for c in ("source_file",) if c in typed.columns]
    return conform(typed, PRICE, keep=lineage + order_columns(typed))


def normalize_prices(
    df: DataFrame,
    order_by: Sequence[str],
    synonyms: Mapping[str, str] = PRICE_SYNONYMS,
    require: bool = False,
) -> DataFrame:
    """Clean bars, one per ticker and day: the first in ``order_by``."""
    return keep_first(clean_prices(df, synonyms, require), list(KEY), order_by)


def daily_prices(clean: DataFrame, ds: date | str, order_by: Sequence[str]) -> DataFrame:
    """Bars of one day, one per ticker; a day without any is an error."""
    day = clean.where(half_open_day(F.col("trading_date"), ds))
    return keep_first(on_empty(day, "error", f"prices of {ds}"), list(KEY), order_by)


def index_series(
    clean: DataFrame,
    order_by: Sequence[str],
    end: date | str,
    start: date | str = INDEX_START,
    symbols: Sequence[str] = INDEX_SYMBOLS,
) -> DataFrame:
    """Bars of the followed indices within the window, the last per index and day.

    A window without any is an error.
    """
    wanted = in_range(clean.where(F.col("ticker").isin(*symbols)), "trading_date", start, end)
    return keep_last(on_empty(wanted, "error", "index prices"), list(KEY), order_by)
