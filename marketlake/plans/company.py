"""Company overview and people."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import strip_text, with_number_text
from ..operators.columns import (
    conform,
    normalize_headers,
    normalize_symbol,
    rename_positional,
    rename_synonyms,
    require_columns,
    with_audit,
)
from ..operators.dedup import keep_first
from ..operators.joins import enrich, listing_meta
from ..operators.reshape import union_roles
from ..schemas import (
    LISTING_EXCHANGE,
    LISTING_INDUSTRY,
    OVERVIEW_COLUMNS,
    OVERVIEW_TABLE_COLUMNS,
    PEOPLE,
)


# Fixed value: the position stored for a shareholder.
SHAREHOLDER = "Cổ đông"


def listing(industries: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Industry and exchange lists in one row per symbol."""
    return listing_meta(industries, exchanges, LISTING_INDUSTRY, LISTING_EXCHANGE)


def company_overview(overview: DataFrame, listed: DataFrame) -> DataFrame:
    """One row per symbol; blanks of the overview filled from the listing."""
    shaped = conform(normalize_symbol(overview), OVERVIEW_COLUMNS, missing="")
    single = keep_first(shaped, ["symbol"], [c for c in OVERVIEW_COLUMNS if c != "symbol"])
    filled = enrich(single, listed, [c for c in listed.columns if c != "symbol"])
    return conform(filled, OVERVIEW_COLUMNS, missing="")


def load_overview(lake: DataFrame, run_ts: Any) -> DataFrame:
    """Warehouse rows from the first five file columns, bound by position.

    Text is stripped; null stays null. Numbers become text with up to 10 decimals.
    """
    bound = rename_positional(lake, OVERVIEW_TABLE_COLUMNS)
    numbers = {n: F.col(n) for n, kind in bound.dtypes if kind in ("double", "float")}
    stripped = bound.withColumns(
        {n: strip_text(F.col(n).cast("string")) for n in bound.columns if n not in numbers}
    )
    texts = with_number_text(stripped, numbers, digits=10, missing="") if numbers else stripped
    return with_audit(texts.select(*OVERVIEW_TABLE_COLUMNS), run_ts)


def people(shareholders: DataFrame, officers: DataFrame) -> DataFrame:
    """Shareholders and officers in one shape, with their ``type``."""

    def role(df: DataFrame, prefix: str, share: str, position: str | None) -> DataFrame:
        def get(c: str | None, default):
            return F.col(c) if c in df.columns else F.lit(default)

        return df.select(
            "symbol",
            get(prefix, "").alias("name"),
            (F.lit(SHAREHOLDER) if position is None else get(position, "")).alias("position"),
            get(share, 0).cast("string").alias("percent"),
        )

    both = union_roles(
        {
            "shareholder": role(shareholders, "share_holder", "share_own_percent", None),
            "officer": role(officers, "officer_name", "officer_own_percent", "officer_position"),
        },
        "type",
    )
    return conform(both, PEOPLE)


def load_people(lake: DataFrame, run_ts: Any) -> DataFrame:
    """Warehouse rows: texts stripped, percent as text with up to 10 decimals, 0 if unreadable."""
    named = rename_synonyms(normalize_headers(lake), {"symbol": "ticker"})
    require_columns(named, ("ticker", "name", "position", "percent", "type"), "people file")
    cleaned = named.select(
        "ticker",
        strip_text(F.col("name")).alias("name"),
        strip_text(F.col("position")).alias("position"),
        "percent",
        strip_text(F.col("type")).alias("type"),
    )
    texts = with_number_text(cleaned, {"percent": F.col("percent")}, digits=10)
    return with_audit(texts.select("ticker", "name", "position", "percent", "type"), run_ts)
