"""Macro and commodity series."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import iso_text
from ..operators.columns import conform, normalize_headers, with_tags
from ..operators.filters import in_range
from ..operators.reshape import union_by_name
from ..schemas import struct
from ..vocabulary import MACRO_SERIES, MACRO_START

MACRO = struct("date string, open double, high double, low double, close double, volume double")
TAGS = ("indicator_type", "asset_type")


def macro_window(df: DataFrame, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
    """Rows of the macro job's window: from 2000 on, unless told otherwise."""
    return in_range(df.withColumn("_day", F.to_date("date")), "_day", start, end, default_start=MACRO_START).drop("_day")


def _shaped(df: DataFrame) -> DataFrame:
    """ISO day and the prices as numbers; what is no number is null, as is an absent column."""
    named = normalize_headers(df)
    dated = named.withColumn("date", iso_text(F.col("date").try_cast("timestamp")))
    return conform(dated, MACRO, keep=[c for c in ("_series",) if c in named.columns])


def macro_series(df: DataFrame, series: str) -> DataFrame:
    """One series: ISO day, prices and its tag under the series' own tag column."""
    column, tag = MACRO_SERIES[series]
    return with_tags(_shaped(df), **{column: tag})


def macro_union(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Series from sources of their own in one table; ``indicator_type`` and ``asset_type`` stay apart."""
    return union_by_name(*[macro_series(df, name) for name, df in frames.items()])


def macro_table(df: DataFrame, series: Column) -> DataFrame:
    """Series that share a table, in one scan; ``series`` names each row's, and rows of no known one go."""
    shaped = _shaped(df.withColumn("_series", series).where(F.col("_series").isin(*MACRO_SERIES)))
    tag = lambda column: F.create_map(
        *[F.lit(x) for name, (c, t) in MACRO_SERIES.items() if c == column for x in (name, t)]
    )[F.col("_series")]
    return shaped.withColumns({column: tag(column) for column in TAGS}).drop("_series")
