"""Financial ratios, whose columns differ between companies."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import coalesce_blank
from ..operators.columns import fill_constant, with_audit, with_tags
from ..operators.reshape import union_by_name
from ..sources.readers import read_csv_by_name


def normalize_ratios(df: DataFrame, symbol: str, period: str, run_ts: Any) -> DataFrame:
    """Ratios of one company, tagged; ``symbol`` stands in for an absent ticker."""
    tagged = with_tags(fill_constant(df, "ticker", symbol), period_type=period)
    return with_audit(tagged, run_ts, "extracted_at")


def ratios_folder(spark: SparkSession, folder: str, period: str, run_ts: Any) -> DataFrame:
    """Ratios of all companies from CSV files below ``folder``, whatever columns they have.

    One scan, however many different headers there are. The symbol is that of the row, or else the
    file's name.
    """
    rows = read_csv_by_name(spark, folder, file_columns=True)
    name = F.regexp_extract("source_file", r"([^/]*?)(?:\.[^/.]*)?$", 1)
    tagged = with_tags(rows.withColumn("ticker", coalesce_blank(F.col("ticker"), name) if "ticker" in rows.columns else name), period_type=period)
    return with_audit(tagged.drop("_file", "_block", "_row", "source_file"), run_ts, "extracted_at")


def ratios_union(frames: Mapping[str, DataFrame], period: str, run_ts: Any) -> DataFrame:
    """All companies in one table; a column one of them lacks is null there."""
    return union_by_name(*[normalize_ratios(df, s, period, run_ts) for s, df in frames.items()])
