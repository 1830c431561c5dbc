"""Financial statements: wide file to long lake rows to warehouse rows."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_int, slugify, with_number_text
from ..operators.columns import conform, fill_constant, normalize_headers, with_audit, with_tags
from ..operators.filters import for_year
from ..operators.joins import lookup_with_default
from ..operators.reshape import melt_wide, union_by_name
from ..schemas import INDICATOR_MAPPING, LOADER_MAPPING, STATEMENT, STATEMENT_TABLE
from ..session import fixed_table
from ..vocabulary import LOADER_INDICATORS, STANDARD_INDICATORS, STATEMENTS, rows


def loader_mapping(spark: SparkSession) -> DataFrame:
    """English indicator name to Vietnamese name and code."""
    return fixed_table(spark, rows(LOADER_INDICATORS), LOADER_MAPPING.names)


def standard_mapping(spark: SparkSession) -> DataFrame:
    """Indicator name to standard name."""
    return fixed_table(spark, rows(STANDARD_INDICATORS), INDICATOR_MAPPING.names)


def statement_long(
    wide: DataFrame, kind: str, run_ts: Any, symbol: str | None = None, year: int | str | None = None
) -> DataFrame:
    """One statement melted, tagged and given indicator codes.

    ``symbol`` stands in for absent tickers. The year filter moves below the melt. A code
    depends on the column name only, so it is made once per column and joined on.
    """
    long = for_year(melt_wide(wide), "year", year)
    names = wide.sparkSession.createDataFrame([(c,) for c in wide.columns[3:]], "ind_name string")
    codes = names.withColumn("ind_code", slugify(F.col("ind_name")))
    long = long.join(F.broadcast(codes), "ind_name", "left")
    if symbol is not None:
        long = fill_constant(long, "ticker", symbol)
    tagged = with_tags(long, report_name=kind, report_code=STATEMENTS[kind])
    return conform(with_audit(tagged, run_ts), STATEMENT)


def statements_long(
    wide: Mapping[str, DataFrame], run_ts: Any, symbol: str | None = None, year: int | str | None = None
) -> DataFrame:
    """All statement kinds in one long table."""
    return union_by_name(*[statement_long(df, k, run_ts, symbol, year) for k, df in wide.items()])


def load_statements(lake: DataFrame, mapping: DataFrame, run_ts: Any) -> DataFrame:
    """Warehouse rows: mapped names and codes, values as 4-decimal text.

    Takes the headers of the lake files and the older ones (``report_quarter``,
    ``report_year``, ``statement_type``, ``report name``); a file may carry either.
    """
    named = normalize_headers(lake).drop("company")

    def either(*names: str):
        present = [F.col(f"`{n}`") for n in names if n in named.columns]
        return F.coalesce(*present) if present else F.lit(None).cast("string")

    prepared = named.withColumns(
        {
            "_quarter": as_int(named, either("report_quarter", "quarter")),
            "_year": as_int(named, either("report_year", "year")),
            "_report_name": either("report_name", "report name"),
            "_report_code": either("statement_type", "report_code"),
            "_raw_name": either("ind_name"),
        }
    )
    valued = with_number_text(prepared, {"_value": either("value")}, digits=4)
    mapped = lookup_with_default(valued, mapping, "_raw_name", "_mapped_name", "_mapped_code")
    shaped = mapped.select(
        either("ticker").alias("ticker"),
        F.col("_quarter").alias("quarter"),
        F.col("_year").alias("year"),
        F.col("_report_name").alias("report_name"),
        F.col("_report_code").alias("report_code"),
        F.col("_mapped_name").alias("ind_name"),
        F.col("_mapped_code").alias("ind_code"),
        F.col("_value").alias("value"),
    )
    return conform(with_audit(shaped, run_ts), STATEMENT_TABLE)
