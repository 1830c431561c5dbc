"""Projection, renaming and column defaults. Plan-time only: none of these runs a job."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean_symbol, lenient_number

# Spellings of the price columns in the source files.
PRICE_SYNONYMS = {
    "time": "trading_date",
    "date": "trading_date",
    "tradingdate": "trading_date",
    "index_code": "ticker",
    "symbol": "ticker",
}
SYMBOL_COLUMNS = ("symbol", "ticker", "code")


def normalize_headers(df: DataFrame) -> DataFrame:
    """Column names stripped and in lower case."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def rename_synonyms(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are present; two columns for one name is an error."""
    new = [names.get(c, c) for c in df.columns]
    twice = sorted({c for c in new if new.count(c) > 1})
    if twice:
        raise ValueError(f"more than one source column for {twice}")
    return df.toDF(*new)


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Bind the first columns by position, whatever their headers; drop the rest."""
    if len(df.columns) < len(names):
        raise ValueError(f"{len(names)} columns expected, file has {len(df.columns)}")
    unique = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return unique.select(*[F.col(f"_{i}").alias(n) for i, n in enumerate(names)])


def normalize_symbol(df: DataFrame) -> DataFrame:
    """Cleaned ``symbol`` from the first of ``symbol``, ``ticker``, ``code``.

    Without any of them there is nothing to key on, and the result is empty.
    """
    source = next((c for c in SYMBOL_COLUMNS if c in df.columns), None)
    if source is None:
        return df.withColumn("symbol", F.lit(None).cast("string")).where(F.lit(False))
    return df.withColumn("symbol", clean_symbol(F.col(source)))


def require_columns(df: DataFrame, names: Iterable[str], label: str = "input") -> DataFrame:
    """Fail, naming them, if columns are missing."""
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns in {label}: {missing}")
    return df


def conform(
    df: DataFrame,
    schema: T.StructType | Sequence[str],
    missing: Any = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Exactly these columns in this order: extras dropped, absent ones filled with ``missing``.

    With a ``StructType`` the values are cast too; text that does not fit becomes null.
    Columns in ``keep`` follow as they are.
    """
    if not isinstance(schema, T.StructType):
        return df.select(
            *[F.col(c) if c in df.columns else F.lit(missing).cast("string").alias(c) for c in schema],
            *keep,
        )
    present = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        if field.name not in present:
            value = F.lit(missing).cast(field.dataType)
        elif present[field.name] == field.dataType:
            value = F.col(field.name)
        elif isinstance(field.dataType, T.DoubleType) and isinstance(present[field.name], T.StringType):
            value = lenient_number(F.col(field.name))
        else:
            value = F.col(field.name).try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns, *keep)


def drop_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Drop the columns whose name ends with ``suffix``."""
    return df.drop(*[c for c in df.columns if c.endswith(suffix)])


def with_tags(df: DataFrame, **tags: Any) -> DataFrame:
    """Literal columns."""
    return df.withColumns({name: F.lit(value) for name, value in tags.items()})


def with_audit(df: DataFrame, run_ts: Any, column: str = "import_time", ds: Any = None) -> DataFrame:
    """Run time, given by the caller so that a repeated run gives the same rows, and run day."""
    audit = {column: F.lit(str(run_ts)).cast("timestamp")}
    if ds is not None:
        audit["ds"] = F.lit(str(ds)).cast("date")
    return df.withColumns(audit)


def fill_constant(df: DataFrame, column: str, value: Any) -> DataFrame:
    """``value`` where ``column`` is null, or everywhere if the column is absent."""
    if column not in df.columns:
        return df.withColumn(column, F.lit(value))
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def fill_from(df: DataFrame, column: str, other: str) -> DataFrame:
    """Nulls of ``column`` taken from ``other``; the column is made if absent."""
    if column not in df.columns:
        return df.withColumn(column, F.col(other))
    return df.withColumn(column, F.coalesce(F.col(column), F.col(other)))


def number_or_zero(df: DataFrame, column: str) -> DataFrame:
    """Lenient number, 0 where there is none."""
    return df.withColumn(column, F.coalesce(F.nanvl(lenient_number(F.col(column)), F.lit(0.0)), F.lit(0.0)))


def order_columns(df: DataFrame) -> list[str]:
    """Columns that only serve ordering: their names start with ``_``, and no table stores them."""
    return [c for c in df.columns if c.startswith("_")]


def drop_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``columns``."""
    return df.dropna(subset=list(columns))


def with_source_file(df: DataFrame, column: str = "source_file") -> DataFrame:
    """Path of the file each row was read from."""
    return df.withColumn(column, F.col("_metadata.file_path"))
