"""Data-quality measures and gates.

A gate runs one aggregation and raises ``QualityError``; at most ``SHOWN`` offenders come
to the driver, with their full number in the message.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..vocabulary import SPECIAL_CHARACTERS

SHOWN = 20

# The characters outside the special class. Deleting them and looking for a rest is many
# times faster than matching so large a class.
PLAIN_CHARACTERS = "".join(
    c for c in map(chr, range(0x2000)) if not re.match(SPECIAL_CHARACTERS, c)
)


class QualityError(ValueError):
    """A table failed a gate."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pass ``df`` on, or fail naming keys that occur more than once."""
    found = duplicate_keys(df, keys)
    offenders = found.orderBy(F.desc("cnt"), *keys).limit(SHOWN).collect()
    if offenders:
        total = found.count()
        raise QualityError(f"{total} duplicate keys, for example {[tuple(r) for r in offenders]}")
    return df


def row_count(df: DataFrame) -> DataFrame:
    """One row: number of rows."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def min_rows(df: DataFrame, least: int) -> DataFrame:
    """One row: number of rows, the least wanted, and whether it is reached."""
    return row_count(df).select(
        "total_rows",
        F.lit(least).cast("bigint").alias("least"),
        (F.col("total_rows") >= least).alias("passed"),
    )


def assert_min_rows(df: DataFrame, least: int) -> DataFrame:
    """Pass ``df`` on, or fail if it has fewer than ``least`` rows."""
    found = df.count()
    if found < least:
        raise QualityError(f"{found} rows, at least {least} expected")
    return df


def null_empty_stats(df: DataFrame, column: str, weight: Column | None = None) -> DataFrame:
    """One row: rows, null names and empty names. ``weight`` counts pre-aggregated rows."""
    w = F.lit(1).cast("bigint") if weight is None else weight
    c = F.col(column)

    def total(hit: Column) -> Column:
        return F.coalesce(F.sum(F.when(hit, w)), F.lit(0)).cast("bigint")

    return df.agg(
        total(F.lit(True)).alias("total_rows"),
        total(c.isNull()).alias("null_names"),
        total(c == "").alias("empty_names"),
    )


def assert_no_blank(df: DataFrame, column: str, weight: Column | None = None) -> DataFrame:
    """Pass ``df`` on, or fail if ``column`` holds a null or empty name."""
    stats = null_empty_stats(df, column, weight).first()
    if stats["null_names"] or stats["empty_names"]:
        raise QualityError(f"{column}: {stats['null_names']} null, {stats['empty_names']} empty")
    return df


def name_issue(c: Column) -> Column:
    """First thing wrong with a name's spelling. A null name counts as clean here."""
    return (
        F.when(F.contains(c, F.lit("  ")), "double_space")
        .when(F.startswith(c, F.lit(" ")) | F.endswith(c, F.lit(" ")), "leading_trailing_space")
        .when(F.translate(c, PLAIN_CHARACTERS, "") != "", "special_characters")
        .otherwise("clean")
    )


def quality_buckets(df: DataFrame, column: str, weight: Column | None = None) -> DataFrame:
    """Rows per spelling issue."""
    w = F.lit(1).cast("bigint") if weight is None else weight
    return df.groupBy(name_issue(F.col(column)).alias("issue_type")).agg(
        F.sum(w).cast("bigint").alias("record_count")
    )


def on_empty(df: DataFrame, policy: str = "skip", label: str = "result") -> DataFrame | None:
    """None for an empty frame under ``skip``; an error under ``error``."""
    if policy not in ("skip", "error"):
        raise ValueError(f"unknown policy {policy!r}")
    if not df.isEmpty():
        return df
    if policy == "error":
        raise QualityError(f"{label} is empty")
    return None
