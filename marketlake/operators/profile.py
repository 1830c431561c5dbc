"""Profiles of a name column.

Every number of a profile can be had from the rows per name. ``name_counts`` computes
these once, with map-side combine, in a single scan that reads one column; the profile
functions then work on that small result instead of scanning the table again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import rename_by_lookup, with_match, without_match


def name_counts(df: DataFrame, column: str = "ind_name") -> DataFrame:
    """Rows per name: ``ind_name``, ``record_count``."""
    return df.groupBy(F.col(column).alias("ind_name")).agg(F.count(F.lit(1)).alias("record_count"))


def sum_counts(counts: DataFrame, *by: str) -> DataFrame:
    """Rows per name, and per ``by``, from counts by more columns than that."""
    return counts.groupBy(*by, "ind_name").agg(F.sum("record_count").cast("bigint").alias("record_count"))


def _raw(mapping: DataFrame) -> DataFrame:
    return mapping.select(F.col("raw_ind_name").alias("ind_name")).distinct()


def _standard(mapping: DataFrame) -> DataFrame:
    return mapping.select(F.col("std_ind_name").alias("ind_name")).distinct()


def profile_before(counts: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row: rows, names, names the mapping knows and names it does not."""
    known = _raw(mapping).withColumn("_known", F.lit(True))
    marked = counts.join(known, "ind_name", "left")
    row = marked.agg(
        F.coalesce(F.sum("record_count"), F.lit(0)).cast("bigint").alias("total_records"),
        F.count("ind_name").alias("unique_indicators"),
        F.count(F.when(F.col("_known"), F.col("ind_name"))).alias("mappable_indicators"),
    )
    return row.withColumn(
        "unmapped_indicators", F.col("unique_indicators") - F.col("mappable_indicators")
    )


def unmapped_names(counts: DataFrame, mapping: DataFrame, top: int = 20) -> DataFrame:
    """First names, in order, without a mapping."""
    unknown = without_match(counts, _raw(mapping), ["ind_name"]).select("ind_name")
    return unknown.orderBy(F.asc_nulls_last("ind_name")).limit(top)


def counts_after(counts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows per name once the mapping is applied."""
    renamed = rename_by_lookup(counts, mapping, "ind_name")
    return renamed.groupBy("ind_name").agg(F.sum("record_count").cast("bigint").alias("record_count"))


def updated_rows(counts: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row: rows whose name is in the mapping, those mapped to themselves included."""
    matched = with_match(counts, _raw(mapping), ["ind_name"])
    return matched.agg(F.coalesce(F.sum("record_count"), F.lit(0)).cast("bigint").alias("updated_rows"))


def moving_names(mapping: DataFrame) -> DataFrame:
    """Names the mapping really changes."""
    return _raw(mapping.where(F.col("raw_ind_name") != F.col("std_ind_name")))


def changed_rows(counts: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row: rows whose name the mapping really changes."""
    moving = mapping.where(F.col("raw_ind_name") != F.col("std_ind_name"))
    return updated_rows(counts, moving).withColumnRenamed("updated_rows", "changed_rows")


def reduction_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: names before, after and saved, and the saving in percent to one decimal."""
    b = before.agg(F.count("ind_name").alias("unique_before"))
    a = after.agg(F.count("ind_name").alias("unique_after"))
    reduced = F.col("unique_before") - F.col("unique_after")
    both = b.unionByName(a, allowMissingColumns=True).agg(
        F.max("unique_before").alias("unique_before"), F.max("unique_after").alias("unique_after")
    )
    return both.select(
        "unique_before",
        "unique_after",
        reduced.alias("reduced"),
        F.when(F.col("unique_before") > 0, F.round(reduced * 100.0 / F.col("unique_before"), 1)).alias(
            "reduced_percent"
        ),
    )


def top_names(counts: DataFrame, top: int = 10) -> DataFrame:
    """Names with most rows; the name breaks ties."""
    return counts.orderBy(F.desc("record_count"), "ind_name").limit(top)


def still_unmapped(counts: DataFrame, mapping: DataFrame, top: int = 10) -> DataFrame:
    """Most frequent names that are not standard names."""
    return top_names(without_match(counts, _standard(mapping), ["ind_name"]), top)


def rows_per_batch(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per batch or symbol."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values as rows, not as one array that a single task would hold."""
    return df.select(column).distinct()
