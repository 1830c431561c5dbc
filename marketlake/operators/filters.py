"""Row filters. Range filters stay on the bare column, so they reach the scan."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_int, day_tokens, half_open_day, lenient_date
from ..session import materialize


def on_day(df: DataFrame, column: str, day: date | str) -> DataFrame:
    """Rows whose date equals ``day``; rows without a readable date fall out.

    On a date or timestamp column this is a range, which reaches the scan.
    """
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.where(lenient_date(F.col(column)) == F.lit(str(day)).cast("date"))
    return df.where(half_open_day(F.col(column), day))


def in_range(
    df: DataFrame,
    column: str,
    start: date | str | None = None,
    end: date | str | None = None,
    *,
    default_start: str | None = None,
    default_end: str | None = None,
    whole_end_day: bool = True,
) -> DataFrame:
    """``start <= column <= end`` with a job's defaults; a bound that nobody gives filters nothing.

    A timestamp later on the end day belongs to it, unless ``whole_end_day`` is False:
    then the end is its midnight. With a bound, rows without a date fall out.
    """
    c = F.col(column)
    if start or default_start:
        df = df.where(c >= F.lit(str(start or default_start)).cast("date"))
    last = end or default_end
    if last is None:
        return df
    high = F.lit(str(last)).cast("date")
    return df.where(c < F.date_add(high, 1) if whole_end_day else c <= high)


def for_year(df: DataFrame, column: str, year: int | str | None) -> DataFrame:
    """Rows of one year; a ``year`` that is no integer filters nothing."""
    try:
        wanted = int(year) if year is not None else None
    except ValueError:
        wanted = None
    if wanted is None:
        return df
    return df.where(as_int(df, F.col(column)) == wanted)


def matches_day(text: Column, day: date | str | None, mode: str = "contains") -> Column:
    """Does the text print the day in any of its five forms? Null text does not.

    ``contains`` also finds ``1/2`` inside ``11/2``; ``exact_date`` wants no digit next
    to the token. No day means no filter.
    """
    if day is None:
        return F.lit(True)
    tokens: Iterable[str] = day_tokens(day)
    if mode == "contains":
        found = reduce(or_, [F.contains(text, F.lit(t)) for t in tokens])
    elif mode == "exact_date":
        found = text.rlike(r"(?<!\d)(" + "|".join(tokens) + r")(?!\d)")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.coalesce(found, F.lit(False))


def matches_or_absent(text: Column, day: date | str | None, mode: str = "contains") -> Column:
    """As ``matches_day``, but a missing text passes."""
    return text.isNull() | matches_day(text, day, mode)


def keep_matches_or_all(df: DataFrame, group: str, keep: Column) -> DataFrame:
    """Per group, the rows that match; all rows of a group in which none does.

    A window would bring each group to one task. Here the groups are aggregated with
    map-side combine first, and the one-row-per-group result joins back, so a group
    with a third of all rows is never gathered.
    """
    marked = df.withColumn("_keep", F.coalesce(keep, F.lit(False)))
    groups = materialize(
        marked.groupBy(F.col(group).alias("_group")).agg(F.bool_or("_keep").alias("_any"))
    )
    without = groups.where(~F.col("_any")).select("_group")
    flagged = marked.join(
        without.withColumn("_all", F.lit(True)),
        F.col(group).eqNullSafe(F.col("_group")),
        "left",
    )
    return flagged.where(F.col("_keep") | F.coalesce("_all", F.lit(False))).drop(
        "_keep", "_group", "_all"
    )
