"""Date and time expressions. The session time zone is taken to be UTC."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the forms in which a page may print its day.
TOKEN_FORMATS = ("yyyy-MM-dd", "dd/MM", "dd-MM", "d/M", "d-M")


def lenient_date(c: Column) -> Column:
    """Date of an ISO date or timestamp; null where the text is neither."""
    readable = c.try_cast("timestamp").isNotNull()
    return F.when(readable, c.try_cast("date"))


def lenient_timestamp(c: Column) -> Column:
    """UTC timestamp of an ISO text; null where unreadable."""
    return c.try_cast("timestamp")


def iso_text(c: Column) -> Column:
    """Date or timestamp as ``yyyy-MM-dd``."""
    return F.date_format(c, "yyyy-MM-dd")


def stringify_timestamps(df: DataFrame) -> DataFrame:
    """Every timestamp column as ``yyyy-MM-dd HH:mm:ss`` text."""
    return df.withColumns(
        {
            f.name: F.date_format(F.col(f"`{f.name}`"), "yyyy-MM-dd HH:mm:ss")
            for f in df.schema.fields
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        }
    )


def epoch_millis(c: Column) -> Column:
    """Timestamp of milliseconds since 1970; 0 and null give null."""
    return F.timestamp_millis(F.nullif(c.cast("bigint"), F.lit(0).cast("bigint")))


def half_open_day(c: Column, day: date | str) -> Column:
    """``day <= c < day + 1``. Kept as a range on ``c`` so that it reaches the scan."""
    start = F.lit(str(day)).cast("date")
    return (c >= start) & (c < F.date_add(start, 1))


def date_tokens(c: Column) -> Column:
    """The five forms of a date column, as an array."""
    return F.array(*[F.date_format(c, form) for form in TOKEN_FORMATS])


def day_tokens(day: date | str) -> list[str]:
    """The same five forms of one day, as literals."""
    d = date.fromisoformat(str(day))
    return [
        d.isoformat(),
        f"{d.day:02d}/{d.month:02d}",
        f"{d.day:02d}-{d.month:02d}",
        f"{d.day}/{d.month}",
        f"{d.day}-{d.month}",
    ]


def path_segment(c: Column, index: int) -> Column:
    """Segment of a ``/`` path, counted from 0; null beyond the end."""
    return F.get(F.split(c, "/"), F.lit(index))


def path_date(c: Column) -> Column:
    """First ``yyyy-MM-dd`` in a path, wherever it stands; null where there is none."""
    return F.nullif(F.regexp_extract(c, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
