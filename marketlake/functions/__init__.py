"""Column expressions. All run inside the JVM except the HTML field extraction."""

from .dates import (
    date_tokens,
    day_tokens,
    epoch_millis,
    half_open_day,
    iso_text,
    lenient_date,
    lenient_timestamp,
    path_date,
    path_segment,
    stringify_timestamps,
)
from .html import parse_articles
from .numbers import as_double, as_int, lenient_int, lenient_number, with_number_text
from .text import (
    clean_symbol,
    coalesce_blank,
    fallback_code,
    md5_id,
    non_blank,
    retry_after_seconds,
    slugify,
    strip_text,
)

__all__ = [
    "as_double",
    "as_int",
    "clean_symbol",
    "coalesce_blank",
    "date_tokens",
    "day_tokens",
    "epoch_millis",
    "fallback_code",
    "half_open_day",
    "iso_text",
    "lenient_date",
    "lenient_int",
    "lenient_number",
    "lenient_timestamp",
    "md5_id",
    "non_blank",
    "parse_articles",
    "path_date",
    "path_segment",
    "retry_after_seconds",
    "slugify",
    "strip_text",
    "stringify_timestamps",
    "with_number_text",
]
