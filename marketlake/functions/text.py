"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's str.strip() removes. Spark's trim() takes
# off the plain space only, so names padded with a no-break space would stay padded.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: how the price API words its waiting time.
RETRY_AFTER = r"(?iu)thử lại sau\s+(\d+)\s+giây"


def strip_text(c: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def clean_symbol(c: Column) -> Column:
    """Ticker in upper case without padding; null stays null."""
    return strip_text(F.upper(c.cast("string")))


def slugify(c: Column) -> Column:
    """Indicator code: runs of other than ASCII letters and digits become ``_``.

    Letters with accents count as other. Nothing left gives ``UNKNOWN``. The class is
    ``[^A-Za-z0-9]`` in a spelling that Java matches several times faster.
    """
    slug = F.upper(F.btrim(F.regexp_replace(c, r"[\W_]+", "_"), F.lit("_")))
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("UNKNOWN"))


def fallback_code(c: Column) -> Column:
    """Code of an indicator without mapping: upper case, ``_`` for space, 50 characters."""
    return F.substring(F.replace(F.upper(c), F.lit(" "), F.lit("_")), 1, 50)


def md5_id(c: Column) -> Column:
    """Hex md5 of the text's UTF-8 bytes."""
    return F.md5(c.cast("binary"))


def non_blank(c: Column) -> Column:
    """True where the text holds more than white space; false for null."""
    return F.coalesce(strip_text(c) != "", F.lit(False))


def coalesce_blank(first: Column, second: Column) -> Column:
    """``first`` unless it is null or empty, else ``second``."""
    return F.when(first.isNotNull() & (first != ""), first).otherwise(second)


def retry_after_seconds(c: Column, pattern: str = RETRY_AFTER) -> Column:
    """Number captured by group 1 of ``pattern``; null where the text has none."""
    return F.regexp_extract(c, pattern, 1).try_cast("double")
