"""Lookups and enrichment.

All joins are equi-joins. Which side is broadcast is left to Catalyst and AQE, which know the
bytes of stored tables and of shuffled sides; beyond the bound AQE splits a hot key of the large side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import coalesce_blank, fallback_code, strip_text
from .columns import conform, drop_suffix, normalize_symbol
from .dedup import keep_first

def rename_by_lookup(
    df: DataFrame,
    mapping: DataFrame,
    column: str,
    raw: str = "raw_ind_name",
    standard: str = "std_ind_name",
) -> DataFrame:
    """Replace names found in ``mapping.raw`` by ``mapping.standard``; keep the others.

    ``mapping.raw`` must be unique (see ``quality.assert_unique``).
    """
    side = mapping.select(F.col(raw).alias("_raw"), F.col(standard).alias("_std"))
    joined = df.join(side, F.col(column) == F.col("_raw"), "left")
    return joined.withColumn(column, F.coalesce("_std", column)).drop("_raw", "_std")


def lookup_with_default(
    df: DataFrame, mapping: DataFrame, column: str, out_name: str, out_code: str
) -> DataFrame:
    """Name and code of an indicator; unknown ones keep their name and get a made code.

    ``mapping`` has ``en_name``, ``vi_name`` and ``code``; ``en_name`` is unique.
    """
    side = mapping.select(
        F.col("en_name").alias("_en"), F.col("vi_name").alias("_vi"), F.col("code").alias("_code")
    )
    named = df.withColumn("_name", strip_text(F.col(column).cast("string")))
    joined = named.join(side, F.col("_name") == F.col("_en"), "left")
    return joined.withColumns(
        {
            out_name: F.coalesce("_vi", "_name"),
            out_code: F.coalesce("_code", fallback_code(F.col("_name"))),
        }
    ).drop("_name", "_en", "_vi", "_code")


def listing_meta(
    industries: DataFrame, exchanges: DataFrame, industry_cols: Sequence[str], exchange_cols: Sequence[str]
) -> DataFrame:
    """Industry list with the exchange list joined on; one row per symbol on either side.

    Of several rows with one symbol the lowest is kept, which is the same in every run.
    """

    def side(df: DataFrame, cols: Sequence[str]) -> DataFrame:
        shaped = conform(normalize_symbol(df), cols, missing="")
        return keep_first(shaped, ["symbol"], [c for c in cols if c != "symbol"])

    return side(industries, industry_cols).join(side(exchanges, exchange_cols), "symbol", "left")


def enrich(base: DataFrame, listing: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill null or empty ``columns`` of ``base`` from the listing with the same symbol.

    Both sides come out of a de-duplication on the symbol, so the join reuses that
    partitioning and needs no further shuffle.
    """
    side = listing.select("symbol", *[F.col(c).alias(f"{c}_listing") for c in columns])
    joined = base.join(side, "symbol", "left")
    filled = {
        c: coalesce_blank(F.col(c), F.col(f"{c}_listing")) if c in base.columns else F.col(f"{c}_listing")
        for c in columns
    }
    return drop_suffix(joined.withColumns(filled), "_listing")


def without_match(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``known``.

    The known keys are made distinct with map-side combine first: AQE can split a hot key
    of the left side, but not of the right.
    """
    return df.join(known.select(*keys).distinct(), list(keys), "left_anti")


def with_match(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``known``."""
    return df.join(known.select(*keys).distinct(), list(keys), "left_semi")
