"""News sites: sitemap and feed entries to the day's articles."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse_articles
from ..operators.dedup import keep_first
from ..operators.filters import keep_matches_or_all, matches_day, matches_or_absent
from ..operators.reshape import union_by_name
from ..session import materialize

COLUMNS = ("target_date", "source", "url", "title", "sapo", "content", "publish_time", "fetched_at")


def sitemap_candidates(entries: DataFrame, day: date | str, mode: str = "contains") -> DataFrame:
    """Entries (``source``, ``loc``, ``published``) of the day or without a day.

    A site in which nothing passes keeps all its entries.
    """
    return keep_matches_or_all(entries, "source", matches_or_absent(F.col("published"), day, mode))


def candidates(
    sitemaps: Mapping[str, DataFrame], feeds: Mapping[str, DataFrame], day: date | str
) -> DataFrame:
    """``source`` and ``url`` of all pages to look at; feeds carry no day and pass whole."""
    frames = []
    if sitemaps:
        entries = union_by_name(*[df.withColumn("source", F.lit(s)) for s, df in sitemaps.items()])
        frames.append(sitemap_candidates(entries, day).select("source", F.col("loc").alias("url")))
    frames += [df.select(F.lit(s).alias("source"), F.col("loc").alias("url")) for s, df in feeds.items()]
    return union_by_name(*frames)


def day_articles(
    wanted: DataFrame,
    pages: DataFrame,
    day: date | str,
    run_ts: Any,
    rules: Mapping[str, Mapping[str, str]] | None = None,
    mode: str = "contains",
) -> DataFrame:
    """Articles printed with the day; if there is none at all, every article. One per source and URL.

    ``pages`` holds ``url`` and ``html`` of the fetched pages; of several of one URL the first text counts.
    Pages nobody asked for are left out, by the addresses alone, before any body is moved or parsed. A URL
    with many copies is reduced to one row in the map tasks, so it is never gathered.
    """
    asked = wanted.select("source", "url").distinct()
    bodies = pages.select("url", "html").join(asked.select("url").distinct(), "url", "left_semi")
    fetched = asked.join(keep_first(bodies, ["url"], ["html"]), "url").select("source", "url", "html")
    articles = materialize(parse_articles(fetched, rules=rules))
    of_day = articles.where(matches_day(F.col("publish_time"), day, mode))
    chosen = of_day if not of_day.isEmpty() else articles
    stamped = chosen.withColumns(
        {"target_date": F.lit(str(day)), "fetched_at": F.lit(str(run_ts))}
    )
    return stamped.select(*COLUMNS)
