"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` (default 8) and
``BENCH_RUNS`` (default 3) set it up. Each query runs once to warm up; the figure is the
median of the following runs, to the last row (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from checks import QUERIES
from checks.run import local_session

HEADLINES = (
    "top_indicators",
    "standardize_indicators",
    "standardize_job",
    "profile_before",
    "statement_long",
    "load_statements",
    "melt_statement_year",
    "number_text_4",
    "normalize_prices",
    "index_series",
    "dedup_composite",
    "duplicate_keys",
    "overview_enrich",
    "daily_news_clean",
    "news_hash_dedup",
    "filter_with_fallback",
    "assign_batches",
    "upsert_lww",
    "insert_if_absent",
    "compaction_rows",
    "stream_ingest",
    "html_article",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, cpus)
    seconds = {}
    for name in HEADLINES:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))


if __name__ == "__main__":
    main()
