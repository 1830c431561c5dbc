"""Standardise the indicator names of the statement table.

Snapshot, mapping refresh and gate, profile, update, profile, quality gate, retention.
The snapshot refers to the table's files and copies none. All numbers come from rows per name and
partition, kept from day to day: only partitions that changed since are scanned, one column of them.
The update rewrites the partitions that hold a name to be changed, and records their new counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import partials, profile
from ..operators.joins import rename_by_lookup, with_match
from ..operators.quality import (
    QualityError,
    assert_min_rows,
    assert_no_blank,
    assert_unique,
    quality_buckets,
)
from ..operators.tables import full_refresh, in_partitions, read_partitions, swap_in
from ..session import materialize
from ..sources import manifest, paths


def standardize_names(df: DataFrame, mapping: DataFrame, column: str = "ind_name") -> DataFrame:
    """The update itself: mapped names replaced, all other rows untouched."""
    return rename_by_lookup(df, mapping, column)


def standardize_table(
    spark: SparkSession,
    table: str,
    mapping: DataFrame,
    mapping_path: str,
    snapshot_root: str,
    day: date | str,
    partition_by: Sequence[str] = (),
    min_mappings: int | None = None,
    keep_days: int = 7,
) -> dict[str, DataFrame | int | list[str]]:
    """Run the job on the Parquet table at ``table``; returns its reports.

    ``min_mappings`` defaults to the number of mappings supplied, which the refreshed
    mapping table must then hold. With ``partition_by`` only the partitions that hold a
    name to be changed are rewritten.
    """
    if not paths.exists(spark, table):
        raise QualityError(f"no table at {table}")
    taken = manifest.take_snapshot(spark, table, snapshot_root, day)

    least = mapping.count() if min_mappings is None else min_mappings
    assert_unique(mapping, ["raw_ind_name"])
    rules = full_refresh(mapping, mapping_path)
    assert_min_rows(rules, least)

    store = f"{snapshot_root}/profile"
    per_part, scanned = partials.partition_counts(spark, table, store)
    before = materialize(profile.sum_counts(per_part))
    after = materialize(profile.counts_after(before, rules))
    changed = profile.changed_rows(before, rules).first()["changed_rows"]
    if changed:
        current = read_partitions(spark, table, partition_by)
        touched = with_match(per_part, profile.moving_names(rules), ["ind_name"]).select("folder").distinct()
        counts = rename_by_lookup(per_part.join(touched, "folder", "left_semi"), rules, "ind_name")

        def record(folder: str) -> None:
            """The new counts are known by the mapping; their partitions need no scan the next day."""
            made = profile.sum_counts(counts, "folder")
            partials.record(spark, store, made.join(manifest.identities(manifest.table_files(spark, folder)), "folder"))

        if partition_by:
            folders = touched.select(*[paths.folder_value(F.col("folder"), name) for name in partition_by]).collect()
            stale = current.where(in_partitions(folders, partition_by))
            # Each task writes back the partitions it read: a shuffle would send the whole table.
            swap_in(standardize_names(stale, rules), table, partition_by, rebalance=False, written=record)
        else:
            full_refresh(standardize_names(current, rules), table, written=record)

    # The update is done even if the gate fails, as the names were wrong before it.
    weight = F.col("record_count")
    assert_no_blank(after, "ind_name", weight)
    return {
        "snapshot_rows": taken["rows"],
        "snapshot_bytes": taken["copied_bytes"],
        "scanned_partitions": scanned,
        "profile_before": profile.profile_before(before, rules),
        "unmapped_before": profile.unmapped_names(before, rules),
        "updated_rows": profile.updated_rows(before, rules).first()["updated_rows"],
        "changed_rows": changed,
        "reduction": profile.reduction_report(before, after),
        "top_indicators": profile.top_names(after),
        "still_unmapped": profile.still_unmapped(after, rules),
        "quality": quality_buckets(after, "ind_name", weight),
        "expired": manifest.drop_snapshots(spark, snapshot_root, day, keep_days),
    }
