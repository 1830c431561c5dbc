"""Rows per name kept up by change: a partition is scanned again only after its files have changed.

The store holds, for each partition that was ever scanned, its rows per name under the identity of its files (see
``manifest.identities``). What a table has now is the partials of its present identities, so partials of folders that
were replaced or dropped don't count, and a job that dies leaves nothing wrong.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources import manifest, paths

RUNS = 8  # runs are merged into one beyond this number
SCHEMA = "folder string, identity string, ind_name string, record_count long, run string"


def _stored(spark: SparkSession, store: str) -> DataFrame:
    if not paths.has_data(spark, store):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(store)


def _valid(stored: DataFrame, now: DataFrame) -> DataFrame:
    """Partials of the partitions in ``now``; of two runs over one partition the first named counts."""
    present = stored.join(now, ["folder", "identity"], "left_semi")
    one = present.groupBy("folder", "identity").agg(F.min("run").alias("run"))
    return present.join(one, ["folder", "identity", "run"], "left_semi").drop("run")


def record(spark: SparkSession, store: str, partials: DataFrame) -> None:
    """Add ``folder, identity, ind_name, record_count`` of whole partitions to the store, as one run.

    Of a partition without rows the run has one with a null name and a count of 0.
    """
    partials.select("folder", "identity", "ind_name", "record_count").write.parquet(paths.unused(spark, store, "run"))


def partition_counts(spark: SparkSession, table: str, store: str, column: str = "ind_name") -> tuple[DataFrame, int]:
    """``folder, ind_name, record_count`` of every partition of a table, and how many partitions had to be scanned.

    ``store`` keeps the counts between calls. Only partitions with other files than at the last call are scanned, one
    column of them, in one job; the first call scans the table.
    """
    files = manifest.table_files(spark, table)
    with paths.step(manifest.identities(files)) as now:
        with paths.step(now.join(_stored(spark, store), ["folder", "identity"], "left_anti")) as changed:
            folders = [r.folder for r in changed.select("folder").collect()]
            if folders:
                _scan(spark, table, store, column, changed, folders)
        counts = materialize(_valid(_stored(spark, store), now).where("record_count > 0").select("folder", "ind_name", "record_count"))
        _merge(spark, store, now)
    return counts, len(folders)


def _scan(spark: SparkSession, table: str, store: str, column: str, changed: DataFrame, folders: list[str]) -> None:
    """Record the rows per name of some partitions."""
    rows = manifest.read_folders(spark, table, folders, spark.read.parquet(table).schema)
    per_file = rows.groupBy(F.col("_metadata.file_path").alias("at"), F.col(column).alias("ind_name"))
    # Stored, as Catalyst would work out the folder of every row for the join below.
    with paths.step(per_file.agg(F.count(F.lit(1)).alias("n"))) as stored:
        below = F.substring(paths.plain_path(F.col("at")), len(paths.qualified(spark, table)) + 2, 1 << 30)
        folder = F.regexp_replace(below, "/?[^/]*$", "")
        counts = stored.groupBy(folder.alias("folder"), "ind_name").agg(F.sum("n").alias("record_count"))
        found = changed.join(counts, "folder", "left")
        record(spark, store, found.withColumn("record_count", F.coalesce("record_count", F.lit(0)).cast("long")))


def _merge(spark: SparkSession, store: str, now: DataFrame) -> None:
    """Put many runs, and what they hold of partitions that are gone, into one."""
    runs = paths.child_folders(spark, store)
    if len(runs) <= RUNS:
        return
    record(spark, store, _valid(_stored(spark, store), now))
    for run in runs:
        paths.delete(spark, f"{store}/{run}")
