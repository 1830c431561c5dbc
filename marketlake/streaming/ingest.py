"""Load each lake file once.

``ingest_stream`` leaves the record of processed files to a stream's checkpoint.
``ingest_files`` keeps it in a log table, for folders that other loaders share, and publishes rows and log together.
Both end in an idempotent load, so a batch that is run again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from itertools import islice
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import with_audit
from ..operators.tables import Log, insert_if_absent, upsert
from ..sources import paths
from ..sources.readers import read_csv_by_name, read_csv_lake

Load = Callable[[DataFrame], Any]

# Among the rows of a key the latest file wins, and in a file its first row. Batches come in the order of
# their files, so the result is the same for any number of files in a batch.
ARRIVAL = ("-_modified", "-_file", "_block", "_row")


@dataclass(frozen=True)
class TableLoad:
    """Load step into a table. With a log it publishes rows and log entries by one rename."""

    target: str
    load: Callable[..., Any]
    depth: int

    def __call__(self, df: DataFrame, log: Log | None = None) -> Any:
        return self.load(df, self.target, log=log)

    def recover(self, spark: SparkSession) -> None:
        """Bring a load to its end that another job had published but not moved."""
        paths.finish_swap(spark, self.target, self.depth)


def upsert_load(
    target: str,
    keys: Sequence[str],
    partition_by: Mapping[str, Column] | None = None,
    order_by: Sequence[str] = ARRIVAL,
    keep: str = "first",
) -> TableLoad:
    """Load step: the first row of a key in its file counts, and later files replace earlier ones."""
    load = partial(upsert, keys=keys, order_by=order_by, partition_by=partition_by, keep=keep)
    return TableLoad(target, load, len(partition_by or {}))


def absent_load(
    target: str,
    keys: Sequence[str],
    order_by: Sequence[str] = ("_modified", "_file", "_block", "_row"),
    partition_by: Mapping[str, Column] | None = None,
) -> TableLoad:
    """Load step: the first row of a key stays."""
    load = partial(insert_if_absent, keys=keys, order_by=order_by, partition_by=partition_by)
    return TableLoad(target, load, len(partition_by or {}))


def read_csv_stream(
    spark: SparkSession, folder: str, schema: T.StructType, multiline: bool = False, files_per_batch: int = 10_000
) -> DataFrame:
    """CSV files below a folder as a stream, with ``source_file``, ``_modified``, ``_file`` and ``_block``."""
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .option("escape", '"')
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", "36500d")  # Spark leaves out files a week older than the newest
        .csv(folder)
        .select(
            "*",
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_modification_time").alias("_modified"),
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
        )
    )


def ingest_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    load: Load,
    multiline: bool = False,
    files_per_batch: int = 10_000,
    run_ts: Any = None,
) -> int:
    """Load the CSV files new since the last call with this checkpoint; returns the batches run.

    ``transform`` gets the rows with ``source_file``, ``_modified`` and the file-order
    columns (see ``ARRIVAL``). A file counts as new however old its date is. With ``run_ts`` the loaded rows
    bear it as ``loaded_at``.
    """
    rows = read_csv_stream(spark, folder, schema, multiline, files_per_batch)
    batches = []

    def run(batch: DataFrame, batch_id: int) -> None:
        load(_stamped(transform(batch.withColumn("_row", F.monotonically_increasing_id())), run_ts))
        batches.append(batch_id)

    query = (
        rows.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(batches)


def _stamped(rows: DataFrame, run_ts: Any) -> DataFrame:
    return rows if run_ts is None else with_audit(rows, run_ts, "loaded_at")


def new_files(files: DataFrame, log: DataFrame) -> DataFrame:
    """Files whose key is not in the log."""
    return files.join(log.select("object_key"), files["path"] == log["object_key"], "left_anti")


def ingest_files(
    spark: SparkSession,
    folder: str,
    log: str,
    transform: Callable[[DataFrame], DataFrame],
    load: Load,
    run_ts: Any,
    schema: T.StructType | None = None,
    multiline: bool = False,
    files_per_batch: int = 10_000,
    check: Callable[[Sequence[str], str], None] | None = None,
    wait: float = 0,
) -> dict:
    """Load the CSV files not yet in the log table, and log them.

    Headers may differ, unless ``schema`` gives the one header that all files must have; ``check`` may
    refuse a header (see ``read_csv_by_name``). Files come in the order of their paths, ``files_per_batch``
    at a time, which bounds what the driver holds; a later one counts as newer. Loaded rows bear ``run_ts``
    as ``loaded_at``.

    A ``TableLoad`` publishes a batch's rows and its log entries by one rename: a job that dies leaves both or neither,
    and the next one finishes what was published. After any other load the log is written by itself; if the job dies in
    between, the files are loaded again, which an idempotent load allows. One job at a time loads by a log: another
    waits for ``wait`` seconds and is then refused (``paths.Busy``).
    """
    with paths.lock(spark, paths.aside(log, "lock"), wait):
        if isinstance(load, TableLoad):
            load.recover(spark)
        return _ingest(spark, folder, log, transform, load, run_ts, schema, multiline, files_per_batch, check)


def _ingest(
    spark: SparkSession,
    folder: str,
    log: str,
    transform: Callable[[DataFrame], DataFrame],
    load: Load,
    run_ts: Any,
    schema: T.StructType | None,
    multiline: bool,
    files_per_batch: int,
    check: Callable[[Sequence[str], str], None] | None,
) -> dict:
    files = paths.lake_files(spark, folder).select("path")
    if paths.has_data(spark, log):
        files = new_files(files, spark.read.parquet(log))
    loaded = 0
    with paths.step(files) as waiting:
        paths_left = (r["path"] for r in waiting.orderBy("path").toLocalIterator())
        while found := list(islice(paths_left, files_per_batch)):
            if schema is None:
                rows = read_csv_by_name(spark, found, multiline=multiline, file_columns=True, check=check)
            else:
                rows = read_csv_lake(spark, found, schema, multiline, file_columns=True)
            rows = _stamped(transform(rows.withColumn("_modified", F.lit(None).cast("timestamp"))), run_ts)
            keys = with_audit(spark.createDataFrame([(p,) for p in found], "object_key string"), run_ts, "processed_at")
            if isinstance(load, TableLoad):
                load(rows, log=(log, keys))
            else:
                load(rows)
                insert_if_absent(keys, log, ["object_key"], ["object_key"])
            loaded += len(found)
    return {"status": "loaded" if loaded else "skip", "files": loaded}
