"""Session settings and shared work folders."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on. None of them depends on the cluster size;
# shuffle partitions and executor memory stay with the cluster's own defaults.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Article pages go to Python in batches; keep a batch of long pages small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    # A task writes to the folders of a few partitions at once, else it would first sort all its rows by partition.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can read and write, as named by ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def with_folder(spark: SparkSession) -> SparkSession:
    """``configure``, and for trials on one machine a folder where none is named.

    For registered queries and tests; jobs call ``configure`` and name a shared folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and re.match(r"local(\[|$)", spark.sparkContext.master):
        spark.conf.set("spark.checkpoint.dir", f"file:{tempfile.mkdtemp(prefix='marketlake-')}")
    return configure(spark)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared root that no earlier run has used."""
    return f"{shared_root(spark)}/marketlake/{name}-{uuid.uuid4().hex}"


EMPTY_METRIC = ("NoSuchElementException", "NullPointerException", "UnsupportedOperationException")


def count_rows(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a row count taken on the way, for a write that must not run twice.

    To be put last, after any shuffle: the tasks before a shuffle may run again when an
    executor is lost, and would count twice.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def counted(seen: Observation) -> int:
    """Rows that went through ``count_rows``, once the write is done."""
    try:
        return seen.get["rows"]
    except Py4JJavaError as error:
        # AQE found the input empty and removed the metric along with the plan: a row without fields.
        if error.java_exception.getClass().getSimpleName() not in EMPTY_METRIC:
            raise
        return 0


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there.

    For results that later steps read several times, such as per-name counts. A lost
    executor costs nothing afterwards, and as a Parquet table the result has a known size,
    by which Catalyst picks the join.
    """
    return stored(df, new_folder(df.sparkSession, "step"))


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a new folder and read it from there."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fixed_table(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """Fixed text values as a table of known size, by which Catalyst picks the join."""
    columns = dict(zip(names, (pa.array(c, pa.string()) for c in zip(*rows))))
    return spark.createDataFrame(pa.table(columns))
