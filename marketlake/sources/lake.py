"""Lake writes, output checks and compaction."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import without_match
from ..operators.quality import QualityError
from ..session import count_rows, counted, new_folder
from ..vocabulary import LAYOUTS
from . import paths
from .readers import read_csv_by_name, read_csv_lake

ARCHIVE = "_archive"


def object_key(dataset: str, **parts: object) -> str:
    """Key of one output under the dataset's layout."""
    return LAYOUTS[dataset].format(**parts)


def object_keys(dataset: str, ds: str, batch: Column) -> Column:
    """The same as a column, for a column of batch numbers."""
    before, after = LAYOUTS[dataset].format(ds=ds, batch="\0").split("\0")
    return F.concat(F.lit(before), batch.cast("string"), F.lit(after))


def write_lake(
    df: DataFrame,
    root: str,
    dataset: str,
    ds: date | str,
    fmt: str = "parquet",
    batch: str | None = None,
    bom: bool = False,
) -> int:
    """Replace the ``ds`` partition (and its batches) of a dataset; returns the rows written.

    Only the partitions present in ``df`` are replaced, so an empty frame changes nothing.
    ``rebalance`` splits a batch that holds most rows over several tasks and files.
    ``bom`` starts each CSV file with a byte-order mark, for spreadsheet programs.
    """
    rows = df.withColumns({"ds": F.lit(str(ds)), "batch": F.col(batch) if batch else F.lit(0)})
    if batch and batch != "batch":
        rows = rows.drop(batch)
    if fmt == "csv" and bom:
        first = next(c for c in rows.columns if c not in ("ds", "batch"))
        rows = rows.withColumnRenamed(first, "\ufeff" + first)
    rows, written = count_rows(rows.hint("rebalance", "ds", "batch"))
    writer = rows.write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("ds", "batch")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(f"{root}/{dataset}")
    return counted(written)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line, UTF-8, nulls kept as absent keys.

    An array would need one writer for the whole file; lines can be written and read in parts.
    """
    df.write.mode("overwrite").json(path)


def write_json_array(df: DataFrame, path: str) -> None:
    """One JSON array per part file, one item per line, nulls written out.

    Each task writes its own array and passes its rows on batch by batch.
    """

    def bracketed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened = False
        for batch in batches:
            lines = "," + batch["value"]
            if not opened and len(lines):
                lines.iloc[0] = "[" + batch["value"].iloc[0]
                opened = True
            yield lines.to_frame("value")
        yield pd.DataFrame({"value": ["]" if opened else "[]"]})

    items = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    items.mapInPandas(bracketed, "value string").write.mode("overwrite").text(path)


def written_batches(spark: SparkSession, root: str, dataset: str, ds: date | str) -> DataFrame:
    """``batch`` of every output that ``write_lake`` left for the day, as text."""
    folder = f"{root}/{dataset}/ds={ds}"
    if not paths.has_data(spark, folder):
        return spark.createDataFrame([], "batch string")
    name = F.regexp_extract("path", r"/batch=([^/]*)/[^/]*$", 1)
    # Spark escapes special characters in folder names with percent codes.
    plain = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return paths.lake_files(spark, folder).select(plain.alias("batch")).distinct()


def written_keys(spark: SparkSession, root: str, dataset: str, ds: date | str) -> DataFrame:
    """``key``, by the dataset's layout, of every batch that ``write_lake`` left for the day."""
    found = written_batches(spark, root, dataset, ds)
    return found.select(object_keys(dataset, str(ds), F.col("batch")).alias("key"))


def missing_outputs(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Expected keys that were not written."""
    return without_match(expected, present, [key])


def compaction_plan(files: DataFrame, min_history: int = 10) -> DataFrame:
    """One row: newest date, the span and number of older dates, and whether to compact.

    ``files`` has a ``ds`` column; rows without a date belong to no partition.
    """
    dates = files.where(F.col("ds").isNotNull()).select("ds").distinct()
    newest_two = dates.orderBy(F.desc("ds")).limit(2)
    span = dates.agg(F.min("ds").alias("first_ds"), F.count("ds").alias("dates"))
    ends = newest_two.agg(F.max("ds").alias("latest"), F.min("ds").alias("last_ds"))
    row = span.unionByName(ends, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("latest", "first_ds", "last_ds", "dates")]
    )
    older = F.greatest(F.col("dates") - 1, F.lit(0))
    return row.select(
        "latest",
        F.when(older > 0, F.col("first_ds")).alias("first_ds"),
        F.when(older > 0, F.col("last_ds")).alias("last_ds"),
        older.cast("bigint").alias("older_dates"),
        (older >= min_history).alias("compact"),
    )


def compact_partitions(
    spark: SparkSession,
    root: str,
    min_history: int = 10,
    schema: T.StructType | None = None,
    multiline: bool = False,
) -> dict:
    """Merge all CSV dates but the newest into one Parquet archive, then drop the inputs.

    Needs at least ``min_history`` older dates. Columns are matched by name, unless
    ``schema`` gives the one header that all files must have. All files are read by one scan, after a look at
    their headers; before anything is deleted, the rows in the archive's footers are checked against
    those read. Small files are
    packed into tasks of ``spark.sql.files.maxPartitionBytes``, so there is no shuffle and
    the archive gets files of about that size.
    """
    if not paths.exists(spark, root):
        return {"status": "no_keys"}
    files = paths.lake_files(spark, root).where(F.col("ds").isNotNull())
    plan = compaction_plan(files, min_history).first()
    if plan["latest"] is None:
        return {"status": "no_keys"}
    if plan["older_dates"] == 0:
        return {"status": "only_latest_kept"}
    if not plan["compact"]:
        return {"status": f"older<{min_history},skip"}
    older = [r["path"] for r in files.where(F.col("ds") < plan["latest"]).select("path").collect()]
    if schema is None:
        rows = read_csv_by_name(spark, older, multiline=multiline)
    else:
        rows = read_csv_lake(spark, older, schema, multiline)
    rows, read = count_rows(rows)
    archive = f"{root}/{ARCHIVE}/{plan['first_ds']}_{plan['last_ds']}"
    staged = new_folder(spark, "archive")
    rows.write.parquet(staged)
    kept = spark.read.parquet(staged).count()
    if kept != counted(read):
        paths.delete(spark, staged)
        raise QualityError(f"the archive has {kept} rows, {counted(read)} were read")
    # A folder of its own for each run: one over late files of the same dates adds to the archive.
    paths.move(spark, staged, f"{archive}/part={uuid.uuid4().hex}")
    for folder in sorted({path.rsplit("/", 1)[0] for path in older}):
        paths.delete_files(spark, folder, older)
    return {"status": "archived", "files": len(older), "rows": kept, "archive": archive}
