"""Manifests of a table's files, and snapshots that refer to files instead of copying them.

A snapshot is the list of the files that a Parquet table had: their folder, name, size, time and rows. Nothing is
copied when it is taken. The library's loads never write into a file; they add files, and put new folders in the
place of old ones. From its first snapshot on a folder that goes is not deleted but moved into the snapshots'
store, if a snapshot can refer to it (``paths.discard``), so that every version of a partition exists once, in the
table or in the store. ``copy_snapshot`` writes out all rows, for a copy that shares nothing with the table.

    <root>/manifest/snapshot_ds=20260115/     the files of that day: table, folder, file, length, modified, rows
    <root>/kept/version=<id>/<folder>/        folders that loads have replaced since
"""

from __future__ import annotations

import json
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import SHOWN, QualityError
from . import paths

FILE = ("folder", "file", "length", "modified")


def table_files(spark: SparkSession, table: str) -> DataFrame:
    """``folder, file, length, modified`` of every data file of a table, by listing alone.

    ``folder`` is that of the partition below the table, empty where there are no partitions.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(table)
    below = F.substring("path", len(paths.qualified(spark, table)) + 2, 1 << 30)
    name = F.substring_index(below, "/", -1)
    folder = F.rtrim(F.substring(below, F.lit(1), F.length(below) - F.length(name)), F.lit("/"))
    return files.select(folder.alias("folder"), name.alias("file"), "length", F.col("modificationTime").alias("modified"))


def identities(files: DataFrame) -> DataFrame:
    """``folder, identity`` of each partition: the same as long as it is made of the same files."""
    each = F.concat_ws(":", "file", F.col("length").cast("string"), F.unix_millis("modified").cast("string"))
    return files.groupBy("folder").agg(F.md5(F.array_join(F.sort_array(F.collect_list(each)), "/")).alias("identity"))


def read_folders(spark: SparkSession, base: str, places: list[str], schema: T.StructType) -> DataFrame:
    """Files or folders below ``base`` with the values of all partition folders above them."""
    reader = spark.read.schema(schema).option("basePath", base)
    return reader.parquet(*[f"{base}/{p}" if p else base for p in places])


def folder_and_file(spark: SparkSession, table: str, path: str) -> tuple[str, str]:
    """The path of a row's file (``_metadata.file_path``), as in ``table_files``."""
    below = unquote(path)[len(paths.qualified(spark, table)) + 1 :]
    folder, _, name = below.rpartition("/")
    return folder, name


def _count_rows(spark: SparkSession, table: str, files: DataFrame) -> DataFrame:
    """``folder, file, rows`` of the given files, from their footers.

    The driver holds their names, as for any scan.
    """
    places = [f"{r.folder}/{r.file}".lstrip("/") for r in files.select("folder", "file").collect()]
    counts = []
    if places:
        rows = spark.read.option("basePath", table).parquet(*[f"{table}/{p}" for p in places])
        counts = rows.groupBy(F.col("_metadata.file_path").alias("at")).agg(F.count(F.lit(1)).alias("rows")).collect()
    return spark.createDataFrame([(*folder_and_file(spark, table, r.at), r.rows) for r in counts], "folder string, file string, rows long")


def _manifests(spark: SparkSession, root: str) -> DataFrame | None:
    place = f"{root}/manifest"
    if not paths.has_data(spark, place):
        return None
    fields = "table string, schema string, folder string, file string, length long, modified timestamp, rows long, snapshot_ds string"
    return spark.read.schema(fields).parquet(place)


def _day(day: date | str) -> str:
    return str(day).replace("-", "")


def take_snapshot(spark: SparkSession, table: str, root: str, day: date | str) -> dict[str, int]:
    """Refer to the table's present files under ``day``; one of the same day is replaced.

    Returns ``rows`` and ``files``, how many files no earlier snapshot had (``new_files``; of these the footers are
    read, for the rows), and ``copied_bytes``, which is 0. A table without rows is refused: it would replace a good
    snapshot of the same day. A table has its snapshots under one root.
    """
    paths.keep_replaced(spark, table, root)  # from here on; what a load replaces meanwhile is kept
    with paths.step(table_files(spark, table)) as files:
        earlier = _manifests(spark, root)
        known = files.limit(0).withColumn("rows", F.lit(0).cast("long"))
        if earlier is not None:
            same = earlier.where(F.col("table") == paths.qualified(spark, table))
            known = files.join(same.select(*FILE, "rows").distinct(), list(FILE))
        new = files.join(known.select(*FILE), list(FILE), "left_anti")
        with paths.step(new) as unknown:
            counted = _count_rows(spark, table, unknown)
            added = unknown.join(counted, ["folder", "file"], "left").withColumn("rows", F.coalesce("rows", F.lit(0)).cast("long"))
            listed = known.unionByName(added)
            schema = spark.read.parquet(table).schema
            own = {"table": F.lit(paths.qualified(spark, table)), "schema": F.lit(schema.json())}
            folder = f"{root}/manifest/snapshot_ds={_day(day)}"
            staged = paths.aside(folder, "staged")
            listed.withColumns(own).select("table", "schema", *FILE, "rows").write.mode("overwrite").parquet(staged)
            made = spark.read.parquet(staged).agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("files"), F.max("modified").alias("newest")
            )
            made = made.select("rows", "files", F.unix_millis("newest").alias("newest")).first()
            if not made.rows:
                paths.delete(spark, staged)
                raise ValueError("no snapshot of an empty table")
            new_files = unknown.count()
    paths.replace_folder(spark, staged, folder)
    paths.keep_replaced(spark, table, root, made.newest)
    return {"rows": made.rows, "files": made.files, "new_files": new_files, "copied_bytes": 0}


def _kept_files(spark: SparkSession, root: str) -> DataFrame:
    """``version, folder, file, length`` of the folders that loads have replaced."""
    if not paths.has_data(spark, f"{root}/kept"):
        return spark.createDataFrame([], "version string, folder string, file string, length long")
    files = table_files(spark, f"{root}/kept")
    version = F.substring_index("folder", "/", 1)
    folder = F.substring(F.col("folder"), F.length(version) + 2, F.lit(1 << 30))
    return files.select(version.alias("version"), folder.alias("folder"), "file", "length")


def snapshot_files(spark: SparkSession, root: str, day: date | str) -> DataFrame:
    """The files of a day's snapshot, each with its ``version`` in the store, or null where the table still has it.

    ``found`` is false for a file that is in neither: something other than this library's loads deleted it.
    """
    listed = _manifests(spark, root)
    listed = None if listed is None else listed.where(F.col("snapshot_ds") == _day(day))
    if listed is None or listed.isEmpty():
        raise QualityError(f"no snapshot of {day} under {root}")
    table = listed.first().table
    kept = _kept_files(spark, root).groupBy("folder", "file", "length").agg(F.max("version").alias("version"))
    live = table_files(spark, table) if paths.has_data(spark, table) else listed.select(*FILE).limit(0)
    marked = listed.join(kept, ["folder", "file", "length"], "left").join(live.withColumn("_live", F.lit(True)), list(FILE), "left")
    found = F.col("version").isNotNull() | F.col("_live").isNotNull()
    return marked.withColumn("found", found).drop("_live")


def read_snapshot(spark: SparkSession, root: str, day: date | str) -> DataFrame:
    """The rows of a day's snapshot, with its columns and types, whatever became of the table since."""
    with paths.step(snapshot_files(spark, root, day)) as files:
        lost = files.where("not found")
        names = [f"{r.folder}/{r.file}" for r in lost.limit(SHOWN).collect()]
        if names:
            raise QualityError(f"{lost.count()} files of the snapshot of {day} are lost, for example {names}")
        first = files.first()
        places = [(r.version, r.folder, r.file) for r in files.select("version", "folder", "file").collect()]
    schema = T.StructType.fromJson(json.loads(first.schema))
    kept = [f"{v}/{d}/{f}".replace("//", "/") for v, d, f in places if v is not None]
    live = [f"{d}/{f}".lstrip("/") for v, d, f in places if v is None]
    frames = []
    if live:
        frames.append(read_folders(spark, first.table, live, schema))
    if kept:
        frames.append(read_folders(spark, f"{root}/kept", kept, schema).select(*schema.names))
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def copy_snapshot(spark: SparkSession, root: str, day: date | str, target: str) -> DataFrame:
    """Write out all rows of a snapshot as a table of its own."""
    read_snapshot(spark, root, day).write.parquet(target)
    return spark.read.parquet(target)


def snapshot_days(spark: SparkSession, root: str) -> list[str]:
    """Days with a snapshot, as ``yyyymmdd``."""
    prefix = "snapshot_ds="
    return [n[len(prefix):] for n in paths.child_folders(spark, f"{root}/manifest") if n.startswith(prefix)]


def drop_snapshots(spark: SparkSession, root: str, today: date | str, keep_days: int = 7) -> list[str]:
    """Delete the snapshots older than ``keep_days``, and the kept folders that no other one refers to."""
    limit = (date.fromisoformat(str(today)) - timedelta(days=keep_days)).strftime("%Y%m%d")
    gone = sorted(d for d in snapshot_days(spark, root) if d.isdigit() and d < limit)
    for day in gone:
        paths.delete(spark, f"{root}/manifest/snapshot_ds={day}")
    kept = _kept_files(spark, root)
    listed = _manifests(spark, root)
    key = ["folder", "file", "length"]
    if gone and listed is not None:
        # A folder stays with all its files while one of them is asked for.
        asked = kept.join(listed.select(*key).distinct(), key, "left_semi").select("version", "folder").distinct()
        kept = kept.join(asked, ["version", "folder"], "left_anti")
    if gone:
        for r in kept.select("version", "folder").distinct().collect():
            paths.delete(spark, f"{root}/kept/{r.version}/{r.folder}".rstrip("/"))
    return gone
