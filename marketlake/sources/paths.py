"""Listing, moving and deleting through Hadoop's file system, on any storage Spark reads."""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import path_date
from ..session import new_folder, stored


def _path(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def quoted(name: str) -> str:
    """A name as SQL takes it, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def qualified(spark: SparkSession, path: str) -> str:
    """The path as listings and file metadata spell it."""
    fs, p = _path(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def plain_path(c: Column) -> Column:
    """A path of file metadata without its percent codes."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def folder_value(folder: Column, name: str) -> Column:
    """Text value of the partition column ``name`` in a folder such as ``year=2024/quarter=1``."""
    found = plain_path(F.regexp_extract(folder, f"(?:^|/){re.escape(name)}=([^/]*)", 1))
    return F.nullif(found, F.lit("__HIVE_DEFAULT_PARTITION__")).alias(name)


def aside(path: str, word: str) -> str:
    """Sibling of ``path`` that folder listings skip."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{word}-{name}"


def exists(spark: SparkSession, path: str) -> bool:
    """Is the folder there? One that a dead job left moved aside is put back first."""
    fs, p = _path(spark, path)
    if fs.exists(p):
        return True
    _, old = _path(spark, aside(path, "old"))
    return fs.exists(old) and fs.rename(old, p)


def has_data(spark: SparkSession, path: str) -> bool:
    """Does the folder hold a file that Spark would read? A table just created has none."""
    if not exists(spark, path):
        return False
    fs, p = _path(spark, path)
    root = fs.makeQualified(p).toString().rstrip("/")
    files = fs.listFiles(p, True)
    while files.hasNext():
        below = files.next().getPath().toString()[len(root) + 1 :].split("/")
        if not any(part.startswith((".", "_")) for part in below):
            return True
    return False


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, in order."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def unused(spark: SparkSession, folder: str, name: str) -> str:
    """A partition folder ``name=<id>`` that no other run has used."""
    return f"{folder.rstrip('/')}/{name}={uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.delete(p, True)


@contextmanager
def step(df: DataFrame) -> Iterator[DataFrame]:
    """``session.materialize`` for use within a block; the folder goes at its end."""
    spark = df.sparkSession
    path = new_folder(spark, "step")
    try:
        yield stored(df, path)
    finally:
        delete(spark, path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the parent of ``target`` is made, and ``target`` must not be there."""
    fs, old = _path(spark, source)
    _, new = _path(spark, target)
    fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def delete_files(spark: SparkSession, folder: str, files: Sequence[str]) -> None:
    """Delete those of ``files`` that lie directly in ``folder``; all at once if it holds nothing else."""
    fs, p = _path(spark, folder)
    if not fs.exists(p):
        return
    named = {f.rsplit("/", 1)[1] for f in files if f.rsplit("/", 1)[0] == folder}
    there = {s.getPath().getName() for s in fs.listStatus(p)}
    if all(name in named or name.startswith((".", "_")) for name in there):
        fs.delete(p, True)
        return
    for name in sorted(there & named):
        delete(spark, f"{folder}/{name}")


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _path(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def _marker(table: str) -> str:
    return f"{aside(table, 'snapshots')}/root"


def keep_replaced(spark: SparkSession, table: str, root: str, newest: int | None = None) -> None:
    """From now on loads keep the folders they replace in ``root``, for snapshots to refer to.

    ``newest`` is the time of the newest file that a snapshot refers to; a folder with newer files alone need not be
    kept. While it is None all are.
    """
    known = snapshot_root(spark, table)
    if known is not None and known[0] != root:
        raise ValueError(f"the snapshots of {table} are under {known[0]}")
    write_text(spark, _marker(table), f"{'' if newest is None else newest}\n{root}")


def snapshot_root(spark: SparkSession, table: str) -> tuple[str, int | None] | None:
    """Where the folders go that loads replace, and the newest time referred to; None without snapshots."""
    text = read_text(spark, _marker(table))
    if text is None:
        return None
    newest, root = text.split("\n", 1)
    return root, int(newest) if newest else None


def discard(spark: SparkSession, folder: str, table: str, below: str = "", version: str = "") -> None:
    """Delete a folder that a load has replaced, or keep it where a snapshot of ``table`` may refer to it.

    ``below`` is the folder's place in the table, ``version`` names the load.
    """
    fs, old = _path(spark, folder)
    if not fs.exists(old):
        return
    kept = snapshot_root(spark, table)
    if kept is not None:
        root, newest = kept
        files = [s for s in fs.listStatus(old) if not s.getPath().getName().startswith(("_", "."))]
        if newest is None or any(s.isDirectory() or s.getModificationTime() <= newest for s in files):
            _, place = _path(spark, f"{root}/kept/version={version or uuid.uuid4().hex}/{below.strip('/')}".rstrip("/"))
            fs.mkdirs(place.getParent())
            if not fs.rename(old, place):
                raise OSError(f"cannot keep {folder}")
            return
    fs.delete(old, True)


def _partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    names = [""]
    for _ in range(depth):
        names = [f"{n}/{c}" for n in names for c in child_folders(spark, path + n) if "=" in c]
    return names


def swap_partitions(spark: SparkSession, staged: str, target: str, depth: int) -> None:
    """Put the partition folders of a completely written table in the place of those of ``target``.

    One rename says that the new folders are complete; from then on they only have to be moved, and
    ``finish_swap`` does what a dead job left, so no row is lost at any moment.
    """
    fs, ready = _path(spark, aside(target, "ready"))
    _, new = _path(spark, staged)
    fs.mkdirs(ready.getParent())
    if not fs.rename(new, ready):
        raise OSError(f"cannot move {staged}")
    finish_swap(spark, target, depth)


COMMIT = "_commit"  # in a written folder: what is published with the partitions it replaces


def add_log(spark: SparkSession, staged: str, rows: DataFrame, log: str) -> None:
    """Have ``rows`` added to the table ``log`` when the folder ``staged`` is published."""
    rows.write.parquet(f"{staged}/{COMMIT}/log")
    write_text(spark, f"{staged}/{COMMIT}/log_path", log)


def _move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move all data files to the same places below ``target``; those that are there already were moved before."""
    fs, root = _path(spark, source)
    if not fs.exists(root):
        return
    prefix = len(qualified(spark, source)) + 1
    found, files = fs.listFiles(root, True), []
    while found.hasNext():
        files.append(found.next().getPath())
    for file in files:
        below = file.toString()[prefix:]
        if any(part.startswith(("_", ".")) for part in below.split("/")):
            continue
        _, place = _path(spark, f"{target}/{below}")
        fs.mkdirs(place.getParent())
        if not fs.exists(place) and not fs.rename(file, place):
            raise OSError(f"cannot move {file.toString()}")


def finish_swap(spark: SparkSession, target: str, depth: int) -> None:
    """Publish what an interrupted ``swap_partitions`` left; nothing to do in most cases.

    Partition folders take the place of the old ones, rows to be appended and entries of a log go to their tables.
    Every step can be done twice, so whoever comes next brings the whole load to its end.
    """
    ready = aside(target, "ready")
    fs, root = _path(spark, ready)
    if not fs.exists(root):
        return
    version = uuid.uuid4().hex
    for name in _partition_folders(spark, ready, depth) if depth else []:
        _, new = _path(spark, ready + name)
        _, place = _path(spark, target + name)
        discard(spark, target + name, target, name, version)
        fs.mkdirs(place.getParent())
        if not fs.rename(new, place):
            raise OSError(f"cannot move {ready}{name}")
    commit = f"{ready}/{COMMIT}"
    _, whole = _path(spark, f"{commit}/whole")
    if fs.exists(whole):
        replace_folder(spark, f"{commit}/whole", target)
    _move_files(spark, f"{commit}/append", target)
    log = read_text(spark, f"{commit}/log_path")
    if log is not None:
        _move_files(spark, f"{commit}/log", log)
    fs.delete(root, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, over one that is there."""
    fs, place = _path(spark, path)
    fs.mkdirs(place.getParent())
    out = fs.create(place, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """Text of a small file; None if it is not there."""
    fs, place = _path(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)
    finally:
        stream.close()
    return bytes(b & 0xFF for b in text).decode()


class Busy(RuntimeError):
    """Another job holds the lock."""


def _take(spark: SparkSession, path: str, owner: str) -> bool:
    """Put up the lock, unless there is one: a folder that holds a file is not replaced by a rename."""
    mine = f"{path}-{owner}"
    write_text(spark, f"{mine}/owner", owner)
    fs, source = _path(spark, mine)
    _, place = _path(spark, path)
    if not fs.exists(place):
        fs.rename(source, place)
    if read_text(spark, f"{path}/owner") == owner:
        return True
    fs.delete(source, True)
    delete(spark, f"{path}/{mine.rsplit('/', 1)[1]}")  # storage may have moved it into the other's
    return False


def _release_dead(spark: SparkSession, path: str, lease: float) -> bool:
    """Remove a lock that was not renewed for ``lease`` seconds."""
    fs, file = _path(spark, f"{path}/owner")
    try:
        owner = read_text(spark, f"{path}/owner")
        age = time.time() - fs.getFileStatus(file).getModificationTime() / 1000
    except Py4JJavaError:  # released since
        return True
    if age <= lease:
        return False
    gone = f"{path}-{uuid.uuid4().hex}"
    _, place = _path(spark, path)
    _, away = _path(spark, gone)
    if fs.rename(place, away):
        if read_text(spark, f"{gone}/owner") != owner:  # another job was faster, and this is its lock
            fs.rename(away, place)
            return False
        fs.delete(away, True)
    return True


@contextmanager
def lock(spark: SparkSession, path: str, wait: float = 0, lease: float = 600) -> Iterator[None]:
    """Hold the lock ``path`` while the block runs; ``Busy`` if another job keeps it for ``wait`` seconds.

    The holder renews it. One that was not renewed for ``lease`` seconds is that of a dead job and is taken over.
    Needs storage that renames a folder in one step, as HDFS and local disks do.
    """
    owner, until = uuid.uuid4().hex, time.monotonic() + wait
    while not _take(spark, path, owner):
        if _release_dead(spark, path, lease):
            continue
        if time.monotonic() >= until:
            raise Busy(f"another job holds {path}")
        time.sleep(min(0.5, max(0.0, until - time.monotonic())))
    fs, file = _path(spark, f"{path}/owner")
    done = threading.Event()

    def renew() -> None:
        while not done.wait(lease / 4):
            fs.setTimes(file, int(time.time() * 1000), -1)

    renewing = threading.Thread(target=renew, daemon=True)
    renewing.start()
    try:
        yield
    finally:
        done.set()
        renewing.join()
        if read_text(spark, f"{path}/owner") == owner:
            delete(spark, path)


def replace_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Put a completely written folder in the place of ``target``.

    Readers see the old folder or the new one, apart from the moment between two renames;
    if the job dies there, ``exists`` puts the old one back.
    """
    fs, old = _path(spark, aside(target, "old"))
    _, new = _path(spark, staged)
    _, place = _path(spark, target)
    if exists(spark, target):
        discard(spark, aside(target, "old"), target)
        if not fs.rename(place, old):
            raise OSError(f"cannot move {target} aside")
    else:
        fs.mkdirs(place.getParent())
    if not fs.rename(new, place):
        raise OSError(f"cannot move {staged} to {target}")
    discard(spark, aside(target, "old"), target)


def lake_files(spark: SparkSession, root: str) -> DataFrame:
    """``path`` and ``ds`` of every file below ``root``; contents are not read.

    Names starting with ``_`` or ``.`` are skipped, and so archives under ``_archive``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    below = F.substring_index("path", root.split(":", 1)[-1].rstrip("/") + "/", -1)
    return files.select("path").withColumn("ds", path_date(below))
