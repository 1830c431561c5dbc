"""Table loads on plain Parquet: append, upsert, insert if absent, refresh, snapshots.

Plain Parquet tables have neither keys nor MERGE. A key is kept by de-duplicating the
source under an explicit order and joining it against the target.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import count_rows, counted
from ..sources import paths
from .columns import order_columns, with_audit
from .dedup import keep_first, keep_last
from .joins import without_match
from .quality import QualityError, assert_unique


Log = tuple[str, DataFrame]  # path of a table of log entries, and the entries of a load


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    location: str | None = None,
) -> DataFrame:
    """Create schema and table if missing; an existing one must have the same columns and types."""
    quoted = lambda text: "`" + text.replace("`", "``") + "`"
    name = ".".join(quoted(part.strip("`")) for part in name.split("."))
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    escaped = (location or "").replace("\\", "\\\\").replace("'", "\\'")
    place = f" LOCATION '{escaped}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{place}")
    table = spark.table(name)
    types = lambda s: sorted((f.name, f.dataType.simpleString()) for f in s.fields)
    if types(table.schema) != types(schema):
        raise ValueError(f"{name} exists with columns {types(table.schema)}")
    return table


def append_positional(df: DataFrame, table: str, run_ts: Any) -> None:
    """Append by column position, with the load time as last column."""
    with_audit(df, run_ts).write.insertInto(table)


def append_by_name(df: DataFrame, table: str) -> None:
    """Append by column name."""
    df.write.mode("append").saveAsTable(table)


def full_refresh(df: DataFrame, path: str, written: Callable[[str], None] | None = None) -> DataFrame:
    """Replace all rows of a dimension; written aside first, so ``df`` may read ``path``.

    ``written`` is called with the folder that holds them before it is moved.
    """
    spark = df.sparkSession
    staged = paths.aside(path, "staged")
    df.write.mode("overwrite").parquet(staged)
    if written is not None:
        written(staged)
    paths.replace_folder(spark, staged, path)
    return spark.read.parquet(path)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], rebalance: bool = True
) -> DataFrame:
    """Replace the partitions present in ``df``; others stay. Loading twice changes nothing.

    ``rebalance`` brings the rows of a partition together and splits large ones, for few
    files of good size. Rows that were just read from the same partitions need no such
    shuffle: each task writes back what it read. If the table has snapshots, the rows are written aside, and the
    folders they replace are kept for these.
    """
    if paths.snapshot_root(df.sparkSession, path) is not None:
        return swap_in(df, path, partition_by, rebalance)
    rows = df.hint("rebalance", *partition_by) if rebalance else df
    writer = rows.write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    spark = df.sparkSession
    return spark.read.parquet(path) if paths.has_data(spark, path) else df.limit(0)


def read_partitions(spark: SparkSession, path: str, partition_by: Sequence[str]) -> DataFrame:
    """A table to be written back: partition values as the text of their folders.

    With Spark's type inference the folder ``quarter=01`` would be read as 1 and written
    back to ``quarter=1``, next to the old one.
    """
    fields = [
        T.StructField(f.name, T.StringType()) if f.name in partition_by else f
        for f in spark.read.parquet(path).schema.fields
    ]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _as_target(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns and types of the target; absent columns are null, unknown ones an error."""
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"the target has no columns {unknown}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _partitioned(df: DataFrame, keys: Sequence[str], partition_by: Mapping[str, Column]) -> DataFrame:
    """Add the partition columns, which may be computed from key columns only.

    Otherwise an update could move a key to another partition and leave a copy behind.
    """
    df.select(*keys).select(*[c.alias(n) for n, c in partition_by.items()])
    # The empty text and null share a folder, so they must be one value.
    return df.withColumns({n: F.nullif(c.cast("string"), F.lit("")) for n, c in partition_by.items()})


def _with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, if all its keys are there: a null equals no key, so its row would pile up."""
    without = df.where(reduce(or_, [F.col(k).isNull() for k in keys])).count()
    if without:
        raise QualityError(f"{without} rows without a value in the key {list(keys)}")
    return df


def upsert(
    source: DataFrame,
    target: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    partition_by: Mapping[str, Column] | None = None,
    keep: str = "last",
    log: Log | None = None,
) -> DataFrame:
    """Insert the source rows; rows of the target with the same key are replaced.

    The source is reduced to one row per key, ``keep`` the first or last in ``order_by``.
    Order columns starting with ``_`` are not stored. Rows with a null in the key are refused.
    Only the partitions the source touches are read and rewritten; ``partition_by`` names them,
    each a function of the key. They are written aside and swapped in one by one, and without
    partitions the whole table is; a job that dies in between loses nothing (``paths.finish_swap``). The rows of
    ``log`` are published with them (see ``swap_in``).
    """
    spark = source.sparkSession
    parts = dict(partition_by or {})
    paths.finish_swap(spark, target, len(parts))
    pick = {"first": keep_first, "last": keep_last}[keep]
    single = pick(source, keys, order_by)
    single = single.drop(*order_columns(single))
    # Read three times below, and its input may be a stream's files.
    with paths.step(_partitioned(single, keys, parts) if parts else single) as incoming:
        _with_keys(incoming, keys)
        merged = incoming
        if paths.has_data(spark, target):
            current = read_partitions(spark, target, list(parts))
            if parts:
                # One value per partition folder, so no more than the file listing itself.
                touched = incoming.select(*parts).distinct().collect()
                if not touched:
                    _publish_log(spark, target, len(parts), log)
                    return spark.read.parquet(target)
                current = current.where(in_partitions(touched, list(parts)))
            # A stored table: Catalyst knows its size, and broadcasts the keys of a small one.
            kept = current.join(incoming.select(*keys), list(keys), "left_anti")
            merged = kept.unionByName(_as_target(incoming, current.schema))
        if parts or log is not None:
            return swap_in(merged, target, list(parts), log=log)
        return full_refresh(merged, target)


def _publish_log(spark: SparkSession, target: str, depth: int, log: Log | None) -> None:
    """The entries of a load that changes no row."""
    if log is not None:
        staged = paths.aside(target, "staged")
        paths.delete(spark, staged)
        paths.add_log(spark, staged, log[1], log[0])
        paths.swap_partitions(spark, staged, target, depth)


def swap_in(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str],
    rebalance: bool = True,
    written: Callable[[str], None] | None = None,
    log: Log | None = None,
) -> DataFrame:
    """``replace_partitions`` for rows read from the same table: written aside before any folder goes.

    ``written`` is called with the folder that holds them before they are moved. One rename then publishes the rows
    and the entries of ``log``; a job that dies before it leaves neither, one that dies after it leaves both to the
    next load.
    """
    spark = df.sparkSession
    staged = paths.aside(target, "staged")
    paths.delete(spark, staged)
    if partition_by:
        replace_partitions(df, staged, partition_by, rebalance)
    else:
        df.write.parquet(f"{staged}/{paths.COMMIT}/whole")
    if written is not None:
        written(staged)
    if log is not None:
        paths.add_log(spark, staged, log[1], log[0])
    paths.swap_partitions(spark, staged, target, len(partition_by))
    return spark.read.parquet(target)


def in_partitions(rows: Sequence, names: Sequence[str]) -> Column:
    """Condition that holds in the given partitions, and so prunes the other folders.

    A set of values for each name in turn, halves joined first, so that thousands of partitions make
    a condition a few levels deep.
    """
    name, *rest = names
    if not rest:
        values = [r[name] for r in rows]
        some = [v for v in values if v is not None]
        return reduce(or_, [F.col(name).isin(some)] * bool(some) + [F.col(name).isNull()] * (len(some) < len(values)))
    groups: dict[Any, list] = {}
    for r in rows:
        groups.setdefault(r[name], []).append(r)
    terms = [F.col(name).eqNullSafe(F.lit(v)) & in_partitions(g, rest) for v, g in groups.items()]
    while len(terms) > 1:
        terms = [reduce(or_, terms[i : i + 2]) for i in range(0, len(terms), 2)]
    return terms[0]


def insert_if_absent(
    source: DataFrame,
    target: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    partition_by: Mapping[str, Column] | None = None,
    log: Log | None = None,
) -> int:
    """Append source rows whose key the target lacks; returns how many.

    With ``log`` the rows are written aside and published with its entries (see ``swap_in``).

    Of several source rows with one key the first in ``order_by`` is taken; rows with a null in the
    key are refused. Of the target only the key columns are read, and only in the partitions the
    source touches, and of these the keys that the source has too.
    """
    spark = source.sparkSession
    parts = dict(partition_by or {})
    paths.finish_swap(spark, target, len(parts))
    single = keep_first(source, keys, order_by)
    single = single.drop(*order_columns(single))
    single = _partitioned(single, keys, parts) if parts else single
    there = paths.has_data(spark, target)
    current = read_partitions(spark, target, list(parts)) if there else None
    with paths.step(_as_target(single, current.schema) if there else single) as incoming:
        _with_keys(incoming, keys)
        if not there:
            return _append(incoming, target, parts, log)
        if parts:
            touched = incoming.select(*parts).distinct().collect()
            if not touched:
                _publish_log(spark, target, len(parts), log)
                return 0
            current = current.where(in_partitions(touched, list(parts)))
        known = current.select(*keys).join(incoming.select(*keys), list(keys), "left_semi")
        return _append(without_match(incoming, known, keys), target, parts, log)


def _append(df: DataFrame, target: str, parts: Mapping[str, Column], log: Log | None = None) -> int:
    spark = df.sparkSession
    rows, added = count_rows(df.hint("rebalance", *parts) if parts else df)
    if log is None:
        rows.write.mode("append").partitionBy(*parts).parquet(target)
        return counted(added)
    staged = paths.aside(target, "staged")
    paths.delete(spark, staged)
    rows.write.partitionBy(*parts).parquet(f"{staged}/{paths.COMMIT}/append")
    paths.add_log(spark, staged, log[1], log[0])
    paths.swap_partitions(spark, staged, target, len(parts))
    return counted(added)


def snapshot(df: DataFrame, root: str, day: date | str) -> int:
    """Copy of a table under ``snapshot_ds=<yyyymmdd>``, replacing one of the same day.

    An empty table is refused: it would replace a good snapshot of the same day.
    """
    name = str(day).replace("-", "")
    folder = f"{root}/snapshot_ds={name}"
    staged = paths.aside(folder, "staged")
    rows, copied = count_rows(df)
    rows.write.mode("overwrite").parquet(staged)
    if not counted(copied):
        paths.delete(df.sparkSession, staged)
        raise ValueError("no snapshot of an empty table")
    paths.replace_folder(df.sparkSession, staged, folder)
    return counted(copied)


def expired(snapshots: DataFrame, column: str, today: date | str, keep_days: int = 7) -> DataFrame:
    """Snapshots older than ``keep_days``; one exactly that old is kept."""
    limit = date.fromisoformat(str(today)) - timedelta(days=keep_days)
    return snapshots.where(F.col(column) < F.lit(limit.strftime("%Y%m%d")))


def expire_snapshots(spark: SparkSession, root: str, today: date | str, keep_days: int = 7) -> list[str]:
    """Delete expired snapshots; returns their dates."""
    prefix = "snapshot_ds="
    names = [n[len(prefix):] for n in paths.child_folders(spark, root) if n.startswith(prefix)]
    names = [n for n in names if n.isdigit()]
    if not names:
        return []
    listed = spark.createDataFrame([(n,) for n in names], "snapshot_ds string")
    gone = sorted(r[0] for r in expired(listed, "snapshot_ds", today, keep_days).collect())
    for name in gone:
        paths.delete(spark, f"{root}/{prefix}{name}")
    return gone


def refresh_mapping(mapping: DataFrame, path: str, key: str) -> DataFrame:
    """Full refresh of a mapping whose key must be unique."""
    return full_refresh(assert_unique(mapping, [key]), path)
