"""Rows that a stream delivers again are dropped by what the stream remembers, without reading the target.

The first row of a key is passed on and the key remembered for a time; later rows of it are dropped. The memory is Spark's
keyed state, spread over the tasks by key and kept with the stream's checkpoint.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.columns import order_columns
from .ingest import read_csv_stream

# Ship the code below with the query: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Order = list[tuple[str, bool]]  # columns and whether they fall


STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # With state that expires Spark else runs batch after batch without new data, and a run never ends.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def _order(order_by: Sequence[str]) -> Order:
    return [(name.removeprefix("-"), name.startswith("-")) for name in order_by]


def _first_of_batch(batch: pa.RecordBatch, keys: Sequence[str], order: Order) -> pa.RecordBatch:
    """The first row of each key in a batch, so that a hot key sends a row per batch to its task."""
    if not batch.num_rows:
        return batch
    table = pa.table({**{k: batch.column(k) for k in keys}})
    sort: list[tuple[str, str]] = []
    columns: dict[str, pa.Array] = {}
    for i, (name, falls) in enumerate(order):
        direction = "descending" if falls else "ascending"
        columns |= {f"valid{i}": pc.cast(batch.column(name).is_valid(), pa.int8()), f"value{i}": batch.column(name)}
        sort += [(f"valid{i}", direction), (f"value{i}", direction)]
    places = pc.sort_indices(pa.table(columns), sort_keys=sort) if sort else pa.array(range(batch.num_rows))
    ranked = table.take(places).append_column("_place", pa.array(range(batch.num_rows)))
    firsts = ranked.group_by(list(keys)).aggregate([("_place", "min")]).column("_place_min")
    return batch.take(places.take(firsts.combine_chunks()))


def _precedes(a: Row, b: Row, order: Order) -> bool:
    """Is ``a`` before ``b``? Nulls are lowest."""
    for name, falls in order:
        x, y = ((r[name] is not None, r[name]) for r in (a, b))
        if x != y:
            lower = x[0] < y[0] if x[0] != y[0] else x[1] < y[1]
            return lower != falls
    return False


class FirstOfKey(StatefulProcessor):
    """Passes on the first row of a key, and none while the key is remembered."""

    def __init__(self, order: Order, remember_ms: int) -> None:
        self.order, self.remember_ms = order, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.remember_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        best = None
        for row in rows:
            if best is None or _precedes(row, best, self.order):
                best = row
        if best is not None and not self.seen.exists():
            self.seen.update((True,))
            yield best

    def close(self) -> None:
        pass


def first_of_key(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], remember_days: float) -> DataFrame:
    """Of a stream the first row of each key; later ones are dropped for the given days after it.

    Of the rows of a key in one micro-batch the first in ``order_by`` is passed on. A null in the key is a value like
    others. A task sends one row of a key per batch of rows; of these the key's task holds one at a time. The
    stream must run with ``STREAM_SETTINGS``, as ``ingest_once`` does.
    """
    order, keys, remember = _order(order_by), list(keys), int(remember_days * 86_400_000)
    if remember < 1:
        raise ValueError("a key must be remembered for a millisecond at least")

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _first_of_batch(batch, keys, order)

    processor = FirstOfKey(order, remember)
    grouped = rows.mapInArrow(thin, rows.schema).groupBy(*keys)
    return grouped.transformWithState(processor, rows.schema, "Append", "ProcessingTime")


def own_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session with all settings of the given one, and more that shall not touch it."""
    own = spark.newSession()
    for name, value in {**spark.conf.getAll, **settings}.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    return own


def ingest_once(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    remember_days: float = 30,
    multiline: bool = False,
    files_per_batch: int = 10_000,
) -> int:
    """Append the first row of each key in the CSV files new since the last call; returns the batches written.

    ``transform`` is applied to the stream, so it may only project and filter; it gets the rows with ``source_file``.
    Order columns starting with ``_`` are not stored. The target is never read: what was delivered before is known
    from the stream's state, for ``remember_days``. Each micro-batch writes a folder ``batch=<id>`` of the target, which a
    second run of the batch replaces.
    """
    own = own_session(spark, STREAM_SETTINGS)
    rows = transform(read_csv_stream(own, folder, schema, multiline, files_per_batch))
    first = first_of_key(rows, keys, order_by, remember_days)
    written = []

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.drop(*order_columns(batch)).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        written.append(batch_id)

    query = first.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    query.trigger(availableNow=True).start().awaitTermination()
    return len(written)
