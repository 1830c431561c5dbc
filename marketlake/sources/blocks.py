"""Records of files that are cut anywhere, so that a file of any size is read by many tasks.

A reader that starts in the middle of a file cannot know whether it is inside quotes. But what a stretch of text does
to the state is a function of the state before it: for each of the two states, inside quotes or not, the state
after it and the change of depth. These functions compose, so one pass finds that of every block, their
composition in the order of the blocks gives the state in which each block starts, and a second pass cuts the blocks
into records. A record that crosses blocks is put together from its fragments, which are few.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

# Ship the code below with the query: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Step = Callable[[str, bool], tuple[bool, int]]


class Grammar(NamedTuple):
    """How text is cut. A piece ends at ``separator``; ``step`` gives the state after it and the change of depth.

    A record ends where a piece leaves no quotes and no bracket open. ``record`` takes the text of pieces up to there
    and returns the record, or None if they hold none. It also gets the file's ``trait``, a number that the first
    piece tells (None: look at the next one); with ``nested`` it is the depth at which records stand.
    """

    separator: str
    step: Step
    record: Callable[[str, int], str | None]
    trait: Callable[[str], int | None]
    nested: bool


def csv_step(line: str, inside: bool, mark: str = ',"') -> tuple[bool, int]:
    """Does the line end inside quotes? A quote counts at the start of a field, a doubled one within."""
    i = 0
    if not inside:
        if not line.startswith('"'):
            i = line.find(mark) + 1
            if not i:
                return False, 0
        i += 1
    while True:
        i = line.find('"', i)
        if i < 0:
            return True, 0
        if line.startswith('""', i):
            i += 2
            continue
        i = line.find(mark, i + 1)
        if i < 0:
            return False, 0
        i += 2


def _csv_record(text: str, crlf: int) -> str | None:
    """A line, without its end. In a file whose first line ends with CR and LF these become LF, as in Spark's reader."""
    text = text.removesuffix("\n").removesuffix("\r")
    return (text.replace("\r\n", "\n") if crlf else text) if text.strip() else None


STRING = re.compile(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', re.S)
STRING_END = re.compile(r'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.S)


def json_step(piece: str, inside: bool) -> tuple[bool, int]:
    """State after a piece and the bracket that ends it; brackets within strings don't count."""
    text = piece + "}"
    if inside:
        end = STRING_END.match(text)
        if end is None:
            return True, 0
        text = text[end.end() :]
    text = STRING.sub("", text) if '"' in text else text
    text, quote, _ = text.partition('"')
    return bool(quote), text.count("{") + text.count("[") - text.count("}") - text.count("]")


def _json_record(text: str, _: int) -> str | None:
    """From the first object bracket on; what stands before it separates elements, or is one that is no object."""
    at = 0
    while at < len(text):
        brace, quote = text.find("{", at), text.find('"', at)
        if brace < 0:
            return None
        string = STRING.match(text, quote) if 0 <= quote < brace else None
        if string is None:
            return text[brace:]
        at = string.end()
    return None


CSV = Grammar("\n", csv_step, _csv_record, lambda piece: int(piece.endswith("\r")), False)
JSON = Grammar("}", json_step, _json_record, lambda piece: int(piece.lstrip().startswith("[")) if piece.strip() else None, True)


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str]]]:
    """Runs of the rows of one block: all columns but the last, then the values of the last."""
    for batch in batches:
        heads = [c.to_pylist() for c in batch.columns[:-1]]
        values = batch.columns[-1].to_pylist()
        first = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or any(h[i] != h[first] for h in heads[:2]):
                yield tuple(h[first] for h in heads), values[first:i]
                first = i


def _summaries(grammar: Grammar, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block does to the state, from either state."""
    held: list = []

    def row(block: list) -> pa.RecordBatch:
        (file, start), (a, x), (b, y), trait = block
        return pa.RecordBatch.from_pylist([{"file": file, "start": start, "after0": a, "depth0": x, "after1": b, "depth1": y, "trait": trait}], SUMMARY)

    for key, pieces in _by_block(batches):
        if not held or held[0] != key:
            if held:
                yield row(held)
            held = [key, (False, 0), (True, 0), None]
        for piece in pieces:
            if key[1] == 0 and held[3] is None:
                piece = piece.removeprefix("\ufeff")
                held[3] = grammar.trait(piece)
            for i in (1, 2) if key[1] else (1,):  # a file starts outside of quotes
                inside, depth = held[i]
                inside, change = grammar.step(piece, inside)
                held[i] = inside, depth + change
    if held:
        yield row(held)


SUMMARY = pa.schema(
    [("file", pa.string()), ("start", pa.int64()), ("after0", pa.bool_()), ("depth0", pa.int64()), ("after1", pa.bool_()), ("depth1", pa.int64()), ("trait", pa.int64())]
)


def _starts(blocks: pd.DataFrame) -> pd.DataFrame:
    """State in which each block of a file starts: the composition of all before it."""
    blocks = blocks.sort_values("start")
    trait = int(blocks["trait"].dropna().max()) if blocks["trait"].notna().any() else 0
    inside, depth, out = False, 0, []
    for b in blocks.itertuples():
        out.append((b.file, b.start, inside, depth, trait))
        inside, depth = (bool(b.after1), depth + int(b.depth1)) if inside else (bool(b.after0), depth + int(b.depth0))
    return pd.DataFrame(out, columns=["file", "start", "inside", "depth", "trait"])


WHOLE, FIRST, LAST, MIDDLE = range(4)  # kinds of text: a record, or the beginning, the end or the inside of one


def _assemble(grammar: Grammar, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and fragments of each block: ``file, start, number, kind, text``; -1 is the number of a file's first.

    Fragments have the pieces' separators; a record is what ``grammar.record`` makes of its pieces.
    """
    block = None
    rows: dict[str, list] = {}

    def flush() -> pa.RecordBatch:
        made = pa.RecordBatch.from_pydict(rows, RECORDS)
        rows.update({n: [] for n in RECORDS.names})
        return made

    def add(kind: int, text: str | None) -> None:
        nonlocal number
        if text is None:
            return
        if number == -1 and block[1]:
            number = 0  # the first record of a file is in its first block
        for name, value in zip(RECORDS.names, (*block, number, kind, text)):
            rows[name].append(value)
        number += 1

    def close() -> None:
        if parts and (inside or depth > base):
            add(MIDDLE if continued else FIRST, "".join(parts))

    rows.update({n: [] for n in RECORDS.names})
    number, parts, inside, depth, base, trait, continued = -1, [], False, 0, 0, 0, False
    for (file, start, started, at, trait), pieces in _by_block(batches):
        if block != (file, start):
            if block is not None:
                close()
            block, number, parts = (file, start), -1, []
            if started is None:
                raise ValueError(f"no state is known of the block of {file} at {start}")
            inside, depth, base = started, at, trait if grammar.nested else 0
            continued = start > 0 and (inside or depth > base)
            if start == 0 and pieces:
                pieces[0] = pieces[0].removeprefix("\ufeff")
        for piece in pieces:
            inside, change = grammar.step(piece, inside)
            depth += change
            parts.append(piece + grammar.separator)
            if not inside and depth <= base:
                text = "".join(parts)
                if continued:
                    add(LAST, text)
                else:
                    add(WHOLE, grammar.record(text, trait))
                parts, continued = [], False
        if len(rows["text"]) >= 4096:
            yield flush()
    if block is not None:
        close()
    yield flush()


RECORDS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("number", pa.int64()), ("kind", pa.int32()), ("text", pa.string())])


def split_size(spark: SparkSession) -> int:
    """Files up to this size are read by one task whatever the cluster."""
    sizes = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    parse = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return min(parse(spark.conf.get(s)) for s in sizes)


def has_large_files(spark: SparkSession, path: str | list[str], recursive: bool = False) -> bool:
    """Is there a file that more than one task would read, if it could be cut?"""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    return files.columns == ["path", "modificationTime", "length", "content"] and not files.where(F.col("length") > split_size(spark)).isEmpty()


def _pieces(spark: SparkSession, path: str | list[str], separator: str, recursive: bool) -> DataFrame:
    """``file, start, value`` of the pieces of all files, each block in order.

    Read in a session of its own, where the number of executors doesn't change the places of the cuts.
    """
    own = spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    text = own.read.option("lineSep", separator).option("recursiveFileLookup", recursive).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def records(spark: SparkSession, path: str | list[str], grammar: Grammar, recursive: bool = False) -> DataFrame:
    """``file, start, number, text`` of every record: the block it starts in and its place there, -1 for a file's first.

    The text is read twice to find the states and the records that cross blocks, and a third time by whoever
    uses the result. States and fragments are a row or two per block; they stay in the shared folder.
    """
    pieces = _pieces(spark, path, grammar.separator, recursive)
    summaries = pieces.mapInArrow(lambda batches: _summaries(grammar, batches), "file string, start long, after0 boolean, depth0 long, after1 boolean, depth1 long, trait long")
    states = summaries.groupBy("file").applyInPandas(_starts, "file string, start long, inside boolean, depth long, trait long")
    states = materialize(states)
    known = pieces.join(F.broadcast(states), ["file", "start"], "left")  # a row per block: as large as the listing
    known = known.select("file", "start", "inside", "depth", "trait", "value")
    made = known.mapInArrow(lambda batches: _assemble(grammar, batches), "file string, start long, number long, kind int, text string")
    fragments = materialize(made.where(F.col("kind") != WHOLE))
    # A fragment belongs to the last block before it in which a record began that was not finished there.
    began = F.last(F.when(F.col("kind") == FIRST, F.col("start")), ignorenulls=True)
    order = Window.partitionBy("file").orderBy("start", F.col("kind") == FIRST)
    named = fragments.withColumn("origin", began.over(order))
    first = F.min(F.when(F.col("kind") == FIRST, F.col("number"))).alias("number")
    joined = named.groupBy("file", F.col("origin").alias("start")).agg(
        first, F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda p: p["text"]), "").alias("text")
    )
    joined = joined.join(F.broadcast(states.groupBy("file").agg(F.max("trait").alias("trait"))), "file")
    crossing = joined.mapInArrow(lambda batches: _finish(grammar, batches), "file string, start long, number long, text string")
    whole = made.where(F.col("kind") == WHOLE).select("file", "start", "number", "text")
    empty = spark.createDataFrame([], whole.schema)
    return empty.unionAll(whole).unionAll(crossing)  # a frame of the caller's session


def _finish(grammar: Grammar, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [grammar.record(t, trait) for t, trait in zip(batch.column("text").to_pylist(), batch.column("trait").to_pylist())]
        made = pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(texts, pa.string())], ["file", "start", "number", "text"])
        yield made.filter(made.column("text").is_valid())
