"""Packing documents into training windows by best-fit decreasing."""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .base import query, table
from .kernels import by_size

WINDOW = 2048
END_ID = 1
GROUP = 1 << 21  # tokens packed together; bounds a task's memory
MIN_PIECE = 16  # gaps below this are padded, not filled by a cut


class OpenWindows:
    """Windows by remaining capacity; a segment tree finds the tightest that still fits."""

    def __init__(self, window: int) -> None:
        self.size = 1 << window.bit_length()
        self.tree = [0] * (2 * self.size)  # windows below each node
        self.by_room: list[list[int]] = [[] for _ in range(window + 1)]

    def _count(self, room: int, change: int) -> None:
        node = room + self.size
        while node:
            self.tree[node] += change
            node >>= 1

    def put(self, number: int, room: int) -> None:
        self.by_room[room].append(number)
        self._count(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """A window with the least room of at least ``need``, and that room."""
        node = need + self.size
        tree = self.tree
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not tree[node]:
                    node += 1
        room = node - self.size
        self._count(room, -1)
        return self.by_room[room].pop(), room


Piece = tuple[int, int, int]  # document, start, length


def best_fit_decreasing(pieces: list[Piece], window: int) -> list[list[Piece]]:
    """Windows of whole pieces; longest first, each into the tightest open window."""
    windows: list[list[Piece]] = []
    tree = OpenWindows(window)
    for piece in sorted(pieces, key=lambda p: (-p[2], p[0], p[1])):
        found = tree.take(piece[2])
        if found is None:
            found = len(windows), window
            windows.append([])
        windows[found[0]].append(piece)
        if found[1] > piece[2]:
            tree.put(found[0], found[1] - piece[2])
    return windows


def fill_gaps(windows: list[list[Piece]], window: int, least: int) -> list[list[Piece]]:
    """Cut pieces of the emptiest windows into the gaps of the fullest.

    At the end one window is partly full, and the others have gaps below ``least``. The partly
    full one is cut at powers of two, where sequences need no padding.
    """
    open_ = sorted(windows, key=lambda w: -sum(p[2] for p in w))
    i, j = 0, len(open_) - 1
    room = window - sum(p[2] for p in open_[0]) if open_ else 0
    while i < j:
        if room < least:
            i += 1
            room = window - sum(p[2] for p in open_[i])
            continue
        if not open_[j]:
            j -= 1
            continue
        doc, start, length = open_[j].pop()
        if length > room:
            open_[j].append((doc, start + room, length - room))
            length = room
        open_[i].append((doc, start, length))
        room -= length
    out = [w for w in open_ if w]
    if not out:
        return out
    last = min(out, key=lambda w: sum(p[2] for p in w))
    fill = sum(p[2] for p in last)
    if window - fill < least:
        return out
    out.remove(last)
    while fill:
        size = 1 << (fill.bit_length() - 1)
        fill -= size
        part: list[Piece] = []
        while size:
            doc, start, length = last.pop()
            if length > size:
                last.append((doc, start + size, length - size))
                length = size
            part.append((doc, start, length))
            size -= length
        out.append(part)
    return out


def pack_group(lengths: list[int], window: int, least: int) -> list[list[Piece]]:
    """Windows for documents of these lengths: full windows are cut off long documents first."""
    full, rest = [], []
    for doc, length in enumerate(lengths):
        whole = length // window * window
        full += [[(doc, at, window)] for at in range(0, whole, window)]
        if length > whole:
            rest.append((doc, whole, length - whole))
    return full + fill_gaps(best_fit_decreasing(rest, window), window, least)


def byte_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}


def read_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """The ids of ``tokenizers`` for the byte-level BPE at ``path`` (JSON), as 32-bit integers.

    Made by the same vocabulary's ranks in the file beside it, which tiktoken runs five times
    faster; the JSON file's added tokens are found first, as the library does. A file whose added tokens
    take in spaces, need word bounds or begin one another is left to the library, for the texts that hold one.
    """
    ranks = byte_ranks(read_file(os.path.splitext(path)[0] + ".tiktoken"))
    coding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    added = json.loads(read_file(path)).get("added_tokens") or []
    ids = {t["content"]: t["id"] for t in added if t["content"]}
    found = re.compile("|".join(map(re.escape, ids)) or "(?!)")
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
    nested = any(a != b and b.startswith(a) for a in ids for b in ids)
    library = None if plain and not nested else Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        if not found.search(text):
            return np.array(coding.encode_ordinary(text), "<u4")
        if library is not None:
            return np.array(library.encode(text, add_special_tokens=False).ids, "<u4")
        out: list[int] = []
        at = 0
        for token in found.finditer(text):
            out += coding.encode_ordinary(text[at : token.start()])
            out.append(ids[token[0]])
            at = token.end()
        return np.array(out + coding.encode_ordinary(text[at:]), "<u4")

    return encode


OUT = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _pack_task(batches: Iterator[pa.RecordBatch], encode, window: int, end_id: int, least: int, group: int):
    task = TaskContext.get()
    sequence = (task.partitionId() if task else 0) << 33
    ids: list = []
    docs: list = []
    held = 0

    def flush():
        nonlocal sequence
        columns: list[list] = [[] for _ in range(7)]
        for pieces in pack_group([len(x) for x in ids], window, least):
            offset = 0
            for doc, start, length in pieces:
                row = docs[doc], start, length, ids[doc][start : start + length].tobytes(), len(ids[doc]), sequence, offset
                for column, value in zip(columns, row):
                    column.append(value)
                offset += length
            sequence += 1
        kinds = pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()
        names = [c.split()[0] for c in OUT.split(", ")]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        whole = pa.RecordBatch.from_arrays(arrays, names)
        for at in range(0, whole.num_rows, 1024):
            yield whole.slice(at, 1024)

    for batch in by_size(batches, "text"):
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids.append(np.append(encode(text or ""), np.uint32(end_id)).astype("<u4"))
            docs.append(doc)
            held += len(ids[-1])
            if held >= group:
                yield from flush()
                ids, docs, held = [], [], 0
    if ids:
        yield from flush()


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID,
         min_piece: int = MIN_PIECE) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) laid into sequences of at most ``window`` tokens.

    One row per piece: ``doc_id, start, length, ids`` (little-endian unsigned 32-bit),
    ``doc_tokens, sequence_id, offset``. Each task packs its own rows, about two million tokens at
    a time, so nothing is shuffled and memory does not grow with the input. Long documents give
    full windows first; what is left goes by best-fit decreasing; then pieces of the emptiest
    windows are cut into gaps of ``min_piece`` or more. A null or empty text is a document of the end
    id alone; a null doc_id stays null; repeated rows are packed each; other columns are ignored;
    an empty table gives no rows.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches):
        return _pack_task(batches, encoder(path), window, end_id, min_piece, GROUP)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, OUT)


@query("op4_pack_best_fit")
def op4(spark, sf_dir):
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
