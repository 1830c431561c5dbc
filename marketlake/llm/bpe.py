"""Byte-level BPE in whole Arrow batches: boundaries by a scan of transition functions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import query, table
from .kernels import PrimeHasher, by_size, utf8
from .packing import byte_ranks, read_file

# Classes of code points, with what the next one says already taken in.
LETTER, NUMBER, OTHER, SHORT, LONG, BLANK, LEAD, BREAK = range(8)
FIRST = 8  # added to the class of a text's first code point
# States after a code point.
DONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_LEAD, IN_BLANKS, ONE_MORE, TWO_MORE = range(8)
COLUMNS = 64  # code points of a block of the scan
CACHE = 1 << 20  # slices remembered by a task


def code_point_classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or BLANK for each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    points = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\p{White_Space}+")):
        for found in regex.finditer(pattern, points):
            shift = [0x800 if i >= 0xD800 else 0 for i in (found.start(), found.end() - 1)]
            out[found.start() + shift[0] : found.end() + shift[1]] = kind
    out[0xD800:0xE000] = OTHER
    return out


def _tables() -> tuple[bytes, bytes]:
    """Next state, and whether a slice starts, by class * 8 + state."""
    step, starts = bytearray(256), bytearray(256)
    for kind in range(16):
        for state in range(8):
            was = state if kind < FIRST else DONE
            now = kind % FIRST
            new, edge = DONE, True
            if now == LETTER:
                new, edge = {ONE_MORE: (DONE, False), TWO_MORE: (ONE_MORE, False), IN_LETTERS: (IN_LETTERS, False), AFTER_LEAD: (IN_LETTERS, False)}.get(was, (IN_LETTERS, True))
            elif now == NUMBER:
                new, edge = IN_NUMBERS, was not in (IN_NUMBERS, AFTER_LEAD)
            elif now in (OTHER, SHORT, LONG):
                edge = was not in (IN_OTHERS, AFTER_LEAD)
                new = {SHORT: ONE_MORE, LONG: TWO_MORE}.get(now, IN_OTHERS) if edge else IN_OTHERS
            elif now == BLANK:
                new, edge = IN_BLANKS, was != IN_BLANKS
            elif now == LEAD:
                new = AFTER_LEAD
            step[kind * 8 + state], starts[kind * 8 + state] = new, edge
    return bytes(step), bytes(starts)


STEP_TABLE, START_TABLE = _tables()


def _look_up(index: np.ndarray, table_: bytes) -> np.ndarray:
    return np.frombuffer(index.tobytes().translate(table_), np.uint8).reshape(index.shape)


def slice_starts(points: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """True where a slice of the pre-tokenising pattern starts.

    ``points`` are the code points of several texts in a row, ``first`` is true at each text's
    first. A code point maps the state before it to the state after it; these maps are composed
    within blocks, then over blocks by doubling, and last applied.
    """
    n = len(points)
    kind = classes[points]
    last = np.append(first[1:], True)
    next_kind = np.append(kind[1:], BLANK)
    next_kind[last] = BLANK
    blank = kind == BLANK
    before_text = blank & (next_kind != BLANK)
    kind[before_text] = np.where(points[before_text] == 0x20, LEAD, BREAK)
    for i in np.flatnonzero((points == 0x27) & ~last):
        one = chr(points[i + 1])
        if one in "stmd":
            kind[i] = SHORT
        elif one in "rvl" and not last[i + 1] and one + chr(points[i + 2]) in ("re", "ve", "ll"):
            kind[i] = LONG
    kind[first] += FIRST
    blocks = -(-n // COLUMNS)
    columns = np.full(blocks * COLUMNS, BLANK, np.uint8)
    columns[:n] = kind
    columns = np.ascontiguousarray(columns.reshape(blocks, COLUMNS).T) << 3
    maps = np.tile(np.arange(8, dtype=np.uint8), (blocks, 1))
    for column in columns:
        maps = _look_up(column[:, None] | maps, STEP_TABLE)
    before, shift = maps.copy(), 1
    while shift < blocks:
        before[shift:] = np.take_along_axis(before[shift:], before[:-shift], 1)
        shift *= 2
    state = np.zeros(blocks, np.uint8)
    state[1:] = before[:-1, DONE]
    out = np.empty((COLUMNS, blocks), np.uint8)
    for j, column in enumerate(columns):
        index = column | state
        out[j] = _look_up(index, START_TABLE)
        state = _look_up(index, STEP_TABLE)
    return out.T.ravel()[:n].astype(bool)


class Merger:
    """Merges the bytes of many slices at once by the ranks of their pairs."""

    NONE = np.int64(1) << 40

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], self.NONE)

    def __call__(self, slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all slices in a row, and how many each has; a slice that is a token is that token."""
        known = np.array([self.ranks.get(piece, -1) for piece in slices], np.int64)
        whole, left = np.flatnonzero(known >= 0), np.flatnonzero(known < 0).tolist()
        done_ids, done_owners = [known[whole]], [whole]
        owner = np.repeat(np.array(left, np.int64), [len(slices[i]) for i in left])
        ids = self.single[np.frombuffer(b"".join(slices[i] for i in left), np.uint8)]
        rank = self._ranks_at(ids, owner, np.arange(len(ids)))
        while len(ids):
            heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.minimum.reduceat(rank, heads)
            low = np.repeat(least, np.diff(np.append(heads, len(ids))))
            stay = low != self.NONE
            if not stay.all():
                done_ids.append(ids[~stay])
                done_owners.append(owner[~stay])
                ids, owner, rank, low = ids[stay], owner[stay], rank[stay], low[stay]
                if not len(ids):
                    break
            at = self._chosen(ids, owner, rank, low)
            ids[at] = low[at]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, owner, rank = ids[stay], owner[stay], rank[stay]
            at = at - np.arange(len(at))  # each merge before it took one place
            for places in (at, at[at > 0] - 1):
                rank[places] = self._ranks_at(ids, owner, places)
        owners = np.concatenate(done_owners)
        order = np.argsort(owners, kind="stable")
        return np.concatenate(done_ids)[order].astype(np.int32), np.bincount(owners, minlength=len(slices))

    def _ranks_at(self, ids: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pair at each of the places; NONE at a slice's end."""
        after = np.minimum(at + 1, len(ids) - 1)
        inside = (at + 1 < len(ids)) & (owner[at] == owner[after])
        return np.where(inside, self.rank(ids[at], ids[after]), self.NONE)

    def _chosen(self, ids: np.ndarray, owner: np.ndarray, rank: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Places to merge now, as one merge after the other from the left would.

        All places of a slice's lowest rank that do not overlap, unless a merge makes a pair of
        lower rank, which would come before the others: then the leftmost alone.
        """
        at = np.flatnonzero(rank == low)
        apart = np.append(True, (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]]))
        begin = np.maximum.accumulate(np.where(apart, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - begin) % 2 == 0]
        same = owner[at[1:]] == owner[at[:-1]]
        if not same.any():
            return at
        many = np.append(same, False) | np.append(False, same)
        test = at[many]
        made, who = low[test], owner[test]
        before, after = np.maximum(test - 1, 0), np.minimum(test + 2, len(ids) - 1)
        lower = (owner[before] == who) & (test > 0) & (self.rank(ids[before], made) < made)
        lower |= (owner[after] == who) & (test + 2 < len(ids)) & (self.rank(made, ids[after]) < made)
        lower |= self.rank(made, made) < made
        if lower.any():
            slow = np.isin(owner[at], who[lower])
            at = at[~slow | np.append(True, owner[at[1:]] != owner[at[:-1]])]
        return at


class BatchEncoder:
    """Ids of all texts of a batch; slices seen before come from a cache."""

    def __init__(self, path: str) -> None:
        ranks = byte_ranks(read_file(path))
        self.merge, self.hash, self.classes = Merger(ranks), PrimeHasher(), code_point_classes()
        self.forget()

    def forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.ids, self.starts, self.filled = np.empty(1 << 16, np.int32), [0], 0

    def _store(self, new: np.ndarray, counts: np.ndarray) -> None:
        while self.filled + len(new) > len(self.ids):
            self.ids = np.append(self.ids, np.empty_like(self.ids))
        self.ids[self.filled : self.filled + len(new)] = new
        self.starts += (self.filled + np.cumsum(counts)).tolist()
        self.filled += len(new)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, offsets of the texts in them, and byte starts and id counts of the slices."""
        none = np.zeros(0, np.int64)
        if not len(data):
            return none.astype(np.int32), np.zeros(len(offsets), np.int64), none, none
        places = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        first = np.zeros(len(points), bool)
        first[np.searchsorted(places, offsets[:-1][offsets[:-1] < offsets[1:]])] = True
        starts = places[slice_starts(points, first, self.classes)]
        ends = np.append(starts[1:], len(data))
        keys, example, which = np.unique(self.hash(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.slot) > CACHE:
            self.forget()
        keys = keys.tolist()
        new = [i for i, key in enumerate(keys) if key not in self.slot]
        if new:
            raw, cuts = data.tobytes(), zip(starts[example[new]].tolist(), ends[example[new]].tolist())
            self._store(*self.merge([raw[a:b] for a, b in cuts]))
            self.slot.update(zip([keys[i] for i in new], range(len(self.slot), len(self.slot) + len(new))))
        bounds = np.array(self.starts)
        slots = np.array([self.slot[key] for key in keys])[which]
        counts = bounds[slots + 1] - bounds[slots]
        ends_ = np.cumsum(counts)
        ids = self.ids[np.arange(ends_[-1]) + np.repeat(bounds[slots] - (ends_ - counts), counts)]
        text_bounds = np.append(0, ends_)[np.searchsorted(starts, offsets)]
        return ids, text_bounds, starts, counts


def encode(docs: DataFrame, tokenizer: str | None = None, offsets: bool = False) -> DataFrame:
    """``doc_id, ids`` of every whole text by the rank file ``tokenizer``, without special tokens.

    With ``offsets`` also ``slice_starts`` (byte offset of each slice of the pre-tokenising pattern) and
    ``slice_ids`` (its number of ids), which map ids back to places in the text. A null or empty text has no ids;
    null doc_ids, repeated rows and an empty table pass through; other columns are ignored.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = BatchEncoder(path)
        for batch in by_size(batches, "text", 1 << 21):
            data, bounds = utf8(batch.column("text"))
            ids, found, starts, counts = coder(data, bounds)
            columns = [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(found.astype(np.int32)), pa.array(ids))]
            if offsets:
                row = np.searchsorted(starts, bounds)
                inside = starts - np.repeat(bounds[:-1], np.diff(row))
                lists = pa.array(row.astype(np.int32))
                columns += [pa.ListArray.from_arrays(lists, pa.array(x.astype(np.int32))) for x in (inside, counts)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "slice_starts", "slice_ids"][: len(columns)])

    schema = "doc_id long, ids array<int>" + ", slice_starts array<int>, slice_ids array<int>" * offsets
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def decode(rows: DataFrame, tokenizer: str | None = None, ids: str = "ids") -> DataFrame:
    """``rows`` with column ``decoded`` (binary), the bytes of ``ids``, in its place; null for null."""
    path = tokenizer or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    others = [c for c in rows.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = byte_ranks(read_file(path))
        token = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            token[rank] = piece
        for batch in batches:
            texts = [None if x is None else b"".join([token[i] for i in x]) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(texts, pa.binary())], [*others, "decoded"])

    kinds = [f.simpleString() for f in rows.select(*others).schema.fields]
    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {k.split(':', 1)[1]}" for c, k in zip(others, kinds)), "decoded binary"]))


@query("op10_bpe_round_trip")
def op10(spark, sf_dir):
    coded = encode(table(spark, sf_dir, "documents"))
    told = coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        "ids",
    )
    return decode(told).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")
