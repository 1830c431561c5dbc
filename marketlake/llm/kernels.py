"""Vectorised steps on Arrow batches that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes hashed at once; bounds the working memory, not the length of a text.
SEGMENT = 1 << 21
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; a null counts as the empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    n = len(column)
    ends = np.zeros(1, np.int64)
    if n:
        ends = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def by_size(batches: Iterator[pa.RecordBatch], column: str | int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` has about ``most`` bytes in each; a longer row stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if i > start and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        yield batch.slice(start)


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of bytes outside ``between``: space, tab, LF, VT, FF and CR."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~between[data]
    edge = np.ones(n, bool)
    edge[1:] = ~inside[:-1]
    edge[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(inside & edge)
    edge = np.ones(n, bool)
    edge[:-1] = ~inside[1:]
    edge[offsets[1:][offsets[1:] > 0] - 1] = True
    ends = np.flatnonzero(inside & edge) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


class SliceHasher:
    """64-bit hashes of byte slices, from prefix sums of a polynomial modulo 2^64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slices must be in ascending order of their starts and must not overlap."""
        return self.beginnings(data, starts, ends)[0]

    def beginnings(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, *sizes: int) -> list[np.ndarray]:
        """Hashes of the slices, and of their first bytes for each of ``sizes`` (all of a shorter slice)."""
        out = [np.empty(len(starts), U64) for _ in (None, *sizes)]
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, "right")))
            low, high = int(starts[i]), int(ends[j - 1])
            if len(self.up) < high - low + 1:
                self.up, self.down = _powers(BASE, high - low + 1), _powers(BASE_INVERSE, high - low + 1)
            sums = np.zeros(high - low + 1, U64)
            np.cumsum((data[low:high].astype(U64) + U64(1)) * self.up[: high - low], dtype=U64, out=sums[1:])
            s = starts[i:j] - low
            for found, size in zip(out, (None, *sizes)):
                e = ends[i:j] - low if size is None else np.minimum(ends[i:j] - low, s + size)
                found[i:j] = mix((sums[e] - sums[s]) * self.down[s] + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93))
            i = j
        return out


PRIMES = (2147483647, 2147483629)
BASES = (1640531513, 805459861)


class PrimeHasher:
    """62-bit hashes of byte slices, from prefix sums of polynomials modulo two primes.

    Modulo a power of two the two halves of certain regular texts would have one hash whatever the base; modulo a
    prime they have not.
    """

    def __init__(self) -> None:
        one = np.ones(1, U64)
        self.up, self.down = [one, one], [one, one]

    def _grow(self, n: int) -> None:
        for i, (prime, base) in enumerate(zip(PRIMES, BASES)):
            for table, root in ((self.up, base), (self.down, pow(base, -1, prime))):
                while len(table[i]) < n:
                    more = table[i][: n - len(table[i])] * U64(pow(root, len(table[i]), prime)) % U64(prime)
                    table[i] = np.append(table[i], more)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slices must be in ascending order of their starts and must not overlap."""
        out = np.empty(len(starts), U64)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, "right")))
            low, high = int(starts[i]), int(ends[j - 1])
            self._grow(high - low + 1)
            s, e = starts[i:j] - low, ends[i:j] - low
            letters = data[low:high].astype(U64) + U64(1)
            halves = []
            for prime, up, down in zip(PRIMES, self.up, self.down):
                terms = letters * up[: high - low]
                if high - low > SEGMENT:  # one long slice: keep the sum below 2^64
                    terms %= U64(prime)
                sums = np.append(U64(0), np.cumsum(terms, dtype=U64))
                halves.append((sums[e] - sums[s]) % U64(prime) * down[s] % U64(prime))
            out[i:j] = mix(halves[0] | halves[1] << U64(31)) ^ (mix((e - s).astype(U64)) >> U64(1))
            i = j
        return out


def runs(rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each of ``n`` rows in an ascending array of row numbers."""
    return np.searchsorted(rows, np.arange(n + 1))


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each row; row i has those from ``bounds[i]`` to ``bounds[i + 1]``."""
    sums = np.append(0, np.cumsum(values, dtype=np.int64 if values.dtype.kind in "bui" else np.float64))
    return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.float64)


def fold_case(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capitals of Latin-1 in lower case."""
    out = LOWER[data]
    if len(out) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 0x20
    return out
