"""Vectorised hashing of text units (bytes or words) inside Arrow tasks.

A unit sequence is hashed with a polynomial over 64-bit integers, so that the hash of
any run of units comes from two prefix sums.  ``anchors`` picks content-defined sample
points: every window of ``span`` units selects the gram of least hash in it, so two
equal windows select the same gram at the same place wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
STEP = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
BACK = pow(STEP, -1, 2**64)
CHUNK = 1 << 16  # units hashed at once; longer sequences go in overlapping chunks
PLACE = 20  # low bits of a sort key that hold the place within a chunk

_powers: dict[int, np.ndarray] = {}
BYTE_VALUES = np.random.RandomState(20_011).randint(1, 2**63 - 1, 256, dtype=np.int64).astype(U64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of the input over the output."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64; kept per worker for the sizes in use."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, 2 * CHUNK)
        known = np.full(size, base, U64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if size <= 2 * CHUNK:
            _powers[base] = known
    return known[:n]


class Runs:
    """Hashes of runs of a unit sequence."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * powers(STEP, len(values)), out=self.sums[1:])
        self.back = powers(BACK, len(values) + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(U64))

    def grams(self, k: int) -> np.ndarray:
        """Hash of every run of k units."""
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self.back[:n] + U64(k))


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of every ``width`` neighbours, in linear time."""
    n = len(keys)
    if width == 1:
        return keys
    full = -(-n // width) * width
    padded = np.full(full, np.iinfo(U64).max, U64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, span: int, k: int):
    """Sample points of the sequences ``values[starts[d]:ends[d]]`` that lie in one chunk.

    Yields arrays (sequence, place, first window, last window, gram hash, context hash);
    places count within ``values``.  The context of a sample point is all that its
    windows cover, with their position relative to it.
    """
    width = span - k + 1
    runs = Runs(values)
    n = len(values) - span + 1
    if n <= 0:
        return None
    grams = runs.grams(k)
    place = U64((1 << PLACE) - 1)
    keys = (grams & ~place) | np.arange(len(grams), dtype=U64)
    chosen = (sliding_least(keys, width)[:n] & place).astype(np.int64)
    # Windows belong to the sequence that holds all of them.
    edge = np.zeros(len(values) + 1, np.int64)
    np.add.at(edge, starts, 1)
    owner = np.cumsum(edge)[:n] - 1
    inside = (owner >= 0) & (np.arange(n) + span <= ends[owner])
    fresh = np.ones(n, bool)
    fresh[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], n) - 1
    keep = inside[first]
    first, last = first[keep], last[keep]
    at = chosen[first]
    context = runs.hash(first, last + span)
    shape = (at - first).astype(U64) * U64(span) + (last - first).astype(U64)
    return owner[first], at, first, last, grams[at], mix(context ^ mix(shape + U64(1)))


def batched(starts: np.ndarray, ends: np.ndarray, span: int) -> Iterator[tuple[int, int, int, int]]:
    """Cuts neighbouring sequences into chunks: (first sequence, behind last, from, to).

    A sequence longer than a chunk comes alone, in pieces that overlap by span - 1 units,
    so that every window lies in exactly one piece.
    """
    d, total = 0, len(starts)
    while d < total:
        if ends[d] - starts[d] > CHUNK:
            for a in range(starts[d], ends[d], CHUNK):
                yield d, d + 1, a, min(ends[d], a + CHUNK + span - 1)
                if a + CHUNK + span - 1 >= ends[d]:
                    break
            d += 1
            continue
        e = int(np.searchsorted(ends, starts[d] + CHUNK, side="right"))
        e = max(e, d + 1)
        yield d, e, int(starts[d]), int(ends[e - 1])
        d = e


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def is_space(raw: np.ndarray) -> np.ndarray:
    """The six ASCII white space characters."""
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def distinct(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """A code for each of the disjoint, ordered byte ranges, and the different ranges.

    Equal codes mean equal bytes: nothing is hashed that is not compared too.
    """
    edges = np.zeros(len(raw) + 1, np.int8)
    edges[start] = 1
    edges[end] -= 1
    offsets = np.append(0, np.cumsum(end - start))
    data = raw[np.cumsum(edges[:-1], dtype=np.int8).view(bool)]
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    ).dictionary_encode()
    return column.indices.to_numpy(zero_copy_only=False), column.dictionary.to_pylist()


class Words:
    """Words of packed texts: byte ranges, hashes, and the range of words of each text."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False):
        if lower:
            raw = np.where((raw >= 65) & (raw <= 90), raw | 32, raw)
        self.raw = raw
        space = is_space(raw)
        begins = ~space
        begins[1:] &= space[:-1]
        edges = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[edges] |= ~space[edges]
        stops = ~space
        stops[:-1] &= space[1:]
        stops[offsets[1:][offsets[:-1] < offsets[1:]] - 1] |= ~space[offsets[1:][offsets[:-1] < offsets[1:]] - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(stops) + 1
        bounds = np.searchsorted(self.start, offsets)
        self.first, self.behind = bounds[:-1], bounds[1:]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word; every different word is hashed as a whole."""
        codes, words = distinct(self.raw, self.start, self.end)
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))[codes]
