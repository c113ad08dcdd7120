"""Byte work on Arrow text columns: words, hashes of words and of byte ranges.

All functions work on the concatenated UTF-8 bytes of several documents. Strings that are told apart by
hashes alone are hashed by ``Fingerprints``: among N strings a given one collides with chance N / 2**62.
``Rolling`` is cheaper and only deals n-grams to buckets and finds what is compared afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

#: \x20 and \x09-\x0D.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: [\x00-\x2F\x3A-\x60\x7B-\x7F], for bytes already in lower case.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
#: Lower case of A-Z alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A fixed pseudo-random code for every byte.
CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


class Rolling:
    """Hashes of ranges of a sequence of 64-bit codes, from one prefix sum modulo 2**64.

    Texts with equal hashes can be made on purpose, so hashes must not stand for their strings.
    """

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = np.ones(size, np.uint64), np.ones(size, np.uint64)
            self.up[1:], self.down[1:] = np.uint64(_BASE), np.uint64(_INVERSE)
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)

    def prefix(self, codes: np.ndarray) -> np.ndarray:
        self._grow(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * self.up[: len(codes)], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of codes[first:last] for every pair."""
        return mix((sums[last] - sums[first]) * self.down[first] + (last - first).astype(np.uint64))

    def windows(self, codes: np.ndarray, size: int) -> np.ndarray:
        """Hash of every run of size codes."""
        n = len(codes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        sums = self.prefix(codes)
        return mix((sums[size:] - sums[:n]) * self.down[:n] + np.uint64(size))


#: The prime 2**31 - 1, whose remainders are sums of two halves, and a base for each of the two lanes.
_PRIME_BITS = 31
_PRIME = (1 << _PRIME_BITS) - 1
_BASES = (0x4F1BBCDD, 0x2545F491)


def _halve(x: np.ndarray) -> None:
    """Replace numbers by smaller ones of the same remainder modulo the prime."""
    upper = x >> np.uint64(_PRIME_BITS)
    x &= np.uint64(_PRIME)
    x += upper


def _powers(base: int, size: int) -> np.ndarray:
    """The first size powers of base modulo the prime."""
    powers, known = np.ones(size, np.uint32), 1
    while known < size:
        more = min(known, size - known)
        step = np.uint64(pow(base, known, _PRIME))
        powers[known : known + more] = powers[:more].astype(np.uint64) * step % np.uint64(_PRIME)
        known += more
    return powers


class Fingerprints:
    """Hashes of ranges of a sequence of 64-bit codes, which stand for their strings.

    Two polynomials in different bases modulo the prime 2**31 - 1, over the low and the high half of each code.
    Modulo a power of two, instead, differences of some strings vanish in every base.
    """

    def __init__(self):
        self.up = self.down = [np.ones(1, np.uint32)] * 2

    def _grow(self, n: int) -> None:
        if len(self.up[0]) < n:
            size = max(n, 2 * len(self.up[0]))
            self.up = [_powers(base, size) for base in _BASES]
            self.down = [_powers(pow(base, -1, _PRIME), size) for base in _BASES]

    def prefix(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self._grow(len(codes) + 1)
        lanes = []
        for half, up in zip((codes & np.uint64(_PRIME), codes >> np.uint64(64 - _PRIME_BITS)), self.up, strict=True):
            half *= up[: len(codes)]
            _halve(half)
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(half, out=sums[1:])
            lanes.append(sums)
        return lanes[0], lanes[1]

    @staticmethod
    def _shifted(difference: np.ndarray, down: np.ndarray) -> np.ndarray:
        """The difference of two sums times a power, modulo the prime."""
        _halve(difference)
        _halve(difference)
        difference *= down
        _halve(difference)
        _halve(difference)
        np.subtract(difference, np.uint64(_PRIME), out=difference, where=difference >= _PRIME)
        return difference

    def ranges(self, sums: tuple[np.ndarray, np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of codes[first:last] for every pair."""
        low, high = (self._shifted(lane[last] - lane[first], down[first]) for lane, down in zip(sums, self.down, strict=True))
        return mix((high << np.uint64(_PRIME_BITS)) + low + (last - first).astype(np.uint64))

    def windows(self, codes: np.ndarray, size: int) -> np.ndarray:
        """Hash of every run of size codes."""
        n = len(codes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        low, high = (self._shifted(lane[size:] - lane[:n], down[:n]) for lane, down in zip(self.prefix(codes), self.down, strict=True))
        return mix((high << np.uint64(_PRIME_BITS)) + low + np.uint64(size))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole documents in runs of about limit bytes: first and last row, bytes, bounds of each row.

    A null counts as an empty text. One longer document is a run of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def pieces_of(raw: bytes, ends: np.ndarray) -> list[bytes]:
    """What lies one after another in raw, by the ends."""
    ends = ends.tolist()
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def strings(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Distinct strings of those that data holds one after another, and which of them each is."""
    column = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = column.dictionary_encode()
    _, ends, raw = coded.dictionary.buffers()
    return pieces_of(raw.to_pybytes(), np.frombuffer(ends, np.int64)[1 : len(coded.dictionary) + 1]), coded.indices.to_numpy()


def looked_up(memory: dict[bytes, bytes], wanted: list[bytes], learn: Callable[[list[bytes]], None]) -> list[bytes]:
    """What memory holds for each of the distinct wanted; learn puts in what it does not hold yet."""
    found = list(map(memory.get, wanted))
    new = [k for k, x in enumerate(found) if x is None]
    if new:
        learn([wanted[k] for k in new])
        for k in new:
            found[k] = memory[wanted[k]]
    return found


def gathered(known: list[bytes], of: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every string one after another, by which of the known it is, and the number of ids of each."""
    pool = np.frombuffer(b"".join(known), kind)
    sizes = np.fromiter(map(len, known), np.int64, len(known)) // pool.itemsize
    counts = sizes[of]
    shifts = (np.cumsum(sizes) - sizes)[of] - (np.cumsum(counts) - counts)
    return pool[np.repeat(shifts, counts) + np.arange(counts.sum())], counts


def text_of(rows: pa.StructArray, columns: list[str]) -> pa.Array:
    """The text of rows that are carried whole as structs; by place, as other names may differ in case only."""
    return pc.struct_field(rows, [columns.index("text")])


def words(data: np.ndarray, bounds: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; outside: the bytes between words."""
    inside = ~outside[data]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[edges], after[edges - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def word_windows(hashes: np.ndarray, rows: np.ndarray, size: int, rolling: Rolling | Fingerprints) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of size words of one row."""
    found = rolling.windows(hashes, size)
    first = np.flatnonzero(rows[size - 1 :] == rows[: len(found)]) if len(found) else np.zeros(0, np.int64)
    return found[first], first


def covered(n: int, first: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """Which of n places lie in a run of size places from one of first."""
    steps = np.bincount(first, minlength=n + 1) - np.bincount(first + size, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weights, minlength=n).astype(np.int64)


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array among."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    return among[np.minimum(at, len(among) - 1)] == values


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values, ascending; by sorting, which for nearly sorted integers is much faster than hashing."""
    values = np.sort(values, kind="stable")
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def pack(values: np.ndarray) -> bytes:
    """Ascending 64-bit integers as planes of the bytes of their differences; zero planes cost nothing once compressed."""
    steps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def pack_small(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers as byte planes."""
    return np.ascontiguousarray(values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack_small(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
