"""Words of whole texts as 64-bit hashes, computed on whole Arrow columns.

A word is a run of bytes other than space and 0x09-0x0D, letters A-Z lower-cased on request. Its hash comes from
polynomials over random byte values, read off running sums, and then mixed; so the
cost is a few vector operations per byte and no Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20   # bytes handled at once: vectors of one slice stay in the cache
BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
KEPT_POWERS = 2 * SLICE_BYTES   # longest tables kept between calls, enough for a slice
PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (1_103_515_245, 1_583_458_089)
_SMALL = np.random.Generator(np.random.PCG64(31)).permutation(4095)[:256].astype(np.uint64) + np.uint64(1)      # of 12 bits


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (in place on a fresh array)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power_tables(size: int, base: int = BASE, prime: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64, or modulo a prime, for i below a power of two that is at least ``size``. Tables up to
    KEPT_POWERS are kept; larger ones serve as well, and give way to smaller ones once they are out of proportion. Larger
    tables are built for the call only: a reused worker would hold them through every later stage."""
    held = _powers.get(base)
    if held is not None and size <= len(held[0]) <= 64 * max(size, 1 << 18):
        return held
    room = 1 << max(int(size - 1).bit_length(), 18)
    if room > KEPT_POWERS:
        return _built_powers(room, base, prime)
    held = _powers[base] = _built_powers(room, base, prime)
    return held


def _built_powers(room: int, base: int, prime: int | None) -> tuple[np.ndarray, np.ndarray]:
    modulus, kind = (1 << 64, np.uint64) if prime is None else (prime, np.uint32)
    tables = []
    for step in (base, pow(base, -1, modulus)):
        powers = np.ones(room, kind)
        filled = 1
        while filled < room:
            more = powers[:filled].astype(np.uint64) * np.uint64(pow(step, filled, modulus))
            powers[filled:2 * filled] = more if prime is None else more % np.uint64(prime)
            filled *= 2
        tables.append(powers)
    return tables[0], tables[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of bytes: three polynomials, modulo 2^64 and two primes, mixed. Structured words can meet in
    the first, whatever its base; the primes part them."""
    size = len(data)
    powers, inverse = _power_tables(size + 1)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers[:size], out=sums[1:])
    whole = (sums[ends] - sums[starts]) * inverse[starts]
    narrow = []
    value = _SMALL[data]
    for prime, base in zip(PRIMES, BASES):
        powers, inverse = _power_tables(size + 1, base, prime)
        terms = value * powers[:size]              # below 2^43, so 2^20 of them fit a sum
        if size > 1 << 20:
            terms %= np.uint64(prime)
        np.cumsum(terms, out=sums[1:])
        narrow.append((sums[ends] - sums[starts]) % np.uint64(prime) * inverse[starts] % np.uint64(prime))
    return mix(whole + mix((narrow[0] << np.uint64(31)) | narrow[1]))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    kind = np.int64 if large else np.int32
    if len(column) == 0 or ends is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(ends, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes, at least one row each."""
    rows, first = len(offsets) - 1, 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, start, end) of every word, in order; rows from 0, bytes counted from data[0].
    ``between`` says which bytes part words."""
    size = len(data)
    if size == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    low = _LOWER[data] if lower else data
    space = between[data]
    word = ~space
    border = np.zeros(size + 1, bool)
    border[offsets] = True
    first = word.copy()
    first[1:] &= space[:-1] | border[1:-1]
    last = word.copy()
    last[:-1] &= space[1:] | border[1:-1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    hashes = span_hashes(low, starts, ends)
    return hashes, np.searchsorted(offsets, starts, "right") - 1, starts, ends


def ngrams(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position of the first word) of every run of ``n`` words within one row."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = len(hashes) - n + 1
    total = hashes[:count].copy()
    for k in range(1, n):
        total = mix(total * np.uint64(BASE) + hashes[k:k + count])
    inside = rows[:count] == rows[n - 1:]
    return total[inside], np.flatnonzero(inside)


def list_array(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def word_bytes(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of the bytes of all words, one after another."""
    size = ends - starts
    stop = np.cumsum(size)
    return np.repeat(starts - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)


def exact_ids(data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunk: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """(number of every word, place of the first word of each number): equal numbers for equal bytes only.
    Hashes group the words; every word is then compared with the first one of its group, byte by byte."""
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    like = first[number]
    same = bool(np.array_equal((ends - starts)[like], ends - starts))
    for a in range(0, len(hashes) if same else 0, chunk):
        part = slice(a, a + chunk)
        at = word_bytes(starts[part], ends[part])
        other = at + np.repeat(starts[like[part]] - starts[part], ends[part] - starts[part])
        if not np.array_equal(data[at], data[other]):
            same = False
            break
    if not same:
        blob = data.tobytes()
        spelt = pa.array([blob[a:b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())
        number = spelt.dictionary_encode().indices.to_numpy().astype(np.int64)
        first = np.unique(number, return_index=True)[1]
    return number, first
