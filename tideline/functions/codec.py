"""Offset coding of chunk timestamps.

A chunk can be stored as its start time plus one offset per point. An offset of 0 means "as
the last one", so evenly sampled chunks hold almost only zeros, which Parquet run-length
encodes to next to nothing. Encoding is lossy by design: offsets that stay within the
tolerance of the one before are left out.

Both directions need running state along a chunk, which array expressions can only carry by
copying the output at every step. They run as Arrow functions on whole batches of arrays
instead: linear in the points, inside the row, without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.points import empty_points, point

# Fixed value: default tolerance in milliseconds. The decoder also starts from it.
TOLERANCE_MS = 10


def _before(numbers: np.ndarray, first: np.ndarray, initial: int) -> np.ndarray:
    """The number before each one in its chunk, ``initial`` for the first of a chunk."""
    shifted = np.empty_like(numbers)
    shifted[1:] = numbers[:-1]
    shifted[first] = initial
    return shifted


def _offsets(times: np.ndarray, bounds: np.ndarray, tolerance: int) -> np.ndarray:
    """Offsets of the points of many chunks, 0 where a point is left to the offset before it.

    Chunk ``i`` holds ``times[bounds[i]:bounds[i + 1]]``.
    """
    if times.size == 0:
        return times
    sizes = np.diff(bounds)
    first = bounds[:-1][sizes > 0]
    chunk = np.repeat(np.arange(sizes.size), sizes)
    # The first point of a chunk has no step, nor has a point after one at timestamp 0.
    last_times = _before(times, first, 0)
    steps = np.where(last_times == 0, 0, times - last_times)
    changed = np.abs(steps - _before(steps, first, 0)) > tolerance
    # How far a point is ahead of one tolerance per point. A point is stored when it has fallen
    # behind the last stored one by more than half a tolerance, which can only happen where the
    # lead shrinks: every other point is decided without looking at the ones before it.
    lead = times - tolerance * (np.arange(times.size) - bounds[chunk])
    shrinks = lead < _before(lead, first, tolerance)
    stored = changed.copy()
    open_chunks = np.zeros(sizes.size, dtype=bool)
    open_chunks[chunk[shrinks & ~changed]] = True
    candidates = np.flatnonzero((changed | shrinks) & open_chunks[chunk])
    current, stored_lead = -1, tolerance
    for i, c, sure, ahead in zip(
        candidates.tolist(), chunk[candidates].tolist(),
        changed[candidates].tolist(), lead[candidates].tolist(),
    ):
        if c != current:
            current, stored_lead = c, tolerance
        if sure or stored_lead - ahead > tolerance // 2:
            stored[i], stored_lead = True, ahead
    return np.where(stored, steps, 0)


def _times(
    starts: np.ndarray, offsets: np.ndarray, bounds: np.ndarray, tolerance: int
) -> np.ndarray:
    """Timestamps of the points of many chunks from their starts and offsets."""
    if offsets.size == 0:
        return offsets
    sizes = np.diff(bounds)
    begin = np.repeat(bounds[:-1], sizes)
    index = np.arange(offsets.size)
    is_first = index == begin
    known = np.maximum.accumulate(np.where((offsets != 0) & ~is_first, index, begin))
    steps = np.where(is_first, 0, np.where(known == begin, tolerance, offsets[known]))
    walked = np.cumsum(steps)
    return np.repeat(starts, sizes) + walked - walked[begin]


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all lists one after the other, and where each list begins and ends."""
    bounds = np.asarray(lists.offsets, dtype=np.int64)
    numbers = lists.flatten()
    if numbers.null_count:
        raise ValueError("a timestamp is missing")
    return np.asarray(numbers, dtype=np.int64), bounds - bounds[0]


def _lists(numbers: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(numbers, pa.int64()))


def delta_encode(chunks: DataFrame, tolerance: int = TOLERANCE_MS) -> DataFrame:
    """Replace ``points`` by ``offsets`` and ``values``. Missing points are skipped; a point without a
    timestamp fails the query."""
    if tolerance < 0:
        raise ValueError("tolerance must not be negative")

    @F.arrow_udf("array<bigint>")
    def encode(times: pa.Array) -> pa.Array:
        numbers, bounds = _flat(times)
        return _lists(_offsets(numbers, bounds, tolerance), bounds)

    present = F.filter("points", lambda p: p.isNotNull())
    return (
        chunks.withColumn("points", F.coalesce(present, empty_points()))
        .withColumn("offsets", encode(F.col("points.timestamp")))
        .withColumn("values", F.col("points.value"))
        .drop("points")
        .withColumn("n_points", F.array_size("values").cast("bigint"))
    )


def _within(times: np.ndarray, bounds: np.ndarray, from_ms: int, to_ms: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the points in the range, where each chunk's begin and end among them)."""
    kept = (times >= from_ms) & (times <= to_ms)
    return np.flatnonzero(kept), np.concatenate(([0], np.cumsum(kept)))[bounds]


def delta_decode_range(encoded: DataFrame, from_ms: int, to_ms: int, tolerance: int = TOLERANCE_MS) -> DataFrame:
    """``delta_decode`` cut to ``[from_ms, to_ms]``, both ends included, while decoding.

    Chunks that start after the range or end before it are left out by the scan, as are all if the range is inverted; of the
    others only points inside are built, so neither times nor values outside reach the result. A bound of -1 is an error. A chunk of
    which no point lies inside stays, without points.
    """
    if from_ms == -1 or to_ms == -1:
        raise ValueError("from_ms and to_ms must not be -1")
    if tolerance < 0:
        raise ValueError("tolerance must not be negative")

    @F.arrow_udf("array<struct<timestamp:bigint,value:double>>")
    def decode(starts: pa.Array, offsets: pa.Array, values: pa.Array) -> pa.Array:
        numbers, bounds = _flat(offsets)
        times = _times(np.asarray(starts, dtype=np.int64), numbers, bounds, tolerance)
        kept, cut = _within(times, bounds, from_ms, to_ms)
        points = pa.StructArray.from_arrays([pa.array(times[kept]), values.flatten().take(pa.array(kept))], ["timestamp", "value"])
        return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), points)

    span = (F.col("start") <= to_ms) & (F.col("end") >= from_ms) if "end" in encoded.columns else F.col("start") <= to_ms
    touched = encoded.where(span if from_ms <= to_ms else F.lit(False))
    known = _known_offsets()
    # As many values as offsets, missing ones null, so that both are cut at the same places.
    values = F.zip_with(known, F.coalesce("values", F.array().cast("array<double>")), lambda o, v: F.when(o.isNotNull(), v))
    values = F.slice(values, F.lit(1), F.size(known))
    return (
        touched.withColumn("points", decode(F.col("start"), known, values))
        .withColumn("n_points", F.array_size("points").cast("bigint"))
        .drop("offsets", "values")
    )


def _known_offsets() -> Column:
    """An absent offset repeats the last one, as 0 does."""
    nothing = F.array().cast("array<bigint>")
    return F.transform(F.coalesce("offsets", nothing), lambda o: F.coalesce(o, F.lit(0).cast("bigint")))


def delta_decode(encoded: DataFrame, tolerance: int = TOLERANCE_MS) -> DataFrame:
    """Rebuild ``points`` from ``start``, ``offsets`` and ``values``.

    The first point is at ``start`` whatever its offset says. Every later one adds its offset,
    or the last one that was not 0, or the tolerance before any was seen.
    """
    if tolerance < 0:
        raise ValueError("tolerance must not be negative")

    @F.arrow_udf("array<bigint>")
    def decode(starts: pa.Array, offsets: pa.Array) -> pa.Array:
        numbers, bounds = _flat(offsets)
        firsts = np.asarray(starts, dtype=np.int64)
        return _lists(_times(firsts, numbers, bounds, tolerance), bounds)

    times = decode(F.coalesce("start", F.lit(0)), _known_offsets())
    return (
        encoded.withColumn("_times", times)
        .withColumn("points", F.zip_with("_times", "values", point))
        .withColumn("n_points", F.array_size("points").cast("bigint"))
        .drop("_times", "offsets", "values")
    )
