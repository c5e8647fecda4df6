"""Periodic runs of words, found with a dictionary of basic factors.

The dictionary names, for every power of two l, the factors of l words: equal factors of one text have
one name, found by naming pairs of names of the level below. A factor that stands only once can be no
part of a repetition; it has no name, and the levels end where nothing repeats.

A run of period q with 2l <= q < 4l holds, within its first q words, a whole factor of l words that begins at
a multiple of l, and the same factor q words later. So on every level each factor at a multiple of l
looks up its next occurrences from 2l to 4l on, two windows of twice its length; in each they form an
arithmetic progression, and their distances propose periods. There are at most 2l to l words, so 2n on
a level of n words, whatever the text. Proposals of one period at neighbouring multiples of l are one
stretch; its ends lie less than l words further and are found by descending through the levels. A
stretch of two periods and more is a run; of the stretches with the same ends the smallest period is the run's.

Texts are handled in the task that reads them, many at a time as whole vectors; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.words import SLICE_BYTES, exact_ids, list_array, slices, text_buffers, word_bytes, word_hashes

LEAST = 12               # words of the shortest run reported
SPACES = "[\\x20\\x09-\\x0D]+"
RUN = "struct<start:bigint,length:bigint,period:bigint>"
ADDED = ["n_words", "runs", "collapsed"]


def basic_factors(words: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of 1, 2, 4, .. words that begin at every word, -1 for those that stand once
    in their row. Names of different rows differ, so no factor across two rows has one."""
    def named(key: np.ndarray, at: np.ndarray) -> np.ndarray:
        names = np.full(len(words), -1, np.int64)
        _, number, count = np.unique(key, return_inverse=True, return_counts=True)
        again = count[number] > 1
        names[at[again]] = number[again]
        return names

    room = max(len(words), 1)
    levels = [named(rows * (int(words.max(initial=0)) + 1) + words, np.arange(len(words)))]
    while (levels[-1] >= 0).any():
        below, half = levels[-1], 1 << (len(levels) - 1)
        at = np.flatnonzero((below[:-half] >= 0) & (below[half:] >= 0)) if half < len(words) else np.zeros(0, np.int64)
        levels.append(named(below[at] * room + below[at + half], at))
    return levels[:-1]


def _proposals(names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) for every occurrence of a factor of ``size`` words, at a multiple of it, at a distance from
    2 ``size`` to 4 ``size``, and for single words also next to it."""
    room = len(names)
    places = np.flatnonzero(names >= 0)
    known = names[places] * room + places
    known.sort()
    anchors = np.arange(0, room, size)
    anchors = anchors[names[anchors] >= 0]
    near = 1 if size == 1 else 2 * size
    low = np.searchsorted(known, names[anchors] * room + np.minimum(anchors + near, room))
    high = np.searchsorted(known, names[anchors] * room + np.minimum(anchors + 4 * size, room))
    many = high - low
    stop = np.cumsum(many)
    found = known[np.repeat(low - (stop - many), many) + np.arange(int(stop[-1]) if len(stop) else 0)] % room
    place = np.repeat(anchors, many)
    return place, found - place


def runs_of(words: np.ndarray, rows: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of every run, by start and then period; words counted over all rows."""
    levels = basic_factors(words, rows)
    found = []
    for k, names in enumerate(levels):
        size = 1 << k
        place, period = _proposals(names, size)
        if not len(place):
            continue
        order = np.lexsort((place, period))
        place, period = place[order], period[order]
        new = np.ones(len(place), bool)
        new[1:] = (period[1:] != period[:-1]) | (place[1:] != place[:-1] + size)
        first = np.flatnonzero(new)
        q = period[first]
        left, right = place[first], place[np.append(first[1:], len(place)) - 1] + size
        for j in range(k - 1, -1, -1):
            step, name = 1 << j, levels[j]
            at = np.flatnonzero(right + q < len(words))
            on = name[right[at]]
            right[at[(on >= 0) & (on == name[right[at] + q[at]])]] += step
            at = np.flatnonzero(left >= step)
            on = name[left[at] - step]
            left[at[(on >= 0) & (on == name[left[at] - step + q[at]])]] -= step
        run = right - left >= np.maximum(q, least - q)
        found.append((left[run], (right + q)[run], q[run]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    start, end, q = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[new], end[new], q[new]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def _joined_words(data: np.ndarray, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, count: int) -> pa.Array:
    """Words of each of ``count`` rows with one space between them."""
    last = np.append(rows[1:] != rows[:-1], True)[:len(rows)]
    size = ends - starts + ~last
    at = word_bytes(starts, starts + size)
    out = data[np.minimum(at, max(len(data) - 1, 0))]
    out[(np.cumsum(size) - 1)[~last]] = 32
    offsets = np.zeros(count + 1, np.int64)
    np.cumsum(np.bincount(rows, weights=size, minlength=count).astype(np.int64), out=offsets[1:])
    return pa.LargeStringArray.from_buffers(count, pa.py_buffer(offsets), pa.py_buffer(out.tobytes())).cast(pa.string())


def _found(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for first, last in slices(offsets, SLICE_BYTES):
                part, count = data[offsets[first]:offsets[last]], last - first
                hashes, rows, starts, ends = word_hashes(part, offsets[first:last + 1] - offsets[first], lower=False)
                words = np.bincount(rows, minlength=count)
                begin = np.cumsum(words) - words
                at, end, q = runs_of(exact_ids(part, hashes, starts, ends)[0], rows, least) if len(rows) else (rows, rows, rows)
                owner = rows[at]
                steps = np.zeros(len(rows) + 1, np.int64)
                np.add.at(steps, at + q, 1)
                np.add.at(steps, end, -1)
                kept = np.cumsum(steps[:-1]) == 0
                runs = pa.StructArray.from_arrays([pa.array(at - begin[owner]), pa.array(end - at), pa.array(q)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, count), pa.array(words.astype(np.int64)), list_array(runs, np.bincount(owner, minlength=count)),
                    _joined_words(part, rows[kept], starts[kept], ends[kept], count)], names=["row", *ADDED])
    return run


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with n_words, runs and collapsed.

    Words are stretches of characters other than space and 0x09-0x0D, compared as they are. A run is a
    stretch of at least ``least`` words and two periods in which words a period apart are equal, the period the
    smallest such and no neighbouring word going on with it: start (word number from 0), length and period in
    words, by start and then period. ``collapsed`` is the text with one space between words, less the words that some run holds
    after its first period. Needs text; all other columns are kept, those of the names added are replaced. Null, empty
    and blank texts have no words, no runs and an empty ``collapsed``; repeated rows are told each. A text is held whole
    by one task, with some 100 bytes a word beside it.
    """
    kept = [c for c in docs.columns if c not in ADDED]
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("text").cast("string").alias("text"))
    kind = base.schema["row"].dataType.simpleString()
    found = base.mapInArrow(_found(least), f"row {kind}, n_words bigint, runs array<{RUN}>, collapsed string")
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], *ADDED)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a repeating tail in one document of ten, chosen and shaped by the CRC of its id.

    With h the CRC of the decimal id, g = h div 10 and n words: where h mod 10 is 0 and n > 0, the words from a = g mod n on
    are the p = 1 + (n - a) div (3 + g mod 8) words from there over and over. The others, and those of null id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary"))
    split = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(
        F.col("h") % 10 == 0, F.filter(F.split(F.coalesce("text", F.lit("")), SPACES, -1), lambda w: w != "")))
    rest = F.expr("size(words) - a")
    shaped = (split.withColumn("g", F.floor(F.col("h") / 10))
              .withColumn("a", F.when(F.size("words") > 0, F.col("g") % F.size("words")).cast("int"))
              .withColumn("p", F.expr("cast(1 + (size(words) - a) div (3 + g % 8) as int)")))
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.expr("cast((size(words) - a + p - 1) div p as int)")))
    changed = F.concat_ws(" ", F.slice("words", 1, F.col("a")), F.slice(tail, 1, rest))
    return shaped.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period) and digests of all runs and of the collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    told = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length = -F.col("best.less")
    return told.select("doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"),
                       F.expr("(1000 * -best.less) div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
