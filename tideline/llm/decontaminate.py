"""Benchmark decontamination by spaced seeds.

A window is 12 words. Six fixed masks look at six of its words each and ignore the other six, chosen
so that any two substituted words leave one mask untouched: the window is cut in four blocks of
three, a mask is a pair of blocks. Mask hashes of the benchmark are joined with those of the
documents, and around every hit the whole window is compared: it counts as an overlap if at most
two words differ. Windows of one alignment are merged to spans.

Equal windows at consecutive words, as a repeated word makes them, are one stretch, and two different
windows are compared once, wherever and however often they stand; two stretches meet in one interval
per alignment. So the work follows the different windows and the spans, not the pairs of places.

A bit array of the benchmark's hashes, of a fixed size, keeps the documents' other hashes from being
shuffled at all; it only spares work, the join decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import stored
from tideline.llm.words import BASE, mix, ngrams, slices, text_buffers, word_hashes

WINDOW = 12
BLOCKS = 4
SUBSTITUTED = 2            # words of a window that may differ
MASKS = list(combinations(range(BLOCKS), BLOCKS - SUBSTITUTED))
FILTER_BITS = 24           # bits of the array: 2 MB
_STEP = WINDOW // BLOCKS

ITEMS = "item_id bigint, item_at bigint, item_run bigint, seed bigint, words binary"
HITS = "doc_id bigint, doc_at bigint, doc_run bigint, seed bigint, words binary"


def _seeds(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seeds per mask, first word) of every window inside one row; seeds is windows x masks."""
    count = len(hashes) - WINDOW + 1
    if count <= 0:
        return np.zeros((0, len(MASKS)), np.uint64), np.zeros(0, np.int64)
    block = hashes.copy()
    for k in range(1, _STEP):
        block[:len(hashes) - k] = block[:len(hashes) - k] * np.uint64(BASE) + hashes[k:]
    seeds = np.empty((count, len(MASKS)), np.uint64)
    for m, blocks in enumerate(MASKS):
        total = np.full(count, np.uint64(m + 1))
        for b in blocks:
            total = total * np.uint64(BASE) + block[b * _STEP:b * _STEP + count]
        seeds[:, m] = mix(total)
    inside = rows[:count] == rows[WINDOW - 1:]
    return seeds[inside], np.flatnonzero(inside)


def _rank_in_row(rows: np.ndarray) -> np.ndarray:
    """Position of each word in its own row."""
    if not len(rows):
        return rows
    starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    return np.arange(len(rows)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(rows)]))))


def _stretches(hashes: np.ndarray, rows: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``first``, windows) of stretches of equal windows at consecutive words of a row."""
    if not len(first):
        return first, first
    like = np.concatenate(([0], np.cumsum(hashes[1:] == hashes[:-1])))      # words equal to the one before, up to each
    before = first[:-1]
    same = (first[1:] == before + 1) & (rows[first[1:]] == rows[before])
    same &= like[np.minimum(before + width, len(hashes) - 1)] - like[before] == width
    begin = np.flatnonzero(np.concatenate(([True], ~same)))
    return begin, np.diff(np.append(begin, len(first)))


def _table(ids, at, runs, seeds, hashes, first, width, names) -> pa.RecordBatch:
    blob = hashes[first[:, None] + np.arange(width)].tobytes() if len(first) else b""
    offsets = np.arange(len(first) + 1, dtype=np.int32) * (8 * width)
    words = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(blob)])
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(at.astype(np.int64)), pa.array(runs.astype(np.int64)), pa.array(seeds.view(np.int64)), words], names=names)


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seeds of the benchmark; an item shorter than a window is one seed of all its words."""
    names = ["item_id", "item_at", "item_run", "seed", "words"]
    for batch in batches:
        data, offsets = text_buffers(batch.column(1))
        hashes, rows, _, _ = word_hashes(data, offsets)
        rank = _rank_in_row(rows)
        seeds, first = _seeds(hashes, rows)
        begin, runs = _stretches(hashes, rows, first, WINDOW)
        seeds, first = seeds[begin], first[begin]
        for m in range(len(MASKS)):
            yield _table(batch.column(0).take(pa.array(rows[first])), rank[first], runs, seeds[:, m].copy(), hashes, first, WINDOW, names)
        words = np.bincount(rows, minlength=batch.num_rows)
        for size in range(1, WINDOW):
            grams, at = ngrams(hashes, rows, size)
            whole = words[rows[at]] == size
            grams, at = grams[whole], at[whole]
            if len(at):
                once = np.ones(len(at), np.int64)
                yield _table(batch.column(0).take(pa.array(rows[at])), rank[at], once, mix(grams + np.uint64(size)), hashes, at, size, names)


def _document_seeds(shared, short: list[int]):
    names = ["doc_id", "doc_at", "doc_run", "seed", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)

        def maybe(seeds: np.ndarray) -> np.ndarray:
            spot = seeds >> np.uint64(64 - FILTER_BITS)
            return (bits[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1

        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for low_row, high_row in slices(offsets):
                low = offsets[low_row]
                hashes, rows, _, _ = word_hashes(data[low:offsets[high_row]], offsets[low_row:high_row + 1] - low)
                seeds, first = _seeds(hashes, rows)
                begin, runs = _stretches(hashes, rows, first, WINDOW)
                parts = [(seeds[begin, m], first[begin], runs, WINDOW) for m in range(len(MASKS))]
                for size in short:
                    grams, at = ngrams(hashes, rows, size)
                    begin, runs = _stretches(hashes, rows, at, size)
                    parts.append((mix(grams[begin] + np.uint64(size)), at[begin], runs, size))
                rank = None
                for seed, at, runs, width in parts:
                    hit = np.flatnonzero(maybe(seed))
                    if len(hit):
                        rank = _rank_in_row(rows) if rank is None else rank
                        at = at[hit]
                        yield _table(batch.column(0).take(pa.array(rows[at] + low_row)), rank[at], runs[hit], seed[hit].copy(), hashes, at, width, names)
    return run


def _filter(seeds: DataFrame) -> bytes:
    """Bit array of the seeds' leading bits: at most 2^FILTER_BITS of them, however many seeds."""
    spots = seeds.select(F.shiftrightunsigned("seed", 64 - FILTER_BITS).alias("spot")).distinct()
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for part in _batches(spots):
        spot = part.astype(np.int64)
        np.bitwise_or.at(bits, spot >> 3, (1 << (spot & 7)).astype(np.uint8))
    return bits.tobytes()


def _batches(spots: DataFrame) -> Iterator[np.ndarray]:
    """A column of bounded length, folded in the tasks before it comes to the driver."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.column(0).to_numpy().astype(np.int32).tobytes()], pa.binary())], names=["spots"])
    for row in spots.mapInArrow(fold, "spots binary").toLocalIterator():
        yield np.frombuffer(row[0], np.int32)


def _same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of windows with the number of words and of equal words; windows of unequal length have none equal."""
    for batch in batches:
        (one, a), (two, b) = (text_buffers(batch.column(k)) for k in (0, 1))
        size, same = np.diff(a), np.zeros(batch.num_rows, np.int64)
        for width in np.unique(size).tolist():
            at = np.flatnonzero((size == width) & (np.diff(b) == width))
            equal = one[a[at][:, None] + np.arange(width)] == two[b[at][:, None] + np.arange(width)]
            same[at] = equal.reshape(len(at), -1, 8).all(axis=2).sum(axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size // 8), pa.array(same)], names=["words", "item_words", "size", "same"])


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Spans of documents that overlap benchmark items.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are ignored. Null
    and blank texts have no words and overlap nothing; items of fewer than 12 words must occur
    whole and unchanged. Rows without an id are skipped in neither table: the id stays null.
    Returns doc_id, item_id, shift (document word less item word), first_word, last_word of the
    document, n_words, n_windows: one row per span, a span being consecutive or overlapping
    windows of one alignment; windows are counted by their first word, also where an id repeats.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    seeds = stored(items.mapInArrow(_item_seeds, ITEMS).distinct())
    short = [r[0] for r in seeds.select((F.octet_length("words") / 8).cast("int").alias("n")).distinct().collect() if r[0] < WINDOW]
    shared = spark.sparkContext.broadcast(_filter(seeds))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hits = stored(texts.mapInArrow(_document_seeds(shared, sorted(short)), HITS))

    # Different windows are compared once, wherever they stand.
    kinds = hits.select("seed", "words").distinct().join(seeds.select("seed", F.col("words").alias("item_words")).distinct(), "seed")
    same = kinds.select("words", "item_words").mapInArrow(_same, "words binary, item_words binary, size bigint, same bigint")
    most = F.when(F.col("size") == WINDOW, F.lit(SUBSTITUTED)).otherwise(F.lit(0))
    alike = same.where((F.col("same") > 0) & (F.col("size") - F.col("same") <= most)).select("words", "item_words", "size").distinct()
    places = seeds.select("item_id", "item_at", "item_run", F.col("words").alias("item_words")).distinct()
    known = stored(alike.join(places, "item_words").drop("item_words"))
    met = hits.select("doc_id", "doc_at", "doc_run", "words").distinct().join(known, "words")
    # Two stretches of equal windows overlap in one interval for each of their alignments.
    shift = F.explode(F.sequence(F.col("doc_at") - F.col("item_at") - F.col("item_run") + 1, F.col("doc_at") + F.col("doc_run") - 1 - F.col("item_at")))
    found = met.select("*", shift.alias("shift")).select(
        "doc_id", "item_id", "shift", F.greatest("doc_at", F.col("item_at") + F.col("shift")).alias("first"),
        F.least(F.col("doc_at") + F.col("doc_run"), F.col("item_at") + F.col("item_run") + F.col("shift")).alias("after"), "size").distinct()
    # Intervals of one alignment of one item in one document: as many as the item has words at most.
    spans = found.groupBy("doc_id", "item_id", "shift").agg(F.array_sort(F.collect_list(F.struct("first", "after", "size"))).alias("windows"))
    merged = F.aggregate(
        "windows", F.array().cast("array<struct<first:bigint,last:bigint,after:bigint,n:bigint>>"),
        lambda done, w: F.when(
            (F.size(done) > 0) & (w["first"] <= F.element_at(done, -1)["last"] + 1),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["first"].alias("first"),
                F.greatest(F.element_at(done, -1)["last"], w["after"] + w["size"] - 2).alias("last"),
                F.greatest(F.element_at(done, -1)["after"], w["after"]).alias("after"),
                (F.element_at(done, -1)["n"] + F.greatest(F.lit(0), w["after"] - F.greatest(w["first"], F.element_at(done, -1)["after"]))).alias("n")))),
        ).otherwise(F.concat(done, F.array(F.struct(
            w["first"].alias("first"), (w["after"] + w["size"] - 2).alias("last"), w["after"].alias("after"), (w["after"] - w["first"]).alias("n"))))))
    return (spans.select("doc_id", "item_id", "shift", F.explode(F.when(F.size("windows") > 0, merged)).alias("s"))
            .select("doc_id", "item_id", "shift", F.col("s.first").alias("first_word"), F.col("s.last").alias("last_word"),
                    (F.col("s.last") - F.col("s.first") + 1).alias("n_words"), F.col("s.n").alias("n_windows")))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item; columns are kept."""
    dirty = stored(overlaps(docs, benchmark).select("doc_id").distinct())
    return docs.join(dirty, docs["doc_id"].cast("bigint").eqNullSafe(dirty["doc_id"]), "left_anti")
