"""Suffix-array dedup: remove what a document repeats of documents with a smaller id.

Whole texts are bytes; a window is ``length`` bytes inside one document. Equal windows must meet in one
shard without comparing all documents, so windows are dealt by content: a window's anchor is
the smallest hash among its 16-byte strings, and a segment is a run of windows of one anchor. Equal
windows have equal anchors, wherever they stand.

1. Anchors are counted per block of documents and added up; a bit array of a bounded size marks those
   that two documents share. It only spares work: segments of other anchors cannot repeat.
2. Segments of marked anchors, equal ones once per block, go to the shard of their anchor. Each shard
   sorts its suffixes by induced sorting: suffixes are classified, leftmost-smaller substrings
   are sorted and named, their reduced string is sorted, and the array is induced in two linear
   scans. The reduced string is sorted by doubling over names, up to the length of a window, as
   a recursion over a huge alphabet has nothing to vectorise; scans go bucket by bucket.
   Permuted common prefixes then part the array into groups of equal windows, and each group
   has a smallest document.
3. Occurrences of segments are joined with their segment's result, which gives the byte runs to remove.

An anchor with so many different surroundings that it would fill a shard is dealt out further: each
of its windows goes by its own hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import released, stored
from tideline.llm.words import BASE, _power_tables, list_array, mix, slices, text_buffers

LENGTH = 50
ANCHOR = 16                # bytes of an anchor
SHARD_BYTES = 1 << 20      # text per shard, about as much as its segments have; an array takes some 200 bytes per byte
SHARDS_TASK = 4            # shards that a task sorts one after another
COUNT_SHARDS = 64
FILTER_BITS = (16, 30)     # limits of the bit array's size, as powers of two
HOT = 20_000               # different surroundings of one anchor from which it is dealt by window
BLOCK_BYTES = 8 << 20      # segments of so much text are put together before they are sent
_SYMBOLS = np.random.Generator(np.random.PCG64(31)).integers(1, 2**63, 258, dtype=np.uint64)


# ---------------------------------------------------------------- suffix array of one shard


def _suffix_types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one behind it; the last symbol is the smallest."""
    n = len(s)
    step = np.sign(s[1:].astype(np.int32) - s[:-1].astype(np.int32))
    place = np.where(step != 0, np.arange(n - 1), n - 1)
    decides = np.minimum.accumulate(place[::-1])[::-1]
    return np.concatenate((np.append(step, 1)[decides] > 0, [True]))


def _induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """Suffix array from leftmost-smaller suffixes ``lms`` in their order, in two scans."""
    counts = np.bincount(s, minlength=size)
    ends = np.cumsum(counts)
    starts = ends - counts
    array = np.full(len(s), -1, np.int32)
    symbols = s[lms]
    order = np.argsort(symbols, kind="stable")
    placed = np.bincount(symbols, minlength=size)
    first = np.cumsum(placed) - placed
    array[(ends - placed)[symbols[order]] + np.arange(len(lms)) - first[symbols[order]]] = lms[order]
    used = np.flatnonzero(counts)
    head, tail = starts.copy(), ends.copy()

    def push(found: np.ndarray, larger: bool) -> None:
        before = found[found > 0] - 1
        before = before[smaller[before] != larger]
        if not len(before):
            return
        symbol = s[before]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        new = np.flatnonzero(np.concatenate(([True], symbol[1:] != symbol[:-1])))
        many = np.diff(np.append(new, len(symbol)))
        kinds = symbol[new]
        rank = np.arange(len(symbol)) - np.repeat(new, many)
        if larger:
            array[np.repeat(head[kinds], many) + rank] = before
            head[kinds] += many
        else:
            array[np.repeat(tail[kinds], many) - 1 - rank] = before
            tail[kinds] -= many

    for c in used:
        low = starts[c]
        while low < head[c]:
            high = head[c]
            push(array[low:high], True)
            low = high
        push(array[ends[c] - placed[c]:ends[c]], True)
    for c in used[::-1]:
        high = ends[c]
        while tail[c] < high:
            low = tail[c]
            push(array[low:high][::-1], False)
            high = low
        push(array[starts[c]:head[c]][::-1], False)
    array[0] = len(s) - 1
    return array


def _by_doubling(names: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a string of names in the order of their first ``depth`` names at least."""
    rank, step, n = names.astype(np.int64), 1, len(names)
    while True:
        behind = np.zeros(n, np.int64)
        behind[:n - step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + behind
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        step *= 2
        if step >= depth or step >= n or fresh[-1] == n - 1:
            return order


def suffix_array(s: np.ndarray, depth: int, size: int = 258) -> np.ndarray:
    """Suffixes of ``s`` (small symbols, the last one unique and smallest) in the order of at least
    their first ``depth`` symbols; in full order if depth is len(s)."""
    if len(s) == 1:
        return np.zeros(1, np.int32)
    smaller = _suffix_types(s)
    is_lms = np.zeros(len(s), bool)
    is_lms[1:] = smaller[1:] & ~smaller[:-1]
    lms = np.flatnonzero(is_lms)
    array = _induce(s, smaller, lms, size)
    in_order = array[is_lms[array]]
    # Equal leftmost-smaller substrings get equal names: same length, same polynomial.
    powers, inverse = _power_tables(len(s) + 1)
    sums = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(_SYMBOLS[s] * powers[:len(s)], out=sums[1:])
    stop = np.append(lms[1:], lms[-1]) + 1
    value = (sums[stop] - sums[lms]) * inverse[lms] + (stop - lms).astype(np.uint64) * np.uint64(BASE)
    at = np.searchsorted(lms, in_order)
    name = np.concatenate(([0], np.cumsum(value[at][1:] != value[at][:-1])))
    if name[-1] < len(lms) - 1:
        names = np.empty(len(lms), np.int64)
        names[at] = name
        in_order = lms[_by_doubling(names, depth)]     # a name spans one symbol at least
    return _induce(s, smaller, in_order, size)


def permuted_prefixes(text: np.ndarray, array: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix of ``text`` with the one before it in ``array``, by text position.

    Along the text the predecessor mostly moves along too, and the prefix is then one shorter; only
    where it does not, bytes are compared, eight at a time.
    """
    n = len(text)
    before = np.empty(n, np.int64)
    before[array[0]] = -1
    before[array[1:]] = array[:-1]
    head = np.ones(n, bool)
    head[1:] = (before[1:] != before[:-1] + 1) | (before[:-1] < 0)
    same = text[:-1] == text[np.maximum(before[:-1], 0)]
    head[1:] |= ~same
    at = np.flatnonzero(head)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    wide = np.ndarray((n,), np.uint64, padded, 0, (1,))
    length = np.zeros(len(at), np.int64)
    live = np.flatnonzero(before[at] >= 0)
    for step, view in ((8, wide), (1, text)):
        moving = live
        while len(moving):
            a, b = at[moving] + length[moving], before[at[moving]] + length[moving]
            inside = (a + step <= n) & (b + step <= n)
            moving, a, b = moving[inside], a[inside], b[inside]
            moving = moving[view[a] == view[b]]
            length[moving] += step
    owner = np.cumsum(head) - 1
    return np.maximum(length[owner] - (np.arange(n) - at[owner]), 0)


def smallest_documents(texts: np.ndarray, lengths: np.ndarray, docs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, smallest document) per window of each of several texts laid end to end.

    Windows come in text order; a text of m bytes has max(m - length + 1, 0) of them.
    """
    count = len(lengths)
    ends = np.cumsum(lengths + 1)
    starts = ends - lengths - 1
    spread = np.full(int(ends[-1]) if count else 0, 0xFF, np.uint8)
    inside = np.ones(len(spread), bool)
    inside[ends - 1] = False
    spread[inside] = texts
    symbols = np.empty(len(spread) + 1, np.uint16)
    symbols[:-1] = np.where(inside, spread.astype(np.uint16) + 2, 1)
    symbols[-1] = 0
    array = suffix_array(symbols, length)
    array = array[array < len(spread)]
    prefix = permuted_prefixes(spread, array)
    windows = np.maximum(lengths - length + 1, 0)
    number = np.repeat(np.arange(count), windows)
    place = np.repeat(starts - (np.cumsum(windows) - windows), windows) + np.arange(len(number))
    owner = np.full(len(spread), -1, np.int64)
    owner[place] = number
    listed = array[owner[array] >= 0]
    # A suffix that starts no window may stand between two that do; it is shorter, so it parts no group.
    least_prefix = prefix[array]
    runs = np.cumsum(least_prefix < length)[owner[array] >= 0]
    result = np.full(len(spread), np.iinfo(np.int64).max)
    if len(listed):
        first = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1])))
        low = np.minimum.reduceat(docs[owner[listed]], first)
        result[listed] = np.repeat(low, np.diff(np.append(first, len(listed))))
    return number, result[place]


# ---------------------------------------------------------------- segments of documents


def _window_hash(data: np.ndarray, length: int) -> np.ndarray:
    powers, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SYMBOLS[data.astype(np.int64) + 2] * powers[:len(data)], out=sums[1:])
    count = len(data) - length + 1
    return mix((sums[length:] - sums[:count]) * inverse[:count])


def segments(data: np.ndarray, offsets: np.ndarray, length: int, hot: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(anchor, id, row, start, bytes) of every segment; windows of ``hot`` anchors are segments of
    their own. The id is a hash of the segment's bytes."""
    none = np.zeros(0, np.int64)
    size = len(data)
    if size < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), none, none, none
    low = _anchor_hashes(data)
    reach, have = length - ANCHOR + 1, 1
    while have < reach:
        step = min(have, reach - have)
        low = np.minimum(low[:len(low) - step], low[step:])
        have += step
    ends = np.repeat(offsets[1:], np.diff(offsets))[:len(low)]
    valid = np.arange(len(low)) + length <= ends
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | ~valid[:-1]
    border = offsets[1:-1]
    new[border[border < len(low)]] = True
    if hot is not None and len(hot):
        spread = mix(low * np.uint64(BASE))
        spot = np.minimum(np.searchsorted(hot, spread), len(hot) - 1)
        is_hot = hot[spot] == spread
        if is_hot.any():
            new |= is_hot
            low = np.where(is_hot, _window_hash(data, length), low)
    start = np.flatnonzero(new & valid)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), none, none, none
    closes = np.flatnonzero(np.append(new[1:], True) | np.append(~valid[1:], True))
    last = closes[np.searchsorted(closes, start)]
    many = last - start + length
    powers, inverse = _power_tables(size + 1)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_SYMBOLS[data.astype(np.int64) + 2] * powers[:size], out=sums[1:])
    ids = mix((sums[start + many] - sums[start]) * inverse[start] + many.astype(np.uint64) * np.uint64(BASE))
    # Smallest hashes crowd at the low end: mixed once more, they spread over bits and shards.
    return mix(low[start] * np.uint64(BASE)), ids, np.searchsorted(offsets, start, "right") - 1, start, many


def _joined_blocks(batches: Iterator[pa.RecordBatch], length: int, hot: np.ndarray | None) -> Iterator[tuple]:
    """Segments of slices of about BLOCK_BYTES: (data, offsets, doc ids, segments)."""
    for batch in batches:
        data, offsets = text_buffers(batch.column(1))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, last in slices(offsets):
            low = offsets[first]
            part = np.ascontiguousarray(data[low:offsets[last]])
            own = offsets[first:last + 1] - low
            yield part, own, ids[first:last], segments(part, own, length, hot)


def _gathered(texts: np.ndarray, start: np.ndarray, many: np.ndarray) -> np.ndarray:
    end = np.cumsum(many)
    return texts[np.repeat(start - (end - many), many) + np.arange(int(end[-1]))]


def _blobs(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.Array:
    return pa.array([values[a:b].tobytes() for a, b in zip(first.tolist(), last.tolist())], pa.binary())


def _anchor_counts(length: int):
    """Rows (shard, anchors, shared, surroundings): sorted anchors of a block of documents, whether two
    of its documents have them, and how many different segments have them."""
    def pack(parts: list[tuple]) -> pa.RecordBatch:
        anchor, ids, doc = (np.concatenate([p[k] for p in parts]) for k in range(3))
        order = np.lexsort((ids, anchor))
        anchor, ids, doc = anchor[order], ids[order], doc[order]
        first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        shared = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
        other = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (ids[1:] != ids[:-1])))
        many = np.add.reduceat(other.astype(np.int32), first)
        anchor = anchor[first]
        shard = (anchor >> np.uint64(58)).astype(np.int64)
        edge = np.searchsorted(shard, np.arange(COUNT_SHARDS + 1))
        has = np.flatnonzero(np.diff(edge))
        a, b = edge[has], edge[has + 1]
        return pa.RecordBatch.from_arrays([
            pa.array(has.astype(np.int32)), _blobs(anchor, a, b), _blobs(shared, a, b), _blobs(many, a, b)],
            names=["shard", "anchors", "shared", "many"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for data, _, docs, (anchor, ids, row, _, _) in _joined_blocks(batches, length, None):
            if len(anchor):
                parts.append((anchor, ids, docs[row]))
                size += len(data)
            if size >= BLOCK_BYTES:
                yield pack(parts)
                parts, size = [], 0
        if parts:
            yield pack(parts)
    return run


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows of one shard at a time; rows come sorted by their first column."""
    shard, held = None, []
    for batch in batches:
        column = batch.column(0).to_numpy()
        cut = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), len(column)]
        for a, b in zip(cut[:-1], cut[1:]):
            if a == b:
                continue
            if held and column[a] != shard:
                yield shard, held
                held = []
            shard = column[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield shard, held


def _column(held: list[pa.RecordBatch], k: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(cell.as_buffer().to_pybytes() for part in held for cell in part.column(k)), kind)


def _marked(bits: int):
    """Per shard its part of the bit array, and its hot anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, held in _by_shard(batches):
            anchor, shared, many = _column(held, 1, np.uint64), _column(held, 2, bool), _column(held, 3, np.int32)
            order = np.argsort(anchor, kind="stable")
            anchor, shared, many = anchor[order], shared[order], many[order]
            first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
            times = np.diff(np.append(first, len(anchor)))
            keep = (times > 1) | np.maximum.reduceat(shared, first)
            hot = anchor[first][np.add.reduceat(many.astype(np.int64), first) >= HOT]
            spot = (anchor[first][keep] >> np.uint64(64 - bits)).astype(np.int64) - (int(shard) << (bits - 6))
            part = np.zeros(1 << (bits - 6), bool)
            part[spot] = True
            yield pa.RecordBatch.from_arrays([
                pa.array([int(shard)], pa.int32()), pa.array([np.packbits(part, bitorder="little").tobytes()], pa.binary()),
                pa.array([hot.tobytes()], pa.binary())], names=["shard", "bits", "hot"])
    return run


def _marks(shared) -> tuple[np.ndarray, int, np.ndarray]:
    blob, bits, hot = shared.value
    return np.frombuffer(blob, np.uint8), bits, np.frombuffer(hot, np.uint64)


def _is_marked(marks: np.ndarray, bits: int, data: np.ndarray, anchor: np.ndarray, hot_windows: np.ndarray) -> np.ndarray:
    spot = (anchor >> np.uint64(64 - bits)).astype(np.int64)
    return ((marks[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1) | hot_windows


def _sent(shared, length: int, shards: int):
    """Rows (shard, ids, docs, times, lengths, texts) of marked segments, equal ones once per block."""
    width = np.uint64(max((1 << 64) // shards, 1) & ((1 << 64) - 1)) if shards > 1 else None

    def pack(parts: list[tuple]) -> pa.RecordBatch:
        anchor, ids, doc, many, start = (np.concatenate([p[k] for p in parts]) for k in range(5))
        text = np.concatenate([p[5] for p in parts])
        shard = (anchor // width).astype(np.int64) if width is not None else np.zeros(len(anchor), np.int64)
        shard = np.minimum(shard, shards - 1)
        order = np.lexsort((doc, ids, shard))
        shard, ids, doc, many, start = shard[order], ids[order], doc[order], many[order], start[order]
        first = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (shard[1:] != shard[:-1]))))
        times = np.minimum(np.diff(np.append(first, len(ids))), 2).astype(np.uint8)
        shard, ids, doc, many, start = shard[first], ids[first], doc[first], many[first], start[first]
        edge = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
        stop = np.append(edge[1:], len(shard))
        end = np.cumsum(many)
        texts = _gathered(text, start, many)
        return pa.RecordBatch.from_arrays([
            pa.array(shard[edge].astype(np.int32)), _blobs(ids, edge, stop), _blobs(doc, edge, stop), _blobs(times, edge, stop),
            _blobs(many.astype(np.int32), edge, stop), _blobs(texts, (end - many)[edge], end[stop - 1])],
            names=["shard", "ids", "docs", "times", "lengths", "texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, bits, hot = _marks(shared)
        parts, size, base = [], 0, 0
        for data, _, docs, found in _joined_blocks(batches, length, hot):
            anchor, ids, row, start, many = _chosen(marks, bits, hot, data, found, length)
            if len(anchor):
                parts.append((anchor, ids, docs[row], many, start + base, data))
                base += len(data)
                size += int(many.sum())
            if size >= BLOCK_BYTES or base >= 4 * BLOCK_BYTES:
                yield pack(parts)
                parts, size, base = [], 0, 0
        if parts:
            yield pack(parts)
    return run


def _chosen(marks, bits, hot, data, found, length):
    """The segments that can repeat: of marked anchors, and single windows of hot ones."""
    anchor, ids, row, start, many = found
    if not len(anchor):
        return found
    single = np.zeros(len(anchor), bool)
    if len(hot):
        single = many == length      # hot windows among them; a few others cost nothing
    keep = _is_marked(marks, bits, data, anchor, single)
    return anchor[keep], ids[keep], row[keep], start[keep], many[keep]


def _anchor_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR bytes from each position on."""
    size = len(data)
    wide = np.ndarray((size,), np.uint64, np.concatenate((data, np.zeros(8, np.uint8))), 0, (1,))
    count = size - ANCHOR + 1
    low = wide[:count] * np.uint64(BASE)
    low ^= low >> np.uint64(29)
    return mix(low * np.uint64(0xC4CEB9FE1A85EC53) + wide[8:8 + count])


def _meets_another(texts: np.ndarray, start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Which of several different texts share their anchor with another one; the rest share no window."""
    hashes = _anchor_hashes(texts)
    bounds = np.stack((start, start + many - ANCHOR + 1), axis=1).reshape(-1)
    if bounds[-1] >= len(hashes):
        hashes = np.append(hashes, np.iinfo(np.uint64).max)
    anchor = np.minimum.reduceat(hashes, bounds)[::2]
    _, group, times = np.unique(anchor, return_inverse=True, return_counts=True)
    return times[group] > 1


def _resolved(length: int):
    """Per segment its runs of windows with a smallest document: id, runs (first, last, doc)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _by_shard(batches):
            ids, docs = _column(held, 1, np.uint64), _column(held, 2, np.int64)
            times, many, texts = _column(held, 3, np.uint8), _column(held, 4, np.int32).astype(np.int64), _column(held, 5, np.uint8)
            start = np.cumsum(many) - many
            order = np.lexsort((docs, ids))
            ids, docs, times, many, start = ids[order], docs[order], times[order], many[order], start[order]
            first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            repeated = np.add.reduceat(times.astype(np.int64), first) > 1
            ids, docs, many, start = ids[first], docs[first], many[first], start[first]
            own = _gathered(texts, start, many)
            begin = np.cumsum(many) - many
            meets = _meets_another(own, begin, many)
            windows = many - length + 1
            number = np.repeat(np.arange(len(ids)), windows)
            low = np.repeat(docs, windows)      # a text whose windows stand in no other text
            if meets.any():
                low[meets[number]] = smallest_documents(_gathered(own, begin[meets], many[meets]), many[meets], docs[meets], length)[1]
            new = np.flatnonzero(np.concatenate(([True], (number[1:] != number[:-1]) | (low[1:] != low[:-1]))))
            stop = np.append(new[1:], len(number))
            begin = np.searchsorted(number, np.arange(len(ids)))
            text, doc = number[new], low[new]
            keep = repeated[text] | (doc < docs[text])
            new, stop, text, doc = new[keep], stop[keep], text[keep], doc[keep]
            if len(new):
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[text].view(np.int64)), pa.array((new - begin[text]).astype(np.int32)),
                    pa.array((stop - 1 - begin[text] + length).astype(np.int32)), pa.array(doc)],
                    names=["id", "first", "stop", "least"])
    return run


def _occurrences(shared, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, bits, hot = _marks(shared)
        for data, own, docs, found in _joined_blocks(batches, length, hot):
            anchor, ids, row, start, _ = _chosen(marks, bits, hot, data, found, length)
            if len(anchor):
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids.view(np.int64)), pa.array(docs[row]), pa.array(start - own[row])], names=["id", "doc_id", "at"])
    return run


def repeated_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Byte runs of each document that smaller documents hold too: doc_id, first, stop (exclusive),
    maximal and apart. ``docs`` needs doc_id and text; rows without doc_id take no part."""
    spark = docs.sparkSession
    base = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = base.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = min(max(int(total // 8).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    shards = max(total // SHARD_BYTES, 1)

    counted = base.mapInArrow(released(_anchor_counts(length)), "shard int, anchors binary, shared binary, many binary")
    counted = counted.repartition(COUNT_SHARDS, "shard").sortWithinPartitions("shard")
    marked = stored(counted.mapInArrow(released(_marked(bits)), "shard int, bits binary, hot binary"))
    marks, hot = bytearray(1 << (bits - 3)), []
    for row in marked.toLocalIterator():     # at most 2^30 bits, however long the documents
        part = row["bits"]
        marks[row["shard"] * len(part):(row["shard"] + 1) * len(part)] = part
        hot.append(np.frombuffer(row["hot"], np.uint64))
    hot = np.sort(np.concatenate(hot)) if hot else np.zeros(0, np.uint64)
    shared = spark.sparkContext.broadcast((bytes(marks), bits, hot.tobytes()))

    sent = base.mapInArrow(released(_sent(shared, length, shards)),
                           "shard int, ids binary, docs binary, times binary, lengths binary, texts binary")
    sent = sent.repartition(max(shards // SHARDS_TASK, 1), "shard").sortWithinPartitions("shard")
    resolved = stored(sent.mapInArrow(released(_resolved(length)), "id bigint, first int, stop int, least bigint"))

    places = base.mapInArrow(released(_occurrences(shared, length)), "id bigint, doc_id bigint, at bigint")
    runs = (places.join(resolved, "id").where("least < doc_id")
            .select("doc_id", F.struct((F.col("at") + F.col("first")).alias("first"), (F.col("at") + F.col("stop")).alias("stop")).alias("run")))
    listed = runs.groupBy("doc_id").agg(F.collect_list("run").alias("runs"))
    return stored(listed.mapInArrow(released(_merged), "doc_id bigint, first array<bigint>, stop array<bigint>"))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a document, as many as its text has segments at most, joined where they touch."""
    for batch in batches:
        lists = batch.column(1)
        ends = lists.offsets.to_numpy()
        flat = lists.values
        first, stop = flat.field("first").to_numpy(), flat.field("stop").to_numpy()
        row = np.repeat(np.arange(len(lists)), np.diff(ends))
        first, stop = first[ends[0]:ends[-1]], stop[ends[0]:ends[-1]]
        if not len(row):
            continue
        order = np.lexsort((first, row))
        row, first, stop = row[order], first[order], stop[order]
        wide = int(stop.max()) + 1
        reach = np.maximum.accumulate(stop + row * wide)
        new = np.concatenate(([True], (row[1:] != row[:-1]) | (first[1:] + row[1:] * wide > reach[:-1])))
        at = np.flatnonzero(new)
        high = reach[np.append(at[1:], len(row)) - 1] - row[at] * wide
        many = np.bincount(row[at], minlength=len(lists))
        yield pa.RecordBatch.from_arrays([
            batch.column(0), list_array(pa.array(first[at]), many), list_array(pa.array(high), many)], names=["doc_id", "first", "stop"])


def _with_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """All rows of ``docs`` in a column ``row``, with doc id, text and runs (null: none)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("__id"), F.col("text").cast("string").alias("__text"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(runs, rows["__id"] == runs["doc_id"], "left").select("__id", "__text", "first", "stop", "row")


def _pairs(batch: pa.RecordBatch, k: int) -> list[tuple[int, int]]:
    first = batch.column(2)[k].as_py()
    return list(zip(first, batch.column(3)[k].as_py())) if first else []


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, removed, spans, digest = [], [], [], []
        for k in range(batch.num_rows):
            cell = batch.column(1)[k]
            text = memoryview(cell.as_buffer()) if cell.is_valid else memoryview(b"")
            state, at, gone, runs = hashlib.sha256(), 0, 0, _pairs(batch, k)
            for first, stop in runs:
                state.update(text[at:first])
                at, gone = stop, gone + stop - first
            state.update(text[at:])
            size.append(len(text))
            removed.append(gone)
            spans.append(len(runs))
            digest.append(state.hexdigest())
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
            pa.array(digest, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def removal_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """What dedup removes of every document, one row per input row.

    ``docs`` needs doc_id and text; other columns are ignored. A null text is empty; texts shorter
    than ``length`` have no window. Rows of one doc_id are one document: they remove nothing of
    each other. Rows without doc_id lose nothing and remove nothing.
    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256.
    """
    narrow = docs.select("doc_id", "text")
    runs = repeated_runs(narrow, length)
    return _with_runs(narrow, runs).mapInArrow(
        released(_digests), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def _cut(text: memoryview, runs: list[tuple[int, int]]) -> str:
    """Text without the characters that lie wholly inside a run; what is left of others stays."""
    kept, at = [], 0
    for first, stop in runs:
        while first < stop and text[first] & 0xC0 == 0x80:
            first += 1                      # the run starts inside a character: that one stays
        if stop < len(text):
            while stop > first and text[stop] & 0xC0 == 0x80:
                stop -= 1                   # it ends inside one: so does that
        kept.append(bytes(text[at:first]))
        at = max(first, stop)
    kept.append(bytes(text[at:]))
    return b"".join(kept).decode()


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated runs cut out of text, whole characters only; other columns are kept,
    and so are documents of which nothing is left (their text is empty). Null texts stay null."""
    runs = repeated_runs(docs, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for k in range(batch.num_rows):
                cell, runs = batch.column(1)[k], _pairs(batch, k)
                texts.append(_cut(memoryview(cell.as_buffer()), runs) if runs else cell.as_py())
            yield pa.RecordBatch.from_arrays([batch.column(4), pa.array(texts, pa.string())], names=["row", "cut"])

    kind = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r")).schema["r"].dataType.simpleString()
    cut = _with_runs(docs, runs).mapInArrow(released(run), f"row {kind}, cut string")
    return cut.select(*[F.col("cut").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
