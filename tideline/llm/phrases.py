"""Phrase collocations: frequent phrases of two to four words, scored by their weakest cut.

A suffix pointer is a word together with the up to three words behind it in its piece of text. Counting
goes in three passes over the texts. The first counts single words and, in two histograms of fixed size, the
pairs and the triples of words that lead the pointers. The second counts hashes of 32 bits of the pairs of frequent words. The
third sends pointers, equal ones of one slice of text as one with their number, to shards by their two leading words,
by three where many pointers share two, and by all four where many share three. A pointer ends at the first word, and
before the first pair, that is too rare for any phrase, as two filters of at most FILTER_BITS say; a filter may let more through, which
changes no result. So every shard has its phrases whole, but for those shorter than what it was dealt by, whose
counts are added up afterwards.

A shard sorts its pointers with multikey three-way quicksort, down to four words: each partition is cut by
a pivot word into smaller, equal and larger; the size of an equal partition is the count of the words
it shares, and only the equal one goes on to the next word. Partitions of too few occurrences are abandoned;
small ones are put together and sorted at once as vectors.

Words are compared as they are: hashes only deal pointers out and filter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.shared import small_batches, stored
from tideline.llm.words import _LOWER, BASE, SLICE_BYTES, exact_ids, mix, slices, text_buffers, word_bytes, word_hashes

LEAST = 30               # occurrences of a candidate
TOP = 2000               # phrases reported per language
DEPTH = 4                # words of the longest phrase
CONTAINED = 80           # percent of a candidate's occurrences inside one longer candidate that drop it
SLICE = 4 << 20          # bytes of text whose pointers are put together
SHARD_WORDS = 1 << 20    # words per shard, about
SMALL = 512              # pointers of a partition that is sorted as it is
LEADS = 1 << 16          # buckets of a histogram of leading words
FILTER_BITS = 1 << 28    # most bits of a filter: 32 MB
CHUNK_BITS = 1 << 19
PENDING = 400_000        # counted words held before they are added up

_CUTS = np.zeros(256, bool)
_CUTS[[*b".,;:!?", 10, 11, 12, 13]] = True
_BETWEEN = _CUTS.copy()
_BETWEEN[[32, 9]] = True
PAIRS = "shard int, first bigint, steps binary, counts binary"
POINTERS = "shard int, lang string, whole int, words binary, ids binary, counts binary"


def _lang_key(langs: Sequence[str]) -> np.ndarray:
    return mix(np.array([zlib.crc32(x.encode()) for x in langs], np.uint64) + np.uint64(1))


def _languages(column: pa.Array) -> tuple[list[str], np.ndarray]:
    coded = column.cast(pa.string()).fill_null("und").dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)


class Slice:
    """The words of some texts: bytes in lower case, hash, start and end of every word, code of its language, and
    whether the next word follows in the same piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, codes: np.ndarray):
        found = []
        for first, last in slices(offsets, SLICE_BYTES):
            low = offsets[first]
            hashes, rows, starts, ends = word_hashes(data[low:offsets[last]], offsets[first:last + 1] - low, between=_BETWEEN)
            found.append((hashes, rows + first, starts + low, ends + low))
        hashes, rows, self.starts, self.ends = (np.concatenate(x) for x in zip(*found))
        self.data = _LOWER[data]
        self.lang = codes[rows]
        self.hashes = hashes
        cut = np.flatnonzero(_CUTS[data])
        piece = np.searchsorted(cut, self.starts)
        self.next = np.zeros(len(rows), bool)
        self.next[:-1] = (rows[1:] == rows[:-1]) & (piece[1:] == piece[:-1])

    def spelt(self, at: np.ndarray) -> pa.Array:
        """The words of some places."""
        starts, ends = self.starts[at], self.ends[at]
        offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(self.data[word_bytes(starts, ends)].tobytes()))

    def leads(self, key: np.ndarray, many: int) -> np.ndarray:
        """A hash of the language and the ``many`` words from every place on, as far as there are places."""
        total = key[self.lang] + self.hashes
        for k in range(1, many):
            total[:len(total) - k] = mix(total[:len(total) - k] * np.uint64(BASE) + self.hashes[k:])
        return mix(total)


def _sliced(batch: pa.RecordBatch) -> Iterator[tuple[list[str], Slice]]:
    langs, codes = _languages(batch.column(0))
    data, offsets = text_buffers(batch.column(1))
    for first, last in slices(offsets, SLICE):
        if offsets[last] > offsets[first]:
            part = Slice(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], codes[first:last])
            if len(part.starts):
                yield langs, part


# ---------------------------------------------------------------- first pass


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (kind, lang, word, n): 0 a word, 2 and 3 a bucket of the pairs and triples that lead pointers."""
    schema = pa.schema([("kind", pa.int32()), ("lang", pa.string()), ("word", pa.large_string()), ("n", pa.int64())])
    buckets = np.zeros((2, LEADS), np.int64)
    held: pa.Table | None = None
    for batch in batches:
        for langs, part in _sliced(batch):
            ids, first = exact_ids(part.data, part.hashes, part.starts, part.ends)
            key, at, n = np.unique(part.lang * len(first) + ids, return_index=True, return_counts=True)
            lang = pa.DictionaryArray.from_arrays(pa.array(part.lang[at].astype(np.int32)), pa.array(langs, pa.string())).cast(pa.string())
            now = pa.table([pa.array(np.zeros(len(at), np.int32)), lang, part.spelt(at), pa.array(n)], schema=schema)
            held = now if held is None else pa.concat_tables([held, now])
            lead = _lang_key(langs)
            two = part.next
            three = two[:-1] & two[1:]
            buckets[0] += np.bincount((part.leads(lead, 2)[two] % np.uint64(LEADS)).astype(np.int64), minlength=LEADS)
            buckets[1] += np.bincount((part.leads(lead, 3)[:-1][three] % np.uint64(LEADS)).astype(np.int64), minlength=LEADS)
            if held.num_rows > PENDING:
                held = held.group_by(["kind", "lang", "word"]).aggregate([("n", "sum")]).rename_columns(schema.names).cast(schema)
                if held.num_rows > PENDING // 2:
                    yield from held.combine_chunks().to_batches(max_chunksize=50_000)
                    held = None
    if held is not None:
        yield from held.group_by(["kind", "lang", "word"]).aggregate([("n", "sum")]).rename_columns(schema.names).cast(schema).to_batches(max_chunksize=50_000)
    for kind, row in zip((2, 3), buckets):
        at = np.flatnonzero(row)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.nulls(len(at), pa.string()),
                                              pa.array(at).cast(pa.large_string()), pa.array(row[at])], schema=schema)


def _word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of words (lang, word)."""
    for batch in batches:
        langs, codes = _languages(batch.column(0))
        data, offsets = text_buffers(batch.column(1))
        for first, last in slices(offsets, SLICE_BYTES):
            low = offsets[first]
            hashes, rows, _, _ = word_hashes(data[low:offsets[last]], offsets[first:last + 1] - low, lower=False, between=np.zeros(256, bool))
            yield pa.RecordBatch.from_arrays([pa.array((_lang_key(langs)[codes[first + rows]] + hashes).view(np.int64))], names=["key"])


def _filter_places(bits: int):
    """The bit of every key: chunk, bit within it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = _place(batch.column(0).to_numpy().view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([pa.array((place // CHUNK_BITS).astype(np.int32)), pa.array((place % CHUNK_BITS).astype(np.int32))], names=["chunk", "bit"])
    return run


def _place(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix(keys) % np.uint64(bits)).astype(np.int64)


def _passes(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in a filter."""
    place = _place(keys, 8 * len(packed))
    return (packed[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 > 0


def _chunk_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of the filter from rows (chunk, bit) sorted by chunk."""
    chunk, bits = None, np.zeros(CHUNK_BITS, bool)

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["chunk", "bytes"])

    for batch in batches:
        chunks, places = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        for value in np.unique(chunks).tolist():
            if value != chunk:
                if chunk is not None:
                    yield close()
                chunk, bits = value, np.zeros(CHUNK_BITS, bool)
            bits[places[chunks == value]] = True
    if chunk is not None:
        yield close()


def _filter(keys: DataFrame) -> np.ndarray:
    """Packed bits of all ``keys`` (key: bigint); at least 16 bits a key up to FILTER_BITS."""
    bits = min(max(1 << (16 * max(keys.count(), 1)).bit_length(), CHUNK_BITS), FILTER_BITS)
    packed = np.zeros(bits // 8, np.uint8)
    places = keys.mapInArrow(_filter_places(bits), "chunk int, bit int").distinct()
    chunks = places.repartition(max(bits // CHUNK_BITS // 64, 1), "chunk").sortWithinPartitions("chunk")
    for row in chunks.mapInArrow(_chunk_bytes, "chunk int, bytes binary").toLocalIterator():
        packed[row[0] * (CHUNK_BITS // 8):(row[0] + 1) * (CHUNK_BITS // 8)] = np.frombuffer(row[1], np.uint8)
    return packed


# ---------------------------------------------------------------- second pass


def _linked(part: Slice, lead: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Where a frequent word is followed by another one in the same piece."""
    common = _passes(words, lead[part.lang] + part.hashes)
    link = part.next & common
    link[:-1] &= common[1:]
    return link


def _pairs(shared, shards: int):
    """Hashes of 32 bits of the pairs of frequent words, by ranges of hashes: the first one, the steps to the next ones, and
    how often each stands (255 for more)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for langs, part in _sliced(batch):
                lead = _lang_key(langs)
                keys = (part.leads(lead, 2)[_linked(part, lead, shared.value)] >> np.uint64(32)).astype(np.uint32)
                keys, n = np.unique(keys, return_counts=True)
                n = np.minimum(n, 255).astype(np.uint8)
                shard = ((keys.astype(np.uint64) * np.uint64(shards)) >> np.uint64(32)).astype(np.int32)
                edges = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(keys)).tolist()
                steps = [np.diff(keys[a:b]) for a, b in zip(edges[:-1], edges[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(shard[edges[:-1]], pa.int32()), pa.array(keys[edges[:-1]].astype(np.int64)),
                    pa.array([(x.astype(np.uint16) if x.max(initial=0) < 1 << 16 else x).tobytes() for x in steps], pa.binary()),
                    pa.array([n[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())], names=["shard", "first", "steps", "counts"])
    return run


def _frequent_pairs(least: int):
    """Keys of the pairs that stand often enough, of shards whose rows come one after another."""
    def close(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        keys = []
        for first, steps, counts in rows:
            narrow = len(steps) == 2 * (len(counts) - 1)
            keys.append(first + np.cumsum(np.append(0, np.frombuffer(steps, np.uint16 if narrow else np.uint32).astype(np.int64))))
        keys, counts = np.concatenate(keys), np.frombuffer(b"".join(r[2] for r in rows), np.uint8)
        order = np.argsort(keys)
        keys = keys[order]
        begin = np.flatnonzero(np.diff(keys, prepend=-1))
        total = np.add.reduceat(counts[order].astype(np.int64), begin)
        return pa.RecordBatch.from_arrays([pa.array(keys[begin[total >= min(least, 255)]])], names=["key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                now = batch.column(0)[k].as_py()
                if now != shard and held:
                    yield close(held)
                    held = []
                shard = now
                held.append(tuple(batch.column(c)[k].as_py() for c in (1, 2, 3)))
        if held:
            yield close(held)
    return run


def _pointers(shared, shards: int):
    """Suffix pointers dealt to shards: for each shard, language and number of words dealt by, the words once, the numbers
    of the words of each pointer one column after another (-1 behind its end), and how often it stands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, many_pairs, many_triples = shared.value
        for batch in batches:
            for langs, part in _sliced(batch):
                lead = _lang_key(langs)
                link = _linked(part, lead, words)
                at = np.flatnonzero(link)
                link[at] = _passes(pairs, part.leads(lead, 2)[at] >> np.uint64(32))
                at = np.flatnonzero(link)
                if not len(at):
                    continue
                used = link.copy()
                used[1:] |= link[:-1]
                place = np.flatnonzero(used)
                ids = np.zeros(len(used), np.int64)
                ids[place], first = exact_ids(part.data, part.hashes[place], part.starts[place], part.ends[place])
                first = place[first]
                rows = np.full((DEPTH, len(at)), -1, np.int64)
                rows[0], rows[1] = ids[at], ids[at + 1]
                go = np.ones(len(at), bool)
                for k in range(2, DEPTH):
                    go = go & link[np.minimum(at + k - 1, len(link) - 1)] & (at + k < len(ids))
                    rows[k, go] = ids[at[go] + k]
                # Equal pointers become one: numbers of the pairs, then of pairs of pairs.
                width = len(first) + 1
                head = np.unique((part.lang[at] * width + rows[0]) * width + rows[1], return_inverse=True)[1]
                tail = (rows[2] + 1) * width + rows[3] + 1
                tail = np.unique(tail, return_inverse=True)[1]
                _, one, n = np.unique(head * (int(tail.max()) + 1) + tail, return_index=True, return_counts=True)
                at, rows = at[one], rows[:, one]

                # Dealt by as many leading words as it takes to be few.
                two, three, four = (part.leads(lead, k)[at] for k in (2, 3, 4))
                size = (rows >= 0).sum(axis=0)
                whole = np.full(len(at), 2)
                whole[many_pairs[(two % np.uint64(LEADS)).astype(np.int64)]] = 3
                whole[(whole == 3) & (size >= 3) & many_triples[(three % np.uint64(LEADS)).astype(np.int64)]] = 4
                deal = np.where(np.minimum(whole, size) == 2, two, np.where(np.minimum(whole, size) == 3, three, four))
                shard = (mix(deal) % np.uint64(shards)).astype(np.int64)
                group = (shard * len(langs) + part.lang[at]) * 8 + whole
                order = np.argsort(group, kind="stable")
                edges = np.flatnonzero(np.diff(group[order], prepend=-1))
                columns: list[list] = [[] for _ in range(6)]
                for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
                    mine = order[a:b]
                    used, number = np.unique(rows[:, mine], return_inverse=True)
                    gone = int(used[0] < 0)
                    spelt = part.spelt(first[used[gone:]])
                    values = (shard[mine[0]], langs[part.lang[at[mine[0]]]], whole[mine[0]], _packed_words(spelt),
                              (number.reshape(rows[:, mine].shape) - gone).astype(np.int16 if len(used) < 1 << 15 else np.int32).tobytes(),
                              n[mine].astype(np.int32).tobytes())
                    for column, value in zip(columns, values):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    columns, (pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["shard", "lang", "whole", "words", "ids", "counts"])
    return run


def _packed_words(words: pa.LargeStringArray) -> bytes:
    return b"\n".join(words.cast(pa.large_binary()).to_pylist())


def equal_partitions(ids: np.ndarray, counts: np.ndarray, least: int, whole: int = 2, small: int = SMALL) -> list[tuple[np.ndarray, int, np.ndarray]]:
    """(pointers, words shared, occurrences) of the equal partitions of two words and more, by multikey three-way
    quicksort of pointers ``ids`` (one row per word, -1 behind the end).

    Partitions with fewer than ``least`` occurrences are abandoned, unless they share fewer than ``whole`` words: those are
    told however few.
    """
    depth, found, rest = len(ids), [], []
    stack = [(np.arange(ids.shape[1]), 0)]
    one = ([], [], [])
    while stack:
        mine, shared = stack.pop()
        if not len(mine) or (max(shared + 1, 2) >= whole and counts[mine].sum() < least):
            continue
        if len(mine) <= small:
            rest.append((mine, shared))
            continue
        word = ids[shared, mine]
        drawn = np.sort(word[::max(len(word) // 101, 1)])
        pivot = drawn[len(drawn) // 2]
        equal = mine[word == pivot]
        stack += [(mine[word < pivot], shared), (mine[word > pivot], shared)]
        if pivot >= 0:
            total = int(counts[equal].sum())
            if shared >= 1 and (total >= least or shared + 1 < whole):
                for column, value in zip(one, (equal[0], shared + 1, total)):
                    column.append(value)
            if shared + 1 < depth:
                stack.append((equal, shared + 1))
    if one[0]:
        for k in range(2, depth + 1):
            own = np.array(one[1]) == k
            found.append((np.array(one[0])[own], k, np.array(one[2])[own]))
    if rest:
        mine = np.concatenate([p for p, _ in rest])
        size = np.array([len(p) for p, _ in rest])
        partition, told = np.repeat(np.arange(len(rest)), size), np.repeat(np.array([d for _, d in rest]), size)
        order = np.lexsort([*ids[::-1, mine], partition])
        mine, partition, told = mine[order], partition[order], told[order]
        weight = counts[mine]
        new = np.ones(len(mine), bool)
        new[1:] = partition[1:] != partition[:-1]
        for k in range(depth):
            word = ids[k, mine]
            new[1:] |= word[1:] != word[:-1]
            begin = np.flatnonzero(new)
            total = np.add.reduceat(weight, begin)
            fits = (word[begin] >= 0) & (told[begin] <= k) & ((total >= least) | (k + 1 < whole))
            if k >= 1:
                found.append((mine[begin[fits]], k + 1, total[fits]))
    return found


def _mined(least: int):
    """Phrases (lang, words, phrase, n) of shards whose rows come one after another."""
    def close(lang: str, whole: int, rows: list[tuple[bytes, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        lists = [r[0].split(b"\n") for r in rows]
        words = pa.array([w for x in lists for w in x], pa.large_binary()).dictionary_encode()
        number = words.indices.to_numpy()
        base = np.cumsum([0] + [len(x) for x in lists])
        ids = []
        for k, (_, raw, counts) in enumerate(rows):
            own = np.frombuffer(raw, np.int16 if len(raw) < DEPTH * len(counts) else np.int32).reshape(DEPTH, -1).astype(np.int64)
            ids.append(np.where(own >= 0, number[base[k]:base[k + 1]][np.maximum(own, 0)], -1))
        ids = np.concatenate(ids, axis=1)
        counts = np.concatenate([np.frombuffer(r[2], np.int32) for r in rows]).astype(np.int64)
        for at, many, total in equal_partitions(ids, counts, least, whole, SMALL):
            for a in range(0, len(at), 50_000):
                part = at[a:a + 50_000]
                spelt = [words.dictionary.take(pa.array(ids[k, part])).cast(pa.large_string()) for k in range(many)]
                phrase = pc.binary_join_element_wise(*spelt, pa.scalar(" ", pa.large_string()))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(np.full(len(part), many, np.int32)),
                                                  phrase.cast(pa.string()), pa.array(total[a:a + 50_000])], names=["lang", "words", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                now = tuple(batch.column(c)[k].as_py() for c in range(3))
                if now != key:
                    if held:
                        yield from close(*key[1:], held)
                    key, held = now, []
                held.append(tuple(batch.column(c)[k].as_py() for c in (3, 4, 5)))
        if held:
            yield from close(*key[1:], held)
    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, words, sizes) of ``docs`` (text, lang): lang, phrase, words and n of every phrase of two to four words with at
    least ``least`` occurrences; lang, word and n of every word with as many; lang and n, all words of a language."""
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    counted = stored(base.mapInArrow(_counted, "kind int, lang string, word string, n bigint").groupBy("kind", "lang", "word").agg(F.sum("n").alias("n")))
    words = counted.where(F.col("kind") == 0).select("lang", "word", "n")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(math.ceil(total / SHARD_WORDS), 1)
    frequent = words.where(F.col("n") >= least)

    heavy = np.zeros((2, LEADS), bool)      # leading words with more than half a shard's share
    for row in counted.where((F.col("kind") > 0) & (2 * F.col("n") * shards > total)).select("kind", "word").toLocalIterator():    # at most 2 LEADS rows
        heavy[row[0] - 2, int(row[1])] = True
    word_filter = _filter(stored(frequent.select("lang", "word").mapInArrow(_word_keys, "key bigint")))
    ranges = max(math.ceil(total / SHARD_WORDS / 4), 1)
    pairs = base.mapInArrow(_pairs(spark.sparkContext.broadcast(word_filter), ranges), PAIRS).repartition(ranges, "shard").sortWithinPartitions("shard")
    pair_filter = _filter(stored(pairs.mapInArrow(_frequent_pairs(least), "key bigint")))
    shared = spark.sparkContext.broadcast((word_filter, pair_filter, heavy[0], heavy[1]))
    dealt = base.mapInArrow(_pointers(shared, shards), POINTERS).repartition(shards, "shard").sortWithinPartitions("shard", "lang", "whole")
    mined = dealt.mapInArrow(_mined(least), "lang string, words int, phrase string, n bigint")
    phrases = mined.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return stored(phrases), frequent, sizes


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, contained: int = CONTAINED) -> DataFrame:
    """The first ``top`` phrases per language: lang, rank, phrase, a, l, r, n, score.

    ``docs`` needs text and lang; other columns are ignored. Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and at line
    breaks, and pieces into words at spaces and tabs. A phrase has two to four words and ``least`` occurrences a; cut after its
    first k words into parts of l and r occurrences it scores floor(2000000 a / (l + r)), and its lowest score counts (ties:
    the smallest k). Phrases inside a longer one that makes up ``contained`` percent of their occurrences are left out. A null
    lang is ``und``; null, empty and wordless texts count nothing; repeated rows count each. Arithmetic is exact.
    """
    phrases, words, sizes = frequent_phrases(docs, least)
    known = phrases.select("lang", "phrase", F.col("n").alias("part_n")).unionByName(words.select("lang", F.col("word").alias("phrase"), F.col("n").alias("part_n")))
    split = F.split("phrase", " ")
    cuts = (phrases.select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
            .select("*", F.array_join(F.slice(split, F.lit(1), F.col("k")), " ").alias("first"),
                    F.array_join(F.slice(split, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest")))
    left = known.select("lang", F.col("phrase").alias("first"), F.col("part_n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("part_n").alias("r"))
    joined = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr("(cast(2000000 as decimal(20,0)) * cast(a as decimal(18,0))) div (cast(l as decimal(20,0)) + r)")
    scored = (joined.withColumn("score", score).groupBy("lang", "phrase")
              .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best")).select("lang", "phrase", "best.*"))

    inside = (phrases.where("words > 2").select("lang", split.alias("ws"), "words", "n")
              .select("lang", "ws", "words", "n", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
              .select("lang", "ws", "n", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at"))
              .select("lang", F.array_join(F.slice("ws", F.col("at"), F.col("size")), " ").alias("phrase"), "n"))
    longer = inside.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        f"longer is null or 100 * cast(longer as decimal(20,0)) < {contained} * cast(a as decimal(20,0))")

    return _ranked(kept, top).join(F.broadcast(sizes), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _ranked(frame: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows per language with their rank; tasks keep their own first rows before they are brought together."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = frame.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.where(F.col("rank") <= top)
