"""Language-model scores: stupid backoff over bigrams of the whole corpus.

    S(w | v) = f(v w) / f(v)            if f(v w) > 0
             = BACKOFF * f(w) / N       otherwise

Counts cover all documents; a document's own occurrences are left out of f(v w) and f(w), so it is
scored by what the others hold (of f(w), those occurrences that are backed off). f(v) counts v as a
context, with a begin mark before every document; N is the number of words. A word that no other document has counts as BACKOFF occurrences. The score
of a document is the sum of ln S over its words.

The n-grams of a block of documents are exploded, sorted and sent to the shard of their context, as
flat arrays of 8 bytes an n-gram instead of rows; a shard holds the count table of its contexts and
joins it by sorting. Contexts with more than their share of all words (at most HEAVY of them) have
their bigrams dealt out over all shards, and their own counts are broadcast. What a shard cannot
find goes on to the shard of the word, which holds the unigram counts. Last, partial sums are added
up per document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import small_batches, stored
from tideline.llm.words import BASE, mix, slices, text_buffers, word_hashes

BACKOFF = 0.4
SHARD_BYTES = 16 << 20     # text per shard; an n-gram takes some 80 bytes there
SHARDS_TASK = 4            # shards that a task works through one after another, adding up sums per document
SUMS_HELD = 1 << 20        # documents whose sums a task holds at most
BLOCK_BYTES = 16 << 20     # text per block
HEAVY = 512                # a context with more than 1/HEAVY of all words is dealt out
BEGIN = np.uint64(0xBE61)  # stands before the first word of a document
_KEEP = np.uint64(64 - 48)
PARTIAL = "bucket int, sum_ids binary, sum_scores binary, sum_words binary"


def _pack48(values: np.ndarray) -> bytes:
    """The low 48 bits of each number."""
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(raw) -> np.ndarray:
    narrow = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(narrow), 8), np.uint8)
    wide[:, :6] = narrow
    return wide.reshape(-1).view("<u8")


def _shard(values: np.ndarray, shards: int) -> np.ndarray:
    return (mix(values * np.uint64(BASE)) >> np.uint64(33)).astype(np.int64) % shards


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(previous word, word, document number, document ids) of blocks of whole documents."""
    for batch in batches:
        data, offsets = text_buffers(batch.column(1))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, last in slices(offsets, BLOCK_BYTES):
            words, rows = [], []
            own = offsets[first:last + 1] - offsets[first]
            part = data[offsets[first]:offsets[last]]
            for a, b in slices(own):
                hashes, row, _, _ = word_hashes(part[own[a]:own[b]], own[a:b + 1] - own[a])
                words.append(hashes >> _KEEP)
                rows.append(row + a)
            if words:
                word, row = np.concatenate(words), np.concatenate(rows)
                before = np.empty_like(word)
                before[1:] = word[:-1]
                before[:1] = BEGIN
                before[1:][row[1:] != row[:-1]] = BEGIN
                yield before, word, row, ids[first:last]


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)


def _cuts(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    edge = np.searchsorted(shard, np.arange(shards + 1))
    has = np.flatnonzero(np.diff(edge))
    return has, edge[has], edge[has + 1]


def _counted(shards: int):
    """Unigram and context counts of a block: (shard, words, counts, contexts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for before, word, _, _ in _blocks(batches):
            if not len(word):
                continue
            value, number = np.unique(np.concatenate((word, before)), return_inverse=True)
            counts = np.bincount(number[:len(word)], minlength=len(value)).astype(np.int32)
            contexts = np.bincount(number[len(word):], minlength=len(value)).astype(np.int32)
            shard = _shard(value, shards)
            order = np.argsort(shard, kind="stable")
            value, counts, contexts = value[order], counts[order], contexts[order]
            has, a, b = _cuts(shard[order], shards)
            spans = list(zip(a.tolist(), b.tolist()))
            yield pa.RecordBatch.from_arrays([
                pa.array(has.astype(np.int32)), pa.array([_pack48(value[x:y]) for x, y in spans], pa.binary()),
                pa.array([counts[x:y].tobytes() for x, y in spans], pa.binary()),
                pa.array([contexts[x:y].tobytes() for x, y in spans], pa.binary())], names=["shard", "words", "counts", "contexts"])
    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """All rows of a shard together; rows come sorted by shard."""
    held, shard = [], None
    for batch in batches:
        column = batch.column(0).to_numpy()
        edges = [0, *(_runs(column)[1:]).tolist(), len(column)]
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            if held and column[a] != shard:
                yield shard, held
                held = []
            shard = column[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield shard, held


def _cells(held: list[pa.RecordBatch], k: int) -> Iterator:
    for part in held:
        for cell in part.column(k):
            yield cell.as_buffer() if cell.is_valid else b""


def _table(least: int):
    """Count table of a shard in flat arrays, and its heavy contexts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, held in _groups(batches):
            words = np.concatenate([_unpack48(c) for c in _cells(held, 1)])
            counts = np.concatenate([np.frombuffer(c, np.int32) for c in _cells(held, 2)]).astype(np.int64)
            contexts = np.concatenate([np.frombuffer(c, np.int32) for c in _cells(held, 3)]).astype(np.int64)
            order = np.argsort(words, kind="stable")
            words, counts, contexts = words[order], counts[order], contexts[order]
            first = _runs(words)
            words, counts, contexts = words[first], np.add.reduceat(counts, first), np.add.reduceat(contexts, first)
            heavy = contexts > least
            yield pa.RecordBatch.from_arrays([
                pa.array([int(shard)], pa.int32()), pa.array([_pack48(words)], pa.binary()), pa.array([counts.tobytes()], pa.binary()),
                pa.array([words[heavy].tobytes()], pa.binary()), pa.array([contexts[heavy].tobytes()], pa.binary())],
                names=["shard", "words", "counts", "heavy", "heavy_counts"])
    return run


def _bigrams(shared, shards: int):
    """Bigrams of a block by shard: contexts with how many bigrams each, then words and documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = shared.value[0]
        for before, word, row, ids in _blocks(batches):
            if not len(word):
                continue
            shard = _shard(before, shards)
            if len(heavy):
                dealt = heavy[np.minimum(np.searchsorted(heavy, before), len(heavy) - 1)] == before
                shard[dealt] = _shard(before[dealt] * np.uint64(3) + word[dealt], shards)
            order = np.lexsort((before, shard))
            shard, before, word, row = shard[order], before[order], word[order], row[order]
            first = _runs(mix(before * np.uint64(BASE) + shard.astype(np.uint64)))
            many = np.diff(np.append(first, len(before))).astype(np.int32)
            has, a, b = _cuts(shard, shards)
            heads = np.searchsorted(first, np.append(a, len(before)))
            narrow = len(ids) <= 1 << 16
            row = row.astype(np.uint16 if narrow else np.uint32)
            spans = list(zip(a.tolist(), b.tolist(), heads[:-1].tolist(), heads[1:].tolist()))
            blob = ids.astype(np.int64).tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array(has.astype(np.int32)), pa.array([blob] * len(has), pa.binary()),
                pa.array([_pack48(before[first[h:i]]) for _, _, h, i in spans], pa.binary()),
                pa.array([many[h:i].tobytes() for _, _, h, i in spans], pa.binary()),
                pa.array([_pack48(word[x:y]) for x, y, _, _ in spans], pa.binary()),
                pa.array([row[x:y].tobytes() for x, y, _, _ in spans], pa.binary())],
                names=["shard", "ids", "contexts", "many", "words", "rows"])
    return run


def _less_own(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, occurrences of a key in other documents) with rows sorted by key and document."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    first = _runs(key)
    total = np.diff(np.append(first, len(key)))
    own_first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))))
    own = np.diff(np.append(own_first, len(key)))
    return order, np.repeat(total, total) - np.repeat(own, own)


def _sums(doc: np.ndarray, value: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = np.bincount(doc, minlength=len(ids))
    score = np.bincount(doc, weights=value, minlength=len(ids))
    at = np.flatnonzero(words)
    return ids[at], score[at], words[at]


class _Sums:
    """Sums per document over several shards; given out when too many documents are held."""

    def __init__(self):
        self.parts, self.rows = [], 0

    def add(self, ids: np.ndarray, score: np.ndarray, words: np.ndarray) -> tuple | None:
        self.parts.append((ids, score, words))
        self.rows += len(ids)
        if self.rows > SUMS_HELD:
            merged = self.merged()
            if len(merged[0]) > SUMS_HELD // 2:
                return merged
            self.parts, self.rows = [merged], len(merged[0])
        return None

    def merged(self) -> tuple | None:
        if not self.parts:
            return None
        ids, score, words = (np.concatenate([p[k] for p in self.parts]) for k in range(3))
        self.parts, self.rows = [], 0
        ids, at = np.unique(ids, return_inverse=True)
        return ids, np.bincount(at, score, len(ids)), np.bincount(at, words, len(ids)).astype(np.int64)


def _scored(shared, shards: int):
    """Per shard: partial sums of what it holds, and (shard, words, documents) of what it does not.

    Rows with a shard are for the next exchange, rows with a bucket are partial sums.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, heavy_counts, _ = shared.value
        sums = _Sums()
        for _, held in _groups(batches):
            blocks = [np.frombuffer(c, np.int64) for c in _cells(held, 1)]
            ids, number = np.unique(np.concatenate(blocks), return_inverse=True)
            place = np.split(number, np.cumsum([len(b) for b in blocks])[:-1])
            context = np.concatenate([np.repeat(_unpack48(c), np.frombuffer(m, np.int32)) for c, m in zip(_cells(held, 2), _cells(held, 3))])
            word = np.concatenate([_unpack48(c) for c in _cells(held, 4)])
            doc = np.concatenate([
                p[np.frombuffer(r, np.uint16 if len(b) <= 1 << 16 else np.uint32)] for p, b, r in zip(place, blocks, _cells(held, 5))]).astype(np.int32)
            order, others = _less_own(mix(context * np.uint64(BASE) + word), doc)
            found = others > 0
            seen, unseen = order[found], order[~found]
            others = np.log(others[found])
            del order, found
            by_context = np.argsort(context, kind="stable")
            first = _runs(context[by_context])
            times = np.diff(np.append(first, len(context)))
            if len(heavy):
                value = context[by_context[first]]
                spot = np.minimum(np.searchsorted(heavy, value), len(heavy) - 1)
                times = np.where(heavy[spot] == value, heavy_counts[spot], times)
            whole = np.empty(len(context))
            whole[by_context] = np.repeat(np.log(times), np.diff(np.append(first, len(context))))
            del by_context, first, context
            full = sums.add(*_sums(doc[seen], others - whole[seen], ids))
            if full:
                yield _partial(*full, shards)
            del seen, others, whole
            if len(unseen):
                word, doc = word[unseen], doc[unseen]
                shard = _shard(word, shards)
                order = np.lexsort((word, shard))
                shard, word, doc = shard[order], word[order], doc[order]
                used, doc = np.unique(doc, return_inverse=True)
                first = _runs(mix(word * np.uint64(BASE) + shard.astype(np.uint64)))
                many = np.diff(np.append(first, len(word))).astype(np.int32)
                has, a, b = _cuts(shard, shards)
                heads = np.searchsorted(first, np.append(a, len(word)))
                rows = []
                for k, x, y, h, i in zip(has.tolist(), a.tolist(), b.tolist(), heads[:-1].tolist(), heads[1:].tolist()):
                    own, small = np.unique(doc[x:y], return_inverse=True)
                    rows.append((k, ids[used[own]].tobytes(), _pack48(word[first[h:i]]), many[h:i].tobytes(), small.astype(np.uint32).tobytes()))
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.binary())] * 3, pa.array([r[0] for r in rows], pa.int32()),
                     *[pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 5)]], names=_SCORED)
        full = sums.merged()
        if full:
            yield _partial(*full, shards)
    return run


_PARTIAL = ["bucket", "sum_ids", "sum_scores", "sum_words"]
_SCORED = [*_PARTIAL, "shard", "ids", "heads", "many", "docs"]


def _columns(ids: np.ndarray, score: np.ndarray, words: np.ndarray, buckets: int) -> list[pa.Array]:
    """Sums in one row per bucket of documents."""
    bucket = _shard(ids.view(np.uint64), buckets)
    order = np.argsort(bucket, kind="stable")
    ids, score, words = ids[order], score[order], words[order].astype(np.int32)
    has, a, b = _cuts(bucket[order], buckets)
    spans = list(zip(a.tolist(), b.tolist()))
    return [pa.array(has.astype(np.int32)), *[pa.array([v[x:y].tobytes() for x, y in spans], pa.binary()) for v in (ids, score, words)]]


def _partial(ids: np.ndarray, score: np.ndarray, words: np.ndarray, buckets: int) -> pa.RecordBatch:
    columns = _columns(ids, score, words, buckets)
    n = len(columns[0])
    return pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.binary())] * 4], names=_SCORED)


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a bucket's documents added up."""
    for _, held in _groups(batches):
        ids, score, words = (np.concatenate([np.frombuffer(c, kind) for c in _cells(held, k)])
                             for k, kind in ((1, np.int64), (2, np.float64), (3, np.int32)))
        own, at = np.unique(ids, return_inverse=True)
        yield pa.RecordBatch.from_arrays([
            pa.array(own), pa.array(np.bincount(at, score, len(own))), pa.array(np.bincount(at, words, len(own)).astype(np.int64))],
            names=["doc_id", "score", "words"])


def _backed_off(total: int, buckets: int):
    """Rows (shard, kind, ids, heads, many, docs): kind 0 is the shard's count table, in heads and ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for _, held in _groups(batches):
            kinds = [k for part in held for k in part.column(1).to_pylist()]
            cells = [list(_cells(held, k)) for k in (2, 3, 4, 5)]
            table = [k for k, kind in enumerate(kinds) if kind == 0]
            asked = [k for k, kind in enumerate(kinds) if kind == 1]
            if not asked:
                continue
            words = np.concatenate([_unpack48(cells[1][k]) for k in table])
            counts = np.concatenate([np.frombuffer(cells[0][k], np.int64) for k in table])
            blocks = [np.frombuffer(cells[0][k], np.int64) for k in asked]
            ids, number = np.unique(np.concatenate(blocks), return_inverse=True)
            place = np.split(number, np.cumsum([len(b) for b in blocks])[:-1])
            word = np.concatenate([np.repeat(_unpack48(cells[1][k]), np.frombuffer(cells[2][k], np.int32)) for k in asked])
            doc = np.concatenate([p[np.frombuffer(cells[3][k], np.uint32)] for p, k in zip(place, asked)])
            order, _ = _less_own(word, doc)
            word, doc = word[order], doc[order]
            own_first = np.flatnonzero(np.concatenate(([True], (word[1:] != word[:-1]) | (doc[1:] != doc[:-1]))))
            own = np.diff(np.append(own_first, len(word)))
            rest = counts[np.searchsorted(words, word)] - np.repeat(own, own)
            value = np.log(BACKOFF * np.maximum(rest, BACKOFF) / total)
            full = sums.add(*_sums(doc, value, ids))
            if full:
                yield pa.RecordBatch.from_arrays(_columns(*full, buckets), names=_PARTIAL)
        full = sums.merged()
        if full:
            yield pa.RecordBatch.from_arrays(_columns(*full, buckets), names=_PARTIAL)
    return run


def backoff_scores(docs: DataFrame) -> DataFrame:
    """Score of every document under the corpus: doc_id, n_words, score, mean_score, perplexity.

    ``docs`` needs doc_id and text; other columns are ignored. Rows of one doc_id are one document
    and give one row; rows without doc_id are scored together as the document null. A document
    without words has n_words 0, score 0 and a null mean and perplexity. A word backed off is
    looked up less its backed-off occurrences in the same document.
    """
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63) + 1)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = base.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(math.ceil(size / SHARD_BYTES), 1)

    def dealt(frame: DataFrame, key: str = "shard") -> DataFrame:
        return frame.repartition(math.ceil(shards / SHARDS_TASK), key).sortWithinPartitions(key)

    counted = dealt(base.mapInArrow(_counted(shards), "shard int, words binary, counts binary, contexts binary"))
    least = max(size // 6 // HEAVY, 1)      # a word has about six bytes: heavier than its share of them
    tables = stored(counted.mapInArrow(_table(least), "shard int, words binary, counts binary, heavy binary, heavy_counts binary"))
    words, counts, total = [], [], 0
    for row in tables.select("heavy", "heavy_counts").toLocalIterator():     # about HEAVY contexts in all
        words.append(np.frombuffer(row[0], np.uint64))
        counts.append(np.frombuffer(row[1], np.int64))
    for row in tables.select("counts").mapInArrow(_totals, "total bigint").agg(F.sum("total")).collect():
        total = row[0] or 0
    heavy = np.concatenate(words) if words else np.zeros(0, np.uint64)
    order = np.argsort(heavy)
    shared = spark.sparkContext.broadcast((heavy[order], (np.concatenate(counts) if counts else np.zeros(0, np.int64))[order], total))

    sent = dealt(base.mapInArrow(_bigrams(shared, shards), "shard int, ids binary, contexts binary, many binary, words binary, rows binary"))
    scored = stored(sent.mapInArrow(_scored(shared, shards), f"{PARTIAL}, shard int, ids binary, heads binary, many binary, docs binary"))
    asked = scored.where("shard is not null").select("shard", F.lit(1).alias("kind"), "ids", "heads", "many", "docs")
    table = tables.select("shard", F.lit(0).alias("kind"), F.col("counts").alias("ids"), F.col("words").alias("heads"),
                          F.lit(None).cast("binary").alias("many"), F.lit(None).cast("binary").alias("docs"))
    rest = dealt(asked.unionByName(table)).mapInArrow(_backed_off(total, shards), PARTIAL)

    parts = dealt(scored.where("shard is null").select(*_PARTIAL).unionByName(rest), "bucket")
    parts = parts.mapInArrow(_per_document, "doc_id bigint, score double, words bigint")
    # Every document takes part with nothing, so that those without words are there too.
    parts = parts.unionByName(base.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).cast("bigint").alias("words")))
    summed = parts.groupBy("doc_id").agg(F.sum("words").alias("n_words"), F.sum("score").alias("score"))
    mean = F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words"))
    return summed.select(F.when(F.col("doc_id") != -(1 << 63) + 1, F.col("doc_id")).alias("doc_id"), "n_words", "score",
                         mean.alias("mean_score"), F.exp(-mean).alias("perplexity"))


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([int(sum(np.frombuffer(c.as_buffer(), np.int64).sum() for c in batch.column(0)))], pa.int64())], names=["total"])
