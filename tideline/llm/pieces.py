"""SentencePiece encoding and decoding over a relational lattice.

A text is cut at every space or run of spaces, and between two bytes that stand side by side in no
piece, where no path could cross; a word is what stands between two cuts, with the run in front of it, and
one space more if it begins the text. A space is what the pieces call the mark U+2581. The lattice of a word has an edge for every substring that is a piece: substrings of at most the longest
piece's length are exploded and equi-joined with the piece table, edges are grouped by word, and
the best path is folded with Spark's higher-order ``aggregate``: the largest sum of piece scores; of
equal sums the edge that starts first. A character that no piece covers is an edge of its UTF-8 bytes.

Every distinct word goes through the lattice once. The paths of the commonest COMMON_WORDS are broadcast, a
bounded table, and looked up where documents are read. Only where there are more words, documents are dealt to places
by their hash, and the paths of the rarer words of a place are joined to it by the word. Which words are common decides speed only,
not results. Words over STRETCH characters take the same best path, found in the task that needs it in time and memory
linear in the word.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.shared import small_batches, stored
from tideline.llm.words import BASE, SLICE_BYTES, list_array, mix, slices, span_hashes, text_buffers, word_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
COMMON_WORDS = 4_000_000   # words whose paths are broadcast at most, some 20 bytes each
TASK_SLICE = 1 << 18       # bytes of text encoded at once
PENDING = 300_000          # counted words held before they are added up
PLACES = 4                 # groups of documents per shuffle partition, where words are left that are not broadcast
STRETCH = 512              # longer words go through ``best_ids`` instead of rows of edges
BYTE_PENALTY = 1e12        # what an edge of bytes costs, more than any piece
WORD_FIELDS = "hash bigint, part int, word string"


def piece_rows(model_path: str = MODEL) -> list[tuple[str, int, float, int]]:
    """(piece, id, score, byte value or -1) of a SentencePiece model; control pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    rows = []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            rows.append((piece, k, model.get_score(k), int(piece[3:5], 16)))
        elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
            # Words are cut before runs of spaces: no piece has a mark behind another character.
            if MARK not in piece.lstrip(MARK):
                rows.append((piece, k, model.get_score(k), -1))
    return rows


def _with_edges(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """``words`` with a row per edge, by stop and start: a substring that is a piece, or a character that is
    none, as its bytes (id -1 - start). Rows without a word stay as they are, with a null id."""
    size, start, stop = F.length("word"), F.col("start"), F.col("stop")
    exploded = words.withColumn("stop", F.explode_outer(F.when(size > 0, F.sequence(F.lit(1), size))))
    exploded = exploded.withColumn("start", F.explode_outer(F.when(stop.isNotNull(), F.sequence(F.greatest(stop - longest, F.lit(0)), stop - 1))))
    text = F.substring("word", start + 1, stop - start)
    # The piece table is a fixed vocabulary, read from the model file. A mark in a text is a character of it, not a
    # space: it is in no piece and left to the edge of bytes.
    table = F.broadcast(pieces.where("byte < 0").select(F.translate("piece", MARK, " ").alias("__piece"), "piece_id", "score"))
    joined = exploded.withColumn("__piece", text).join(table, "__piece", "left")
    bare = F.col("piece_id").isNull() & (stop - start == 1)
    kept = joined.where(F.col("piece_id").isNotNull() | F.coalesce(bare, F.lit(True)))
    return kept.select(*words.columns, "stop", "start", F.when(bare, -1 - start).otherwise(F.col("piece_id")).alias("id"),
                       F.when(bare, F.lit(-BYTE_PENALTY)).otherwise(F.col("score")).alias("score"))


def _best_path(matched: Column, size: Column) -> Column:
    """Ids of the best path through ``matched``, the edges (start, id, score) into every position from 1 on;
    id -1 - start for bytes.

    The fold keeps the best arrival per position: no position is without an edge, as every character
    has one of its own.
    """
    begin = F.array(F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("back"), F.lit(0).alias("id")))

    def reach(done: Column, edges: Column) -> Column:
        arrivals = F.transform(edges, lambda e: F.struct(
            (F.get(done, e["start"])["total"] + e["score"]).alias("total"), (-e["start"]).alias("back"), e["id"].alias("id")))
        return F.concat(done, F.array(F.array_max(arrivals)))

    def walk(state: Column, stop: Column) -> Column:
        at = F.get(state["arrivals"], stop)
        return F.when(state["at"] == stop, F.struct(
            state["arrivals"].alias("arrivals"), (-at["back"]).alias("at"),
            F.concat(F.array(at["id"]), state["ids"]).alias("ids"))).otherwise(state)

    start = F.struct(F.aggregate(matched, begin, reach).alias("arrivals"), size.alias("at"), F.array().cast("array<int>").alias("ids"))
    return F.aggregate(F.sequence(size, F.lit(1), F.lit(-1)), start, walk, lambda s: s["ids"])


_EDGE = pa.struct([("start", pa.int32()), ("id", pa.int32()), ("score", pa.float64())])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (hash, part, word, stop, start, id, score) of one word together as one row, its edges by stop. The edges of a word
    come one after another, by stop, the first of them with the word; a word begins with its only edge of stop 1."""
    names = ["hash", "part", "word", "matched"]
    held: list[pa.RecordBatch] = []

    def close(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for batch in table.combine_chunks().to_batches():
            stop = batch.column(3).fill_null(0).to_numpy(zero_copy_only=False)
            head, hit = stop <= 1, stop > 0
            owner, into = (np.cumsum(head) - 1)[hit], stop[hit]
            begin = np.flatnonzero(np.concatenate(([True], (into[1:] != into[:-1]) | (owner[1:] != owner[:-1])))[:len(into)])
            edges = batch.filter(pa.array(hit))
            flat = pa.StructArray.from_arrays([edges.column(k).cast(t.type) for k, t in zip((4, 5, 6), _EDGE)], fields=list(_EDGE))
            heads = batch.filter(pa.array(head))
            per_stop = list_array(flat, np.diff(np.append(begin, len(into))))
            matched = list_array(per_stop, np.bincount(owner[begin], minlength=heads.num_rows))
            yield pa.RecordBatch.from_arrays([*heads.columns[:3], matched], names=names)

    for batch in batches:
        heads = np.flatnonzero(batch.column(3).fill_null(0).to_numpy(zero_copy_only=False) <= 1)
        cut = int(heads[-1]) if len(heads) else 0      # what begins last may go on in the next batch
        if cut or len(heads):
            before = pa.Table.from_batches([*held, batch.slice(0, cut)])
            if before.num_rows:
                yield from close(before)
            held = []
        held.append(batch.slice(cut))
    if held and (rest := pa.Table.from_batches(held)).num_rows:
        yield from close(rest)


def encode_words(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """Ids of distinct words (hash, part, word) as ``path``: explode, equi-join, group by word, fold. The edges of a word are
    made in one task and come one after another, so they are grouped where they are."""
    edges = _with_edges(words.repartition("hash", "part"), pieces, longest)
    first = F.coalesce(F.col("stop") == 1, F.lit(True))       # only the first edge carries the word
    own = [F.when(first, F.col(c)).alias(c) for c in ("hash", "part", "word")]
    grouped = edges.select(*own, "stop", "start", "id", "score").mapInArrow(
        _gathered, f"{WORD_FIELDS}, matched array<array<struct<start:int,id:int,score:double>>>")
    size = F.length("word")
    path = F.when(size > 0, _best_path(F.col("matched"), size)).otherwise(F.array().cast("array<int>"))
    return grouped.select("hash", "part", "word", path.alias("path"))


# ---------------------------------------------------------------- words of texts


def pair_table(rows: list[tuple[str, int, float, int]]) -> np.ndarray:
    """Which bytes stand side by side in some piece."""
    pairs = np.zeros((256, 256), bool)
    for piece, _, _, byte in rows:
        if byte < 0:
            raw = np.frombuffer(piece.encode(), np.uint8)
            pairs[raw[:-1], raw[1:]] = True
    return pairs


def _words(data: np.ndarray, offsets: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, row, start, stop, whether a space goes before) of every word of every non-empty text; words
    may be empty."""
    full = np.flatnonzero(np.diff(offsets) > 0)
    space = data == 32
    space[1:] &= data[:-1] != 32
    space[offsets[full]] = False        # the spaces that begin a text belong to its first word
    space = np.flatnonzero(space)
    cut = np.zeros(len(data), bool)
    if len(data) > 1:
        cut[1:] = ~pairs[data[:-1], data[1:]] & (data[1:] & 0xC0 != 0x80) & (data[1:] != 32) & (data[:-1] != 32)
    cut[offsets[full]] = False
    cut = np.flatnonzero(cut)
    begins = np.concatenate((space + 1, offsets[full]))
    start = np.concatenate((begins, cut))
    marked = np.arange(len(start)) < len(begins)
    order = np.argsort(start, kind="stable")
    start, marked = start[order], marked[order]
    stop = np.sort(np.concatenate((space, offsets[full + 1], cut)), kind="stable")
    size = (stop - start).astype(np.uint64) * np.uint64(2) + marked
    hashes = mix(span_hashes(data, start, stop) + size * np.uint64(BASE))
    many = sum(np.diff(np.concatenate((np.searchsorted(at, offsets[full]), [len(at)]))) for at in (space, cut)) + 1
    return hashes, np.repeat(full, many), start, stop, marked


def piece_prefixes(rows: list[tuple[str, int, float, int]]) -> dict[str, tuple[int, float] | None]:
    """(id, score) of every piece, None of what only begins one; with spaces for marks."""
    spelt = {piece.replace(MARK, " "): (k, score) for piece, k, score, byte in rows if byte < 0}
    return {piece[:k]: None for piece in spelt for k in range(1, len(piece))} | spelt


def best_ids(word: str, pieces: dict[str, tuple[int, float] | None], longest: int, byte_ids: np.ndarray) -> np.ndarray:
    """Ids of the best path through a word, by the rules of ``_with_edges`` and ``_best_path``. Only the last
    ``longest`` arrivals are kept; their totals are taken from the oldest one, so they stay exact in any word."""
    size = len(word)
    back, into = np.zeros(size + 1, np.int32), np.zeros(size + 1, np.int32)
    totals, ring = [None] * (longest + 1), longest + 1      # arrival at p: totals[p % ring]
    totals[0] = 0.0
    for start in range(size):
        here = start % ring
        total, totals[here] = totals[here], None
        if start % ring == 0 and start:
            totals = [None if t is None else t - total for t in totals]
            total = 0.0
        single = False
        for stop in range(start + 1, min(start + longest, size) + 1):
            piece = word[start:stop]
            if piece not in pieces:
                break
            found = pieces[piece]
            if found is None:
                continue
            single |= stop == start + 1
            at, reached = stop % ring, total + found[1]
            if totals[at] is None or reached > totals[at]:      # of equal sums the edge that starts first
                totals[at], back[stop], into[stop] = reached, start, found[0]
        if not single:
            at, reached = (start + 1) % ring, total - BYTE_PENALTY
            if totals[at] is None or reached > totals[at]:
                totals[at], back[start + 1], into[start + 1] = reached, start, -1
    steps, at = [], size
    while at:
        start = int(back[at])
        steps.append(into[at:at + 1] if into[at] >= 0 else byte_ids[np.frombuffer(word[start:at].encode(), np.uint8)])
        at = start
    return np.concatenate(steps[::-1]).astype(np.int32)


def _texts(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[str]:
    blob = data.tobytes()
    return [blob[a:b].decode("utf-8", "replace") for a, b in zip(start.tolist(), stop.tolist())]


COUNTED = pa.schema([("hash", pa.int64()), ("part", pa.int32()), ("word", pa.large_string()), ("n", pa.int64())])


def _spelt(data: np.ndarray, start: np.ndarray, stop: np.ndarray, marked: np.ndarray) -> pa.Array:
    """The words themselves, a space in front of the marked ones."""
    offsets = np.concatenate(([0], np.cumsum(stop - start)))
    bare = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[word_bytes(start, stop)].tobytes()))
    return pc.binary_join_element_wise(pc.if_else(pa.array(marked), " ", "").cast(pa.large_string()), bare, pa.scalar("", pa.large_string()))


def _short(data: np.ndarray, start: np.ndarray, stop: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Which words have at most STRETCH characters."""
    begins = np.concatenate(([0], np.cumsum(data & 0xC0 != 0x80)))
    return begins[stop] - begins[start] + marked <= STRETCH


def _distinct_words(data: np.ndarray, offsets: np.ndarray, pairs: np.ndarray) -> pa.Table:
    """Words of some texts of at most STRETCH characters, once each with their number; part is 0 where a space goes before."""
    found = []
    for first, last in slices(offsets, SLICE_BYTES):
        low = offsets[first]
        part = data[low:offsets[last]]
        hashes, _, start, stop, marked = _words(part, offsets[first:last + 1] - low, pairs)
        value, at, n = np.unique(hashes, return_index=True, return_counts=True)
        keep = _short(part, start[at], stop[at], marked[at])
        at, n = at[keep], n[keep]
        found.append(pa.table([pa.array(value[keep].view(np.int64)), pa.array(np.where(marked[at], 0, 1).astype(np.int32)),
                               _spelt(part, start[at], stop[at], marked[at]), pa.array(n)], schema=COUNTED))
    return pa.concat_tables(found) if found else COUNTED.empty_table()


def _added_up(table: pa.Table) -> pa.Table:
    """Rows of one hash as one."""
    hashes, n = table.column("hash").to_numpy(), table.column("n").to_numpy()
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    kept = table.take(pa.array(first))
    return kept.set_column(3, "n", pa.array(np.bincount(number, weights=n, minlength=len(first)).astype(np.int64))).cast(COUNTED)


def _counted_words(shared):
    """Words with their number, added up over what a task reads as far as PENDING rows go: hash, part, word, n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = COUNTED.empty_table()
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            for first, last in slices(offsets, 1 << 21):
                held = pa.concat_tables([held, _distinct_words(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], shared.value)])
                if held.num_rows > PENDING:
                    held = _added_up(held)
                    if held.num_rows > PENDING // 2:
                        yield from held.to_batches(max_chunksize=50_000)
                        held = COUNTED.empty_table()
        yield from _added_up(held).to_batches(max_chunksize=50_000)
    return run


def _chosen(counted: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """(up to ``limit`` words of most occurrences, all others or None): hash, part, word."""
    words = counted.select("hash", "part", "word")
    if counted.count() <= limit:
        return words, None
    levels = counted.groupBy(F.least("n", F.lit(100_000)).alias("level")).count().orderBy(F.desc("level")).collect()
    least, held = 100_001, 0
    for row in levels:       # at most 100,000 levels
        held += row["count"]
        if held > limit:
            break
        least = row["level"]
    return (counted.where(F.col("n") >= least).select("hash", "part", "word"), counted.where(F.col("n") < least).select("hash", "part", "word"))


class Paths:
    """Ids per word hash, in flat arrays: hashes in order, how many ids each has, all ids one after another."""

    def __init__(self, hashes: np.ndarray, many: np.ndarray, ids: np.ndarray):
        self.hashes, self.many, self.ids = hashes, many, ids
        self.ends = np.zeros(len(many) + 1, np.int32 if len(ids) < 1 << 31 else np.int64)
        np.cumsum(many, out=self.ends[1:])

    @classmethod
    def of(cls, hashes: np.ndarray, many: np.ndarray, ids: np.ndarray) -> Paths:
        """From paths in any order, as narrow as they go."""
        order = np.argsort(hashes)
        end = np.cumsum(many[order], dtype=np.int64)
        begin = (np.cumsum(many, dtype=np.int64) - many)[order] - (end - many[order])
        ids = ids[np.repeat(begin, many[order]) + np.arange(len(ids))]
        return cls(hashes[order], many[order].astype(np.uint16 if many.max(initial=0) < 1 << 16 else np.int64),
                   ids.astype(np.uint16 if ids.max(initial=0) < 1 << 16 else np.int32))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is there) of each hash."""
        hashes = hashes.view(np.int64)
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def of_places(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of some places one after another, how many each has)."""
        many = self.many[at].astype(np.int64)
        end = np.cumsum(many)
        return self.ids[np.repeat(self.ends[at] - (end - many), many) + np.arange(int(end[-1]) if len(end) else 0)].astype(np.int32), many


def _with_bytes(words: pa.Array, lists: pa.ListArray, byte_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all paths one after another, ids per path): bytes in place of characters without a piece."""
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    many = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    bare = np.flatnonzero(ids < 0)
    if not len(bare):
        return ids, many
    owner = np.repeat(np.arange(len(many)), many)
    raw = [words[row].as_py()[-1 - k].encode() for row, k in zip(owner[bare].tolist(), ids[bare].tolist())]
    width = np.ones(len(ids), np.int64)
    width[bare] = [len(r) for r in raw]
    out = np.repeat(ids, width)
    out[np.repeat(ids < 0, width)] = byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    return out, np.bincount(owner, weights=width, minlength=len(many)).astype(np.int64)


def _finished(byte_ids: np.ndarray):
    """Paths (hash, part, word, path) of words of one part as ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, many = _with_bytes(batch.column(2), batch.column(3), byte_ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), list_array(pa.array(ids, pa.int32()), many)], names=["hash", "ids"])
    return run


def _flat_paths(rows: pa.Table) -> Paths:
    """From (hash, ids) in any order."""
    rows = rows.combine_chunks()
    lists = rows.column(1).combine_chunks()
    return Paths.of(rows.column(0).to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64),
                    lists.flatten().to_numpy(zero_copy_only=False))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths (hash, ids) as flat arrays, in rows of many."""
    for batch in batches:
        paths = _flat_paths(pa.Table.from_batches([batch]))
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (paths.hashes, paths.many.astype(np.uint16), paths.ids.astype(np.int32))],
                                         names=["hashes", "many", "ids"])


def _collected(paths: DataFrame, count: int) -> Paths:
    """At most COMMON_WORDS paths (hash, ids) on the driver, sorted by the tasks and brought over one of them after another."""
    parts = max(math.ceil(count / 100_000), 1)
    rows = paths.repartitionByRange(parts, "hash").sortWithinPartitions("hash").mapInArrow(_packed, "hashes binary, many binary, ids binary")
    found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.uint16)], [np.zeros(0, np.uint16)]]
    for row in rows.toLocalIterator():
        ids = np.frombuffer(row[2], np.int32)
        for held, part in zip(found, (np.frombuffer(row[0], np.int64), np.frombuffer(row[1], np.uint16), ids.astype(np.uint16) if ids.max(initial=0) < 1 << 16 else ids)):
            held.append(part)
    return Paths(*map(np.concatenate, found))


# ---------------------------------------------------------------- documents


class _Encoder:
    """Encodes the documents of a task: words are looked up by hash, those over STRETCH characters take their path here."""

    def __init__(self, shared, exact: bool):
        *flat, self.byte_ids, self.pairs, self.table = shared.value
        self.common = Paths(*flat)
        self.names = _Names(piece_bytes(self.table)) if exact else None
        self.longest = max(len(p) for p, _, _, byte in self.table if byte < 0)
        self.prefixes = None

    def missing(self, text: pa.Array) -> pa.Table:
        """Words that are not common."""
        data, offsets = text_buffers(text)
        words = _distinct_words(data, offsets, self.pairs)
        return words.filter(pa.array(~self.common.find(words.column(0).to_numpy().view(np.uint64))[1]))

    def documents(self, rows: pa.Array, text: pa.Array, rare: Paths) -> Iterator[pa.RecordBatch]:
        data, offsets = text_buffers(text)
        for first, last in slices(offsets, TASK_SLICE):
            low = offsets[first]
            sliced = data[low:offsets[last]]
            bounds = offsets[first:last + 1] - low
            hashes, row, start, stop, marked = _words(sliced, bounds, self.pairs)
            value, at, number = np.unique(hashes, return_index=True, return_inverse=True)
            # Ids of the distinct words, those of the common ones first.
            place, there = self.common.find(value)
            found = [self.common.of_places(place[there])]
            order = [np.flatnonzero(there)]
            left = np.flatnonzero(~there)
            if len(left):
                place, there = rare.find(value[left])
                found.append(rare.of_places(place[there]))
                order.append(left[there])
                left = left[~there]
            if len(left):
                at = at[left]
                if _short(sliced, start[at], stop[at], marked[at]).any():
                    raise ValueError("a word has no path")
                self.prefixes = self.prefixes or piece_prefixes(self.table)
                paths = [best_ids(" " + t if m else t, self.prefixes, self.longest, self.byte_ids)
                         for t, m in zip(_texts(sliced, start[at], stop[at]), marked[at].tolist())]
                found.append((np.concatenate(paths), np.array([len(p) for p in paths])))
                order.append(left)
            flat, many = (np.concatenate(x) for x in zip(*found))
            spot = np.empty(len(value), np.int64)
            spot[np.concatenate(order)] = np.arange(len(value))
            spot = spot[number]
            count = many[spot]
            end = np.cumsum(count)
            begin = np.cumsum(many) - many
            got = flat[np.repeat(begin[spot] - (end - count), count) + np.arange(int(end[-1]) if len(end) else 0)]
            sizes = np.bincount(row, weights=count, minlength=last - first).astype(np.int64)
            columns = [rows.slice(first, last - first), list_array(pa.array(got, pa.int32()), sizes)]
            if self.names:
                columns.append(pa.array(self._exact(got, sizes, sliced, bounds)))
            yield pa.RecordBatch.from_arrays(columns, names=["row", "ids", "exact"][:len(columns)])

    def _exact(self, ids: np.ndarray, sizes: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Whether the ids of each document decode to its bytes, with the space that begins every text that is not empty."""
        blob, width = self.names.decode(ids)
        ends = np.concatenate(([0], np.cumsum(width)))[np.concatenate(([0], np.cumsum(sizes)))]
        full = np.diff(bounds) > 0
        same = np.diff(ends) == np.diff(bounds) + full
        if same.all():
            own = np.ones(len(blob), bool)
            own[ends[:-1][full]] = False
            equal = blob[own] == data
            if equal.all() and (blob[~own] == 32).all():
                return same
        parts = blob.tobytes()
        raw = data.tobytes()
        return np.array([parts[a:b] == (b" " if c < d else b"") + raw[c:d] for a, b, c, d in zip(
            ends[:-1].tolist(), ends[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist())], bool)


NO_PATHS = Paths(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))


def _encoded(shared, exact: bool):
    """Documents (row, text) with their ids, all of whose words are common or long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(shared, exact)
        for batch in batches:
            yield from encoder.documents(batch.column(0), batch.column(1), NO_PATHS)
    return run


def _rare_words(shared):
    """Words (place, hash) of documents (place, text) that are not common, once per place of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(shared, False)
        for batch in batches:
            place = batch.column(0).to_numpy()
            order = np.argsort(place, kind="stable")
            edges = np.append(np.flatnonzero(np.diff(place[order], prepend=-1)), len(order)).tolist()
            for a, b in zip(edges[:-1], edges[1:]):
                words = encoder.missing(batch.column(1).take(pa.array(order[a:b])))
                hashes = pc.unique(words.column(0).combine_chunks())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), place[order[a]], np.int32)), hashes], names=["place", "hash"])
    return run


def _encoded_places(shared, exact: bool):
    """Rows (place, kind, hash, ids, row, text) by place, in each first the paths of its rare words, then its documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place, held, rare = _Encoder(shared, exact), None, [], NO_PATHS
        for batch in batches:
            key = batch.column(0).to_numpy().astype(np.int64) * 2 + batch.column(1).to_numpy()
            edges = np.append(np.flatnonzero(np.diff(key, prepend=-1)), len(key)).tolist()
            for a, b in zip(edges[:-1], edges[1:]):
                part = batch.slice(a, b - a)
                if key[a] // 2 != place:
                    place, held, rare = key[a] // 2, [], NO_PATHS
                if key[a] % 2 == 0:
                    held.append(part.select([2, 3]))
                    continue
                if held:
                    rare, held = _flat_paths(pa.Table.from_batches(held)), []
                yield from encoder.documents(part.column(4), part.column(5), rare)
    return run


def encoded(docs: DataFrame, model_path: str = MODEL, exact: bool = False) -> DataFrame:
    """``docs`` with a column ``ids``: piece ids of the whole text; all other columns are kept. With ``exact``
    also a column ``exact``: whether the ids decode to the text, a null text being empty.

    Needs text. A null or empty text has no ids. Runs of spaces are kept whole; decoding gives back the
    text exactly.
    Columns of these names that are there already are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    table = piece_rows(model_path)
    pieces = spark.createDataFrame(table, "piece string, piece_id int, score double, byte int")
    longest = max(len(p) for p, _, _, byte in table if byte < 0)
    byte_ids = np.zeros(256, np.int32)
    for _, k, _, byte in table:
        if byte >= 0:
            byte_ids[byte] = k
    pairs = pair_table(table)
    added = ["ids", "exact"] if exact else ["ids"]
    kept = [c for c in docs.columns if c not in added]
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("text").cast("string").alias("text"))
    kind = base.schema["row"].dataType.simpleString()
    result = f"row {kind}, ids array<int>" + (", exact boolean" if exact else "")

    counted = stored(base.select("text").mapInArrow(_counted_words(spark.sparkContext.broadcast(pairs)), f"{WORD_FIELDS}, n bigint")
                     .groupBy("hash", "part", "word").agg(F.sum("n").alias("n")))
    common, others = _chosen(counted, COMMON_WORDS)

    def paths(words: DataFrame) -> DataFrame:
        return stored(encode_words(words, pieces, longest).mapInArrow(_finished(byte_ids), "hash bigint, ids array<int>"))

    best = _collected(paths(common), common.count())
    shared = spark.sparkContext.broadcast((best.hashes, best.many, best.ids, byte_ids, pairs, table))
    if others is None:
        done = base.mapInArrow(_encoded(shared, exact), result)
    else:
        # All other words: documents are dealt to places by what they are, and meet the paths of their rare words there.
        places = PLACES * int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = base.select(F.pmod(F.xxhash64("row"), F.lit(places)).cast("int").alias("place"), "row", "text")
        asked = dealt.select("place", "text").mapInArrow(_rare_words(shared), "place int, hash bigint").distinct()
        rare = asked.join(paths(others), "hash").select("place", F.lit(0).alias("kind"), "hash", "ids", F.lit(None).cast(kind).alias("row"), F.lit(None).cast("string").alias("text"))
        own = dealt.select("place", F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("hash"), F.lit(None).cast("array<int>").alias("ids"), "row", "text")
        both = rare.unionByName(own).repartition(places, "place").sortWithinPartitions("place", "kind")
        done = both.mapInArrow(_encoded_places(shared, exact), result)
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], *added)


def piece_bytes(table: list[tuple[str, int, float, int]]) -> list[bytes]:
    """What each id decodes to; a mark is a space."""
    names = [b""] * (max(k for _, k, _, _ in table) + 1)
    for piece, k, _, byte in table:
        names[k] = bytes([byte]) if byte >= 0 else piece.replace(MARK, " ").encode()
    return names


class _Names:
    """What ids decode to, as flat bytes."""

    def __init__(self, names: list[bytes]):
        self.width = np.array([len(n) for n in names])
        self.first = np.cumsum(self.width) - self.width
        self.flat = np.frombuffer(b"".join(names), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids, bytes of each)."""
        ids = np.where((ids >= 0) & (ids < len(self.width)), ids, 0)
        size = self.width[ids]
        end = np.cumsum(size)
        return self.flat[np.repeat(self.first[ids] - (end - size), size) + np.arange(int(end[-1]) if len(end) else 0)], size


def _decoder(names: list[bytes]) -> Callable[[pa.ListArray], pa.Array]:
    """A function from lists of ids to their texts."""
    known = _Names(names)

    def decode(lists: pa.ListArray) -> pa.Array:
        ends = lists.offsets.to_numpy()
        blob, size = known.decode(lists.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]])
        blob = blob.tobytes()
        bounds = np.concatenate(([0], np.cumsum(size)))[ends - ends[0]].tolist()
        texts = [blob[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        return pa.array([(t[1:] if t[:1] == b" " else t).decode("utf-8", "replace") for t in texts], pa.string())
    return decode


def decoded(frame: DataFrame, model_path: str = MODEL) -> DataFrame:
    """``frame`` (ids and other columns) with the text of the ids in a column ``decoded``.

    Null ids give an empty text; ids that are no piece give nothing. Bytes that are no UTF-8 become
    U+FFFD, as can be only where ids do not come from encoding.
    """
    shared = frame.sparkSession.sparkContext.broadcast(piece_bytes(piece_rows(model_path)))       # the fixed vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _decoder(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), decode(batch.column(1))], names=["row", "decoded"])

    kept = [c for c in frame.columns if c != "decoded"]
    base = frame.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.coalesce("ids", F.array().cast("array<int>")).cast("array<int>").alias("ids"))
    done = base.mapInArrow(run, f"row {base.schema['row'].dataType.simpleString()}, decoded string")
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], "decoded")


def op3_sentencepiece(spark: SparkSession, docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """doc_id, ids, n_tokens and whether decoding gives back the text, per document."""
    back = encoded(docs.select("doc_id", "text"), model_path, exact=True)
    return back.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), "exact")
