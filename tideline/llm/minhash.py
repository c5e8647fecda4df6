"""MinHash near-dedup with min-max hashing.

Every hash function gives two signature values, the smallest and the largest hash of a set, so a
signature of 160 values takes 80 hash evaluations per shingle. 32 bands of 5 values make
candidates: two sets of similarity 0.8 share no band with probability (1 - 0.8^5)^32 = 3e-6.
Candidates are confirmed on the full sets of 64-bit shingle hashes, and confirmed links are
joined to connected components.

Steps: one pass over the texts makes signatures; equal sets collapse into classes; a band bucket
names its smallest member as leader, and every class is checked against its smallest leader;
then every bucket that still holds several components names a few members at random, and every other
one is checked against one of those outside its own component. Copies so cost no pair at all and near
copies two pairs per member: a large family is one component by then. What is left are members of one
bucket that are mostly just not similar enough. They are dealt to cells of bounded size, two cells
meet where a bucket holds members of both, and a task compares the sets of two cells as bits: no
pair becomes a row unless it is a link.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import components, small_batches, stored
from tideline.llm.words import BASE, list_array, mix, ngrams, slices, text_buffers, word_hashes

FUNCTIONS = 80
BANDS = 32
ROWS = 2 * FUNCTIONS // BANDS
PERCENT = 80
LEADERS = 4          # members that a bucket names in a turn; every other member is compared with one of those that its buckets name
LEADER_TURNS = 1
CELL_SETS = 1024     # sets and shingles that a cell holds at about the most; one larger set is a cell of its own
CELL_SHINGLES = 1 << 20
COLUMNS = 1 << 14    # shingles whose bits are compared at once
_random = np.random.Generator(np.random.PCG64(411))
_A = _random.integers(0, 2**63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 2**63, FUNCTIONS, dtype=np.uint64)
_ORDER = _random.permutation(2 * FUNCTIONS)   # which values make up a band

SIGNATURES = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes sorted within a row, shingles per row) of whole texts. A text of
    fewer than ``size`` words has its whole sequence as one shingle, one without words none."""
    hashes, rows, _, _ = word_hashes(data, offsets)
    count = len(offsets) - 1
    words = np.bincount(rows, minlength=count)
    grams, at = ngrams(hashes, rows, size)
    owner = rows[at]
    if size > 1 and len(hashes):
        first = np.concatenate(([0], np.cumsum(words)))
        for k in range(1, size):
            short = np.flatnonzero(words == k)
            if len(short):
                total = hashes[first[short]].copy()
                for j in range(1, k):
                    total = mix(total * np.uint64(BASE) + hashes[first[short] + j])
                grams = np.concatenate((grams, mix(total + np.uint64(k))))
                owner = np.concatenate((owner, short))
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    if len(grams):
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        grams, owner = grams[new], owner[new]
    return grams, np.bincount(owner, minlength=count)


def _band_keys(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One key per band for every row that has shingles."""
    first = np.concatenate(([0], np.cumsum(counts[counts > 0])[:-1])).astype(np.int64)
    values = np.empty((len(first), 2 * FUNCTIONS), np.uint64)
    for k in range(FUNCTIONS):
        hashed = grams * _A[k] + _B[k]
        hashed ^= hashed >> np.uint64(32)
        values[:, 2 * k] = np.minimum.reduceat(hashed, first)
        values[:, 2 * k + 1] = np.maximum.reduceat(hashed, first)
    values = values[:, _ORDER].reshape(len(first), BANDS, ROWS)
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(first), 1))
    for r in range(ROWS):
        keys = mix(keys * np.uint64(BASE) + values[:, :, r])
    return keys


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for first, last in slices(offsets):
                low, high = offsets[first], offsets[last]
                grams, counts = shingle_sets(data[low:high], offsets[first:last + 1] - low, size)
                has = counts > 0
                sums = np.zeros((2, last - first), np.uint64)
                keys = np.zeros((0, BANDS), np.uint64)
                if len(grams):
                    starts = np.concatenate(([0], np.cumsum(counts[has])[:-1])).astype(np.int64)
                    sums[0, has] = np.add.reduceat(mix(grams), starts)
                    sums[1, has] = np.add.reduceat(mix(grams + np.uint64(BASE)), starts)
                    keys = _band_keys(grams, counts)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first).cast(pa.int64()), pa.array(counts.astype(np.int64)),
                    pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                    list_array(pa.array(keys.reshape(-1).view(np.int64)), np.where(has, BANDS, 0)),
                ], names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])
    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for first, last in slices(offsets):
                low, high = offsets[first], offsets[last]
                grams, counts = shingle_sets(data[low:high], offsets[first:last + 1] - low, size)
                ends = np.concatenate(([0], np.cumsum(counts)))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first).cast(pa.int64()),
                    pa.array([grams[ends[i]:ends[i + 1]].tobytes() for i in range(last - first)], pa.binary()),
                ], names=["id", "shingles"])
    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                one = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint64)
                two = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(one) + len(two) - both)
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(keep)) for c in batch.columns[:2]], names=["a", "b"])
    return run


def _links(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b, n_a, n_b) whose full sets are similar enough."""
    fit = pairs.where((100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))).select("a", "b")
    fit = stored(fit.distinct())
    ids = fit.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = docs.join(ids, "doc_id", "left_semi").select("doc_id", "text")
    # A document with several texts has several sets, and is linked by any of them.
    # Dealt by id once, for dropping repeated rows and for both joins.
    sets = sets.mapInArrow(_sets(size), "id bigint, shingles binary").repartition("id").distinct()
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("one"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("two"))
    joined = fit.join(one, "a").join(two, "b").select("a", "b", "one", "two")
    return stored(joined.mapInArrow(_confirmed(percent), "a bigint, b bigint"))


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that still hold several components: band, doc, n, part, low (the bucket's smallest part)."""
    placed = members.join(labels, members.doc == labels.id, "left").select(
        "band", "doc", "n", F.coalesce("component_id", "doc").alias("part"))
    split = placed.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    return stored(placed.join(split.select("band", "low"), "band"))


def _cells(open_: DataFrame, percent: int) -> DataFrame:
    """The cell of every open set (doc, n, part, and its open bands): those that meet the same smallest component, where they are
    too many parted by size, so that only neighbouring sizes can be similar enough, and then by hash."""
    homes = open_.groupBy("doc", "n", "part").agg(F.min("low").alias("family"), F.collect_set("band").alias("bands"))
    step = 1.001 * math.log(max(100 / percent, 1.01))
    load = (F.sum("n").alias("weight"), F.count("*").alias("sets"))
    families = homes.groupBy("family").agg(*load).select(
        "family", ((F.col("weight") > CELL_SHINGLES) | (F.col("sets") > CELL_SETS)).alias("large"))
    sized = homes.join(families, "family").withColumn("class", F.when(F.col("large"), F.floor(F.log("n") / step)))
    # Beside its key a cell without a class carries -1: null is equal to nothing in a join.
    sized = stored(sized.drop("large").withColumn("key", F.coalesce("class", F.lit(-1))))
    blocks = sized.groupBy("family", "key").agg(*load).select(
        "family", "key", F.greatest(F.ceil(F.col("weight") / CELL_SHINGLES), F.ceil(F.col("sets") / CELL_SETS)).alias("blocks"))
    block = F.pmod(F.xxhash64("doc", "n"), "blocks")
    return stored(sized.join(blocks, ["family", "key"]).select(
        "doc", "n", "part", "class", "bands", F.xxhash64("family", "key", block).alias("cell")))


def _meetings(cells: DataFrame) -> DataFrame:
    """Pairs of cells (low, high, maybe one cell twice) with members of different components in one bucket."""
    spread = (cells.select(F.explode("bands").alias("band"), "part", "class", "cell").groupBy("band", "cell", "class")
              .agg(F.min("part").alias("least"), F.max("part").alias("most")))
    one, two = (spread.select("band", *(F.col(c).alias(f"{c}_{side}") for c in ("cell", "class", "least", "most"))) for side in "ab")
    near = F.coalesce(F.abs(F.col("class_a") - F.col("class_b")) <= 1, F.lit(True))
    return (one.join(two, "band").where((F.col("cell_a") <= F.col("cell_b")) & near)
            .where(F.least("least_a", "least_b") < F.greatest("most_a", "most_b"))
            .select(F.col("cell_a").alias("low"), F.col("cell_b").alias("high")).distinct())


def _overlaps(grams: np.ndarray, owner: np.ndarray, upto: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For every row i, the shingles it shares with each of the rows i + 1 .. upto[i] - 1."""
    count = len(upto)
    shared = [np.zeros(max(int(upto[i]) - i - 1, 0), np.int64) for i in range(count)]
    names, column = np.unique(grams, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, len(names), COLUMNS):
        part = slice(*np.searchsorted(column, (low, low + COLUMNS)))
        dense = np.zeros((count, COLUMNS), bool)
        dense[owner[part], column[part] - low] = True
        bits = np.packbits(dense, axis=1).view(np.uint64)
        bits = bits[:, :-(-min(COLUMNS, len(names) - low) // 64)]
        for i in range(count):
            if len(shared[i]):
                shared[i] += np.bitwise_count(bits[i] & bits[i + 1:upto[i]]).sum(axis=1, dtype=np.int64)
    yield from enumerate(shared)


def _compared(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links between the sets of one cell, or of two: one for each pair of components."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in table["shingles"]]
        sizes = np.array([len(s) for s in sets])
        grams, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        # A shingle of one set alone is in no intersection; a set with too many of them is similar to none here.
        _, column, times = np.unique(grams, return_inverse=True, return_counts=True)
        common = times[column] > 1
        usable = np.bincount(owner[common], minlength=len(sets))
        fit = np.flatnonzero(100 * usable >= percent * sizes)
        fit = fit[np.argsort(sizes[fit], kind="stable")]
        place = np.full(len(sets), -1)
        place[fit] = np.arange(len(fit))
        kept = common & (place[owner] >= 0)
        sizes = sizes[fit]
        doc, part, side = (table[c].to_numpy()[fit] for c in ("doc", "part", "side"))
        upto = np.searchsorted(percent * sizes, 100 * sizes, "right")
        found: dict[tuple[int, int], tuple[int, int]] = {}
        two = len(np.unique(table["side"].to_numpy())) > 1
        for i, both in _overlaps(grams[kept], place[owner[kept]], upto):
            others = slice(i + 1, i + 1 + len(both))
            linked = (100 * both >= percent * (sizes[i] + sizes[others] - both)) & (part[others] != part[i])
            if two:
                linked &= side[others] != side[i]
            for j in np.flatnonzero(linked).tolist():
                j += i + 1
                found.setdefault((min(part[i], part[j]), max(part[i], part[j])), (doc[i], doc[j]))
        ends = np.array(list(found.values()), np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})
    return run


def _across(docs: DataFrame, open_: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between members of one bucket in different components."""
    cells = _cells(open_, percent)
    meetings = _meetings(cells)
    sides = F.when(F.col("low") == F.col("high"), F.array(F.struct(F.col("low").alias("cell"), F.lit(0).alias("side")))).otherwise(
        F.array(F.struct(F.col("low").alias("cell"), F.lit(0).alias("side")), F.struct(F.col("high").alias("cell"), F.lit(1).alias("side"))))
    sent = (meetings.select("low", "high", F.explode(sides).alias("s")).select("low", "high", "s.cell", "s.side")
            .join(cells, "cell").select("low", "high", "side", "doc", "n", "part"))
    texts = docs.join(cells.select(F.col("doc").alias("doc_id")).distinct(), "doc_id", "left_semi").select("doc_id", "text")
    sets = texts.mapInArrow(_sets(size), "id bigint, shingles binary").select(
        F.col("id").alias("doc"), (F.length("shingles") / 8).cast("bigint").alias("n"), "shingles")
    sets = sets.repartition("doc", "n").distinct()
    return stored(sent.join(sets, ["doc", "n"]).groupBy("low", "high").applyInArrow(_compared(percent), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """Component of every document under similarity of word-shingle sets.

    ``docs`` needs doc_id and text; other columns are ignored. Rows that repeat a doc_id are one
    document; should their texts differ, it is linked by each of them. Null and blank texts have no shingles
    (n_shingles 0) and are linked with nothing; a null doc_id is its own component (null).
    Returns doc_id, n_shingles, component_id, kept: one row per input row.
    """
    small_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(base.mapInArrow(_signatures(size), SIGNATURES))
    filled = signed.where("n_shingles > 0 and doc_id is not null")
    classes = stored(filled.groupBy("n_shingles", "set_a", "set_b").agg(F.min("doc_id").alias("rep")))
    # A doc_id may repeat with other texts: a class is known by its own set, not by the id alone.
    placed = filled.join(classes, ["n_shingles", "set_a", "set_b"])
    reps = stored(placed.where("doc_id = rep").select("rep", "n_shingles", "bands"))
    # Classes that share a document are linked by it.
    owners = placed.select("doc_id", "rep").distinct()
    several = owners.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("most")).where("a < most")
    same = owners.join(several, "doc_id").where("a < rep").select("a", F.col("rep").alias("b"))
    banded = reps.select(F.col("rep").alias("doc"), F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("doc").alias("leader"), F.max("doc").alias("other")).where("leader < other")
    members = stored(banded.join(shared.select("band", "leader"), "band").distinct())

    sizes = members.select(F.col("doc").alias("a"), F.col("n").alias("n_a")).distinct()
    first = (members.where("leader < doc").groupBy(F.col("doc").alias("b"), F.col("n").alias("n_b"))
             .agg(F.min("leader").alias("a")).join(sizes, "a"))
    links = stored(_links(base, first, size, percent).unionByName(same))

    def alike(n: Column, m: Column) -> Column:
        return 100 * F.least(n, m) >= percent * F.greatest(n, m)

    for turn in range(LEADER_TURNS):
        open_ = _open(members, components(links))
        leaders = open_.groupBy("band").agg(F.array(*[
            F.min(F.struct(F.xxhash64(F.lit(turn), F.lit(k), "doc").alias("order"), "doc", "n", "part")) for k in range(LEADERS)
        ]).alias("leaders")).select("band", F.explode(F.array_distinct("leaders")).alias("l"))
        drawn = F.struct(F.xxhash64(F.lit(turn), "doc", "l.doc").alias("order"), "l.doc", "l.n")
        pairs = (open_.join(leaders, "band").where((F.col("part") != F.col("l.part")) & alike(F.col("n"), F.col("l.n")))
                 .groupBy("doc", "n").agg(F.min(drawn).alias("l"))
                 .select(F.col("doc").alias("a"), F.col("l.doc").alias("b"), F.col("n").alias("n_a"), F.col("l.n").alias("n_b")))
        links = stored(links.unionByName(_links(base, pairs, size, percent)))
    open_ = _open(members, components(links))
    labels = components(links.unionByName(_across(base, open_, size, percent)))

    ranked = classes.join(labels, classes.rep == labels.id, "left").select(
        "n_shingles", "set_a", "set_b", F.coalesce("component_id", "rep").alias("component_id"))
    keys = ["n_shingles", "set_a", "set_b"]
    whole = signed.select("doc_id", *keys).join(ranked, keys, "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return whole.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
