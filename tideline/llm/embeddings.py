"""Embedding near-dedup: sign hashing by random hyperplanes, exact cosine, components.

A table is a set of ``bits`` hyperplanes; vectors of one label with equal signs in a table form a
bucket. ``bits`` follows the largest label, so that a bucket of unrelated vectors stays small,
and the number of tables follows ``bits``, so that a pair at the threshold is missed with
probability 1e-4 at most. Inside a bucket the cosine of every pair is computed in double
precision; a pair that shares several tables is counted in the first. A large bucket is dealt out
as pairs of blocks, so no task holds it whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import components, mixed, stored

BLOCK = 1024
MISSED = 1e-4
SEED = 77


def plan(largest: int, threshold: float) -> tuple[int, int]:
    """(bits, tables) for labels of up to ``largest`` vectors."""
    bits = min(max(math.ceil(math.log2(max(largest, 1))) - 4, 6), 24)
    same = (1 - math.acos(min(threshold, 1.0)) / math.pi) ** bits
    return bits, math.ceil(math.log(MISSED) / math.log1p(-min(same, 0.999999)))


def _rows(column: pa.Array) -> list[np.ndarray | None]:
    """Double vectors; None where null, empty, zero, or with null or non-finite components."""
    out = []
    for cell in column:
        if cell.values is None or len(cell.values) == 0 or cell.values.null_count:
            out.append(None)
            continue
        v = cell.values.to_numpy(zero_copy_only=False).astype(np.float64)
        top = np.abs(v).max()
        out.append(v / top if np.isfinite(top) and top > 0 else None)
    return out


def _coded(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors = _rows(batch.column(2))
            keep = [i for i, v in enumerate(vectors) if v is not None]
            codes = np.zeros((len(keep), tables), np.int32)
            unit = [vectors[i] / np.sqrt(vectors[i] @ vectors[i]) for i in keep]
            for size in {len(v) for v in unit}:
                if size not in planes:
                    planes[size] = np.random.Generator(np.random.PCG64([SEED, size])).standard_normal((size, tables * bits))
                at = [k for k, v in enumerate(unit) if len(v) == size]
                signs = (np.stack([unit[k] for k in at]) @ planes[size] > 0).reshape(len(at), tables, bits)
                codes[at] = signs @ (1 << np.arange(bits, dtype=np.int32))
            taken = batch.take(pa.array(keep, pa.int64()))
            offsets = pa.array(np.arange(len(keep) + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays([
                taken.column(0), taken.column(1), pa.array([len(v) for v in unit], pa.int32()),
                pa.array([v.tobytes() for v in unit], pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(codes.reshape(-1))),
            ], names=["vec_id", "label", "size", "unit", "codes"])
    return run


def _joined(links_i: np.ndarray, links_j: np.ndarray, count: int) -> np.ndarray:
    """Smallest member linked, directly or not, for each of ``count`` sorted members."""
    label = np.arange(count)
    while True:
        new = label.copy()
        np.minimum.at(new, links_i, label[links_j])
        np.minimum.at(new, links_j, label[links_i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(threshold: float):
    def bucket(ids, block, low, high, table, units, codes):
        order = np.argsort(ids, kind="stable")
        ids, block = ids[order], block[order]
        matrix = np.stack([np.frombuffer(units[i], np.float64) for i in order])
        code = codes[order]
        hit = np.triu(matrix @ matrix.T >= threshold, 1) & (ids[:, None] != ids[None, :])
        if low != high:
            hit &= block[:, None] != block[None, :]
        i, j = np.nonzero(hit)
        if not len(i):
            return None
        new = ~(code[i, :table] == code[j, :table]).any(axis=1) if table else np.ones(len(i), bool)
        count = np.bincount(i[new], minlength=len(ids)) + np.bincount(j[new], minlength=len(ids))
        root = _joined(i, j, len(ids))
        linked = np.zeros(len(ids), bool)
        linked[i] = linked[j] = True
        return ids[linked], count[linked], ids[root[linked]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(batch: pa.RecordBatch):
            key, low, high = (batch.column(k).to_numpy() for k in (0, 1, 2))
            cut = np.flatnonzero((key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
            edges = [0, *cut.tolist(), len(key)]
            ids, block, table = (batch.column(k).to_numpy() for k in (3, 4, 5))
            width = len(batch.column(7)[0])
            codes = batch.column(7).flatten().to_numpy().reshape(-1, width)
            parts = []
            for s, e in zip(edges[:-1], edges[1:]):
                if e - s > 1:
                    units = [batch.column(6)[k].as_buffer() for k in range(s, e)]
                    got = bucket(ids[s:e], block[s:e], low[s], high[s], table[s], units, codes[s:e])
                    if got is not None:
                        parts.append(got)
            if parts:
                columns = [np.concatenate([p[k] for p in parts]).astype(np.int64) for k in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["vec_id", "n", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key, low, high = (batch.column(k).to_numpy() for k in (0, 1, 2))
            last = np.flatnonzero((key != key[-1]) | (low != low[-1]) | (high != high[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut or (held and (held[0].column(0)[0].as_py(), held[0].column(1)[0].as_py(), held[0].column(2)[0].as_py()) != (key[0], low[0], high[0])):
                done = pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks().to_batches(max_chunksize=None)
                for part in done:
                    yield from flush(part)
                held = []
            held.append(batch.slice(cut))
        if held:
            for part in pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=None):
                yield from flush(part)
    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """Links and components of vectors of one label with cosine of at least ``threshold``.

    Needs vec_id, embedding (array of numbers) and label; other columns are ignored. Rows with a
    null label or vec_id and vectors that are null, empty, zero or hold null or non-finite
    components link with nothing; vectors of unlike length neither. Equal vectors are at cosine 1.
    Rows that
    share a vec_id are one vertex: equal ones count once, different vectors add up their links.
    Returns vec_id, n_links, component_id, kept: one row per input row.
    """
    base = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding")
    usable = base.where("vec_id is not null and label is not null")
    largest = usable.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan(largest, threshold)
    coded = stored(usable.mapInArrow(
        _coded(bits, tables), "vec_id bigint, label bigint, size int, unit binary, codes array<int>")
        .withColumn("uid", mixed(F.col("label"), F.col("unit"))).dropDuplicates(["vec_id", "uid"]))

    keyed = coded.select("vec_id", "uid", "label", "size", F.posexplode("codes").alias("t", "code"))
    keyed = keyed.withColumn("key", mixed(F.col("label"), F.col("size"), F.col("t"), F.col("code")))
    shared = keyed.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    dealt = keyed.join(shared, "key").withColumn("blocks", F.ceil(F.col("held") / BLOCK).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    dealt = dealt.select("key", "t", "vec_id", "uid", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    dealt = dealt.select("key", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
                         "vec_id", "uid", "block", "t")
    filled = dealt.join(coded.select("vec_id", "uid", "unit", "codes"), ["vec_id", "uid"]).select(
        "key", "low", "high", "vec_id", "block", "t", "unit", "codes")
    ordered = filled.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    found = stored(ordered.mapInArrow(_compare(threshold), "vec_id bigint, n bigint, root bigint"))

    degree = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    labels = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    result = base.select("vec_id").join(degree, "vec_id", "left").join(
        labels.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                         component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
