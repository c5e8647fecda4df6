"""Quality classifier by importance resampling.

Two bags of hashed n-grams are modelled: the target (documents labelled good and not toxic) and
the raw text (all documents). The log weight of a document is the sum of its log ratios, and
Gumbel top-k draws that many documents without replacement, with odds that follow the weights.

Features are hashed into 2^18 buckets per view of the text:

* terms: lower-cased words without punctuation, each counted once per document. Only buckets
  significantly rarer in the target than in the raw text weigh, so common words add no noise.
* tokens and pairs: words as they are and pairs of neighbours (a word next to itself is one
  feature), with a ratio averaged over the document, so a long text gains nothing by its length.

The target is fitted on a bounded sample of labelled rows, the raw model on all documents. The
weight from which a document counts as good is set on labelled rows kept out of the fit; the
number of documents above it is the k of the draw.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import stored
from tideline.llm.words import mix, ngrams, slices, text_buffers, word_hashes

BITS = 18
VIEWS = 3                  # terms, tokens, pairs
LABELLED_ROWS = 60_000     # bound on the labelled sample
HELD_OUT = 4               # every fourth labelled row sets the threshold
RARE = 3.0                 # standard deviations from which a term counts as rarer in the target
MEAN_WEIGHT = 30.0         # tokens and pairs weigh as a text of so many features
TEMPERATURE = 0.02         # log weights are divided by this before Gumbel noise is added
MISSED_BAD = 2.0           # a bad document let through costs as many as so many good ones lost (in shares)
SEED = 9
CHUNK = 1 << 12            # buckets per row of a partial count
_PUNCTUATION = np.array([b < 48 or 58 <= b < 65 or 91 <= b < 97 or 123 <= b < 128 for b in range(256)])
_REPEAT = np.uint64(12345)


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of every feature per view; terms once per row."""
    shift = np.uint64(64 - BITS)
    terms, owner, _, _ = word_hashes(data, offsets, True, _PUNCTUATION)
    once = np.unique((owner.astype(np.uint64) << np.uint64(BITS)) | (terms >> shift))
    views = [((once & np.uint64((1 << BITS) - 1)).astype(np.int64), (once >> np.uint64(BITS)).astype(np.int64))]
    tokens, owner, _, _ = word_hashes(data, offsets, False)
    views.append(((tokens >> shift).astype(np.int64), owner))
    pairs, at = ngrams(tokens, owner, 2)
    pairs = np.where(tokens[at] == tokens[at + 1], mix(np.array([_REPEAT]))[0], pairs) if len(at) else pairs
    views.append(((pairs >> shift).astype(np.int64), owner[at]))
    return views


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Raw and target counts of a task, in rows of CHUNK buckets. Columns: text, target."""
    raw = np.zeros(VIEWS << BITS, np.int64)
    good = np.zeros(VIEWS << BITS, np.int64)
    docs, targets = 0, 0
    for batch in batches:
        data, offsets = text_buffers(batch.column(0))
        target = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        docs, targets = docs + len(target), targets + int(target.sum())
        for first, last in slices(offsets):
            low = offsets[first]
            for view, (bucket, row) in enumerate(features(data[low:offsets[last]], offsets[first:last + 1] - low)):
                base = view << BITS
                raw[base:base + (1 << BITS)] += np.bincount(bucket, minlength=1 << BITS)
                chosen = target[first:last][row]
                if chosen.any():
                    good[base:base + (1 << BITS)] += np.bincount(bucket[chosen], minlength=1 << BITS)
    if docs:
        starts = list(range(0, len(raw), CHUNK))
        yield pa.RecordBatch.from_arrays([
            pa.array([-1] + starts, pa.int32()),
            pa.array([np.array([docs]).tobytes()] + [raw[s:s + CHUNK].tobytes() for s in starts], pa.binary()),
            pa.array([np.array([targets]).tobytes()] + [good[s:s + CHUNK].tobytes() for s in starts], pa.binary()),
        ], names=["start", "raw", "good"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of equal chunks added up; holds one chunk at a time per start in a task."""
    sums: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for k in range(batch.num_rows):
            start = batch.column(0)[k].as_py()
            both = [np.frombuffer(batch.column(c)[k].as_buffer(), np.int64) for c in (1, 2)]
            if start in sums:
                sums[start][0] += both[0]
                sums[start][1] += both[1]
            else:
                sums[start] = [b.copy() for b in both]
    if sums:
        keys = list(sums)
        yield pa.RecordBatch.from_arrays([
            pa.array(keys, pa.int32()), pa.array([sums[k][0].tobytes() for k in keys], pa.binary()),
            pa.array([sums[k][1].tobytes() for k in keys], pa.binary())], names=["start", "raw", "good"])


def ratios(raw: np.ndarray, good: np.ndarray, docs: int, targets: int) -> np.ndarray:
    """Log ratio of the target to the raw model per bucket of each view, smoothed towards 0."""
    out = np.zeros(VIEWS << BITS)
    for view in range(VIEWS):
        part = slice(view << BITS, (view + 1) << BITS)
        r, g = raw[part].astype(float), good[part].astype(float)
        share = targets / docs if view == 0 else g.sum() / max(r.sum(), 1)
        expected = r * share
        out[part] = np.log((g + 1) / (expected + 1))
        if view == 0:
            out[part][(g - expected) > -RARE * np.sqrt(expected + 1)] = 0
    return out


def _weights(model: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    weight, sums, number = np.zeros(rows), np.zeros(rows), np.zeros(rows)
    for view, (bucket, row) in enumerate(features(data, offsets)):
        part = np.bincount(row, weights=model[(view << BITS) + bucket], minlength=rows)
        if view == 0:
            weight += part
        else:
            sums += part
            number += np.bincount(row, minlength=rows)
    return weight + MEAN_WEIGHT * sums / np.maximum(number, 1)


def _noise(ids: np.ndarray, seed: int) -> np.ndarray:
    """Gumbel noise that a document keeps on every run."""
    bits = mix(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) >> np.uint64(11)
    return -np.log(-np.log((bits.astype(float) + 0.5) / (1 << 53)))


def _scored(shared, text_at: int, id_at: int):
    """Batches with their log weights and keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        model = np.frombuffer(shared.value, np.float64)
        for batch in batches:
            data, offsets = text_buffers(batch.column(text_at))
            ids = batch.column(id_at).fill_null(-1).to_numpy(zero_copy_only=False)
            weights = np.zeros(batch.num_rows)
            for first, last in slices(offsets):
                low = offsets[first]
                weights[first:last] = _weights(model, data[low:offsets[last]], offsets[first:last + 1] - low)
            yield batch, weights, weights / TEMPERATURE + _noise(ids, SEED)
    return run


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, DataFrame]:
    """Log ratios per bucket, and the labelled sample (doc_id, fold, bad)."""
    known = (labels.where("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg(F.max(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 0).otherwise(1)).alias("bad")))
    total = known.count()
    share = min(1.0, LABELLED_ROWS / max(total, 1))
    spot = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1_000_000))
    sample = known.where(spot < int(share * 1_000_000)).withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)).cast("int"))
    sample = stored(sample.select("doc_id", "fold", "bad"))
    train = sample.where("bad = 0 and fold > 0").select("doc_id", F.lit(True).alias("target"))
    marked = docs.select("doc_id", "text").join(F.broadcast(train), "doc_id", "left")   # bounded by LABELLED_ROWS
    marked = marked.select("text", F.coalesce("target", F.lit(False)).alias("target"))
    layout = "start int, raw binary, good binary"
    sums = marked.mapInArrow(_counts, layout).repartition("start").mapInArrow(_summed, layout)
    raw, good = np.zeros(VIEWS << BITS, np.int64), np.zeros(VIEWS << BITS, np.int64)
    counted = targets = 0
    for row in stored(sums).toLocalIterator():   # one fixed-size table, whatever the corpus
        r, g = np.frombuffer(row["raw"], np.int64), np.frombuffer(row["good"], np.int64)
        if row["start"] < 0:
            counted, targets = int(r[0]), int(g[0])
        else:
            raw[row["start"]:row["start"] + CHUNK], good[row["start"]:row["start"] + CHUNK] = r, g
    if not targets:
        return np.zeros(VIEWS << BITS), sample
    return ratios(raw, good, counted, targets), sample


def threshold(scored: DataFrame, sample: DataFrame) -> float:
    """Log weight that best parts good from bad held-out documents; ``scored``: doc_id, log_weight."""
    held = scored.join(F.broadcast(sample.where("fold = 0")), "doc_id").select("bad", "log_weight")
    rows = held.toArrow()      # bounded by LABELLED_ROWS
    bad = rows.column(0).to_numpy().astype(bool)
    weight = rows.column(1).to_numpy()
    if not bad.any() or bad.all():
        return -math.inf
    order = np.argsort(weight, kind="stable")
    weight, bad = weight[order], bad[order]
    lost = np.concatenate(([0], np.cumsum(~bad))) / (~bad).sum()
    passed = 1 - np.concatenate(([0], np.cumsum(bad))) / bad.sum()
    cost = lost + MISSED_BAD * passed
    cost[1:-1][weight[1:] == weight[:-1]] = np.inf      # equal weights fall on one side
    at = int(np.argmin(cost))
    if at == 0:
        return -math.inf
    return float((weight[at - 1] + weight[at]) / 2) if at < len(weight) else math.inf


def kth_largest(keys: DataFrame, k: int, bins: int = 4096) -> float:
    """The k-th largest value of the column ``key``, by histograms that narrow down on it."""
    if k <= 0:
        return math.inf
    low, high, count = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if count <= k:
        return -math.inf
    rest = k
    while True:
        inside = keys.where((F.col("key") >= low) & (F.col("key") <= high))
        width = (high - low) / bins
        if count <= bins or width <= 0 or low + width == low:
            values = sorted((r[0] for r in inside.groupBy("key").count().select("key", "count").collect() for _ in range(r[1])), reverse=True)
            return values[rest - 1]
        spot = F.least(F.floor((F.col("key") - low) / width), F.lit(bins - 1))
        found = inside.groupBy(spot.alias("bin")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        for row in sorted(found, key=lambda r: -r["bin"]):
            if rest <= row["n"]:
                low, high, count = row["low"], row["high"], row["n"]
                break
            rest -= row["n"]


def resample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ``docs`` that are drawn, all columns and order of columns kept; their scores).

    ``docs`` needs doc_id and text; ``labels`` doc_id, quality, toxic. Null and empty texts have
    weight 0; rows are judged by themselves, also when a doc_id repeats; a null doc_id is drawn
    with the noise of id -1. Keys that tie with the last one drawn are drawn too. Without labels
    of good documents all weights are 0, and without held-out labels of both kinds all are drawn.
    Scores: doc_id, log_weight, key of the rows drawn.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model, sample = fit(base, labels)
    shared = spark.sparkContext.broadcast(model.tobytes())   # VIEWS * 2^BITS doubles: 6 MB
    score = _scored(shared, 1, 0)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, weights, keys in score(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weights), pa.array(keys)], names=["doc_id", "log_weight", "key"])

    scored = stored(base.mapInArrow(scores, "doc_id bigint, log_weight double, key double"))
    least = threshold(scored, sample)
    k = scored.where(F.col("log_weight") >= least).count()
    cut = kth_largest(scored, k)

    kept_columns = docs.columns
    whole = docs.select(F.col("doc_id").cast("bigint").alias("__id"), F.col("text").cast("string").alias("__text"), F.struct(*[F.col(f"`{c}`") for c in kept_columns]).alias("__row"))
    drawn_score = _scored(shared, 1, 0)

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, keys in drawn_score(batches):
            rows = batch.filter(pa.array(keys >= cut))
            yield pa.RecordBatch.from_arrays([rows.column(2)], names=["__row"])

    layout = f"__row {docs.select(F.struct(*[F.col(f'`{c}`') for c in kept_columns]).alias('r')).schema['r'].dataType.simpleString()}"
    rows = whole.mapInArrow(drawn, layout).select("__row.*")
    return rows, scored.where(F.col("key") >= cut)

