"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import os
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tideline.llm import periods  # noqa: E402
from tideline.llm.periods import periodic_runs, run_digests, runs_of, with_periodic_tails  # noqa: E402

rng = np.random.default_rng(11)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(w, least=12):
    """Every run, by trying all periods."""
    ends = {}
    for q in range(1, len(w) // 2 + 1):
        at = 0
        while at + q < len(w):
            stop = at
            while stop + q < len(w) and w[stop] == w[stop + q]:
                stop += 1
            if stop - at >= q:
                ends.setdefault((at, stop + q), q)
            at = stop + 1
    return sorted((s, e - s, q) for (s, e), q in ends.items() if e - s >= least)


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def twisted(size):
    """A word of a's and b's and its complement: their polynomial hashes modulo a power of two agree."""
    bits = [bin(k).count("1") % 2 for k in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def sample():
    texts = []
    for _ in range(60):
        letters = rng.integers(1, 4)
        unit = ["xyz"[k] for k in rng.integers(0, letters, rng.integers(1, 24))]
        parts = [["pqr"[k] for k in rng.integers(0, 3, rng.integers(0, 12))], (unit * 9)[:rng.integers(1, 9 * len(unit) + 1)],
                 ["pqx"[k] for k in rng.integers(0, 3, rng.integers(0, 12))], (unit[::-1] * 4)[:rng.integers(0, 60)]]
        texts.append("  ".join(" ".join(p) for p in parts))
    one, other = twisted(2048)
    return texts + [None, "", " \n ", "a", "a " * 11, "a " * 12, "\ta\x0b" * 300, "ab ba " * 500 + "ab", "É è " * 40 + "e", "Aa aA " * 9,
                    f"{one} {other} " * 4, f"{one} {one} " * 6, " ".join(f"w{k % 700}" for k in range(3000)), " ".join(f"u{k}" for k in range(500))]


def test_runs_of_many_rows():
    for _ in range(150):
        rows, flat = [], []
        for r in range(rng.integers(1, 5)):
            n = int(rng.integers(0, 90))
            flat += rng.integers(0, rng.integers(1, 4), n).tolist()
            rows += [r] * n
        start, end, q = runs_of(np.array(flat, np.int64), np.array(rows, np.int64), 2)
        expected, base = [], 0
        for r in range(5):
            own = [x for x, y in zip(flat, rows) if y == r]
            expected += [(s + base, s + base + n, p) for s, n, p in brute(own, 2)]
            base += len(own)
        assert list(zip(start.tolist(), end.tolist(), q.tolist())) == sorted(expected, key=lambda x: (x[0], x[2]))


@pytest.mark.parametrize("size", [1 << 20, 64])
def test_periodic_runs(spark, size, monkeypatch):
    monkeypatch.setattr(periods, "SLICE_BYTES", size)
    texts = sample()
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(3, texts[3])], "doc_id bigint, text string").withColumn("row", F.lit(1)).withColumn("runs", F.lit(2))
    got = periodic_runs(frame).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        w = words(texts[r["doc_id"]])
        runs = brute(w)
        assert (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"], r["row"]) == (len(w), runs, collapsed(w, runs), 1)
    assert periodic_runs(frame.limit(0)).count() == 0


def test_run_digests(spark):
    texts = [(int(k), t) for k, t in zip(rng.integers(0, 10**9, 400), sample() * 6)] + [(None, "a " * 30)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("h", F.lit("x")).withColumn("words", F.lit(0))
    expected, changed = Counter(), 0
    for i, t in texts:
        w = words(t)
        n, h = len(w), zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
            changed += 1
        runs = brute(w)
        s, m, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        expected[i, len(runs), s, m, q, m and 1000 * m // q, hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
                 hashlib.sha256(collapsed(w, runs).encode()).hexdigest()] += 1
    got = Counter(map(tuple, run_digests(periodic_runs(with_periodic_tails(frame))).collect()))
    assert changed > 10 and got == expected
