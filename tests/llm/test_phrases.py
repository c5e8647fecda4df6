"""Phrase collocations against brute force."""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tideline.llm import phrases  # noqa: E402
from tideline.llm.phrases import collocations, equal_partitions  # noqa: E402

rng = np.random.default_rng(13)


def brute(rows, least, top):
    f = Counter()
    for text, lang in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            f.update((lang or "und" if lang is None else lang, *w[k:k + n]) for n in range(1, 5) for k in range(len(w) - n + 1))
    sizes = Counter()
    for (lang, *w), n in f.items():
        sizes[lang] += n if len(w) == 1 else 0
    out = {}
    for (lang, *w), a in f.items():
        if len(w) < 2 or a < least:
            continue
        longer = [m for key, m in f.items() if key[0] == lang and len(key) - 1 > len(w) and m >= least
                  and any(list(key[1:][k:k + len(w)]) == w for k in range(len(key) - len(w)))]
        if any(100 * m >= 80 * a for m in longer):
            continue
        score, k = min((2000000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return Counter((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score) for lang, found in out.items()
                   for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1))


def twisted(size):
    bits = [bin(k).count("1") % 2 for k in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.fixture(scope="module")
def rows():
    vocabulary = ["the", "of", "Été", "a", "b", "x-y", " ", "zz", "Été"] + [f"w{k}" for k in range(30)]
    share = 1 / np.arange(1, len(vocabulary) + 1)
    texts = []
    for k in range(250):
        w = rng.choice(vocabulary, rng.integers(0, 40), p=share / share.sum()).tolist()
        for at in rng.integers(0, len(w) + 1, 2).tolist():
            w.insert(at, ["new york city hall", "New York", "the the the the the", "Paris, France", "one\ttwo  three\x0bfour", "x x x x x x x x!"][rng.integers(0, 6)])
        texts.append((" ".join(w), ["en", "fr", None, "", "und"][k % 5]))
    one, other = twisted(1024)
    texts += [(f"{one} {other} t. {other} {one} t. {one} {one}", "en")] * 6
    return texts + texts[:30] + [(None, "en"), ("", None), (" .,;\n", "de"), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string").withColumn("words", F.lit(1)).withColumn("phrase", F.lit("x")).repartition(5)


@pytest.mark.parametrize("shard_words, small, leads, pending", [(1 << 20, 512, 1 << 16, 400_000), (150, 3, 64, 20)])
def test_collocations(docs, rows, shard_words, small, leads, pending, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(phrases, "SMALL", small)
    monkeypatch.setattr(phrases, "LEADS", leads)
    monkeypatch.setattr(phrases, "PENDING", pending)
    for least, top in ((6, 40), (3, 2000)):
        expected = brute(rows, least, top)
        got = Counter(map(tuple, collocations(docs, least, top).collect()))
        assert len(expected) > 40 and got == expected
    assert collocations(docs.limit(0)).count() == 0


def test_equal_partitions():
    for _ in range(60):
        n, letters = int(rng.integers(1, 300)), int(rng.integers(1, 6))
        ids = rng.integers(0, letters, (4, n))
        for k, size in enumerate(rng.integers(2, 5, n)):
            ids[size:, k] = -1
        counts, least, whole = rng.integers(1, 5, n), int(rng.integers(1, 30)), int(rng.integers(2, 5))
        expected = Counter()
        for k in range(n):
            for size in (2, 3, 4):
                if ids[size - 1, k] >= 0:
                    expected[tuple(ids[:size, k])] += int(counts[k])
        got = Counter()
        for at, size, total in equal_partitions(ids, counts, least, whole, small=int(rng.integers(1, 60))):
            for a, t in zip(at.tolist(), total.tolist()):
                assert tuple(ids[:size, a]) not in got
                got[tuple(ids[:size, a])] = t
        assert got == Counter({p: t for p, t in expected.items() if t >= least or len(p) < whole})
