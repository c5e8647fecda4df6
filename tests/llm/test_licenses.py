"""License scans against brute force: places by word, notices by dynamic programming over edits."""

from __future__ import annotations

import os
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tideline.llm import licenses  # noqa: E402
from tideline.llm.licenses import NOTICES, PHRASES, license_labels, license_notices  # noqa: E402

rng = np.random.default_rng(12)
FILLER = "lorem mit license under the cc by apache version 2 er the ense é ç released gnu 3 nc".split()


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def fewest_edits(notice, text):
    """Fewest edits of the notice anywhere in the text, each part within its own bound; None if there is none."""
    costs = {k: 0 for k in range(len(text) + 1)}          # where the parts so far may end, and at what cost
    for part, bound in notice.parts:
        ends = {}
        for start, before in costs.items():
            row = list(range(len(part) + 1))
            for stop in range(start, min(len(text), start + len(part) + bound) + 1):
                if row[-1] <= bound:
                    ends[stop] = min(ends.get(stop, 10**6), before + row[-1])
                if stop == len(text) or min(row) > bound:
                    break
                new = [stop + 1 - start]
                for i, c in enumerate(part):
                    new.append(min(row[i] + (c != text[stop]), row[i + 1] + 1, new[i] + 1))
                row = new
        costs = ends
    return min(costs.values(), default=None)


def spoilt(text, n):
    out = list(text)
    for _ in range(n):
        k = int(rng.integers(0, len(out)))
        kind = rng.integers(0, 3)
        if kind == 0:
            out[k] = "zé"[rng.integers(0, 2)]
        elif kind == 1:
            del out[k]
        else:
            out.insert(k, "qé€"[rng.integers(0, 3)])
    return "".join(out)


def sample():
    def filler(n):
        return " ".join(rng.choice(FILLER, n))
    texts = [None, "", "...", "under the mit license", "Under the MIT-License, under the mit license.", "cc by nc cc by nc", "cc by ncx", "CC BY-NC",
             "apache license version 2.0", "apache license, Version 20", "x" * 3000, "er the " * 400, "released under the " * 60 + "mit license",
             "license mit license under the mit", "Licensed under CC BY-NC 4.0.", "Released under the MIT License.",
             "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.",
             "licensed under the gnu general public license version 2.", "licensed under the apache license version 1.1", "MIT"]
    for _ in range(160):
        notice = NOTICES[rng.integers(0, len(NOTICES))]
        line = spoilt("".join(t for t, _ in notice.parts), rng.integers(0, 9))
        texts.append(filler(rng.integers(0, 9)) + [" ", "\n", ", "][rng.integers(0, 3)] + line + [" ", ". "][rng.integers(0, 2)] + filler(rng.integers(0, 9)))
    return texts


@pytest.mark.parametrize("size", [1 << 20, 300])
def test_license_notices(spark, size, monkeypatch):
    monkeypatch.setattr(licenses, "SLICE_BYTES", size)
    texts = sample()
    frame = spark.createDataFrame(list(enumerate(texts)) + [(4, texts[4])], "doc_id bigint, text string").withColumn("places", F.lit(1)).withColumn("row", F.lit(2))
    found = license_notices(frame)
    spans = {r["doc_id"]: r for r in found.collect()}
    got = license_labels(found).collect()
    assert len(got) == len(texts) + 1 and license_notices(frame.limit(0)).count() == 0
    fuzzy = 0
    for r in got:
        text = texts[r["doc_id"]]
        w = words(text)
        places = [(k, label) for phrase, label in PHRASES for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (
            len(w), len(places), min(places, default=(None,))[0], max(places, default=(None,))[0])
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        line = " " + "".join(x + " " for x in w)
        edits = {(n.label, k): e for k, n in enumerate(NOTICES) if w and (e := fewest_edits(n, line)) is not None}
        assert r["labels"] == ",".join(sorted({label for _, label in places} | {label for label, _ in edits})), text
        best = max((1 - e / sum(len(t) for t, _ in NOTICES[k].parts) for (_, k), e in edits.items()), default=0.0)
        assert r["score"] == (1.0 if places else pytest.approx(best)), text
        fuzzy += bool(edits) and not places
        raw = (text or "").encode()
        for s in spans[r["doc_id"]]["notices"]:
            assert 0 <= s["first_byte"] < s["end_byte"] <= len(raw)
            line = " " + "".join(x + " " for x in words(raw[s["first_byte"]:s["end_byte"]].decode("utf-8", "ignore")))
            assert any(fewest_edits(n, line) is not None for n in NOTICES if n.label == s["label"]), (text, line)
    assert fuzzy > 20
