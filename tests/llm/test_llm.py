"""Operators of the llm subpackage against brute force, on small fixtures with every odd case."""

from __future__ import annotations

import hashlib
import math
import os
import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tideline.llm import html, minhash, pieces, quality, suffix, urls, warc  # noqa: E402
from tideline.llm.decontaminate import decontaminated, overlaps  # noqa: E402
from tideline.llm.embeddings import near_vectors  # noqa: E402
from tideline.llm.minhash import near_duplicates  # noqa: E402
from tideline.llm.scoring import backoff_scores  # noqa: E402
from tideline.llm.shared import components  # noqa: E402
from tideline.llm.urls import RULES, url_verdicts  # noqa: E402

rng = np.random.default_rng(5)
VOCABULARY = ["".join(rng.choice(list("abcdeéß"), rng.integers(2, 7))) for _ in range(400)]


def prose(n: int) -> str:
    return " ".join(rng.choice(VOCABULARY, n))


def twisted(size):
    """A word of a's and b's and its complement: their polynomial hashes modulo a power of two agree."""
    bits = [bin(k).count("1") % 2 for k in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def joined(edges, ids):
    """Smallest id reachable, by repeated relabelling."""
    label = {i: i for i in ids}
    while True:
        old = dict(label)
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
        if label == old:
            return label


@pytest.fixture(scope="module")
def texts():
    base = [prose(60) for _ in range(6)]
    near = [" ".join(w if k % 37 else "changed" for k, w in enumerate(b.split(), 1)) for b in base]
    passage = prose(70)
    odd = [None, "", "   \n\t", "one", "One", "two words", "x" * 49, "y" * 50, "y" * 50, "y" * 3000, "é" * 40, "é" * 41, prose(3000)]
    mixed = [prose(20) + " " + passage + " " + prose(20) for _ in range(4)]
    rows = list(enumerate([*base, *near, *base[:2], *odd, *mixed]))
    return rows + [(3, base[3])]        # one row twice


@pytest.fixture(scope="module")
def docs(spark, texts):
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    return frame.select("*", F.lit("x").alias("rep"), F.lit(1).alias("n_shingles"), F.lit(2.5).alias("id")).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


def test_hashes_part_structured_words():
    """Also in texts beyond the size up to which sums need no reduction, and wherever a word stands."""
    from tideline.llm.words import word_hashes
    for size in (1024, 2048, 8192):
        one, other = twisted(size)
        for before in ("", "x " * 700_000):
            raw = np.frombuffer(f"{before}{one} {other} y {one}".encode(), np.uint8)
            hashes = word_hashes(raw, np.array([0, len(raw)]))[0][len(before) // 2:]
            assert hashes[0] != hashes[1] and hashes[0] == hashes[3]
            plain = np.frombuffer(f"{one}\n{other}".encode(), np.uint8)
            assert word_hashes(plain, np.array([0, len(plain)]))[0].tolist() == hashes[:2].tolist()


def test_components(spark):
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(100 + k, 101 + k) for k in range(20)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    expected = joined(edges, {x for e in edges for x in e})
    assert got == {i: c for i, c in expected.items() if any(i in e and e[0] != e[1] for e in edges)}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, texts, no_docs, size):
    def shingles(text):
        w = words(text)
        return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    sets = {i: shingles(t) for i, t in texts}
    edges = [(i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    label = joined(edges, sets)
    got = Counter(map(tuple, near_duplicates(docs, size).select("doc_id", "n_shingles", "component_id", "kept").collect()))
    assert got == Counter((i, len(sets[i]), label[i], label[i] == i) for i, _ in texts)
    assert near_duplicates(no_docs, size).count() == 0


def test_near_duplicates_of_structured_words_and_repeated_ids(spark):
    one, other = twisted(2048)
    a, b = prose(40), prose(40)
    rows = [(1, one), (2, other), (3, "x " + one), (4, "x " + other), (7, a), (7, b), (9, b + " more"), (20, a + " word"), (30, a), (31, "y")]
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()}
    parts = {i: c for (i, _), (c, _) in got.items()}
    assert parts == {1: 1, 2: 2, 3: 3, 4: 4, 7: 7, 9: 7, 20: 7, 30: 7, 31: 31}


def test_near_duplicates_lose_no_link(spark, sf_dir):
    """Links of documents of a real table, all pairs compared, against those found."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], words(r["text"])) for r in docs.select("doc_id", "text").collect()]
    sets = {i: frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else []) for i, w in rows}
    holders = {}
    for i, grams in sets.items():
        for g in grams:
            holders.setdefault(g, []).append(i)
    shared = Counter((i, j) for ids in holders.values() if len(ids) < 400 for k, i in enumerate(ids) for j in ids[k + 1:])
    edges = [(i, j) for (i, j), n in shared.items() if n > 0.3 * len(sets[i] | sets[j]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    label = joined(edges, sets)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, 2).collect()}
    assert len(edges) > 20 and sum(got[i] == got[j] for i, j in edges) >= 0.99 * len(edges)
    assert all(label[i] == label[c] for i, c in got.items())


@pytest.mark.parametrize("cell", [1, 5, 1024])
def test_near_duplicates_in_cells(spark, cell, monkeypatch):
    """Families of copies around the threshold, and longer and longer ones, whose leader links few: every link is
    found whatever a cell holds, also between cells, and between texts of one id."""
    monkeypatch.setattr(minhash, "CELL_SETS", cell)
    monkeypatch.setattr(minhash, "COLUMNS", 64)
    monkeypatch.setattr(minhash, "LEADER_TURNS", 0)
    draw = np.random.default_rng(8)
    rows = []
    for family in range(4):
        base = [f"w{family}x{k}" for k in range(60 + 40 * family)]
        for _ in range(30):
            text = [w if draw.random() > 0.05 else f"new{draw.integers(10**9)}" for w in base]
            rows.append((len(rows), " ".join(text + base[:draw.integers(0, len(base) // 4)])))
    rows += [(7, rows[40][1] + " more"), (7, rows[7][1] + " more")]
    sets = [(i, frozenset(zip(words(t), words(t)[1:]))) for i, t in rows]
    edges = [(a, b) for a, x in sets for b, y in sets if a < b and 100 * len(x & y) >= 80 * len(x | y)]
    label = joined(edges, [i for i, _ in rows])
    assert 8 < len(set(label.values())) < 110
    got = {(r["doc_id"], r["component_id"]) for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()}
    assert got == set(label.items())


def test_cells_compare_only_unlinked_sets():
    """One link for each pair of components, none within a component or within a side."""
    table = pa.table({"doc": [1, 2, 3, 4, 5], "part": [1, 2, 3, 3, 5], "side": pa.array([0, 0, 1, 1, 1], pa.int32()),
                      "shingles": [np.arange(n, dtype=np.uint64).tobytes() for n in (100, 90, 95, 96, 50)]})
    got = minhash._compared(80)(table)
    assert sorted((min(p), max(p)) for p in zip(got["a"].to_pylist(), got["b"].to_pylist())) in ([(1, 3), (2, 3)], [(1, 4), (2, 3)], [(1, 3), (2, 4)], [(1, 4), (2, 4)])


def test_near_vectors(spark):
    base = rng.standard_normal((12, 16))
    close = np.concatenate([base + 0.05 * rng.standard_normal(base.shape) for _ in range(4)] + [base, base])
    rows = [(int(i), [float(x) for x in np.float32(v)], int(i % 3)) for i, v in enumerate(close)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [1e300] * 16, [float("inf")] + [0.0] * 15, [None] * 16, [1.0, 2.0]]
    rows += [(200 + k, v, 1) for k, v in enumerate(odd)] + [(300, rows[0][1], None), rows[5]]
    got = Counter(map(tuple, near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("key", F.lit(1)))
                      .select("vec_id", "n_links", "component_id", "kept").collect()))
    usable = {i: (np.array(v, float) / np.abs(v).max(), c) for i, v, c in rows
              if c is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    edges = [(i, j) for i, (a, c) in usable.items() for j, (b, d) in usable.items()
             if i < j and c == d and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.98]
    label, degree = joined(edges, [r[0] for r in rows]), Counter(x for e in edges for x in e)
    assert edges and got == Counter((r[0], degree[r[0]], label[r[0]], label[r[0]] == r[0]) for r in rows)
    assert near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


def test_suffix_array():
    for _ in range(120):
        s = np.append(rng.integers(0, rng.integers(1, 5), rng.integers(1, 150)) + 2, 0).astype(np.uint16)
        got = suffix.suffix_array(s, len(s))
        plain = s.tolist()
        assert got.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
        text = s[:-1].astype(np.uint8)
        array = got[got < len(text)]
        prefix = suffix.permuted_prefixes(text, array)
        for a, b in zip(array[1:], array[:-1]):
            same = next((k for k in range(len(text)) if max(a, b) + k >= len(text) or text[a + k] != text[b + k]), 0)
            assert prefix[a] == same


def removed(texts, length=50):
    first = {}
    for i, t in sorted(texts, key=lambda r: r[0]):
        raw = (t or "").encode()
        for k in range(len(raw) - length + 1):
            first.setdefault(raw[k:k + length], i)
    for i, t in texts:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if first[raw[k:k + length]] < i:
                gone[k:k + length] = b"\1" * length
        yield i, raw, gone


@pytest.mark.parametrize("hot", [20_000, 1])
def test_removal_digests(docs, texts, no_docs, hot, monkeypatch):
    monkeypatch.setattr(suffix, "HOT", hot)
    expected = Counter()
    for i, raw, gone in removed(texts):
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        expected[i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    got = Counter(map(tuple, suffix.removal_digests(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()))
    assert sum(k[2] for k in expected) > 0 and got == expected
    assert suffix.removal_digests(no_docs).count() == 0


def test_without_repeats(docs, texts):
    cut = {r["doc_id"]: r["text"] for r in suffix.without_repeats(docs).collect()}
    for i, raw, gone in removed(texts):
        whole = raw.decode()
        text, at = [], 0
        for c in whole:
            size = len(c.encode())
            if not all(gone[at:at + size]):
                text.append(c)
            at += size
        assert (cut[i] or "") == "".join(text)


def test_overlaps(spark, docs, no_docs):
    items = [(1, prose(30)), (2, prose(14)), (3, "short one here"), (4, None), (5, "")]
    changed = items[0][1].split()
    changed[4] = changed[9] = "other"
    spoilt = [w if k % 4 else "no" for k, w in enumerate(items[1][1].split())]
    rows = [(10, prose(9) + " " + items[0][1] + " " + prose(5)), (11, prose(3) + " " + " ".join(changed)), (12, " ".join(spoilt)),
            (13, "a b short one here c"), (14, "short one x here"), (15, None), (16, items[1][1].replace("a", "A")), (17, prose(40))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("seed", F.lit(1))
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(7))
    got = {(r["doc_id"], r["item_id"], r["first_word"], r["n_words"]) for r in overlaps(frame, bench).collect()}
    assert got == {(10, 1, 9, 30), (11, 1, 3, 30), (13, 3, 2, 3), (16, 2, 0, 14)}
    assert {r["doc_id"] for r in decontaminated(frame, bench).collect()} == {12, 14, 15, 17}
    assert overlaps(no_docs, bench).count() == 0 and overlaps(frame, bench.limit(0)).count() == 0


def _spans(rows, items):
    """Spans of windows of 12 words with at most two substituted, of whole short items, all windows compared."""
    found = Counter()
    for doc_id, text in set(rows):
        for item_id, item in set(items):
            d, t = words(text), words(item)
            size, most = (12, 2) if len(t) >= 12 else (len(t), 0)
            for shift in range(-len(t), len(d) + 1) if t else ():
                spans = []
                for k in range(max(0, shift), min(len(d), len(t) + shift) - size + 1):
                    if sum(x != y for x, y in zip(d[k:k + size], t[k - shift:k - shift + size])) <= most:
                        if spans and k <= spans[-1][1] + 1:
                            spans[-1] = (spans[-1][0], k + size - 1, spans[-1][2] + 1)
                        else:
                            spans.append((k, k + size - 1, 1))
                found.update((doc_id, item_id, shift, a, b, b - a + 1, n) for a, b, n in spans)
    return found


def test_overlaps_of_repeated_words(spark):
    """Stretches of one word, broken or not, in items and documents, one-word items among them."""
    items = [(1, "no " * 40), (2, "no " * 20 + "yes " + "no " * 15), (3, "no"), (4, "ha ho " * 12), (5, "no no no"), (6, prose(13)), (6, prose(13))]
    rows = [(1, "no " * 60), (2, "a " + "no " * 14 + "b " + "no " * 30 + "c d"), (3, "ho ha " * 20), (4, items[5][1] + " no no"), (5, "yes " * 30), (6, "no")]
    got = Counter(map(tuple, overlaps(spark.createDataFrame(rows + rows[:1], "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
                      .select("doc_id", "item_id", "shift", "first_word", "last_word", "n_words", "n_windows").collect()))
    assert len(got) > 300 and got == _spans(rows, items)


def test_overlaps_of_long_repetition(spark):
    docs = spark.createDataFrame([(k, "no " * 2000) for k in range(5)], "doc_id bigint, text string")
    items = spark.createDataFrame([(k, "no " * 300) for k in range(20)], "item_id bigint, text string")
    assert overlaps(docs, items).count() == 100 * (2000 - 12 + 300 - 12 + 1)


@pytest.mark.parametrize("common", [4_000_000, 40, 0])
def test_pieces(spark, docs, texts, no_docs, common, monkeypatch):
    monkeypatch.setattr(pieces, "COMMON_WORDS", common)
    more = [(900, "  two  spaces "), (901, "tab\tand\nline"), (902, "a ▁ mark▁in"), (903, "汉字 🙂"), (904, "z" * 2000), (905, " ".join(twisted(512)) * 2), (906, " ")]
    frame = docs.select("doc_id", "text", "id").unionByName(spark.createDataFrame(more, "doc_id bigint, text string").withColumn("id", F.lit(1.0)))
    frame = frame.withColumn("exact", F.lit("x")).withColumn("place", F.lit(1)).withColumn("hash", F.lit(None).cast("string"))
    got = pieces.decoded(pieces.encoded(frame)).collect()
    assert len(got) == len(texts) + len(more)
    best = {}
    for r in got:
        text = r["text"] or ""
        assert r["decoded"] == text and r["exact"] == "x"
        if text not in best and len(text) < 2500:
            best[text] = _best_of_all(text) if text else []
        assert text not in best or r["ids"] == best[text], text[:60]
    checked = pieces.encoded(frame, exact=True).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in checked) == sorted((r["doc_id"], r["ids"]) for r in got)
    assert all(r["exact"] for r in checked)
    assert pieces.encoded(no_docs).count() == 0


def _best_of_all(text):
    """Ids of the best path over the full piece table of the model, whole texts at once: spaces are marks, and no
    word or run of spaces is cut. Bytes cost more than any pieces."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    table, byte_ids = {}, {}
    for k in range(model.get_piece_size()):
        if model.is_byte(k):
            byte_ids[int(model.id_to_piece(k)[3:5], 16)] = k
        elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
            table[model.id_to_piece(k)] = (k, model.get_score(k))
    # A mark that the text holds itself is no space: it is its bytes.
    word, longest = pieces.MARK + text.replace(pieces.MARK, "\uffff").replace(" ", pieces.MARK), max(map(len, table))
    at = [((0, 0), 0, ())]
    for stop in range(1, len(word) + 1):
        options = []
        for start in range(max(0, stop - longest), stop):
            (bare, total), found = at[start][0], table.get(word[start:stop])
            if found:
                options.append(((bare, total + found[1]), -start, (found[0],)))
            elif stop - start == 1:
                options.append(((bare - 1, total), -start, tuple(byte_ids[b] for b in word[start].replace("\uffff", pieces.MARK).encode())))
        at.append(max(options))
    ids, stop = [], len(word)
    while stop:
        ids.append(at[stop][2])
        stop = -at[stop][1]
    return [k for step in ids[::-1] for k in step]


def _check_ids(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in pieces.encoded(frame, exact=True).collect()}
    for k, text in enumerate(texts):
        assert got[k]["exact"] and got[k]["ids"] == _best_of_all(text), text[:60]


def test_long_words(spark):
    draw = lambda letters, n: "".join(rng.choice(list(letters), n))
    _check_ids(spark, [
        "z" * 2001, draw("0123456789abcdef", 4000), draw("ABCDEFGHabcdefgh0123+/", 5000), "ha" * 1500 + " and " + "=" * 777,
        "f(x){return" * 300, draw("ab\U0001f642", 3000), "x " + draw("etaoin", 511), draw("etaoin", 511), draw("etaoin", 512)])


def test_runs_of_spaces(spark):
    _check_ids(spark, [*("a" + " " * k + "b" for k in range(1, 20)), "    indented  twice   x", "ends  ", " ", " " * 40, " " * 1300 + "x",
                       "x  " + "yz" * 900 + "   z", "\n        return  1;\n   \t  x"])


def test_scores(docs, texts, no_docs):
    merged = {}
    for i, t in texts:
        merged.setdefault(i, []).append(words(t))
    pairs = {i: [p for w in many for p in zip([None] + w, w)] for i, many in merged.items()}
    both, context, single = Counter(), Counter(), Counter()
    for p in pairs.values():
        both.update(p)
        context.update(a for a, _ in p)
        single.update(b for _, b in p)
    total = sum(single.values())
    got = {r["doc_id"]: (r["n_words"], r["score"]) for r in backoff_scores(docs).collect()}
    assert set(got) == set(pairs)
    for i, p in pairs.items():
        own = Counter(p)
        missed = Counter(b for a, b in p if both[a, b] == own[a, b])
        score = sum(math.log((both[a, b] - own[a, b]) / context[a]) if both[a, b] > own[a, b]
                    else math.log(0.4 * max(single[b] - missed[b], 0.4) / total) for a, b in p)
        assert got[i] == (len(p), pytest.approx(score, rel=1e-9, abs=1e-9))
    assert backoff_scores(no_docs).count() == 0


def test_quality(spark, no_docs):
    good = [prose(40) for _ in range(300)]
    bad = [prose(30) + " vile " + prose(5) + " awful!" if k % 2 else prose(40).upper() for k in range(300)]
    rows = list(enumerate(good + bad)) + [(9000, None), (9001, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.lit(3))
    labels = spark.createDataFrame([(k, int(k < 300), int(k >= 300 and k % 2)) for k in range(600) if k % 3] + [(None, 1, 0), (5, None, None)],
                                   "doc_id bigint, quality int, toxic int")
    kept, scores = quality.resample(frame, labels)
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == frame.columns and ids == {r["doc_id"] for r in scores.collect()}
    held = [k for k in range(600) if not k % 3]
    assert np.mean([(k in ids) == (k < 300) for k in held]) > 0.95
    assert quality.resample(frame, labels.limit(0))[0].count() == len(rows)
    assert quality.resample(no_docs, labels)[0].count() == 0


def test_kth_largest(spark):
    values = [float(v) for v in rng.integers(0, 50, 3000)]
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 17, 1500, 2999):
        assert quality.kth_largest(keys, k, bins=8) == sorted(values, reverse=True)[k - 1]


def _reputations(hosts, outcomes):
    """Lower posterior bound of every host, by plain loops."""
    two = lambda h: ".".join(h.split(".")[-2:])
    suffix = lambda h: two(h) if two(h) in urls.TWO_PART_SUFFIXES else h.split(".")[-1]
    domain = lambda h: ".".join(h.split(".")[-3:]) if two(h) in urls.TWO_PART_SUFFIXES else two(h)
    low = lambda a, b: a / (a + b) - math.sqrt(a * b / (a + b) ** 2 / (a + b + 1))
    good, n = sum(g for _, g in outcomes) + 1, len(outcomes) + 2
    above = {h: (good / n, low(good, n - good)) for h in hosts}
    for key in (suffix, domain, lambda h: h):
        seen = {}
        for h, g in outcomes:
            seen.setdefault(key(h), []).append((g, above[h][0]))
        rows = [(len(v), sum(g for g, _ in v), v[0][1]) for v in seen.values()]
        many = sum(m * (1 - m) * (k - 1) for k, _, m in rows)
        share = (sum(k * (g / k - m) ** 2 - m * (1 - m) for k, g, m in rows) / many) if many > 0 else 0
        weight = min(max(1 / share - 1 if share > 0 else 1000.0, 2.0), 1000.0)
        now = {}
        for h in hosts:
            values = seen.get(key(h))
            a = weight * above[h][0] + sum(g for g, _ in values or [])
            b = weight + len(values or []) - a
            now[h] = (a / (a + b), low(a, b)) if values else above[h]
        above = now
    return {h: v for h, (_, v) in above.items()}


def test_urls(spark):
    sites = ["http://a.org/x", "https://WWW.Example.ORG/es/1?q#f", "http://example.org/en/12", "http://notexample.org/en/1", "http://b.com/fr/", "http://b.com/de/x",
            "http://b.com/en/", "nourl", None, "http://", "http://h.net?x=/fr/", "ftp://u.co.uk/p#z", "x://y.net/a\nb"]
    pages = spark.createDataFrame(list(enumerate(sites)) + [(6, sites[6])], "page_id bigint, url string").withColumn("host", F.lit("z"))
    outcomes = spark.createDataFrame([(6, 1), (6, 1), (10, 0), (11, 1), (12, None)], "page_id bigint, good int")
    got = url_verdicts(pages, outcomes).collect()
    assert len(got) == len(sites) + 1
    for r in got:
        url = sites[r["page_id"]] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = host.lower()
        fits = [x for x in RULES if (host == x[0] or host.endswith("." + x[0])) and path.startswith(x[1])]
        rule = max(fits, key=lambda x: len(x[0] + x[1]), default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0] + rule[1])
        assert r["verdict"] == rule[2] if rule else r["verdict"] in ("allow", "block")
    # The reputation behind every verdict, level by level.
    hosts = {r["host"]: r["reputation"] for r in got}
    judged = _reputations(hosts, [(r["host"], g) for r in got for p, g in [(6, 1), (6, 1), (10, 0), (11, 1)] if p == r["page_id"]])
    assert hosts == {h: pytest.approx(v, rel=1e-12) for h, v in judged.items()}
    assert all(r["verdict"] == ("allow" if r["reputation"] >= 0.5 else "block") for r in got if r["rule"] is None)
    plan = url_verdicts(pages, outcomes)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert url_verdicts(pages.limit(0), outcomes).count() == 0 and url_verdicts(pages, outcomes.limit(0)).count() == len(sites) + 1


def test_html():
    def page(body):
        return f"<html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"
    main = "<article><h1>Title &amp; more</h1><p>First <b>bold\n text.<br>next<p>Second&nbsp;one &lt;x&gt;.</p><ul><li>a<li>b</ul></article>"
    around = ('<nav><ul><li><a href="/x">Home</a></li></ul></nav><div class="ad">Buy</div>', '<aside class="sidebar">Side</aside><div class="comments"><p>Nice post</p></div>'
              '<form><input><label>Mail</label></form><footer>&copy; me</footer><script>var a = "</p>";</script>')
    pages = [html.Page(page(around[0] + main.replace("First", prose(30)) + around[1])) for _ in range(40)]
    label = [html.markup_label(p) for p in pages]
    x = np.concatenate([html.node_features(p)[m >= 0] for p, m in zip(pages, label)])
    trees = html.fit_trees(x, np.concatenate([m[m >= 0] for m in label]).astype(float))
    assert html.extract(page(around[0] + main + around[1]), trees) == "Title & more\nFirst bold text. next\nSecond one <x>.\na\nb"
    for odd in (None, "", "plain", "<", "<p", "<!-- x", "</div>", "<script>never closed", "<a b='"):
        assert isinstance(html.extract(odd, trees), str)


def test_malformed_pages_take_linear_time():
    import time
    for unit in ('<a b="x ', "<a b='x ", "<a b=\"x' ", "<", "<a ", "<!x ", "</a "):
        for end in ("", ">", '">', "'>"):
            start = time.perf_counter()
            html.Page(unit * (1_000_000 // len(unit)) + end)
            assert time.perf_counter() - start < 5, (unit, end)
    page = html.Page('a <b c="1>2">x</b> < y <i d=\'>\'>z</i> <u "open')
    assert page.tags == ["#root", "b", "i"] and "".join(t for _, t in page.pieces) == 'a x < y z <u "open'


def test_html_decoding_never_contradicts():
    for _ in range(50):
        p = html.Page("<div><p>a<b>b</b></p><div><p>c</p></div></div>" * 3)
        main = html.decode(p, rng.standard_normal(len(p.tags)))
        assert all(main[u] or not main[k] for k, u in enumerate(p.parents) if k)


def test_main_texts(spark):
    rows = [(k, "u", f"<body><nav>menu {k}</nav><article><p>{prose(20)}</p></article></body>") for k in range(30)] + [(None, None, None), (31, "u", "")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    got = {r["page_id"]: r for r in html.main_texts(frame).collect()}
    for page_id, _, raw in rows:
        text = re.search(r"<p>(.*)</p>", raw).group(1) if raw else ""
        assert (got[page_id]["text"], got[page_id]["n_chars"]) == (text, len(text))


def _extracted(spark, rows):
    frame = spark.createDataFrame([(k, "u", page) for k, page in enumerate(rows)], "page_id bigint, url string, html string")
    return [r["text"] for r in html.main_texts(frame).orderBy("page_id").collect()]


def test_main_texts_without_main_markup(spark):
    """Pages without article or main, alone and as one in 100 among others; an article behind a long header."""
    links = "".join(f'<li><a href="/{k}">Go {k}</a></li>' for k in range(8))
    bodies = [[prose(20) for _ in range(3)] for _ in range(30)]
    plain = [f'<body><div class="nav"><ul>{links}</ul></div><div class="content"><p>' + "</p><p>".join(b) + "</p></div></body>" for b in bodies]
    bare = [f'<body><table><tr><td><ul>{links}</ul></td><td><p>' + "</p><p>".join(b) + "</p></td></tr></table></body>" for b in bodies]
    unsaid = [f"<body><section><p>" + "</p><p>".join(b) + "</p></section></body>" for b in bodies]
    article = [f"<body><nav><ul>{links}</ul></nav><article><p>{prose(20)}</p></article></body>" for _ in range(900)]
    late = [f"<body><nav><ul>{links * 300}</ul></nav><article><p>" + "</p><p>".join(b) + "</p></article></body>" for b in bodies]
    expected = ["\n".join(b) for b in bodies]
    assert len(late[0]) > 1 << 16
    for rows in (plain, bare, unsaid, late):
        assert _extracted(spark, rows) == expected
    assert _extracted(spark, [*article, *plain[:9]])[900:] == expected[:9]


def test_one_label_rejects_nothing():
    trees = html.fit_trees(np.zeros((5, html.WIDTH), np.float32), np.ones(5))
    assert html.extract("<body><nav>menu</nav><div><p>Some text.</p></div></body>", trees) == "Some text."


@pytest.mark.parametrize("size", [97, 8 << 20])
def test_warc(spark, tmp_path, size):
    big, fake = prose(400), "x" * 1200 + "\x1f\x8b\x08"
    rows = [(1, "http://a", big), (2, "http://b", big), (3, None, None), (4, "u\r\nv", ""), (5, "http://c", "small"), (6, "http://d", "small"),
            (9, "http://i/" + "".join(rng.choice(list("abcdefghijklmnop0123456789"), 1_000_000 if size > 97 else 3_000)), "after a long address"),
            (7, "http://e", fake), (7, "http://e", fake), (None, "http://f", big), (8, "http://g", "\r\n\r\nWARC/1.1\r\n\r\n")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("same", F.lit(1)).repartition(2)
    manifest = warc.write_warc(frame, str(tmp_path / "w"))
    got = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_warc(manifest, size).collect())
    expected = Counter()
    for page_id, _, text in rows:
        raw = (text or "").encode()
        revisit = page_id == 1
        expected[page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None] += 1
    assert got == expected
    records = warc.read_warc(manifest, size)
    assert warc.incomplete_files(manifest, records).count() == 0
    assert warc.incomplete_files(manifest, records.where("page_id <> 9 or page_id is null")).count() == 1
    assert warc.read_warc(warc.write_warc(frame.limit(0), str(tmp_path / "e"))).count() == 0


def test_pipeline(spark, sf_small):
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    result = corpus_pipeline.run(spark, sf_small)
    assert {"doc_id", "text", "ids"} <= set(result.columns) and 0 < result.count() <= docs.count()
    assert result.where("not exact").count() == 0
