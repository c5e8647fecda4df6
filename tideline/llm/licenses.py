"""License notices in texts, also misspelt ones.

Texts are reduced to lower-case words with one space between them. A notice is a line of words, each part of
which bears a number of edits (characters put in, left out or changed). By the pigeonhole principle a
part that bears k edits, split into k + 1 pieces, holds one of them unchanged wherever it occurs: all
pieces of one part of every notice are searched at once by an Aho-Corasick automaton, a hit places a
window of fixed length around where the notice would stand, and in the window the ``regex`` library
matches the whole notice with its edits bounded part by part and says where it begins and ends.
Phrases that must stand exactly are patterns of the same automaton.

Every hit has its own window and equal windows are looked at once, so work is linear in the hits; all of
it is done by the task that reads the text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.words import _LOWER, SLICE_BYTES, list_array, slices, text_buffers, word_bytes, word_hashes


class Notice(NamedTuple):
    """A label and the notice's parts in order: (words, edits they bear)."""
    label: str
    parts: tuple[tuple[str, int], ...]


#: Phrases whose words must stand as they are, and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Notices that may be misspelt. What tells one license from another bears no edits.
NOTICES = (
    Notice("mit", (("released under the", 2), (" mit ", 0), ("license", 1))),
    Notice("mit", (("permission is hereby granted free of charge to any person obtaining a copy of this software", 6),)),
    Notice("apache-2", (("licensed under the apache license version", 4), (" 2", 0))),
    Notice("apache-2", (("spdx license identifier", 2), (" apache 2 0 ", 0))),
    Notice("cc-by-nc", (("licensed under", 2), (" cc by nc ", 0))),
    Notice("cc-by-nc", (("creative commons attribution", 3), (" noncommercial ", 0))),
    Notice("cc-by-sa", (("creative commons attribution", 3), (" sharealike ", 0))),
    Notice("gpl-3", (("licensed under the gnu general public license version", 5), (" 3 ", 0))),
    Notice("gpl-2", (("licensed under the gnu general public license version", 5), (" 2 ", 0))),
    Notice("lgpl", (("gnu lesser general public license", 3),)),
    Notice("mpl-2", (("subject to the terms of the mozilla public license", 5), (" v 2 0 ", 0))),
    Notice("bsd", (("redistribution and use in source and binary forms with or without modification", 6),)),
)

PLACE = "struct<label:string,first_word:bigint>"
SPAN = "struct<label:string,first_byte:bigint,end_byte:bigint,edits:int,similarity:double>"
ADDED = ["n_words", "places", "notices"]
SEEN = 100_000           # windows remembered at once
_BETWEEN = np.ones(256, bool)
_BETWEEN[48:58] = _BETWEEN[65:91] = _BETWEEN[97:123] = _BETWEEN[128:] = False


def seeds_of(notice: Notice) -> list[tuple[str, int]]:
    """(piece, its first character within the notice) of the part with the longest pieces."""
    best: list[tuple[str, int]] = []
    base = 0
    for text, edits in notice.parts:
        cuts = [len(text) * k // (edits + 1) for k in range(edits + 2)]
        pieces = [(text[a:b], base + a) for a, b in zip(cuts[:-1], cuts[1:])]
        if min(len(p) for p, _ in pieces) > min((len(p) for p, _ in best), default=0):
            best = pieces
        base += len(text)
    return best


def pattern_of(notice: Notice):
    import regex

    parts = [f"(?:{regex.escape(text)}){{e<={edits}}}" if edits else regex.escape(text) for text, edits in notice.parts]
    return regex.compile("(?b)" + "".join(parts))


@lru_cache(maxsize=4)
def _search(phrases: Sequence[tuple[str, str]], notices: Sequence[Notice]):
    """(automaton, patterns); values of the automaton are lists of (phrase or None, notice or None, offset)."""
    import ahocorasick

    found: dict[str, list[tuple[int, int, int]]] = {}
    for k, (phrase, _) in enumerate(phrases):
        found.setdefault(f" {phrase} ", []).append((k, -1, 0))
    for k, notice in enumerate(notices):
        for piece, offset in seeds_of(notice):
            found.setdefault(piece, []).append((-1, k, offset))
    machine = ahocorasick.Automaton()
    for text, uses in found.items():
        machine.add_word(text, (len(text), uses))
    machine.make_automaton()
    return machine, [pattern_of(n) for n in notices]


def _reduced(data: np.ndarray, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, count: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(all texts reduced, each a line break, a space, and its words with a space behind each; first byte of every
    line, and of every word there)."""
    size = ends - starts + 1
    begin = np.cumsum(size) - size
    at = begin + 2 * (rows + 1)
    lines = np.append(begin, size.sum())[np.searchsorted(rows, np.arange(count))] + 2 * np.arange(count)
    out = np.full(int(size.sum()) + 2 * count, 32, np.uint8)
    out[lines] = 10
    out[word_bytes(at, at + size - 1)] = _LOWER[data[word_bytes(starts, ends)]]
    return out.tobytes(), lines, at


def _verified(window: str, pattern) -> tuple[int, int, int] | None:
    """(bytes before the best match, its bytes, edits)."""
    hit = pattern.search(window)
    return hit and (len(window[:hit.start()].encode()), len(hit.group().encode()), sum(hit.fuzzy_counts))


def _spans(text: bytes, lines: np.ndarray, windows: set[tuple[int, int, int]], patterns: list, notices: Sequence[Notice]) -> set[tuple[int, int, int, int, int]]:
    """(line, first byte, end, notice, edits) of the notices in ``windows`` (line, notice, byte where it would begin)."""
    ends = np.append(lines[1:], len(text))
    sizes = [sum(len(t) for t, _ in n.parts) for n in notices]
    slack = [4 * sum(e for _, e in n.parts) for n in notices]       # a character put in has up to four bytes
    needed = [[t.encode() for t, e in n.parts if not e] for n in notices]
    seen: dict[tuple[int, bytes], tuple[int, int, int] | None] = {}
    spans = set()
    for line, notice, begin in windows:
        low = max(begin - slack[notice], int(lines[line]) + 1)
        high = min(begin + sizes[notice] + slack[notice], int(ends[line]))
        while text[low] & 0xC0 == 0x80:
            low += 1
        raw = text[low:high]
        if any(part not in raw for part in needed[notice]):
            continue
        if (notice, raw) not in seen:
            if len(seen) >= SEEN:
                seen.clear()
            seen[notice, raw] = _verified(raw.decode("utf-8", "ignore"), patterns[notice])
        if hit := seen[notice, raw]:
            spans.add((line, low + hit[0], low + hit[0] + hit[1], notice, hit[2]))
    return spans


def _chosen(spans: set[tuple[int, int, int, int, int]], notices: Sequence[Notice]) -> list[tuple[int, int, int, int, int]]:
    """Of spans of one label that share bytes the one of least edits for its length (ties: the first)."""
    sizes = [sum(len(t) for t, _ in n.parts) for n in notices]
    groups: dict[tuple[int, str], list[tuple[int, int, int, int, int]]] = {}
    for span in spans:
        groups.setdefault((span[0], notices[span[3]].label), []).append(span)
    chosen = []
    for group in groups.values():
        taken = np.zeros(0, np.int64)       # ends of disjoint spans: begin, end, begin, end ...
        for span in sorted(group, key=lambda s: (s[4] / sizes[s[3]], s[1:])):
            at = int(np.searchsorted(taken, span[1], "right"))
            if at % 2 == 0 and at == int(np.searchsorted(taken, span[2], "left")):
                taken = np.insert(taken, at, span[1:3])
                chosen.append(span)
    return sorted(chosen)


def _found(phrases: Sequence[tuple[str, str]], notices: Sequence[Notice]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, patterns = _search(phrases, notices)
        sizes = [sum(len(t) for t, _ in n.parts) for n in notices]
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for first, last in slices(offsets, SLICE_BYTES):
                part, bounds, count = data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], last - first
                _, rows, starts, ends = word_hashes(part, bounds, between=_BETWEEN)
                words = np.bincount(rows, minlength=count)
                before = np.cumsum(words) - words
                text, lines, at = _reduced(part, rows, starts, ends, count)
                exact, windows = [], set()
                for stop, (length, uses) in machine.iter(text.decode("latin-1")):
                    begin = stop - length + 1
                    for phrase, notice, offset in uses:
                        if notice < 0:
                            exact.append((begin + 1, phrase))
                        else:
                            windows.add((begin, notice, begin - offset))
                owner = np.searchsorted(lines, [w[0] for w in windows], "right") - 1
                windows = {(line, notice, begin) for line, (_, notice, begin) in zip(owner.tolist(), windows)}
                told = _chosen(_spans(text, lines, windows, patterns, notices), notices)

                exact.sort()
                place = np.searchsorted(at, np.array([b for b, _ in exact], np.int64))
                owner = rows[place] if len(place) else np.zeros(0, np.int64)
                places = pa.StructArray.from_arrays([
                    pa.array([phrases[k][1] for _, k in exact], pa.string()), pa.array((place - before[owner]).astype(np.int64))], ["label", "first_word"])

                def original(bytes_: list[int], lines_: np.ndarray) -> np.ndarray:
                    """The byte within its row of the text for a byte of the reduced texts."""
                    reduced = np.array(bytes_, np.int64)
                    word = np.clip(np.searchsorted(at, reduced, "right") - 1, before[lines_], before[lines_] + words[lines_] - 1)
                    return np.clip(starts[word] + reduced - at[word], starts[word], ends[word]) - bounds[lines_]

                line = np.array([t[0] for t in told], np.int64)
                found = pa.StructArray.from_arrays([
                    pa.array([notices[t[3]].label for t in told], pa.string()),
                    pa.array(original([t[1] for t in told], line) if told else line), pa.array(original([t[2] for t in told], line) if told else line),
                    pa.array([t[4] for t in told], pa.int32()), pa.array([1 - t[4] / sizes[t[3]] for t in told], pa.float64())],
                    ["label", "first_byte", "end_byte", "edits", "similarity"])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, count), pa.array(words.astype(np.int64)), list_array(places, np.bincount(owner, minlength=count)),
                    list_array(found, np.bincount(line, minlength=count))], names=["row", *ADDED])
    return run


def license_notices(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES, notices: Sequence[Notice] = NOTICES) -> DataFrame:
    """``docs`` with n_words, places and notices.

    Words are stretches of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. ``places``: label and
    first word (from 0) of every place where the words of a phrase stand one after another, by first word. ``notices``: label, first
    byte and end in the UTF-8 text, edits and similarity (1 less edits per character) of every notice found within its bounds;
    of those of one label that share bytes the one of least edits for its length. Needs text; all other columns
    are kept, those of the names added are replaced. Null, empty and wordless texts have no words, no places and no notices;
    repeated rows are told each. A text is held whole by one task.
    """
    kept = [c for c in docs.columns if c not in ADDED]
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("text").cast("string").alias("text"))
    kind = base.schema["row"].dataType.simpleString()
    found = base.mapInArrow(_found(tuple(phrases), tuple(notices)), f"row {kind}, n_words bigint, places array<{PLACE}>, notices array<{SPAN}>")
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], *ADDED)


def license_labels(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score (the best similarity, 1 for a phrase, 0 for nothing)."""
    first, base = F.transform("places", lambda p: p["first_word"]), F.transform("places", lambda p: p["label"])
    every = F.concat(base, F.transform("notices", lambda n: n["label"]))
    said = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    score = F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("notices", lambda n: n["similarity"])), F.lit(0.0)))
    return found.select("doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"), F.array_min(first).alias("first_word"),
                        F.array_max(first).alias("last_word"), said(base).alias("base_labels"), said(every).alias("labels"), score.alias("score"),
                        "notices")
