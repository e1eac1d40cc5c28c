"""Licence scan: parts of a text compared to licence templates by the Dice coefficient over word bigrams.

Texts are normalised to words (ASCII letters lower-cased, runs of letters and
digits) and compared part by part: every line, every paragraph of several
lines, and the whole text if it has several paragraphs. A part and a template
with a and b distinct bigrams have at best ``2 min(a, b) / (a + b)`` in common,
so only templates whose size lies within bounds around the part's are
compared; a part that shares no bigram with any template is not looked at
again. A notice that shares its line or block with other words, or whose lines
stand behind comment signs, is found by windows: runs of as many words as a
template has, wherever in the text so many of the template's bigrams lie that
the coefficient can be reached. One pass over the documents, no shuffle; the
templates are a parameter.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from crashlens.llm.words import NOT_ALNUM, U64, raw_bytes, slices, split_words, windows

# Public licence notices.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-or-later notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MIT": "Released under the MIT License",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def _bigrams(texts: list[str]) -> list[np.ndarray]:
    words = split_words(*raw_bytes(pa.array(texts, pa.large_string())), NOT_ALNUM, lower=True)
    at, hashes = windows(words, 2)
    return np.split(hashes, np.searchsorted(at, words.first[1:-1])) if len(texts) else []


def _parts(text: bytes) -> list[tuple[str, int, int]]:
    """``(kind, first byte, end)``: lines, paragraphs of several lines, a text of several paragraphs."""
    lines, at = [], 0
    for line in text.split(b"\n"):
        lines.append((at, at + len(line), not line.strip()))
        at += len(line) + 1
    out = [("line", a, b) for a, b, blank in lines if not blank]
    many = []
    run: list[tuple[int, int]] = []
    for a, b, blank in [*lines, (len(text), len(text), True)]:
        if not blank:
            run.append((a, b))
        elif run:
            many.append((run[0][0], run[-1][1], len(run)))
            run = []
    out += [("paragraph", a, b) for a, b, n in many if n > 1]
    if len(many) > 1:
        out.append(("text", many[0][0], many[-1][1]))
    return out


class _Inside:
    """Matches of one text by licence and kind; those of a kind come in the order of the text and do not overlap."""

    def __init__(self) -> None:
        self.found: dict[str, dict[str, tuple[list[int], list[int], list[float]]]] = {}

    def add(self, licence: str, kind: str, start: int, end: int, dice: float) -> None:
        for values, x in zip(self.found.setdefault(licence, {}).setdefault(kind, ([], [], [])), (start, end, dice)):
            values.append(x)

    def has(self, licence: str, start: int, end: int, dice: float) -> bool:
        """Whether a match of the licence with this coefficient or more lies between ``start`` and ``end``; only matches there are looked at."""
        for starts, ends, values in self.found.get(licence, {}).values():
            for k in range(bisect.bisect_left(starts, start), bisect.bisect_right(starts, end)):
                if ends[k] <= end and values[k] >= dice:
                    return True
        return False


def scan(docs: DataFrame, *, text: str = "text", templates: Mapping[str, str] = TEMPLATES, dice: float = 0.8) -> DataFrame:
    """All columns of ``docs``, then ``matches``: what each matching part is (existing columns of that name are replaced).

    A match is ``(licence, dice, kind, start, end)`` with the template nearest to the
    part (the first by name of equals), if its coefficient is at least ``dice``;
    ``start`` and ``end`` are bytes of the text's UTF-8 form. A part is left out if a
    smaller part of it matches the same template as well. Windows (kind ``window``)
    take only template bigrams that no matching part or larger window has taken.
    Null and empty texts, and texts with fewer than two words, match nothing.
    Rows are scanned each by itself: equal texts have equal matches.
    """
    names = sorted(templates)
    own = _bigrams([templates[n] for n in names])
    lengths = [len(x) for x in own]
    sets = [np.unique(x) for x in own]
    sizes = np.array([len(s) for s in sets])
    known = np.unique(np.concatenate([np.zeros(0, dtype=U64), *sets]))
    holds = [np.isin(known, s) for s in sets]
    least = [max(1, int(np.ceil(dice * n / (2 - dice) - 1e-9))) for n in sizes.tolist()]  # common bigrams that a match has
    kept = docs.drop("matches")
    columns = kept.columns

    def nearest(own: np.ndarray) -> tuple[float, int] | None:
        own, best = np.unique(own), None
        fits = np.flatnonzero(2 * np.minimum(sizes, len(own)) >= dice * (sizes + len(own)))  # size bounds
        for i in fits.tolist():
            value = 2 * len(np.intersect1d(own, sets[i], assume_unique=True)) / (len(own) + len(sets[i]))
            if value >= dice and (best is None or value > best[0]):
                best = value, i
        return best

    def windowed(hashes: np.ndarray, text_of: np.ndarray, free: np.ndarray) -> Iterator[tuple[int, float, int, int]]:
        """``(template, dice, first bigram, end)`` of windows that match by bigrams that are ``free``; these are taken."""
        at = np.flatnonzero(free)
        which, tried = np.searchsorted(known, hashes[at]), []
        for t, n in enumerate(lengths):
            if not n:
                continue
            place = at[holds[t][which]]
            last = place[least[t] - 1 :]
            first = place[: len(last)]
            close = (last - first < n) & (text_of[first] == text_of[last])
            starts = set()
            for a, b in zip(first[close].tolist(), last[close].tolist()):
                low, high = np.searchsorted(text_of, (text_of[a], text_of[a] + 1)).tolist()
                begin = max(low, b - n + 1)
                starts.update((x, min(high, x + n)) for x in range(begin, max(begin, min(a, high - n)) + 1))
            for a, b in starts:
                own = np.unique(hashes[a:b])
                both = len(np.intersect1d(own, sets[t], assume_unique=True))
                value = 2 * both / (len(own) + len(sets[t]))
                if value >= dice:
                    tried.append((-both, -value, t, a, b))
        for _, value, t, a, b in sorted(tried):
            mine = free[a:b] & np.isin(hashes[a:b], sets[t])
            if mine.sum() >= least[t]:
                free[a:b] &= ~mine
                yield t, -value, a, b

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                data, offsets = raw_bytes(part.column(text))
                words = split_words(data, offsets, NOT_ALNUM, lower=True)
                at, hashes = windows(words, 2)
                hit = np.isin(hashes, known)
                free = hit.copy()
                rows: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for i in np.unique(words.text[at[hit]]).tolist():
                    smaller = _Inside()
                    raw = data[offsets[i] : offsets[i + 1]].tobytes()
                    for kind, start, end in _parts(raw):
                        low, high = np.searchsorted(words.start, (offsets[i] + start, offsets[i] + end))
                        a, b = np.searchsorted(at, (low, high - 1))  # bigrams of which both words lie in the part
                        found = nearest(hashes[a:b]) if hit[a:b].any() else None
                        if not found:
                            continue
                        value, name = found[0], names[found[1]]
                        free[a:b] &= ~np.isin(hashes[a:b], sets[found[1]])
                        if not smaller.has(name, start, end, value):
                            smaller.add(name, kind, start, end, value)
                            rows[i].append({"licence": name, "dice": value, "kind": kind, "start": start, "end": end})
                for t, value, a, b in windowed(hashes, words.text[at], free):
                    i = words.text[at[a]]
                    start, end = int(words.start[at[a]] - offsets[i]), int(words.end[at[b - 1] + 1] - offsets[i])
                    rows[i].append({"licence": names[t], "dice": value, "kind": "window", "start": start, "end": end})
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(rows, _MATCHES)], [*columns, "matches"])

    match = T.StructType().add("licence", T.StringType()).add("dice", T.DoubleType()).add("kind", T.StringType()).add("start", T.IntegerType()).add("end", T.IntegerType())
    return kept.mapInArrow(make, T.StructType(kept.schema.fields[:]).add("matches", T.ArrayType(match)))


_MATCHES = pa.list_(pa.struct([("licence", pa.string()), ("dice", pa.float64()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
