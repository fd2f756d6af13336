"""License scans: MinHash bands over overlapping text windows retrieve templates, shingle containment verifies.

A template is cut into windows of ``WINDOW`` words at every offset, a document into windows of the same size
at every ``STRIDE``-th offset; a template shorter than that is one window of its own length, and documents are
then cut at that length and every offset (a window of one shingle has one band, as it matches whole or not at all). The MinHash of a window's five-word shingles is banded. A document
window with Jaccard similarity s to a template window shares a band with probability 1 - (1 - s^ROWS)^BANDS,
which is 1 for a verbatim passage of WINDOW + STRIDE words and above 0.99 from s = 0.6. Retrieved pairs are
verified exactly: the share of the template's different shingles that the whole document holds must reach
``threshold``.

Templates travel with the tasks in slices of about ``SLICE_WORDS`` words, dealt by a hash; a template of more
than ``TEMPLATE_WORDS`` words is a slice of its own, so what a task holds is bounded by the slice or by one
template. Slices are scanned one by one. Documents are never shuffled.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; null and empty texts match nothing; templates
of fewer than five words are one shingle; very long templates and texts are compared whole; repeated rows are scanned each; templates with equal ids are
refused; ties do not arise; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from formline.llm.common import _mixed, slices, text_bytes, word_bounds, word_keys

SHINGLE = 5
WINDOW = 24
STRIDE = 4
ROWS = 2
BANDS = 12
THRESHOLD = 0.8
SLICE_WORDS = 1_000_000
TEMPLATE_WORDS = 20_000

# Short public license notices, and the whole license texts of the folder ``licenses`` by file name.
NOTICES = {
    "gpl-3-line": "This work is licensed under the GNU General Public License, version 3.",
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "all-rights-line": "Copyright holders. All rights reserved.",
    "gpl-3-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
    " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
    " option) any later version.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
    ' associated documentation files (the "Software"), to deal in the Software without restriction, including without'
    " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
    " Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
    " that the following conditions are met:",
    "apache-2.0-notice": "Unless required by applicable law or agreed to in writing, software distributed under the License"
    ' is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    **{
        f"{part.name.removesuffix('.txt')}-text": part.read_text("utf-8")
        for part in sorted((files(__package__) / "licenses").iterdir(), key=lambda part: part.name)
        if part.name.endswith(".txt")
    },
}


def shingles(keys: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash per run of ``size`` word keys; a shorter text is one shingle."""
    if not len(keys):
        return keys
    size = min(size, len(keys))
    with np.errstate(over="ignore"):
        out = np.zeros(len(keys) - size + 1, np.uint64)
        for k in range(size):
            out = out * np.uint64(0xBF58476D1CE4E5B9) + keys[k : k + len(out)]
    return _mixed(out)


def _text_keys(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    first, last, _ = word_bounds(data, np.array([0, len(data)]))
    return word_keys(data, first, last)


_NOISE = np.random.default_rng(3).integers(1, 2**63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(marks: np.ndarray, spans: list[tuple[np.ndarray, np.ndarray, int]]) -> list[np.ndarray]:
    """Per span (begin, end, number of bands) of windows over the shingles ``marks`` their bands: windows x bands.

    A window's smallest value is that of the two runs of 2^k shingles that cover it; runs are doubled once for all spans.
    """
    out = [np.empty((len(begin), bands), np.uint64) for begin, _, bands in spans]
    covers = []
    for begin, end, _ in spans:
        power = np.frexp(end - begin)[1] - 1
        covers.append([(k, np.flatnonzero(power == k)) for k in np.unique(power).tolist()])
    deepest = max((k for cover in covers for k, _ in cover), default=0)
    with np.errstate(over="ignore"):
        for band in range(max((bands for *_, bands in spans), default=0)):
            keys = [np.full(len(begin), band, np.uint64) for begin, _, _ in spans]
            for row in range(ROWS):
                least = [_mixed(marks * _NOISE[band * ROWS + row])]
                for k in range(deepest):
                    least.append(np.minimum(least[k][: -(1 << k)], least[k][1 << k :]))
                for key, cover, (begin, end, bands) in zip(keys, covers, spans):
                    if band < bands:
                        key *= np.uint64(0x9E3779B97F4A7C15)
                        for k, at in cover:
                            at = slice(None) if len(at) == len(key) else at
                            key[at] += np.minimum(least[k][begin[at]], least[k][end[at] - (1 << k)])
            for found, key, (*_, bands) in zip(out, keys, spans):
                if band < bands:
                    found[:, band] = _mixed(key)
    return out


def _bands(words: int) -> int:
    """Windows of one shingle are equal or have nothing in common, which one band decides."""
    return BANDS if words > SHINGLE else 1


def windows(counts: np.ndarray, first: np.ndarray, words: int, size: int, step: int):
    """Begin and end (in shingles) and text of the windows of ``words`` words; the last one ends at the text's end.

    Text d has ``counts[d]`` words from ``first[d]``; a text with fewer words than a window is one window.
    """
    held = counts - size + 1
    width = words - size + 1
    full = np.maximum(held - width, 0)
    made = np.where(held > 0, -(-full // step) + 1, 0)
    owner = np.repeat(np.arange(len(counts)), made)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made)
    begin = first[owner] + np.minimum(place * step, full[owner])
    return begin, begin + np.minimum(width, held[owner]), owner


class Retriever:
    """Templates by band key, for windows of each length."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.ids = [i for i, _ in templates]
        keys = [_text_keys(t) for _, t in templates]
        self.sizes = [min(SHINGLE, len(k)) for k in keys]
        self.marks = [np.unique(shingles(k)) for k in keys]
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for at, own in enumerate(keys):
            if len(own):
                words, size = min(len(own), WINDOW), self.sizes[at]
                begin, end, _ = windows(np.array([len(own)]), np.array([0]), words, size, 1)
                bands = np.unique(band_keys(shingles(own), [(begin, end, _bands(words))])[0])
                found.setdefault(words, []).append((bands, np.full(len(bands), at)))
        self.tables = {}
        for words, parts in found.items():
            bands = np.concatenate([b for b, _ in parts])
            owners = np.concatenate([o for _, o in parts])
            order = np.argsort(bands, kind="stable")
            near = np.zeros(1 << 22, bool)  # rules out most keys before the search
            near[bands >> np.uint64(42)] = True
            self.tables[words] = bands[order], owners[order], near

    def matches(self, data: np.ndarray, starts: np.ndarray, threshold: float) -> list[tuple[int, str, float, int]]:
        """Text, template id, containment and the number of windows that retrieved it."""
        word_start, word_end, first = word_bounds(data, starts)
        keys = word_keys(data, word_start, word_end)
        counts, first = np.diff(first), first[:-1]
        hits: dict[tuple[int, int], set[int]] = {}
        marks = {size: _runs(keys, size) for size in {min(words, SHINGLE) for words in self.tables}}
        asked_of: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size, runs in marks.items():
            lengths = [words for words in self.tables if min(words, SHINGLE) == size]
            cut = [windows(counts, first, words, size, STRIDE if words == WINDOW else 1) for words in lengths]
            bands = band_keys(runs, [(begin, end, _bands(words)) for words, (begin, end, _) in zip(lengths, cut)])
            asked_of |= {words: (own, owner) for words, own, (*_, owner) in zip(lengths, bands, cut)}
        for words, (bands, owners, near) in self.tables.items():
            own, owner = asked_of[words]
            window, band = np.nonzero(near[own >> np.uint64(42)])
            asked = own[window, band]
            low, high = np.searchsorted(bands, asked, "left"), np.searchsorted(bands, asked, "right")
            for k in np.flatnonzero(high > low).tolist():
                for at in owners[low[k] : high[k]].tolist():
                    hits.setdefault((int(owner[window[k]]), at), set()).add(int(window[k]))
        out = []
        for (text, at), seen in sorted(hits.items()):
            size = self.sizes[at]
            held = np.unique(marks[size][first[text] : first[text] + counts[text] - size + 1])
            share = float(np.isin(self.marks[at], held, assume_unique=True).mean())
            if share >= threshold:
                out.append((text, self.ids[at], share, len(seen)))
        return out


def _runs(keys: np.ndarray, size: int) -> np.ndarray:
    """A shingle from every position; those that cross a text's end are never looked at."""
    return shingles(keys, size) if len(keys) >= size else np.zeros(0, np.uint64)


def scan(
    docs: DataFrame,
    templates: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    template_id: str = "template_id",
    template_text: str = "text",
    threshold: float = THRESHOLD,
    slice_words: int = SLICE_WORDS,
    template_words: int = TEMPLATE_WORDS,
) -> DataFrame:
    """``doc_id, template_id, containment, n_windows`` of every verified match."""
    rows = templates.select(F.col(template_id).cast("string").alias("_id"), F.coalesce(F.col(template_text), F.lit("")).alias("_text"))
    if rows.groupBy("_id").count().where("count > 1").limit(1).count():
        raise ValueError("template ids must be unique")
    sized = rows.withColumn("_words", F.size(F.split("_text", r"[\x20\x09-\x0D]+")))
    short = sized.where(F.col("_words") <= template_words)
    total = short.agg(F.coalesce(F.sum("_words"), F.lit(0)).alias("n")).first()["n"]
    parts = max(2 * -(-total // slice_words) - 1, 1)
    dealt = short.withColumn("_part", F.pmod(F.xxhash64("_id"), F.lit(parts)))
    cuts = [dealt.where(F.col("_part") == part) for part in range(parts)]
    # One id per further pass over the documents.
    alone = [r["_id"] for r in sized.where(F.col("_words") > template_words).select("_id").orderBy("_id").collect()]
    cuts += [sized.where(F.col("_id").eqNullSafe(name)) for name in alone]
    kind = docs.schema[doc_id].dataType.simpleString()
    bodies = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))

    def scanned(cut: DataFrame) -> DataFrame:
        chosen = sorted(((r["_id"], r["_text"]) for r in cut.select("_id", "_text").collect()), key=lambda t: (t[0] is not None, t))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            retriever = Retriever(chosen)
            for batch in slices(batches, "_text"):
                found = retriever.matches(*text_bytes(batch.column(1)), threshold)
                at, names, shares, seen = zip(*found) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at, pa.int64())),
                        pa.array(names, pa.string()),
                        pa.array(shares, pa.float64()),
                        pa.array(seen, pa.int64()),
                    ],
                    ["_id", "template_id", "containment", "n_windows"],
                )

        return bodies.mapInArrow(run, f"_id {kind}, template_id string, containment double, n_windows bigint")

    found = reduce(DataFrame.unionByName, [scanned(cut) for cut in cuts])
    return found.withColumnRenamed("_id", doc_id)
