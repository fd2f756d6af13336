"""Frequent phrases and their collocation score, by Rabin-Karp fingerprints of all word n-grams.

A-Z are lowered, texts are split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words ``[^\\x20\\x09]+``.
Prefix polynomials over bytes hash every word, prefix polynomials over the word hashes every run of one to
``LONGEST`` words inside a piece, and the text's language goes into the fingerprint. Two rounds:

1. Each chunk of texts reduces its n-grams to different fingerprints with counts and deals them to buckets,
   which add up the counts. The pointer to an occurrence is the chunk and the entry in its sorted list: the
   answer, one code per entry, says which fingerprints may reach ``least``.
2. Each chunk writes out the phrase of every such fingerprint from the text, after comparing all occurrences
   in the chunk with it word by word; occurrences that differ in spite of an equal fingerprint are counted
   apart. The buckets add up phrases, not fingerprints, so the counts are exact.

Only phrases that reach ``least`` leave the second round; scores, the nesting rule and the ranking are joins
over them. Counts and scores are exact: products are decimals.

Defined results: a null text is empty, a null language is ``und`` (one language with texts so named); a phrase
at ``least`` is a candidate; ties in the score go to the larger count, then to the smaller phrase in UTF-8 byte
order, ties between cuts to the shortest first part; repeated rows count each; an empty table gives an empty
result; texts of any length are hashed in segments; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from formline.llm import chunks as ch
from formline.llm.common import _mixed
from formline.llm.suffix_sort import by_bucket
from formline.operators.sequence import assign_sequence
from formline.session import store

LONGEST = 4
LEAST = 30
TOP = 2000
NESTED_PERCENT = 80
SCALE = 2_000_000
UNKNOWN = "und"
LANGUAGES = 10_000
SEGMENT = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = np.random.default_rng(13).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of every word, and the number of its piece."""
    inside = ~(_BLANK | _BREAK)[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins, ends = starts[:-1][starts[:-1] < starts[1:]], starts[1:][starts[:-1] < starts[1:]]
    first[begins], last[ends - 1] = inside[begins], inside[ends - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    breaks = np.flatnonzero(_BREAK[data])
    owner = np.searchsorted(starts, begin, "right") - 1
    cut = np.searchsorted(breaks, begin)
    new = (np.diff(owner) != 0) | (np.diff(cut) != 0)
    return begin, end, owner, np.concatenate(([0], np.cumsum(new))) if len(begin) else np.zeros(0, np.int64)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of each word, over segments of bounded size (or one word)."""
    out = np.empty(len(begin), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(begin):
            to = max(at + 1, int(np.searchsorted(end, begin[at] + SEGMENT, "right")))
            low = begin[at]
            prefix = ch.prefix_polynomial(_BYTES[data[low : end[to - 1]]])
            back = ch.powers(ch.UNBASE, int(begin[to - 1] - low) + 1)
            out[at:to] = (prefix[end[at:to] - low] - prefix[begin[at:to] - low]) * back[begin[at:to] - low]
            at = to
    return _mixed(out)


@dataclass
class Grams:
    """Every n-gram of a chunk: its fingerprint, first word and number of words; and the words."""

    prints: np.ndarray
    first: np.ndarray
    size: np.ndarray
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    owner: np.ndarray
    keys: np.ndarray


def grams_of(chunk: ch.Chunk, longest: int) -> Grams:
    data = _LOWER[chunk.data]
    begin, end, owner, piece = words_of(data, chunk.starts)
    keys = word_hashes(data, begin, end)
    salts = {lang: zlib.crc32(lang.encode()) for lang in set(chunk.carried[0])}
    salt = _mixed(np.array([salts[lang] for lang in chunk.carried[0]], np.uint64) + np.uint64(1))[owner]
    prefix = ch.prefix_polynomial(keys)
    whole = [np.flatnonzero(piece[n - 1 :] == piece[: max(len(piece) - n + 1, 0)]).astype(np.int32) for n in range(1, longest + 1)]
    total = sum(map(len, whole))
    # Filled in place: these arrays are the largest of a task.
    prints, first, size = np.empty(total, np.uint64), np.empty(total, np.int32), np.empty(total, np.int8)
    at = 0
    for n, rows in enumerate(whole, 1):
        own = slice(at, at := at + len(rows))
        if len(rows):
            prints[own] = _mixed(_mixed(ch.window_hashes(prefix, n)[rows] + np.uint64(n)) ^ salt[rows])
        first[own], size[own] = rows, n
    return Grams(prints, first, size, data, begin, end, owner, keys)


def ask_counts(chunk: ch.Chunk, bits: int, longest: int) -> Iterator[tuple[int, bytes]]:
    prints = grams_of(chunk, longest).prints
    prints.sort()
    first = np.flatnonzero(np.concatenate(([True], prints[1:] != prints[:-1]))) if len(prints) else np.zeros(0, np.int64)
    distinct, counts = prints[first], np.diff(first, append=len(prints))
    del prints
    rest = ((distinct << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
    counts = counts.astype(np.uint32)
    for bucket, at in by_bucket(distinct, bits):
        planes = counts[at].view(np.uint8).reshape(-1, 4).T.tobytes()
        keys = ch.squeezed(rest[at])
        yield bucket, len(keys).to_bytes(8, "little") + keys + ch.compressed(planes)


def answer_counts(blobs: list[bytes], least: int) -> list[bytes]:
    """For every entry 1 if its fingerprint, in all chunks, counts ``least`` or more."""
    keys, counts = [], []
    for blob in blobs:
        cut = 8 + int.from_bytes(blob[:8], "little")
        keys.append(ch.unsqueezed(blob[8:cut]))
        planes = np.frombuffer(ch.plain(blob[cut:]), np.uint8).reshape(4, -1)
        counts.append(np.ascontiguousarray(planes.T).view(np.uint32).ravel())
    _, own = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(own, np.concatenate(counts))
    often = (total >= least)[own].astype(np.uint8)
    return [ch.compressed(part.tobytes()) for part in np.split(often, np.cumsum([len(k) for k in keys])[:-1])]


def word_numbers(grams: Grams) -> np.ndarray:
    """A number per different word, by hash and then compared with the text."""
    _, first, own = np.unique(grams.keys, return_index=True, return_inverse=True)
    length = grams.end - grams.begin
    model = first[own]
    same = bool((length == length[model]).all())
    at = 0
    while same and at < len(own):
        to = max(at + 1, int(np.searchsorted(grams.end, grams.begin[at] + SEGMENT, "right")))
        n = length[at:to]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ours, theirs = np.repeat(grams.begin[at:to], n) + place, np.repeat(grams.begin[model[at:to]], n) + place
        same = bool((grams.data[ours] == grams.data[theirs]).all())
        at = to
    if same:
        return own
    body, number = grams.data.tobytes(), {}
    spans = zip(grams.begin.tolist(), grams.end.tolist())
    return np.array([number.setdefault(body[a:b], len(number)) for a, b in spans], np.int64)


def ask_phrases(chunk: ch.Chunk, bits: int, longest: int) -> Iterator[tuple[int, bytes]]:
    """Per bucket the phrases that may reach the limit and their counts here; an empty phrase counts a language's words."""
    grams = grams_of(chunk, longest)
    langs = chunk.carried[0]
    words: dict[str, int] = {}
    for lang, n in zip(langs, np.bincount(grams.owner, minlength=len(langs)).tolist()):
        words[lang] = words.get(lang, 0) + n
    for lang, n in words.items():
        yield zlib.crc32(lang.encode()) % (1 << bits), _listed([b"\n" + lang.encode()], [n])
    if not chunk.replies[0]:
        return
    keys, rows, model, counts = often_rows(chunk, grams)
    grams.prints = keys[:0]  # no longer needed
    numbers = np.append(word_numbers(grams), np.zeros(longest, np.int64))
    langs_of = {lang: i for i, lang in enumerate(words)}
    spoken = np.array([langs_of[lang] for lang in langs], np.int64)[grams.owner]
    like = np.repeat(model, counts)
    same = (grams.size[rows] == grams.size[like]) & (spoken[grams.first[rows]] == spoken[grams.first[like]])
    for k in range(longest):
        same &= (grams.size[rows] <= k) | (numbers[grams.first[rows] + k] == numbers[grams.first[like] + k])
    own = np.repeat(np.arange(len(model)), counts)
    counts = counts - np.bincount(own[~same], minlength=len(counts))
    apart: dict[int, list[int]] = {}
    for i, row in zip(own[~same].tolist(), rows[~same].tolist()):  # equal fingerprints of different phrases
        apart.setdefault(i, []).append(row)
    body = grams.data.tobytes()

    def phrase(row: int) -> bytes:
        low = int(grams.first[row])
        high = low + int(grams.size[row])
        spans = zip(grams.begin[low:high].tolist(), grams.end[low:high].tolist())
        return b" ".join([body[a:b] for a, b in spans]) + b"\n" + langs[grams.owner[low]].encode()

    for bucket, at in by_bucket(keys, bits):
        phrases, times = [phrase(row) for row in model[at].tolist()], counts[at].tolist()
        for i in apart.keys() & range(at.start, at.stop):
            phrases += [phrase(row) for row in apart[i]]
            times += [1] * len(apart[i])
        yield bucket, _listed(phrases, times)


def _listed(phrases: list[bytes], times: list[int]) -> bytes:
    sizes = np.array([len(phrases), *map(len, phrases)], np.int64)
    return ch.compressed(b"".join([sizes.tobytes(), np.array(times, np.int64).tobytes(), *phrases]))


def often_rows(chunk: ch.Chunk, grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The fingerprints that may reach the limit, sorted; their n-grams, one of each, and how many there are."""
    order = np.argsort(grams.prints).astype(np.int32)
    ranked = grams.prints[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    size = np.diff(first, append=len(order))
    often = np.concatenate([np.frombuffer(ch.plain(blob), np.uint8) for _, blob in sorted(chunk.replies[0].items())]) == 1
    keys, model = ranked[first[often]], order[first[often]]
    del ranked
    return keys, order[np.repeat(often, size)], model, size[often]


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST
) -> DataFrame:
    """``lang, phrase, words, f`` of every phrase with f >= least, stored; the empty phrase has a language's words."""
    named = docs.select(F.col(text).alias("_body"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("_tongue"))
    chunks = ch.packed(named, "_body", ["_tongue"], "phrase-chunks")
    bits = ch.bucket_bits(chunks, 0.5)
    often = ch.answered(
        ch.dealt(chunks, lambda c: ask_counts(c, bits, longest)), lambda _, blobs: answer_counts(blobs, least), "phrase-often"
    )

    def total(table: pa.Table) -> pa.Table:
        sums: dict[bytes, int] = {}
        for blob in table.column("_blob").to_pylist():
            raw = ch.plain(blob)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            ends = 8 + 16 * n + np.cumsum(np.frombuffer(raw, np.int64, n, 8))
            times = np.frombuffer(raw, np.int64, n, 8 + 8 * n).tolist()
            for a, b, t in zip([8 + 16 * n, *ends[:-1].tolist()], ends.tolist(), times):
                sums[raw[a:b]] = sums.get(raw[a:b], 0) + t
        rows = [(*p.split(b"\n", 1), f) for p, f in sums.items() if f >= least or p.startswith(b"\n")]
        phrases = [p.decode() for p, _, _ in rows]
        return pa.table(
            {
                "lang": pa.array([spoken.decode() for _, spoken, _ in rows], pa.string()),
                "phrase": pa.array(phrases, pa.string()),
                "words": pa.array([p.count(" ") + 1 if p else 0 for p in phrases], pa.int32()),
                "f": pa.array([f for *_, f in rows], pa.int64()),
            }
        )

    asked = ch.dealt(ch.with_replies(chunks, often), lambda c: ask_phrases(c, bits, longest))
    counted = asked.groupBy("_bucket").applyInArrow(total, "lang string, phrase string, words int, f bigint")
    return store(counted, "phrases")


def scored_candidates(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of every phrase of two words or more, by its lowest-scoring cut."""
    cuts = (
        phrases.where("words >= 2")
        .select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
        .withColumn("_first", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("_rest", F.expr("substring(phrase, length(_first) + 2)"))
    )
    part = lambda key, name: phrases.where("words >= 1").select(
        "lang", F.col("phrase").alias(key), F.col("f").alias(name)
    )
    both = cuts.join(part("_first", "l"), ["lang", "_first"]).join(part("_rest", "r"), ["lang", "_rest"])
    exact = F.expr(f"(cast(a as decimal(28, 0)) * {SCALE}) div (cast(l as decimal(28, 0)) + cast(r as decimal(28, 0)))")
    lowest = both.withColumn("score", exact).groupBy("lang", "phrase", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("_cut")
    )
    return lowest.select("lang", "phrase", "words", "a", "_cut.l", "_cut.r", "_cut.score")


def without_nested(candidates: DataFrame, percent: int = NESTED_PERCENT) -> DataFrame:
    """Drops a phrase whose words lie inside a longer one that has at least ``percent`` of its count."""
    words = F.split("phrase", " ")
    inner = F.transform(
        F.sequence(F.lit(2), F.col("words") - 1),
        lambda n: F.transform(
            F.sequence(F.lit(1), F.col("words") - n + 1), lambda at: F.array_join(F.slice(words, at, n), " ")
        ),
    )
    largest = (
        candidates.where("words >= 3")
        .select("lang", F.explode(F.array_distinct(F.flatten(inner))).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("_longer"))
    )
    wide = lambda c, by: F.coalesce(F.col(c), F.lit(0)).cast("decimal(28,0)") * F.lit(by)
    return candidates.join(largest, ["lang", "phrase"], "left").where(wide("_longer", 100) < wide("a", percent)).drop("_longer")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, top: int = TOP
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    phrases = phrase_counts(docs, text, lang, longest, least)
    left = without_nested(store(scored_candidates(phrases), "phrase-scores"))
    order = F.struct((-F.col("score")).alias("s"), (-F.col("a")).alias("a"), "phrase").alias("_key")
    numbered = assign_sequence(store(left.select("lang", order, "l", "r"), "phrase-order"), ["lang", "_key"], "_place")
    first = numbered.groupBy("lang").agg(F.min("_place").alias("_zero"))
    totals = phrases.where("words = 0").select("lang", F.col("f").alias("n"))
    # One row per language; only a checked number of rows is broadcast.
    heads = store(first.join(totals, "lang"), "phrase-languages")
    heads = F.broadcast(heads) if heads.count() <= LANGUAGES else heads
    return (
        numbered.join(heads, "lang")
        .withColumn("rank", F.col("_place") - F.col("_zero") + 1)
        .where(F.col("rank") <= top)
        .select(
            "lang",
            F.col("rank").cast("long").alias("rank"),
            F.col("_key.phrase").alias("phrase"),
            (-F.col("_key.a")).alias("a"),
            "l",
            "r",
            "n",
            (-F.col("_key.s")).alias("score"),
        )
    )
