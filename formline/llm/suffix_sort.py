"""Repeated byte strings across documents by a depth-limited most-significant-digit radix sort of suffixes.

A suffix is ordered only through its first ``LENGTH`` bytes, its window; windows that are equal after the
last digit are one group, and a window is repeated for a document if its group holds a document with a
smaller id. Every byte under a repeated window is removed.

The leading digit is chosen so that neighbouring suffixes share it: the hash of the smallest (by hash) of the
``PIECE``-byte strings inside the window. It is a function of the window alone, so equal windows have equal
digits, and a run of neighbouring windows with one digit moves as one string. Passes:

1. Each chunk of documents reduces its runs to one entry per digit and asks which digits occur in more than
   one document. Most do not; their suffixes are alone in their group and are finished.
2. The remaining runs are sent as strings, one entry per different string and chunk with the smallest id that
   holds it. In a bucket the digit groups with more than one string are sorted on, eight bytes a pass, a group
   of one suffix being dropped, until all 50 bytes are ordered.

A digit found in more than ``HOT`` chunks (a line that very many documents hold, in different surroundings)
is not gathered: its windows are dealt one by one by a hash of all their bytes.

Defined results: ``doc_id`` is an integral column; a null id counts as larger than all others, rows with equal
ids never repeat each other; a null text is empty; texts under 50 bytes lose nothing; of equal texts the one
with the smallest id stays; texts of any length are read in segments; an empty table gives an empty result;
other columns are ignored. What is kept is bytes, as a window may begin inside a character.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType

from formline.llm import chunks as ch
from formline.llm.common import _mixed

LENGTH = 50
PIECE = 16
DIGIT = 8
RUN = 64
HOT = 256
SEGMENT = 1 << 16  # its words stay in a core's cache
REST = 31
LAST = 2**63 - 1
_LOW, _HIGH = np.random.default_rng(9).integers(1, 2**63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if span < width else values


def piece_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of every ``PIECE``-byte string, from its halves read as two words."""
    words = np.ndarray(max(len(data) - 7, 0), "<u8", data, strides=(1,)).astype(np.uint64)
    hashes = words[: max(len(words) - 8, 0)] * _LOW
    hashes ^= hashes >> np.uint64(32)
    hashes += words[8:]
    hashes *= _HIGH
    hashes ^= hashes >> np.uint64(32)
    return hashes


def digit_runs(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digit, first position, number of windows (at most ``RUN``) and document of every run of equal leading digits."""
    data = np.ascontiguousarray(data)
    fits = np.ones(len(data), bool)
    for low, high in zip(starts[:-1].tolist(), starts[1:].tolist()):
        fits[max(low, high - LENGTH + 1) : high] = False
    found = []
    for low in range(0, max(len(data) - LENGTH + 1, 0), SEGMENT):
        piece = data[low : low + SEGMENT + LENGTH - 1]
        fit = fits[low : low + len(piece) - LENGTH + 1]
        if not fit.any():
            continue
        digits = sliding_minimum(piece_hashes(piece), LENGTH - PIECE + 1)
        # Windows of two documents are never neighbours: the last ones of a document do not fit.
        new = np.ones(len(digits), bool)
        np.logical_or(digits[1:] != digits[:-1], fit[1:] != fit[:-1], out=new[1:])
        begin = np.flatnonzero(new)
        count, own = np.diff(begin, append=len(digits)), fit[begin]
        begin = begin[own]
        found.append((digits[begin], begin + low, count[own]))
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    digits, begin, count = map(np.concatenate, zip(*found))
    # Minima crowd at small values; mixing spreads them over the buckets. Long runs (of periodic text) are cut.
    digits = _mixed(digits + np.uint64(1))
    if count.max() > RUN:
        parts = -(-count // RUN)
        place = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.repeat(begin, parts) + place * RUN
        count = np.minimum(np.repeat(count, parts) - place * RUN, RUN)
        digits = np.repeat(digits, parts)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(np.searchsorted(begin, starts)))
    return digits, begin, count, owner


def by_bucket(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Buckets of sorted 64-bit keys and where their entries are."""
    numbers = keys >> np.uint64(64 - bits)
    cuts = np.flatnonzero(np.concatenate(([True], numbers[1:] != numbers[:-1]))) if len(keys) else []
    for low, high in zip(cuts, [*cuts[1:], len(keys)]):
        yield int(numbers[low]), slice(low, high)


def ask_digits(chunk: ch.Chunk, bits: int) -> Iterator[tuple[int, bytes]]:
    """Per bucket the rest of each digit, its lowest bit telling whether two documents of this chunk hold it."""
    digits, _, _, owner = digit_runs(chunk.data, chunk.starts)
    order = np.argsort(digits)
    digits, owner = digits[order], owner[order]
    new = np.ones(len(digits), bool)
    new[1:] = digits[1:] != digits[:-1]
    first = np.flatnonzero(new)
    # A document's runs may stand anywhere among those of its digit: if two documents hold it, two neighbours differ.
    apart = np.zeros(len(digits), bool)
    apart[1:] = ~new[1:] & (owner[1:] != owner[:-1])
    digits, many = digits[first], np.logical_or.reduceat(apart, first) if len(first) else apart
    rest = (digits << np.uint64(bits)) >> np.uint64(64 - REST)
    entries = ((rest << np.uint64(1)) | many.astype(np.uint64)).astype(np.uint32)
    for bucket, at in by_bucket(digits, bits):
        yield bucket, ch.squeezed(np.sort(entries[at]))


def answer_digits(blobs: list[bytes], hot: int) -> list[bytes]:
    """For every entry 1 if more than one document holds the digit, 2 if more than ``hot`` chunks do, else 0."""
    lists = [ch.unsqueezed(b) for b in blobs]
    entries = np.concatenate(lists)
    _, own, held = np.unique(entries >> np.uint32(1), return_inverse=True, return_counts=True)
    many = np.zeros(len(held), bool)
    many[own[(entries & np.uint32(1)) == 1]] = True
    code = (np.where(held > hot, 2, np.where((held > 1) | many, 1, 0)).astype(np.uint8))[own]
    return [ch.compressed(part.tobytes()) for part in np.split(code, np.cumsum([len(x) for x in lists])[:-1])]


def _codes(chunk: ch.Chunk, digits: np.ndarray) -> np.ndarray:
    """The answer of the first pass for every run."""
    distinct, own = np.unique(digits, return_inverse=True)
    parts = [np.frombuffer(ch.plain(blob), np.uint8) for _, blob in sorted(chunk.replies[0].items())]
    return np.concatenate(parts)[own] if len(distinct) else np.zeros(0, np.uint8)


@dataclass
class Entries:
    """The different strings of a chunk's open runs, sorted by digit, and the windows of its hot runs."""

    keys: np.ndarray  # digit of each string
    count: np.ndarray  # windows of each string
    least: np.ndarray  # smallest id that holds it
    strings: list[bytes]
    run_at: np.ndarray  # open runs, and the string of each
    run_entry: np.ndarray
    hot_windows: dict[bytes, list[int]]  # number and smallest id
    hot_at: np.ndarray


def entries_of(chunk: ch.Chunk, runs: tuple, ids: np.ndarray) -> Entries:
    digits, begin, count, owner = runs
    codes = _codes(chunk, digits)
    body = chunk.data.tobytes()
    open_at, hot_at = np.flatnonzero(codes == 1), np.flatnonzero(codes == 2)
    number: dict[bytes, int] = {}
    ends = begin + count + LENGTH - 1
    own = [number.setdefault(body[a:b], len(number)) for a, b in zip(begin[open_at].tolist(), ends[open_at].tolist())]
    entry = np.array(own, np.int64)
    least = np.full(len(number), LAST)
    np.minimum.at(least, entry, ids[owner[open_at]])
    keys, counts = np.zeros(len(number), np.uint64), np.zeros(len(number), np.int64)
    keys[entry], counts[entry] = digits[open_at], count[open_at]
    order = np.argsort(keys, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    strings = list(number)
    windows: dict[bytes, list[int]] = {}
    for a, n, i in zip(begin[hot_at].tolist(), count[hot_at].tolist(), ids[owner[hot_at]].tolist()):
        for at in range(a, a + n):
            held = windows.setdefault(body[at : at + LENGTH], [len(windows), i])
            held[1] = min(held[1], i)
    return Entries(
        keys[order], counts[order], least[order], [strings[i] for i in order], open_at, rank[entry], windows, hot_at
    )


def _ids(chunk: ch.Chunk) -> np.ndarray:
    return np.array([LAST if i is None else i for i in chunk.carried[0]], np.int64)


def hot_buckets(entries: Entries, bits: int) -> dict[int, list[bytes]]:
    """The hot windows by bucket, beyond the buckets of the strings."""
    out: dict[int, list[bytes]] = {}
    for window in entries.hot_windows:
        out.setdefault((1 << bits) + zlib.crc32(window) % (1 << bits), []).append(window)
    return out


def ask_strings(chunk: ch.Chunk, bits: int) -> Iterator[tuple[int, bytes]]:
    found = entries_of(chunk, digit_runs(chunk.data, chunk.starts), _ids(chunk))
    for bucket, at in by_bucket(found.keys, bits):
        head = np.array([at.stop - at.start], np.int64)
        parts = [head, found.keys[at], found.least[at], found.count[at].astype(np.uint8)]
        yield bucket, ch.compressed(b"".join([*(p.tobytes() for p in parts), *found.strings[at]]))
    for bucket, windows in hot_buckets(found, bits).items():
        least = np.array([found.hot_windows[w][1] for w in windows], np.int64)
        yield bucket, ch.compressed(b"".join([np.array([len(windows)], np.int64).tobytes(), least.tobytes(), *windows]))


def sorted_pairs(label: np.ndarray, digit: np.ndarray) -> np.ndarray:
    """The order by label (not negative) and, in it, by digit; labels are sorted in steps of two bytes."""
    order = np.argsort(digit)
    for shift in range(0, int(label.max()).bit_length() if len(label) else 0, 16):
        order = order[np.argsort((label[order] >> shift).astype(np.uint16), kind="stable")]
    return order


def first_holders(data: np.ndarray, at: np.ndarray, group: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id among the windows equal to each one, by radix passes inside the groups of the leading digit."""
    least = ids.copy()
    rows, label = np.arange(len(at)), group
    for offset in [*range(0, LENGTH - DIGIT, DIGIT), LENGTH - DIGIT]:
        digit = np.zeros(len(rows), np.uint64)
        for k in range(DIGIT):
            digit = (digit << np.uint64(8)) | data[at[rows] + offset + k].astype(np.uint64)
        order = sorted_pairs(label, digit)
        low, high = label[order], digit[order]
        first = np.flatnonzero(np.concatenate(([True], (low[1:] != low[:-1]) | (high[1:] != high[:-1]))))
        size = np.diff(first, append=len(order))
        more = np.repeat(size > 1, size)
        rows, label = rows[order][more], np.repeat(np.arange(len(size)), size)[more]
        if not len(rows):
            return least
    first = np.flatnonzero(np.concatenate(([True], label[1:] != label[:-1])))
    least[rows] = np.repeat(np.minimum.reduceat(ids[rows], first), np.diff(first, append=len(rows)))
    return least


def answer_strings(blobs: list[bytes]) -> list[bytes]:
    """For every string a 64-bit word: bit w is set if a smaller id than the asker's holds window w."""
    number: dict[bytes, int] = {}
    asked, keys, counts = [], [], []
    for blob in blobs:
        raw = ch.plain(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        key, least = np.frombuffer(raw, np.uint64, n, 8), np.frombuffer(raw, np.int64, n, 8 + 8 * n)
        count = np.frombuffer(raw, np.uint8, n, 8 + 16 * n).astype(np.int64)
        ends = 8 + 17 * n + np.cumsum(count + LENGTH - 1)
        known = len(number)
        own = np.array([number.setdefault(raw[a:b], len(number)) for a, b in zip((ends - count - LENGTH + 1).tolist(), ends.tolist())], np.int64)
        new = own >= known  # the strings of a blob differ
        keys.append(key[new])
        counts.append(count[new])
        asked.append((own, least))
    least = np.full(len(number), LAST)
    for own, ids in asked:
        least[own] = np.minimum(least[own], ids)
    key, count = np.concatenate(keys), np.concatenate(counts)
    data = np.frombuffer(b"".join(number), np.uint8)
    begin = np.cumsum(count + LENGTH - 1) - count - LENGTH + 1
    _, group, size = np.unique(key, return_inverse=True, return_counts=True)
    # A string alone in its digit's group needs no more passes.
    owner = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    holder = least[owner]
    shared = np.flatnonzero(size[group[owner]] > 1)
    if len(shared):
        holder[shared] = first_holders(data, (begin[owner] + place)[shared], group[owner][shared], holder[shared])
    words = np.full((len(count), RUN), LAST)
    words[owner, place] = holder
    out = []
    for own, ids in asked:
        masks = [np.packbits(words[own[a : a + 65536]] < ids[a : a + 65536, None], axis=1, bitorder="little") for a in range(0, len(own), 65536)]
        out.append(ch.compressed(b"".join(m.tobytes() for m in masks)))
    return out


def answer_windows(blobs: list[bytes]) -> list[bytes]:
    """For every hot window 1 if a smaller id than the asker's holds it."""
    least: dict[bytes, int] = {}
    asked = []
    for blob in blobs:
        raw = ch.plain(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        ids = np.frombuffer(raw, np.int64, n, 8).tolist()
        windows = [raw[a : a + LENGTH] for a in range(8 + 8 * n, len(raw), LENGTH)]
        for window, i in zip(windows, ids):
            least[window] = min(least.get(window, i), i)
        asked.append((windows, ids))
    return [ch.compressed(bytes(least[w] < i for w, i in zip(windows, ids))) for windows, ids in asked]


def repeated_windows(chunk: ch.Chunk, bits: int) -> np.ndarray:
    """Positions of the windows that start in a document with a smaller id, in order."""
    ids = _ids(chunk)
    runs = digits, begin, count, owner = digit_runs(chunk.data, chunk.starts)
    found = entries_of(chunk, runs, ids)
    answers = chunk.replies[1] if len(chunk.replies) > 1 else {}
    parts = [np.frombuffer(ch.plain(blob), np.uint64) for b, blob in sorted(answers.items()) if b < 1 << bits]
    masks = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    rows = found.run_at
    n = count[rows]
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    entry = np.repeat(found.run_entry, n)
    later = np.repeat(ids[owner[rows]], n) > found.least[entry]
    gone = later | ((masks[entry] >> place.astype(np.uint64)) & np.uint64(1)).astype(bool)
    positions = [(np.repeat(begin[rows], n) + place)[gone]]
    told: dict[bytes, bool] = {}
    for bucket, windows in hot_buckets(found, bits).items():
        told.update(zip(windows, map(bool, ch.plain(answers[bucket]))))
    body = chunk.data.tobytes() if told else b""
    for a, n, i in zip(begin[found.hot_at].tolist(), count[found.hot_at].tolist(), ids[owner[found.hot_at]].tolist()):
        for at in range(a, a + n):
            window = body[at : at + LENGTH]
            if told[window] or i > found.hot_windows[window][1]:
                positions.append(np.array([at]))
    return np.sort(np.concatenate(positions))


def removed_spans(positions: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and document of the maximal runs of bytes under the windows at ``positions``."""
    owner = np.searchsorted(starts, positions, "right") - 1
    apart = (np.diff(positions) > LENGTH) | (np.diff(owner) != 0)
    first = np.flatnonzero(np.concatenate(([True], apart))) if len(positions) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(positions))[: len(first)] - 1
    return positions[first], positions[last] + LENGTH, owner[first]


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, spans`` (begin and end of each maximal removed run) and ``kept`` (the other bytes) of every row."""
    kind = docs.schema[doc_id].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"{doc_id} must be an integral column")
    chunks = ch.packed(docs.select(F.col(doc_id).cast("long").alias(doc_id), text), text, [doc_id], "suffix-chunks")
    bits = ch.bucket_bits(chunks, 1 / 18)
    digits = ch.answered(
        ch.dealt(chunks, lambda c: ask_digits(c, bits)), lambda _, blobs: answer_digits(blobs, hot), "suffix-digits"
    )
    strings = ch.answered(
        ch.dealt(ch.with_replies(chunks, digits), lambda c: ask_strings(c, bits)),
        lambda bucket, blobs: answer_windows(blobs) if bucket >> bits else answer_strings(blobs),
        "suffix-strings",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in ch.each(batches):
            begin, end, owner = removed_spans(repeated_windows(chunk, bits), chunk.starts)
            cuts = np.searchsorted(owner, np.arange(len(chunk.starts)))
            low = chunk.starts[owner]
            spans = pa.StructArray.from_arrays([pa.array(begin - low), pa.array(end - low)], ["begin", "end"])
            body, kept = memoryview(chunk.data), []
            for d, (a, b) in enumerate(zip(chunk.starts[:-1].tolist(), chunk.starts[1:].tolist())):
                gone = slice(cuts[d], cuts[d + 1])
                edges = [a, *np.stack([begin[gone], end[gone]], 1).ravel().tolist(), b]
                kept.append(b"".join(body[x:y] for x, y in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(chunk.carried[0], pa.int64()),
                    pa.array(np.diff(chunk.starts)),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans),
                    pa.array(kept, pa.binary()),
                ],
                ["_id", "n_bytes", "spans", "kept"],
            )

    out = ch.with_replies(chunks, digits, strings).mapInArrow(
        run, "_id bigint, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary"
    )
    return out.select(F.col("_id").cast(kind).alias(doc_id), "n_bytes", "spans", "kept")
