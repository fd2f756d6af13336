"""Documents in stored chunks, and questions that the chunks put to each other through buckets.

``packed`` writes the texts once, several megabytes to a row, compressed. A chunk can then ask about the keys
of its texts: it sorts and reduces them to one entry per key, cuts the sorted entries into buckets by their
leading bits and sends one compressed blob per bucket. All blobs of a bucket meet in one task; the answers go
back to the chunk as one blob per bucket and are joined to it by its number. A key that every document holds
is thus one entry per chunk, whatever it is worth in rows, and no text travels with the keys.

Chunks grow with the square root of the input (within bounds), so that blobs per chunk stay few; buckets have
about a million entries each, at least ``LEAST_BUCKETS`` of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from formline.llm.common import slices, text_bytes
from formline.session import store

SMALLEST, LARGEST = 1 << 21, 1 << 24
BUCKET = 1 << 20
LEAST_BUCKETS = 64
DEALT = "_bucket bigint, _chunk bigint, _blob binary"


def compressed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def plain(blob) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def squeezed(values: np.ndarray) -> bytes:
    """Sorted unsigned integers as differences, byte plane by byte plane."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return compressed(steps.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def unsqueezed(blob, kind: type = np.uint32) -> np.ndarray:
    planes = np.frombuffer(plain(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)


def packed(docs: DataFrame, text: str, carry: list[str], label: str) -> DataFrame:
    """``_chunk``, a list of every column of ``carry``, ``_lengths`` in bytes, ``_data`` (null texts: empty), ``_bytes``."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    size = int(min(max(math.sqrt(total * 65536.0), SMALLEST), LARGEST))
    kinds = {f"_c{i}": docs.schema[c].dataType.simpleString() for i, c in enumerate(carry)}

    def row(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = [pa.concat_arrays([b.column(i) for b in held]) for i in range(held[0].num_columns)]
        data, starts = text_bytes(columns[0])
        ends = pa.array([0, len(columns[0])], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, c) for c in [*columns[1:], pa.array(np.diff(starts))]]
        blob = pa.array([compressed(data.tobytes())], pa.binary())
        return pa.RecordBatch.from_arrays([*lists, blob, pa.array([len(data)])], [*kinds, "_lengths", "_data", "_bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, taken = [], 0
        for batch in slices(batches, "_text"):
            held.append(batch)
            taken += batch.column(0).nbytes
            if taken >= size:
                yield row(held)
                held, taken = [], 0
        if held:
            yield row(held)

    schema = ", ".join(f"{name} array<{kind}>" for name, kind in kinds.items())
    rows = docs.select(F.col(text).alias("_text"), *[F.col(c).alias(n) for n, c in zip(kinds, carry)]).mapInArrow(
        run, f"{schema}, _lengths array<bigint>, _data binary, _bytes bigint"
    )
    return store(rows.withColumn("_chunk", F.monotonically_increasing_id()), label)


def bucket_bits(chunks: DataFrame, entries_per_byte: float) -> int:
    """Leading bits that name a bucket, for about ``BUCKET`` entries in each."""
    total = chunks.agg(F.sum("_bytes")).first()[0] or 0
    return max(math.ceil(math.log2(max(total * entries_per_byte / BUCKET, 1))), int(math.log2(LEAST_BUCKETS)))


@dataclass
class Chunk:
    """``carried`` has the lists of the carried columns, ``replies`` the answers of each round by bucket."""

    number: int
    carried: list[list]
    data: np.ndarray
    starts: np.ndarray
    replies: list[dict[int, bytes]] = field(default_factory=list)


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        carried = [c for n, c in at.items() if n.startswith("_c") and n != "_chunk"]
        rounds = [c for n, c in sorted(at.items()) if n.startswith("_reply")]
        for i in range(batch.num_rows):
            lengths = at["_lengths"][i].values.to_numpy(zero_copy_only=False)
            yield Chunk(
                at["_chunk"][i].as_py(),
                [c[i].as_py() for c in carried],
                np.frombuffer(plain(at["_data"][i].as_buffer()), np.uint8),
                np.concatenate(([0], np.cumsum(lengths))).astype(np.int64),
                [{r["_bucket"]: r["_blob"] for r in c[i].as_py() or []} for c in rounds],
            )


def dealt(chunks: DataFrame, ask: Callable[[Chunk], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """``_bucket, _chunk, _blob`` of everything that the chunks ask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in each(batches):
            asked = list(ask(chunk))
            numbers = pa.array([b for b, _ in asked], pa.int64()), pa.array([chunk.number] * len(asked), pa.int64())
            blobs = pa.array([blob for _, blob in asked], pa.binary())
            yield pa.RecordBatch.from_arrays([*numbers, blobs], ["_bucket", "_chunk", "_blob"])

    return chunks.mapInArrow(run, DEALT)


def answered(questions: DataFrame, answer: Callable[[int, list[bytes]], list[bytes]], label: str) -> DataFrame:
    """The stored answers: ``answer`` gets a bucket with all its blobs and returns one blob for each."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        blobs = answer(key[0].as_py(), table.column("_blob").to_pylist())
        return table.set_column(table.schema.get_field_index("_blob"), "_blob", pa.array(blobs, pa.binary()))

    return store(questions.groupBy("_bucket").applyInArrow(run, DEALT), label)


def with_replies(chunks: DataFrame, *rounds: DataFrame) -> DataFrame:
    """The chunks with the answers of each round; a chunk has at most one blob per bucket, each smaller than its question."""
    for i, replies in enumerate(rounds):
        own = replies.groupBy("_chunk").agg(F.collect_list(F.struct("_bucket", "_blob")).alias(f"_reply{i}"))
        chunks = chunks.join(own, "_chunk", "left")
    return chunks


# Prefix polynomials


def powers(base: int, count: int) -> np.ndarray:
    """base^0, base^1, ... modulo 2^64."""
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 2**64)


def prefix_polynomial(values: np.ndarray) -> np.ndarray:
    """P[i] = sum of values[j] * BASE^j over j < i; one entry more than values."""
    with np.errstate(over="ignore"):
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * powers(BASE, len(values)), dtype=np.uint64)))


def window_hashes(prefix: np.ndarray, size: int) -> np.ndarray:
    """The polynomial of every window of ``size`` values, moved to the origin; equal windows are equal wherever they stand."""
    with np.errstate(over="ignore"):
        return (prefix[size:] - prefix[: len(prefix) - size]) * powers(UNBASE, max(len(prefix) - size, 0))
