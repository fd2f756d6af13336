"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLICE_BYTES = 2_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that columns of any name pass a step untouched; ``_row.*`` unpacks it."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column (null: empty) and where each row starts, with the end as last entry."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, cut so that a slice has at most ``size`` bytes of text or one row."""
    for batch in batches:
        _, starts = text_bytes(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def word_bounds(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word ``[^\\x20\\x09-\\x0D]+``, and the first word of each row (one more than rows)."""
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = starts[:-1][starts[:-1] < starts[1:]]
    ends = starts[1:][starts[:-1] < starts[1:]]
    first[begins] = inside[begins]
    last[ends - 1] = inside[ends - 1]
    word_start, word_end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return word_start, word_end, np.searchsorted(word_start, starts)


_generator = np.random.default_rng(7)
_BYTE = _generator.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[[0x20, *range(0x09, 0x0E)]] = 0
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        keys = keys ^ (keys >> np.uint64(32))
        keys = keys * np.uint64(0xD6E8FEB86659FD93)
        keys = keys ^ (keys >> np.uint64(32))
        keys = keys * np.uint64(0xD6E8FEB86659FD93)
        return keys ^ (keys >> np.uint64(32))


def word_keys(data: np.ndarray, word_start: np.ndarray, word_end: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word; ``lower`` maps A-Z to a-z first. The bytes are taken in runs of bounded size."""
    if not len(word_start):
        return np.zeros(0, np.uint64)
    table = _BYTE_LOWER if lower else _BYTE
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int((word_end - word_start).max()), _BASE, np.uint64))
        out = np.empty(len(word_start), np.uint64)
        at = 0
        while at < len(word_start):
            to = max(at + 1, int(np.searchsorted(word_end, word_start[at] + SLICE_BYTES, "right")))
            low = word_start[at]
            begin = word_start[at:to] - low
            values = table[data[low : word_end[to - 1]]]
            place = np.arange(len(values)) - np.repeat(begin, np.diff(begin, append=len(values)))
            # White space between words is worth nothing, wherever its place would be.
            values *= powers[np.minimum(place, len(powers) - 1)]
            out[at:to] = np.add.reduceat(values, begin)
            at = to
    return _mixed(out)
