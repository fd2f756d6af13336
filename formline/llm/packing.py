"""Best-fit packing of token sequences by the sum of squares rule.

A document's ids are its text's ids followed by the end id. Longer ones are cut into pieces of the full
length, the first piece being the shorter rest. A piece goes where the sum over all gaps of (number of open
bins with that gap) squared becomes smallest, which keeps the gaps of the open bins varied and so leaves
few bins unfilled. Only ids and lengths are shuffled: pieces are dealt by hash into groups of about
``group`` pieces and every group is packed by one task, longest piece first, which leaves about one unfilled
sequence per group. Full pieces are sequences as they are.

Ids come from tiktoken where the text lies in the range in which its ids were tested equal to those of the
tokenizers file (up to U+027F, no special token), else from tokenizers; the first is six times as fast here.

Defined results: null and empty texts are one end id; repeated rows are packed each; ties between gaps go to
the fuller bin; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from formline.llm.common import slices
from formline.session import store

LENGTH = 2048
GROUP = 10_000
END_ID = 0
_TESTED = bytes([*range(0x80), *range(0x80, 0xC0), *range(0xC2, 0xCA)])


def _vocabulary() -> tuple[str, str, str]:
    import public_tokenizers

    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return *paths, public_tokenizers.PATTERN


class Encoder:
    """Ids of texts, as the tokenizers file gives them without added special tokens."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        plain = not text.encode().translate(None, _TESTED) and not any(s in text for s in self.special)
        if plain:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


def token_pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    vocabulary: tuple[str, str, str] | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """``_id, piece, start, length, ids_crc32`` of every piece, and ``ids`` if asked for."""
    files = vocabulary or _vocabulary()

    def cut(ids: np.ndarray) -> list[tuple[int, int]]:
        first = len(ids) % length or length
        return [(0, first), *((s, length) for s in range(first, len(ids), length))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(*files)
        for batch in slices(batches, "_text"):
            at, rows = [], []
            for i, body in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode(body or ""), END_ID).astype("<u4")
                for k, (start, n) in enumerate(cut(ids)):
                    piece = ids[start : start + n]
                    at.append(i)
                    rows.append((k, start, n, zlib.crc32(piece.tobytes()), *([piece.astype(np.int32)] if with_ids else [])))
            columns = list(zip(*rows))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64()))] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).mapInArrow(run, schema)


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size; sizes are taken longest first, a new bin is opened only where none fits.

    A piece of size s turns one bin of gap g into one of gap g - s, so the sum of squared counts N changes by
    2 (N[g - s] - N[g] + 1); a bin that becomes full is no longer open and changes it by 1 - 2 N[g].
    """
    counts = np.zeros(capacity + 1, np.int64)  # open bins per gap
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    never, used = np.iinfo(np.int64).max, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = counts[size:]
        change = 2 * (counts[: capacity + 1 - size] - fitting + 1)
        change[0] = 1 - 2 * fitting[0]
        change[fitting == 0] = never
        best = int(change.argmin())
        if change[best] < never:
            gap = best + size
            target = stacks[gap].pop()
            counts[gap] -= 1
        else:
            gap, target, used = capacity, used, used + 1
        bins[i], offsets[i] = target, capacity - gap
        if gap > size:
            stacks[gap - size].append(target)
            counts[gap - size] += 1
    return bins, offsets


def pack(pieces: DataFrame, size: str = "length", capacity: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``pieces`` (sizes from 1 to ``capacity``) with ``sequence_id`` and ``offset``."""
    rows = store(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = -(-rows.where(F.col(size) < capacity).count() // group)

    def place(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = sum_of_squares(part["_size"].to_numpy(), capacity)
        return pd.DataFrame({"_packed": part["_row"], "sequence_id": key[0] * 2**32 + bins, "offset": offsets})

    placed = (
        rows.where(F.col(size) < capacity)
        .select("_row", F.col(size).alias("_size"), F.pmod(F.xxhash64("_row"), F.lit(max(groups, 1))).alias("_group"))
        .groupBy("_group")
        .applyInPandas(place, "_packed bigint, sequence_id bigint, offset bigint")
    )
    small = rows.where(F.col(size) < capacity).join(placed, F.col("_row") == F.col("_packed"))
    full = rows.where(F.col(size) >= capacity).select(
        "*", (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    kept = [*pieces.columns, "sequence_id", "offset"]
    return small.select(*kept).unionByName(full.select(*kept))


def packed_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Every piece of every document with its place; ``packed_ids`` makes the sequences themselves."""
    pieces = token_pieces(docs, doc_id, text, length)
    return pack(pieces, "length", length).withColumnRenamed("_id", doc_id)


def packed_ids(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``sequence_id, ids``: the packed sequences, at most ``length`` ids each."""
    placed = pack(token_pieces(docs, doc_id, text, length, with_ids=True), "length", length)
    joined = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(joined, lambda x: x["ids"])).alias("ids"))
