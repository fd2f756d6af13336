"""SimHash near-duplicates by multi-index hashing.

Fingerprints are 64-bit. Two that differ in at most three bits differ in at most one bit in one of the two
32-bit segments. Each fingerprint is stored in one table per segment, and a query looks up the small ball
around its segment: the value itself and, for every set bit, the value with that bit cleared (of two
segments that differ in one bit, exactly one has it set, so one of the two finds the other). Matches are
verified on the whole fingerprint. Documents with equal fingerprints are one entry, so copies are never
paired with each other.

Defined results: a null, empty or blank text has fingerprint zero and is linked like any other; repeated ids
are one document per row with the same component; an empty table gives an empty result; texts of any length
are hashed whole; columns other than id and text are ignored, and kept under any name by ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from formline.llm.common import slices, whole_row
from formline.llm.components import connected
from formline.session import store

SHINGLE = 3
RADIUS = 3
SEGMENT = 32
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The bits set in more than half of the hashes of the text's word shingles."""
    words = (text or "").encode().lower().split()  # bytes: lower and split touch ASCII only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    parts = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, parts, repeat(SEED))), np.uint8).reshape(-1, 8)
    ones = np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``_id`` and ``_print`` (the fingerprint as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            prints = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            values = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["_id", "_print"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).mapInArrow(
        run, f"_id {kind}, _print bigint"
    )


def _segment(value: Column, k: int) -> Column:
    return F.shiftrightunsigned(value, SEGMENT * k).bitwiseAND(F.lit((1 << SEGMENT) - 1))


def near_pairs(prints: DataFrame, column: str = "_print") -> DataFrame:
    """Pairs ``a < b`` of different fingerprints at most three bits apart. ``prints`` has each value once."""
    value = F.col(column)
    table = prints.select(
        value.alias("b"), F.posexplode(F.array(*[_segment(value, k) for k in range(2)])).alias("seg", "key")
    )
    flipped = lambda s, i: s.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))
    set_bits = lambda s: F.filter(F.sequence(F.lit(0), F.lit(SEGMENT - 1)), lambda i: F.getbit(s, i) == 1)
    ball = lambda s: F.concat(F.array(s), F.transform(set_bits(s), lambda i: flipped(s, i)))
    probes = prints.select(
        value.alias("a"), F.posexplode(F.array(*[ball(_segment(value, k)) for k in range(2)])).alias("seg", "_keys")
    ).select("a", "seg", F.explode("_keys").alias("key"))
    return (
        probes.join(table, ["seg", "key"])
        .where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row; the component is named by its smallest id."""
    rows = store(fingerprints(docs, doc_id, text, shingle), "simhash")
    classes = store(rows.groupBy("_print").agg(F.min("_id").alias("_first")), "simhash-classes")
    parts = connected(near_pairs(classes)).withColumnsRenamed({"node": "_print", "component": "_part"})
    placed = classes.join(parts, "_print", "left").withColumn("_part", F.coalesce("_part", "_print"))
    named = placed.groupBy("_part").agg(F.min("_first").alias("component_id"))
    of_print = placed.join(named, "_part").select("_print", "component_id")
    return rows.join(of_print, "_print").select(
        F.col("_id").alias(doc_id),
        F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every group of near copies: that with the smallest id (of equal ids, one).

    The row is picked by a combined minimum over small keys; texts are joined back once.
    """
    numbered = store(docs.select(whole_row(docs).alias("_row"), F.monotonically_increasing_id().alias("_at")), "simhash-docs")
    own = F.col("_row")
    key = F.struct(own[doc_id].isNull().alias("none"), own[doc_id].alias("id"), F.col("_at").alias("at"))
    groups = simhash_groups(numbered.select(key.alias("_key"), own[text].alias("_body")), "_key", "_body")
    kept = groups.where(F.col("_key") == F.col("component_id")).select(F.col("_key.at").alias("_at"))
    return numbered.join(kept, "_at", "left_semi").select(*[own[c].alias(c) for c in docs.columns])
