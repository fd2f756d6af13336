"""Dense row numbers over a whole table without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from formline.session import store

_ROW_BITS = 33  # fixed value: monotonically_increasing_id keeps the row in the low 33 bits


def assign_sequence(
    df: DataFrame, order_by: Sequence[str], name: str = "seq", start: int = 1, partitions: int | None = None
) -> DataFrame:
    """Number the rows ``start, start+1, ...`` in the order of ``order_by``.

    The rows are range-partitioned and sorted, stored once, and then only the
    row count of each partition (one small row per partition) is summed up to
    find where each partition starts. ``order_by`` must identify a row,
    otherwise the order among equal rows is free.
    """
    stored = _sorted_rows(df, order_by, partitions)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort, so the broadcast is bounded by the partition count.
    offsets = (
        stored.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return stored.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_row") + F.lit(start)).cast("long").alias(name)
    )


def _sorted_rows(df: DataFrame, order_by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """The rows range-partitioned, sorted and stored, with their partition ``_part`` and their place in it, ``_row``."""
    ranged = (
        df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
    ).sortWithinPartitions(*order_by)
    placed = ranged.withColumn("_at", F.monotonically_increasing_id())
    return store(
        placed.select(
            *df.columns,
            F.shiftright("_at", _ROW_BITS).cast("int").alias("_part"),
            F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
        ),
        "sequence",
    )


def sequence_within(df: DataFrame, key: str, order_by: Sequence[str], name: str = "seq") -> DataFrame:
    """Number the rows of each ``key`` from 1, however many rows one key holds.

    The rows of a key in one partition of the sort are a piece. Rows meet the few numbers of their piece, not of
    their key, so a key with very many rows is as many groups as it has partitions. The pieces are stored: Spark
    then knows their size, and broadcasts them if there are few.
    """
    stored = _sorted_rows(df, [key, *order_by])
    before = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    pieces = (
        stored.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_of"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_low"))
        .select("_key", "_of", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_shift"))
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_of"))
    return (
        stored.join(store(pieces, "sequence-pieces"), same)
        .withColumn(name, (F.col("_row") + F.col("_shift") + F.lit(1)).cast("long"))
        .select(*df.columns, name)
    )
