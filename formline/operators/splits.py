"""Repeatable shuffles and exact train/test splits by hashed key.

A row's place is the rank of ``md5(key:seed)``. The digest is uniform, so its
first four hex digits give 65,536 even buckets; counting those is enough to
find where any rank lies. A split then needs no sort of the table at all: only
the bucket that a cut falls into is ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_BUCKET_DIGITS = 4


_NO_KEY = "g"  # behind every hexadecimal digest


def digest(key: str, seed: int = 42) -> Column:
    """The row's place in hashed order; rows without a key come last, so they do not move the others."""
    return F.coalesce(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), F.lit(_NO_KEY))


def _with_bucket(df: DataFrame, key: str, seed: int) -> DataFrame:
    hashed = df.withColumn("_digest", digest(key, seed))
    return hashed.withColumn("_bucket", F.substring("_digest", 1, _BUCKET_DIGITS))


def _bucket_counts(hashed: DataFrame) -> DataFrame:
    """Rows per bucket and before it: never more than 16^4 rows."""
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        hashed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(upto), F.lit(0)))
        .withColumn("_total", F.sum("_rows").over(everything))
    )


def seeded_shuffle(df: DataFrame, key: str, seed: int = 42, name: str = "position") -> DataFrame:
    """Add the row's position (from 1) in a repeatable random order of a unique ``key``."""
    hashed = _with_bucket(df, key, seed)
    before = _bucket_counts(hashed.select("_bucket")).select("_bucket", "_before")
    inside = Window.partitionBy("_bucket").orderBy("_digest", key)
    return (
        hashed.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(before), "_bucket")  # at most 16^4 rows
        .select(*df.columns, (F.col("_before") + F.col("_rank")).cast("long").alias(name))
    )


def hash_split(
    df: DataFrame,
    key: str,
    cuts: Sequence[tuple[str, Callable[[Column], Column]]],
    rest: str,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Label rows by rank: each cut gives its label up to a rank computed from the row count.

    Sizes are exact for a unique ``key``; rows that share a key share a label. Rows without a key count and rank
    last, so sizes are exact with them too unless a cut falls among them, where they all get its label.
    """
    keyed = _with_bucket(df.select(key), key, seed)
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("_cut"), upto(F.col("_total")).cast("long").alias("_rank"))
            for i, (_, upto) in enumerate(cuts)
        ]
    )
    hit = (
        _bucket_counts(keyed.select("_bucket"))
        .select("_bucket", "_before", "_rows", F.inline(wanted))
        .where((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_rows")))
        .select("_bucket", "_cut", (F.col("_rank") - F.col("_before")).alias("_rank"))
    )
    running = Window.partitionBy("_cut").orderBy("_digest", key).rowsBetween(Window.unboundedPreceding, 0)
    edges = (
        keyed.join(F.broadcast(hit), "_bucket")  # one row per cut
        .groupBy("_cut", "_rank", "_digest", key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_upto", F.sum("_rows").over(running))
        .where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_rows") < F.col("_rank")))
        .select("_cut", F.struct("_digest", F.col(key).alias("_key")).alias("_edge"))
    )
    last = edges.agg(F.map_from_entries(F.collect_list(F.struct("_cut", "_edge"))).alias("_edges")).scalar()
    place = F.struct(digest(key, seed).alias("_digest"), F.col(key).alias("_key"))
    label = F.lit(rest)
    for i, (text, _) in reversed(list(enumerate(cuts))):
        label = F.when(place <= F.try_element_at("_edges", F.lit(i)), text).otherwise(label)
    return df.withColumn("_edges", last).withColumn(name, label).drop("_edges")


def split_80_20(df: DataFrame, key: str, seed: int = 42, name: str = "split") -> DataFrame:
    """One fifth (rounded up) ``test``, the rest ``train``."""
    return hash_split(df, key, [("test", lambda n: F.ceil(F.lit(0.2) * n))], "train", seed, name)


def split_70_15_15(df: DataFrame, key: str, seed: int = 42, name: str = "split") -> DataFrame:
    """Hold out 30% (rounded up), half of it (rounded up) ``test``, the other half ``validation``."""
    held = lambda n: F.ceil(F.lit(0.3) * n)
    half = lambda n: F.ceil(F.lit(0.5) * held(n))
    return hash_split(df, key, [("test", half), ("validation", held)], "train", seed, name)


def split_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per source, split or any other label."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
