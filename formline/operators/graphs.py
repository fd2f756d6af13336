"""Graphs as node and edge tables keyed by ``graph_id``."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from formline.operators.shaping import BLOCK, in_blocks, nan_to_null


def parsed_only(df: DataFrame, column: str) -> DataFrame:
    """Drop records that could not be parsed (null)."""
    return df.where(F.col(column).isNotNull())


def undirected(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Every edge in both directions with its attributes, from one scan."""
    rest = [c for c in edges.columns if c not in (src, dst)]
    ways = F.array(
        F.struct(F.col(src).alias("a"), F.col(dst).alias("b")), F.struct(F.col(dst).alias("a"), F.col(src).alias("b"))
    )
    return (
        edges.select(*rest, F.inline(ways))
        .withColumnsRenamed({"a": src, "b": dst})
        .select(*edges.columns)
    )


def degrees(
    nodes: DataFrame, edges: DataFrame, graph: str = "graph_id", node: str = "node_id", block: int = BLOCK
) -> DataFrame:
    """Neighbours per node; isolated nodes have degree 0.

    The nodes are counted first, and meet their degrees in partitions of about ``block`` nodes.
    """
    counted = undirected(edges).groupBy(graph, F.col("src").alias(node)).agg(F.count(F.lit(1)).alias("degree"))
    key, rows = [graph, node], nodes.count()
    near = in_blocks(nodes, rows, key, block).join(in_blocks(counted, rows, key, block), key, "left")
    return near.withColumn("degree", F.coalesce("degree", F.lit(0)))


def mean_pool(nodes: DataFrame, features: Sequence[str], graph: str = "graph_id") -> DataFrame:
    """Mean of every node feature per graph."""
    clean = nan_to_null(nodes)
    return clean.groupBy(graph).agg(*[F.avg(c).alias(c) for c in features], F.count(F.lit(1)).alias("n_nodes"))


def _uniform(*parts: Column | str) -> Column:
    """A number in (0, 1] that depends on the parts only, not on where the row is."""
    head = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8)
    return (F.conv(head, 16, 10).cast("double") + 1.0) / 4294967296.0


def graph_noise(
    nodes: DataFrame,
    features: Sequence[str],
    graph: str = "graph_id",
    node: str = "node_id",
    seed: int = 42,
    scale: float = 0.01,
    training: Column | None = None,
) -> DataFrame:
    """For half of the graphs add normal noise to every node feature.

    ``training`` tells which rows may be changed (all, if it is not given); the others stay as they are.
    Coin and noise come from hashes of the ids, so a retried task repeats them.
    """
    coin = _uniform(F.lit(f"coin{seed}"), F.col(graph).cast("string")) < 0.5
    if training is not None:
        coin = coin & F.coalesce(training, F.lit(False))
    out = {}
    for c in features:
        place = (F.lit(f"{c}{seed}"), F.col(graph).cast("string"), F.col(node).cast("string"))
        radius = F.sqrt(-2.0 * F.log(_uniform(F.lit("r"), *place)))
        normal = radius * F.cos(2.0 * math.pi * _uniform(F.lit("a"), *place))
        out[c] = F.when(coin, F.col(c) + normal * scale).otherwise(F.col(c))
    return nodes.withColumn("noisy", coin).withColumns(out)
