"""Connected components of a link table by repeated contraction; all state is a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from formline.session import store


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable over the undirected ``links``.

    Each round maps every node to the first of its neighbours and itself, and redraws the links between the
    images; the link to the chosen neighbour is redrawn too, so nothing comes apart. Nodes are ordered by a
    hash: the images of a long chain are then its local minima, so that a constant share of the nodes is
    expected to go in each round, however the ids run. Minima are combined before the shuffle, and the joins
    have one row per node on one side, so a node with very many links is split by adaptive execution.
    Nodes are any orderable values; links from a node to itself are ignored.
    """
    tagged = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
    edges = store(
        links.where(F.col(a) != F.col(b))
        .select(tagged(a).alias("x"), tagged(b).alias("y"))
        .select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))
        .distinct(),
        "links",
    )
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = store(
            both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("parent")), "parents"
        )
        named = parent.withColumnRenamed("u", "x")
        if labels is None:
            labels = parent.select(F.col("u").alias("node"), F.col("parent").alias("part"))
        else:
            labels = labels.join(named, F.col("part") == F.col("x"), "left").select(
                "node", F.coalesce("parent", "part").alias("part")
            )
        labels = store(labels, "labels")
        images = (
            edges.join(named.withColumnsRenamed({"x": "x1", "parent": "p1"}), F.col("u") == F.col("x1"))
            .join(named.withColumnsRenamed({"x": "x2", "parent": "p2"}), F.col("v") == F.col("x2"))
            .where(F.col("p1") != F.col("p2"))
            .select(F.least("p1", "p2").alias("u"), F.greatest("p1", "p2").alias("v"))
            .distinct()
        )
        edges = store(images, "links")
        if edges.isEmpty():
            break
    # Stored, so that the join has a plain shuffle on both sides and a part with very many nodes can be split.
    names = store(labels.groupBy("part").agg(F.min("node.n").alias("component")), "parts")
    return labels.join(names, "part").select(F.col("node.n").alias("node"), "component")
