"""Near-duplicate vectors by counting collisions of sorted one-dimensional projections.

Unit vectors at cosine c lie sqrt(2 - 2 c) apart, so their projections on a Gaussian direction differ by a
normal number of that width. Two vectors collide on a direction if their projections differ by at most
``WINDOW``; a pair becomes a candidate if it collides on at least ``needed`` of the ``DIRECTIONS``, where
``needed`` is the largest count that a pair exactly at the threshold reaches with probability ``RECALL``.
Candidates are verified by their cosine in double precision.

Equal vectors of a label are one entry. Which entries are compared is decided by cells: a table cuts several
further projections into intervals of width ``CELL`` at random offsets, and entries of a label in the same
intervals share a cell. A pair at the threshold shares a cell of a table with at least a known probability, so
as many tables are made as let it miss all of them with probability ``CELL_MISS`` or less. The number of
projections in a table grows with the logarithm of the largest label, so that a cell of unrelated vectors stays
within a block; the tables grow with about the eighth root of it. Nothing is dropped: a cell of any size is cut into blocks of at
most ``block`` entries, each block meets itself and every other one of its cell. A meeting of two blocks is one group,
and so are the blocks of small neighbouring cells, up to ``block`` entries in all. In a meeting every query opens its window in each of the sorted projections and the entries inside are counted. A pair
that shares cells of several tables counts in the first of them only. Meetings return link counts and a spanning
forest of the links they found, never all pairs.

Defined results: a null vector, an empty or zero one, one with null or non-finite entries, and any vector with
a null label link with nothing; vectors of different length do not link; equal ids are one vector per row;
an empty table gives an empty result; columns other than id, vector and label are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from formline.llm.components import connected
from formline.session import store

THRESHOLD = 0.98
DIRECTIONS = 48
WINDOW = 0.2
RECALL = 0.9995
CELL = 1.5
CELL_MISS = 1e-4
SHARED = 0.4  # about the chance that unrelated unit vectors share an interval of width CELL
BLOCK = 1024
SEED = 5


def _within(width: float) -> float:
    """Probability that a standard normal number lies within ``width``."""
    return math.erf(width / math.sqrt(2.0))


def needed_collisions(threshold: float = THRESHOLD, directions: int = DIRECTIONS, recall: float = RECALL) -> int:
    chance = _within(WINDOW / math.sqrt(2.0 - 2.0 * threshold)) if threshold < 1 else 1.0
    tail, best = 1.0, 1
    for k in range(directions):
        tail -= math.comb(directions, k) * chance**k * (1.0 - chance) ** (directions - k)
        if tail < recall:
            break
        best = k + 1
    return best


def directions(size: int, count: int = DIRECTIONS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, count))


def cell_plan(entries: int, threshold: float = THRESHOLD, block: int = BLOCK) -> tuple[int, int]:
    """Projections per table and tables for a largest label of so many entries; (0, 1) is one cell for all."""
    # E max(0, 1 - |x| / CELL) for a normal x of the pair's width, from below.
    kept = 1.0 - math.sqrt(max(2.0 - 2.0 * threshold, 0.0)) * math.sqrt(2.0 / math.pi) / CELL
    width = max(0, math.ceil(math.log(max(4.0 * entries / block, 1.0)) / -math.log(SHARED)))
    if width == 0 or kept <= SHARED:  # where links are as far apart as unrelated vectors, cells cannot tell them
        return 0, 1
    return width, max(1, math.ceil(math.log(CELL_MISS) / math.log1p(-min(kept**width, 1 - 1e-12))))


def cells(units: np.ndarray, width: int, tables: int) -> np.ndarray:
    """The cell of each unit row in each table: rows x tables."""
    random = np.random.default_rng(SEED + 1)
    offsets = random.uniform(0, CELL, tables * width)
    lines = random.standard_normal((units.shape[1], tables * width))
    steps = np.floor((units @ lines + offsets) / CELL).astype(np.int64).reshape(len(units), tables, width)
    out = np.zeros((len(units), tables), np.int64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = (out + steps[:, :, k]) * np.int64(0x5851F42D4C957F2D)
            out ^= out >> np.int64(29)
    return out


def _usable(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return label.isNotNull() & vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(some, F.lit(False))


def collisions(own: np.ndarray, other: np.ndarray, needed: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (row of ``own``, row of ``other``): projections that collide at least ``needed`` times."""
    counts = np.zeros(len(own) * len(other), np.int64)
    step = 4.0 * max(np.abs(own).max(initial=0), np.abs(other).max(initial=0)) + 1.0
    for j in range(0, own.shape[1], 12):  # a dozen projections side by side on one line, far apart
        mine, others = own[:, j : j + 12], other[:, j : j + 12]
        shift = step * np.arange(mine.shape[1])
        order = np.argsort(others, axis=0, kind="stable")
        line = (np.take_along_axis(others, order, 0) + shift).T.ravel()
        asked = (mine + shift).T.ravel()
        low = np.searchsorted(line, asked - WINDOW, "left")
        inside = np.searchsorted(line, asked + WINDOW, "right") - low
        place = np.arange(inside.sum()) - np.repeat(np.cumsum(inside) - inside - low, inside)
        row = np.repeat(np.tile(np.arange(len(own)), mine.shape[1]), inside)
        counts += np.bincount(row * len(other) + order.T.ravel()[place], minlength=len(counts))
    return np.divmod(np.flatnonzero(counts >= needed), max(len(other), 1))


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; divided by their largest entry first, so that squares of very large or small ones stay in range."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Positions of links that join parts not yet joined."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            kept.append(i)
    return kept


def _meet(threshold: float, needed: int, own: np.ndarray, other: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the verified pairs between two blocks of vectors."""
    own, other = unit_rows(own), unit_rows(other)
    lines = directions(own.shape[1])
    a, b = collisions(own @ lines, other @ lines, needed)
    if same:
        a, b = a[a < b], b[a < b]
    close = np.einsum("ij,ij->i", own[a], other[b]) >= threshold
    return a[close], b[close]


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    needed = needed_collisions(threshold)
    all_rows = vectors.select(
        F.col(vec_id).alias("_id"), F.col(label).alias("_label"), F.col(vector).cast("array<double>").alias("_vector")
    )
    usable = _usable(F.col("_vector"), F.col("_label"))
    entries = (
        all_rows.where(usable)
        .groupBy("_label", "_vector")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_copies"))
    )
    entries = store(entries.withColumn("_size", F.size("_vector")), "vector-entries")
    largest = entries.groupBy("_label").count().agg(F.coalesce(F.max("count"), F.lit(0)).alias("n")).first()["n"]
    width, tables = cell_plan(largest, threshold, block)
    numbered = store(_in_cells(entries, width, tables), "vectors")
    links = store(_linked(numbered, threshold, needed, block), "vector-links")
    counts = links.where(F.col("n") > 0).groupBy(F.col("a").alias("_entry")).agg(F.sum("n").alias("_n"))
    # A node is named by its smallest id and its number, so a component's smallest node holds its smallest id; the
    # vectors stay out of the way until the end.
    node = lambda e: F.struct(
        F.col(f"{e}f").isNull().alias("none"), F.col(f"{e}f").alias("first"), F.col(e).alias("entry")
    )
    firsts = numbered.select("_entry", "_first")
    tree = (
        links.where(F.col("b").isNotNull())
        .select("a", "b")
        .join(firsts.toDF("a", "af"), "a")
        .join(firsts.toDF("b", "bf"), "b")
        .select(node("a").alias("a"), node("b").alias("b"))
    )
    parts = connected(tree).select(F.col("node.entry").alias("_entry"), F.col("component.first").alias("_component"))
    known = (
        numbered.select("_entry", "_label", "_vector", "_first", "_copies")
        .join(parts, "_entry", "left")
        .join(counts, "_entry", "left")
        .select(
            F.col("_label").alias("_elabel"),
            F.col("_vector").alias("_evector"),
            (F.coalesce("_n", F.lit(0)) + F.col("_copies") - 1).alias("_links"),
            F.coalesce("_component", "_first").alias("_component"),
        )
    )
    joined = all_rows.withColumn("_key", F.when(usable, F.col("_vector"))).join(
        known, (F.col("_label") == F.col("_elabel")) & (F.col("_key") == F.col("_evector")), "left"
    )
    component = F.coalesce("_component", "_id")
    return joined.select(
        F.col("_id").alias(vec_id),
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )


def _in_cells(entries: DataFrame, width: int, tables: int) -> DataFrame:
    """Entries with a number ``_entry`` and their cell in every table, ``_cells``."""

    def place(batches):
        for pdf in batches:
            for size, part in pdf.groupby("_size", sort=False):
                found = cells(unit_rows(np.stack(part["_vector"].to_numpy()).astype(float)), width, tables)
                yield part.assign(_cells=list(found))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in entries.schema) + ", _cells array<bigint>"
    return entries.mapInPandas(place, schema).withColumn("_entry", F.monotonically_increasing_id())


def _linked(numbered: DataFrame, threshold: float, needed: int, block: int) -> DataFrame:
    """Link counts (``a``, ``n``) and forest links (``a``, ``b``) from every two blocks of a cell."""
    cell = ["_label", "_size", "_table", "_cell"]
    placed = numbered.select("_entry", "_label", "_size", F.posexplode("_cells").alias("_table", "_cell"))
    order = [*cell, "_entry"]
    ranged = store(
        placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()),
        "vector-cells",
    )
    # A block is what a run of ``block`` neighbours in a sorted partition has of one cell.
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    seats = ranged.withColumn("_block", F.shiftleft(part, 33) + F.floor(row / block))
    blocks = store(seats.groupBy(*cell, "_block").agg(F.count(F.lit(1)).alias("_held")), "vector-blocks")
    one, two = blocks.withColumnRenamed("_block", "x"), blocks.select(*cell, F.col("_block").alias("y"))
    meeting = one.join(two, cell).where((F.col("x") < F.col("y")) | ((F.col("x") == F.col("y")) & (F.col("_held") > 1)))
    sides = F.array(F.struct(F.col("x").alias("_block"), F.lit(0).alias("_side")), F.struct(F.col("y").alias("_block"), F.lit(1).alias("_side")))
    alone = F.col("x") == F.col("y")
    asked = meeting.select(
        *cell,
        # All cells of one run share a group, as most are small.
        F.when(alone, F.struct(F.col("x").alias("run"), F.lit(-1).alias("pair")))
        .otherwise(F.struct(F.xxhash64(*cell, "x", "y").alias("run"), F.hash("y", "x", *cell).alias("pair")))
        .alias("_task"),
        F.xxhash64(*cell).alias("_key"),
        F.inline(F.when(alone, F.slice(sides, 1, 1)).otherwise(sides)),
    )
    # Only numbers move until here; a vector then goes to the meetings of its blocks.
    members = (
        seats.join(asked, [*cell, "_block"])
        .select("_entry", "_task", "_table", "_key", "_side")
        .join(numbered.select("_entry", "_copies", "_vector", "_cells"), "_entry")
    )

    def met(part: pd.DataFrame) -> list[pd.DataFrame]:
        table = int(part["_table"].iloc[0])
        sides = [part[part["_side"] == 0], part[part["_side"] == 1]]
        same = sides[1].empty
        if same:
            sides[1] = sides[0]
        ids, copies = ([p[c].to_numpy(np.int64) for p in sides] for c in ("_entry", "_copies"))
        a, b = _meet(threshold, needed, *[np.stack(p["_vector"].to_numpy()).astype(float) for p in sides], same)
        if not len(a):
            return []
        earlier = [np.stack(p["_cells"].to_numpy())[:, :table] for p in sides]
        new = ~(earlier[0][a] == earlier[1][b]).any(axis=1)
        a, b = a[new], b[new]
        ends = np.concatenate([ids[0][a], ids[1][b]])
        counts = pd.DataFrame({"a": ends, "n": np.concatenate([copies[1][b], copies[0][a]])}).groupby("a", as_index=False)["n"].sum()
        a, b = ids[0][a], ids[1][b]
        kept = _forest(a, b)
        return [counts, pd.DataFrame({"a": a[kept], "n": 0, "b": b[kept]})]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": [], "n": [], "b": []})
        found = [frame for _, one in part.groupby("_key", sort=False) for frame in met(one)] or [none]
        return pd.concat([f.reindex(columns=["a", "n", "b"]).astype("Int64") for f in found], ignore_index=True)

    return members.groupBy("_task").applyInPandas(run, "a bigint, n bigint, b bigint")
