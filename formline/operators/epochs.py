"""An order of its own for every epoch, without a sort.

Rows are numbered densely once. A keyed bijection of 0..n-1 then gives each row its place in each epoch: a
number is split into two digits of a mixed-radix system (``left`` times ``right`` values, at least n), four Feistel
half-rounds add a hash of one digit to the other, and a result of n or more is sent round again (cycle walking). The
radices are chosen so that few values lie beyond n; as a walk can meet each of them once at most, the number of
steps has an exact bound. Every epoch is a narrow map over the rows, whatever their number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

CANDIDATES = 2000


def radices(n: int) -> tuple[int, int]:
    """Two numbers near the square root whose product is at least ``n`` and exceeds it as little as possible.

    The larger is at most twice the root, so both digits have values enough to mix.
    """
    root = max(math.isqrt(max(n - 1, 0)) + 1, 1)
    return min(((a, -(-n // a)) for a in range(root, root + min(CANDIDATES, root + 1))), key=lambda ab: (ab[0] * ab[1], ab[0]))


def _hashed(seed: int, epoch: Column, step: int, digit: Column) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.lit(str(step)), digit.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _round(x: Column, epoch: Column, left: int, right: int, seed: int) -> Column:
    """One pass of the bijection on 0 .. left * right - 1."""
    one = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))  # noqa: E731  evaluates value once
    l0, r0 = F.floor(x / F.lit(right)).cast("long"), F.pmod(x, F.lit(right))
    step = lambda own, other, k, size: F.pmod(own + _hashed(seed, epoch, k, other), F.lit(size))
    return one(
        F.struct(l0.alias("l"), r0.alias("r")),
        lambda a: one(
            F.struct(step(a["l"], a["r"], 1, left).alias("l"), a["r"].alias("r")),
            lambda b: one(
                F.struct(b["l"].alias("l"), step(b["r"], b["l"], 2, right).alias("r")),
                lambda c: one(
                    F.struct(step(c["l"], c["r"], 3, left).alias("l"), c["r"].alias("r")),
                    lambda d: d["l"] * F.lit(right) + step(d["r"], d["l"], 4, right),
                ),
            ),
        ),
    )


def place_in_epoch(row: Column, epoch: Column, n: int, seed: int = 42) -> Column:
    """The place (from 0) of dense row number ``row`` (from 0) in ``epoch``; a bijection of 0..n-1 for each epoch."""
    left, right = radices(n)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(left * right - n + 1)),
        row.cast("long") + F.lit(left * right),  # not yet placed
        lambda x, k: F.when(x < n, x).otherwise(_round(F.pmod(x, F.lit(left * right)), epoch, left, right, seed)),
    )
    return walked


def epoch_batches(
    df: DataFrame, row: str, epochs: int, batch: int = 32, seed: int = 42, first: int = 0
) -> DataFrame:
    """Every row once per epoch with ``epoch`` (from 1), ``position`` (from 0) and ``batch_id``.

    ``row`` is a dense row number from ``first`` (see ``assign_sequence``). All batches but the last of an epoch have
    ``batch`` rows. An empty table gives no batches.
    """
    n = df.count()
    spread = df.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    position = place_in_epoch(F.col(row) - first, F.col("epoch"), max(n, 1), seed)
    return spread.withColumn("position", position).withColumn("batch_id", F.floor(F.col("position") / batch).cast("long"))
