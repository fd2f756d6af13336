"""Mixing sources to target weights by Poisson replication.

Each source's mean repetition rate is (target weight x all characters) / (its own characters). A document's
count inverts the Poisson distribution of that mean at a number in (0, 1) hashed from the seed and its id,
so a run can be repeated exactly and no task needs to know another's draws. Rows are exploded by count and
shuffled globally by a hash of seed, id and copy.

Defined results: a null source is a source of its own; null and empty texts have no characters but are drawn
like the others of their source; a source without characters has rate 1; rows with equal ids draw alike; an
empty table gives an empty result. Target weights need not sum to one. Without targets a source's weight is
the square root of its share, which lifts small sources. Copies with equal shuffle keys (of rows with equal ids) come in
any order; very long texts are rows like others. Other columns, of any name, are kept; the added ones replace columns of
the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from formline.llm.common import whole_row
from formline.session import store

SEED = "mix-1"
SMOOTHING = 0.5


def hashed_unit(seed: str, key: Column) -> Column:
    """A number inside (0, 1) with 52 bits, from md5 of seed and key."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def poisson_count(mean: Column, unit: Column) -> Column:
    """The smallest k whose cumulative Poisson probability reaches ``unit``; logarithms keep large means right."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    state = lambda log_p, below, n: F.struct(log_p.alias("log_p"), below.alias("below"), n.alias("n"))

    def step(s: Column, k: Column) -> Column:
        below = s["below"] + F.exp(s["log_p"])
        return state(s["log_p"] + F.log(mean) - F.log(k), below, s["n"] + F.when(below < unit, 1).otherwise(0))

    start = state(-mean, F.lit(0.0), F.lit(0))
    drawn = F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["n"])
    return F.when(mean > 0, drawn).otherwise(0)


def source_rates(
    docs: DataFrame, targets: DataFrame | None = None, text: str = "text", source: str = "source"
) -> DataFrame:
    """``_mix_source, _mix_rate`` per source. ``targets`` has the columns ``source`` and ``weight``."""
    mass = docs.groupBy(F.col(source).alias("_mix_source")).agg(
        F.sum(F.length(F.coalesce(F.col(text), F.lit(""))).cast("double")).alias("_mass")
    )
    if targets is None:
        weighted = mass.withColumn("_weight", F.pow("_mass", F.lit(SMOOTHING)))
    else:
        given = targets.groupBy(F.col("source").alias("_target")).agg(F.sum("weight").alias("_weight"))
        weighted = mass.join(given, F.col("_mix_source").eqNullSafe(F.col("_target")), "left").drop("_target")
    weighted = store(weighted, "mix-sources")
    everything, weights = weighted.agg(F.sum("_mass"), F.sum("_weight")).first()
    if not everything or not weights:
        return weighted.select("_mix_source", F.lit(1.0).alias("_mix_rate"))
    share = F.coalesce("_weight", F.lit(0.0)) / F.lit(float(weights)) * F.lit(float(everything))
    return weighted.select(
        "_mix_source", F.when(F.col("_mass") > 0, share / F.col("_mass")).otherwise(1.0).alias("_mix_rate")
    )


def _copies(
    docs: DataFrame,
    targets: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: str = SEED,
) -> DataFrame:
    """``_row, rate, copy, shuffle_key`` of every copy, in global shuffled order."""
    rates = source_rates(docs, targets, text, source)
    whole = docs.select(
        whole_row(docs).alias("_row"),
        F.col(source).alias("_source"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_draw"),
    )
    count = poisson_count(F.col("_mix_rate"), hashed_unit(seed, F.col("_draw")))
    copies = (
        whole.join(rates, F.col("_source").eqNullSafe(F.col("_mix_source")))
        .withColumn("_count", count)
        .where(F.col("_count") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_count") - 1)))
        .withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(seed), "_draw", F.col("copy").cast("string"))))
        .select("_row", F.col("_mix_rate").alias("rate"), "copy", "shuffle_key")
    )
    return copies.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key")


def replicate(docs: DataFrame, targets: DataFrame | None = None, **options: str) -> DataFrame:
    """The columns of ``docs`` for every copy, in global shuffled order."""
    return _copies(docs, targets, **options).select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def mix_sources(docs: DataFrame, targets: DataFrame | None = None, **options: str) -> DataFrame:
    """``replicate`` with the columns ``rate``, ``copy`` and ``shuffle_key``, which replace columns of those names."""
    added = ("rate", "copy", "shuffle_key")
    kept = [F.col("_row")[c].alias(c) for c in docs.columns if c not in added]
    return _copies(docs, targets, **options).select(*kept, *added)
