"""Evaluation metrics as grouped aggregates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F


def argmax(scores: Column) -> Column:
    """Index of the largest score; the lowest index on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def property_stats(long: DataFrame, prop: str = "property", y_true: str = "y_true") -> DataFrame:
    """Labelled rows and value range per property (range 1 without labels)."""
    y = F.nanvl(F.col(y_true).cast("double"), F.lit(None))
    return long.groupBy(prop).agg(
        F.count(y).alias("n_labelled"), F.coalesce(F.max(y) - F.min(y), F.lit(1.0)).alias("value_range")
    )


def _weighted(stats: DataFrame) -> DataFrame:
    """Add ``weight`` = (1/range) * K * sqrt(1/n) / sum of sqrt(1/n) over the K properties."""
    root = F.when(F.col("n_labelled") > 0, F.sqrt(1.0 / F.col("n_labelled"))).otherwise(0.0)
    every = Window.partitionBy(F.lit(True))  # one row per property
    total = F.sum(root).over(every)
    norm = F.when(total == 0, 1.0).otherwise(F.count(F.lit(1)).over(every) * root / total)
    return stats.withColumn("weight", F.try_divide(F.lit(1.0), F.col("value_range")) * norm)


def property_weights(long: DataFrame, prop: str = "property", y_true: str = "y_true") -> DataFrame:
    """Metric weight per property. A constant property has no weight (null)."""
    return _weighted(property_stats(long, prop, y_true))


def weighted_mae(
    long: DataFrame, prop: str = "property", y_true: str = "y_true", y_pred: str = "y_pred"
) -> DataFrame:
    """Weighted absolute error over all labelled cells, in one scan.

    The weight is constant within a property, so a property only needs its
    count, range and error sum. Null without labels, or if a labelled cell has
    no prediction.
    """
    y = F.nanvl(F.col(y_true).cast("double"), F.lit(None))
    p = F.nanvl(F.col(y_pred).cast("double"), F.lit(None))
    stats = long.groupBy(prop).agg(
        F.count(y).alias("n_labelled"),
        F.coalesce(F.max(y) - F.min(y), F.lit(1.0)).alias("value_range"),
        F.sum(F.abs(p - y)).alias("error_sum"),
        F.count_if(y.isNotNull() & p.isNull()).alias("n_unpredicted"),
    )
    total = F.sum(F.when(F.col("n_labelled") > 0, F.col("weight") * F.col("error_sum")))
    unusable = F.count_if((F.col("n_labelled") > 0) & F.col("weight").isNull()) + F.sum("n_unpredicted")
    return _weighted(stats).agg(
        F.when(unusable == 0, F.try_divide(total, F.sum("n_labelled"))).alias("wmae"),
        F.sum("n_labelled").alias("n_labelled"),
    )


def batch_loss(
    long: DataFrame,
    weights: DataFrame,
    batch: str = "batch_id",
    prop: str = "property",
    y_true: str = "y_true",
    y_pred: str = "y_pred",
) -> DataFrame:
    """Per batch: sum over properties of weight * mean absolute error, over the batch's rows."""
    y = F.nanvl(F.col(y_true).cast("double"), F.lit(None))
    parts = long.groupBy(batch, prop).agg(
        F.avg(F.abs(F.col(y_pred) - y)).alias("_mae"), F.count(F.lit(1)).alias("_rows")
    )
    return (
        parts.join(weights.select(prop, "weight"), prop, "left")
        .groupBy(batch)
        .agg(
            (F.coalesce(F.sum(F.col("weight") * F.col("_mae")), F.lit(0.0)) / F.max("_rows")).alias("loss"),
            F.max("_rows").alias("n_rows"),
        )
    )


def accuracy(df: DataFrame, y: str, y_hat: str) -> DataFrame:
    """The share of right predictions among rows with a true class; a missing prediction is wrong."""
    right = F.coalesce(F.col(y) == F.col(y_hat), F.lit(False))
    return df.where(F.col(y).isNotNull()).agg(F.avg(right.cast("double")).alias("accuracy"))


def class_report(df: DataFrame, y: str, y_hat: str, names: Mapping[object, str] | None = None) -> DataFrame:
    """Precision, recall, f1 and support per class, then accuracy, macro and weighted averages.

    A class list is the union of true and predicted classes; a zero denominator
    gives 0. Rows without a true class are left out, a missing prediction is wrong and no class of its own (as in
    ``accuracy``). The table is reduced to its confusion counts first.
    """
    pairs = df.where(F.col(y).isNotNull()).groupBy(F.col(y).alias("y"), F.col(y_hat).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    one = lambda cls, hit, seen, said: F.struct(
        F.col(cls).alias("cls"), hit.alias("hit"), seen.alias("seen"), said.alias("said")
    )
    none = F.lit(0).cast("long")
    right = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(none)
    classes = (
        pairs.select(F.inline(F.array(one("y", right, F.col("n"), none), one("p", none, none, F.col("n")))))
        .where(F.col("cls").isNotNull())
        .groupBy("cls")
        .agg(F.sum("hit").alias("hit"), F.sum("seen").alias("support"), F.sum("said").alias("said"))
    )
    over = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    scored = (
        classes.withColumn("precision", over(F.col("hit").cast("double"), F.col("said")))
        .withColumn("recall", over(F.col("hit").cast("double"), F.col("support")))
        .withColumn(
            "f1",
            over(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        )
    )
    label = F.col("cls").cast("string")
    if names:
        lookup = F.create_map(*[F.lit(x) for k, v in names.items() for x in (str(k), v)])
        label = F.coalesce(F.try_element_at(lookup, label), label)
    columns = ("precision", "recall", "f1", "support")
    per_class = scored.select(label.alias("label"), *columns)
    totals = scored.agg(
        F.sum("support").alias("rows"),
        F.sum("hit").alias("hits"),
        *[F.avg(c).alias(f"macro_{c}") for c in columns[:3]],
        *[F.sum(F.col(c) * F.col("support")).alias(f"sum_{c}") for c in columns[:3]],
    )
    line = lambda name, p, r, f: F.struct(
        F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"), F.col("rows").alias("support")
    )
    empty = F.lit(None).cast("double")
    mean = lambda c: over(F.col(f"sum_{c}"), F.col("rows"))
    summary = totals.select(
        F.inline(
            F.array(
                line("accuracy", empty, empty, over(F.col("hits").cast("double"), F.col("rows"))),
                line("macro avg", *[F.col(f"macro_{c}") for c in columns[:3]]),
                line("weighted avg", *[mean(c) for c in columns[:3]]),
            )
        )
    )
    return per_class.unionByName(summary)


def epoch_loss(metrics: DataFrame, epoch: str = "epoch", loss: str = "loss") -> DataFrame:
    return metrics.groupBy(epoch).agg(F.avg(loss).alias("mean_loss"), F.count(F.lit(1)).alias("n_rows"))
