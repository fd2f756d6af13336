"""Early-stopping decision over a table of training runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from formline.operators.slices import plan_slices


def stall_stop(
    df: DataFrame, run: str, step: str, metric: str, patience: int = 5, width: int | None = None
) -> DataFrame:
    """Per run: the step that ends it after ``patience`` steps without a strict improvement.

    Steps count 1, 2, ... within a run. ``stop`` is null for a run that never
    stalls; ``best_step`` and ``best`` are the last improvement up to the stop.

    A run may be arbitrarily long, so it is read in slices of ``width`` steps:
    the best value before each slice comes from one small row per slice, and
    only improvements are carried from slice to slice.
    """
    slicing = plan_slices(df, step, width=width)
    rows = df.select(
        F.col(run), F.col(step).cast("long").alias("_step"), F.nanvl(F.col(metric), F.lit(None)).alias("_value")
    ).withColumn("_slice", slicing.number("_step"))
    earlier = Window.partitionBy(run).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(run).orderBy("_slice").rowsBetween(1, Window.unboundedFollowing)
    slices = rows.groupBy(run, "_slice").agg(F.min("_value").alias("_low"), F.max("_step").alias("_end"))
    known = slices.select(
        F.col(run), "_slice", F.min("_low").over(earlier).alias("_best"), F.max("_end").over(Window.partitionBy(run)).alias("_end")
    )
    inside = Window.partitionBy(run, "_slice").orderBy("_step")
    best_before = F.least(F.min("_value").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.col("_best"))
    improved = (
        rows.join(known, [run, "_slice"])
        .withColumn("_before", best_before)
        .where(F.col("_value").isNotNull() & (F.col("_before").isNull() | (F.col("_value") < F.col("_before"))))
        .withColumn("_next", F.lead("_step").over(inside))
    )
    # In a slice the last improvement has no next one yet; the later slices know it.
    stalls = F.col("_next") > F.col("_step") + patience
    per_slice = improved.groupBy(run, "_slice").agg(
        F.min("_step").alias("_first"),
        F.min(F.when(stalls, F.col("_step"))).alias("_stall"),
        F.min_by("_value", F.when(stalls, F.col("_step"))).alias("_stall_value"),
        F.max("_step").alias("_last"),
        F.min("_value").alias("_last_value"),
        F.max("_end").alias("_end"),
    )
    # A run starts from no value at all, as if step 0 had been its last improvement.
    nothing = F.lit(None)
    starts = known.groupBy(run).agg(F.max("_end").alias("_end")).select(
        F.col(run),
        F.lit(-1).cast("long").alias("_slice"),
        F.lit(0).cast("long").alias("_first"),
        nothing.cast("long").alias("_stall"),
        nothing.cast("double").alias("_stall_value"),
        F.lit(0).cast("long").alias("_last"),
        nothing.cast("double").alias("_last_value"),
        "_end",
    )
    following = F.coalesce(F.min("_first").over(later), F.col("_end") + 1)
    open_end = (following > F.col("_last") + patience) & (F.col("_end") >= F.col("_last") + patience)
    at = F.coalesce("_stall", F.when(F.col("_open"), F.col("_last")))
    value = F.when(F.col("_stall").isNotNull(), F.col("_stall_value")).otherwise(F.col("_last_value"))
    return (
        per_slice.unionByName(starts)
        .withColumn("_open", open_end)
        .withColumn("_at", at)
        .groupBy(run)
        .agg(
            F.min("_at").alias("_at"),
            F.min_by(value, "_at").alias("_at_value"),
            F.max("_last").alias("_last"),
            F.min("_last_value").alias("_last_value"),
        )
        .select(
            run,
            (F.col("_at") + patience).alias("stop"),
            F.nullif(F.coalesce("_at", "_last"), F.lit(0)).alias("best_step"),
            F.when(F.col("_at").isNotNull(), F.col("_at_value")).otherwise(F.col("_last_value")).alias("best"),
        )
    )
