"""Scoring by a model from outside Spark, loaded once per worker and given batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

BATCH = 32


def score_batches(
    df: DataFrame,
    load: Callable[[], Callable[..., np.ndarray]],
    inputs: Sequence[str],
    name: str = "score",
    shapes: Sequence[Sequence[int] | None] | None = None,
    outputs: int = 1,
    batch: int = BATCH,
) -> DataFrame:
    """Add ``name``: what the loaded model returns for each row.

    ``load`` runs once per Python worker and returns a function of one array per input column, at most ``batch``
    rows at a time. ``shapes`` gives the shape of each array column (None for plain numbers). With several ``outputs`` the
    result is an array. A row with a null in any input, in any entry of an array, or with an array of another size
    is not given to the model and has a null score.
    """
    shapes = list(shapes) if shapes else [None] * len(inputs)
    kind = DoubleType() if outputs == 1 else ArrayType(DoubleType())
    known, given = F.lit(True), []
    for column, shape in zip(inputs, shapes):
        value = F.col(column)
        if shape is None:
            known = known & value.isNotNull()
            given.append((value.cast("double"), F.lit(0.0)))
        else:
            size = int(np.prod(shape))
            whole = value.isNotNull() & (F.size(value) == size) & F.forall(value, lambda x: x.isNotNull())
            known = known & F.coalesce(whole, F.lit(False))
            given.append((value.cast("array<double>"), F.array_repeat(F.lit(0.0), size)))
    score = predict_batch_udf(
        load,
        return_type=kind,
        batch_size=batch,
        input_tensor_shapes=[list(s) if s else None for s in shapes] if any(shapes) else None,
    )
    # The model sees a stand-in for rows it cannot score; their result is dropped.
    shown: list[Column] = [F.when(known, value).otherwise(blank) for value, blank in given]
    marked = df.withColumn("_known", known).withColumn(name, score(*shown))
    return marked.withColumn(name, F.when(F.col("_known"), F.col(name))).drop("_known")


def linear_model(weights: Sequence[float], slope: float, bias: float) -> Callable[[], Callable[..., np.ndarray]]:
    """A small model of a vector and a number, as a loader for ``score_batches``."""
    held = [float(w) for w in weights]

    def load() -> Callable[..., np.ndarray]:
        import numpy

        w = numpy.array(held)
        return lambda vector, number: vector @ w + slope * number + bias

    return load
