"""One regression per sparsely labelled target, over pooled graph features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from formline.operators.graphs import degrees, mean_pool
from formline.operators.shaping import present


def graph_inputs(nodes: DataFrame, edges: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean node features, mean degree and size of every graph."""
    return mean_pool(degrees(nodes, edges), [*features, "degree"])


@dataclass
class LinearTarget:
    """``intercept`` + the sum of ``weights`` x features, fitted on ``n`` labelled rows."""

    weights: list[float]
    intercept: float
    n: int


def _known(df: DataFrame, features: Sequence[str]) -> Column:
    known = F.lit(True)
    for c in features:
        known = known & present(df, c).isNotNull()
    return known


def fit_targets(
    samples: DataFrame, features: Sequence[str], targets: Sequence[str], reg: float = 0.01
) -> dict[str, LinearTarget | None]:
    """A least-squares fit per target on its labelled rows; None for a target without labels.

    All targets are fitted from two scans: one for the means of the features, one that adds up, per target and over
    its labelled rows only, the products of the centred features with each other and with the target. What is
    collected has the size of the models. ``reg`` adds that share of its variance to each feature (ridge); features
    that depend on each other get the smallest weights that fit.
    """
    xs = [present(samples, c).cast("double") for c in features]
    ys = [present(samples, t).cast("double") for t in targets]
    rows = samples.where(_known(samples, features))
    means = [m or 0.0 for m in rows.agg(*[F.avg(x) for x in xs]).first()]
    x = [c - F.lit(m) for c, m in zip(xs, means)]
    size = len(features)
    upper = [(i, j) for i in range(size) for j in range(i, size)]
    sums = []
    for y in ys:
        own = lambda value, y=y: F.sum(F.when(y.isNotNull(), value))
        sums += [F.count(y), F.sum(y), *[own(c) for c in x], *[own(c * y) for c in x], *[own(x[i] * x[j]) for i, j in upper]]
    found = list(rows.agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)]).first())
    width, models = 2 + 2 * size + len(upper), {}
    for k, target in enumerate(targets):
        n, total, *rest = found[k * width : (k + 1) * width]
        if not n:
            models[target] = None
            continue
        centre, cross = np.array(rest[:size]) / n, np.array(rest[size : 2 * size]) / n
        square = np.zeros((size, size))
        for (i, j), value in zip(upper, rest[2 * size :]):
            square[i, j] = square[j, i] = value / n
        covariance = square - np.outer(centre, centre)
        covariance += np.diag(np.diag(covariance)) * reg
        weights = np.linalg.lstsq(covariance, cross - centre * total / n, rcond=1e-12)[0]
        intercept = total / n - float(weights @ (centre + np.array(means)))
        models[target] = LinearTarget(weights.tolist(), intercept, n)
    return models


def predict_targets(
    samples: DataFrame, models: dict[str, LinearTarget | None], features: Sequence[str], key: str
) -> DataFrame:
    """A prediction for every row with all inputs; null for a target without a model."""
    scored = []
    for target, model in models.items():
        value = F.lit(None).cast("double")
        if model is not None:
            value = F.lit(model.intercept)
            for c, w in zip(features, model.weights):
                value = value + F.lit(w) * present(samples, c).cast("double")
        scored.append(value.alias(f"pred_{target}"))
    return samples.where(_known(samples, features)).select(key, *scored)
