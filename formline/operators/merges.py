"""Merging sparse label tables that share a key."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from formline.operators.shaping import rename_present
from formline.session import store

SUFFIX = "_supp"


def outer_merge(left: DataFrame, right: DataFrame, key: str, null_keys: str = "keep") -> DataFrame:
    """Full outer merge; duplicates multiply.

    Rows with a null key are kept unmatched, or with ``null_keys="match"`` match
    each other, which multiplies them: only for few such rows. Clashing columns of ``right`` get the suffix ``_supp``. A full outer join
    cannot be split when one key is hot, so it is put together from an inner
    join and two anti joins against distinct keys, each of which adaptive
    execution can split on the side that is skewed.
    """
    other = right.withColumnsRenamed(
        {c: c + SUFFIX for c in right.columns if c != key and c in left.columns}
    ).withColumnRenamed(key, "_key")
    if null_keys not in ("keep", "match"):
        raise ValueError(f"unknown null_keys {null_keys!r}")
    same = F.col(key).eqNullSafe(F.col("_key")) if null_keys == "match" else F.col(key) == F.col("_key")
    both = left.join(other, same).drop("_key")
    only_left = left.join(other.select("_key").distinct(), same, "left_anti")
    only_right = other.join(left.select(key).distinct(), same, "left_anti").withColumnRenamed("_key", key)
    return both.unionByName(only_left, allowMissingColumns=True).unionByName(
        only_right, allowMissingColumns=True
    )


def fill_from_supplement(merged: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep the original value, fill its gaps from the supplement, drop the helper column."""
    for c in columns:
        if c + SUFFIX in merged.columns and c in merged.columns:
            merged = merged.withColumn(c, F.coalesce(F.col(c), F.col(c + SUFFIX))).drop(c + SUFFIX)
    return merged


def null_safe_merge(
    base: DataFrame, supplements: Sequence[DataFrame], key: str, rename: Mapping[str, str], null_keys: str = "keep"
) -> DataFrame:
    """Merge supplements in order; mapped columns fill the base, others are added.

    ``null_keys`` as in ``outer_merge``.

    A merge reads its left side three times, so each result but the last is
    stored before the next merge instead of being planned anew.
    """
    out = base
    for step, supplement in enumerate(supplements):
        if step:
            out = store(out, "merged")
        out = outer_merge(out, rename_present(supplement, rename), key, null_keys)
        out = fill_from_supplement(out, dict.fromkeys(rename.values()))
    return out


def attach_predictions(ids: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Every id with its predictions; null where there is none."""
    return ids.join(predictions, key, "left")


def left_merge(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "left")
