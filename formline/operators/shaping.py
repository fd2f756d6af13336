"""Column and row shaping of same-shaped or sparse tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

BLOCK = 524_288  # narrow rows of a task


def in_blocks(df: DataFrame, rows: int, keys: Sequence[str], block: int = BLOCK) -> DataFrame:
    """A table of about ``rows`` narrow rows, shuffled by ``keys`` into partitions of at most about ``block`` rows.

    The number is said outright: narrow rows compress so well that adaptive execution, which puts partitions
    together by their stored size, would have a task sort and hold millions of them. Fewer partitions than any other
    shuffle has would be shuffled again for a join; rows that are one block need none.
    """
    if rows <= block:
        return df
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, rows // block + 1), *keys)


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a null (or NaN) in any column."""
    return nan_to_null(df).na.drop("any")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column, so that aggregates skip it."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else df


def present(df: DataFrame, column: str) -> Column:
    """The column with NaN read as missing."""
    floating = isinstance(df.schema[column].dataType, (DoubleType, FloatType))
    return F.nanvl(F.col(column), F.lit(None)) if floating else F.col(column)


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; others in the map are ignored."""
    return df.withColumnsRenamed(dict(names))


def label_source(df: DataFrame, label: int, name: str = "label") -> DataFrame:
    return df.withColumn(name, F.lit(label).cast("int"))


def stack_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing from one table is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def distinct_values(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Distinct non-null values over several columns, read in one scan."""
    values = df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias(name))
    return values.where(F.col(name).isNotNull()).distinct()
