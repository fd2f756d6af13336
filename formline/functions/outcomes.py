"""Maps of match results."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Class index and points of a result seen from the home side.
RESULT_CLASS = {"H": 0, "D": 1, "A": 2}
RESULT_POINTS = {"H": 3, "D": 1, "A": 0}
CLASS_NAMES = {0: "Home Win", 1: "Draw", 2: "Away Win"}
# Labels of a scored text by class index.
TEXT_LABELS = {0: "REAL", 1: "FAKE"}


def mapped(column: str | Column, values: dict) -> Column:
    """Look values up in a literal map; others give null."""
    value = F.col(column) if isinstance(column, str) else column
    lookup = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.try_element_at(lookup, value)


def result_class(result: str) -> Column:
    return mapped(result, RESULT_CLASS)


def points(result: str) -> Column:
    return mapped(result, RESULT_POINTS)


def away_points(result: str) -> Column:
    """The away side's own points."""
    return mapped(result, {"H": 0, "D": 1, "A": 3})


def away_score(result: str) -> Column:
    """0 for a home win, 1 for an away win, one half otherwise."""
    return F.when(F.col(result) == "H", 0.0).when(F.col(result) == "A", 1.0).otherwise(0.5)
