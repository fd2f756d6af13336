"""Shaping of object detections, the same for tables and streams.

A frame is one row: ``frame_id``, and parallel arrays ``boxes`` (structs of
x1, y1, x2, y2), ``confs``, ``class_ids`` and, if segmented, ``polygons``
(arrays of x, y structs).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: only detections above this confidence are kept.
THRESHOLD = 0.5

FRAME_SCHEMA = (
    "frame_id long, boxes array<struct<x1:double,y1:double,x2:double,y2:double>>, "
    "confs array<double>, class_ids array<int>, polygons array<array<struct<x:double,y:double>>>"
)


def confident(df: DataFrame, conf: str = "conf", threshold: float = THRESHOLD) -> DataFrame:
    return df.where(F.col(conf) > threshold)


def int_box(df: DataFrame) -> DataFrame:
    """Box corners as whole pixels, cut toward zero."""
    return df.withColumns({c: F.col(c).cast("int") for c in ("x1", "y1", "x2", "y2")})


def int_polygon(polygon: Column) -> Column:
    return F.transform(polygon, lambda p: F.struct(p["x"].cast("int").alias("x"), p["y"].cast("int").alias("y")))


def with_class_name(df: DataFrame, classes: DataFrame | Mapping[int, str]) -> DataFrame:
    """Look up ``class_name`` by ``class_id`` in a table or a literal map; unknown ids give null."""
    if isinstance(classes, Mapping):
        lookup = F.create_map(*[F.lit(x) for k, v in classes.items() for x in (k, v)])
        return df.withColumn("class_name", F.try_element_at(lookup, F.col("class_id")))
    return df.join(classes.select("class_id", "class_name"), "class_id", "left")


def label_text(name: Column, conf: Column) -> Column:
    """``name: 0.87``"""
    return F.concat(name, F.lit(": "), F.call_function("format_number", conf, F.lit("0.00")))


def explode_frames(frames: DataFrame) -> DataFrame:
    """One row per detection; the polygon is null where a frame has fewer polygons than boxes."""
    each = F.posexplode(F.arrays_zip("boxes", "confs", "class_ids")).alias("det_no", "d")
    return frames.select("frame_id", "polygons", each).select(
        "frame_id",
        "det_no",
        F.col("d.confs").alias("conf"),
        F.col("d.class_ids").alias("class_id"),
        "d.boxes.*",
        F.get("polygons", F.col("det_no")).alias("polygon"),
    )


def shape_detections(
    frames: DataFrame, classes: DataFrame | Mapping[int, str], threshold: float = THRESHOLD
) -> DataFrame:
    """Explode, keep confident detections, cut to pixels, name and label them."""
    kept = int_box(confident(explode_frames(frames), threshold=threshold))
    named = with_class_name(kept, classes)
    return named.select(
        "frame_id",
        "det_no",
        "class_id",
        "class_name",
        "conf",
        "x1",
        "y1",
        "x2",
        "y2",
        label_text(F.col("class_name"), F.col("conf")).alias("label"),
        int_polygon(F.col("polygon")).alias("polygon"),
    )


def polygon_area(polygon: Column) -> Column:
    """Area by the shoelace formula; null for a missing polygon, 0 below three points."""
    n = F.size(polygon)
    terms = F.transform(
        polygon,
        lambda p, i: p["x"].cast("double") * F.get(polygon, (i + 1) % n)["y"]
        - F.get(polygon, (i + 1) % n)["x"].cast("double") * p["y"],
    )
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda total, t: total + t)) / 2.0


def class_areas(shaped: DataFrame) -> DataFrame:
    """Detections and summed polygon area per class."""
    return shaped.groupBy("class_id").agg(
        F.count(F.lit(1)).alias("n_detections"), F.sum(polygon_area(F.col("polygon"))).alias("area")
    )
