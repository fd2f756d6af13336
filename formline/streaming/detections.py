"""Detection streams: the batch shaping applied to arriving frames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from formline.operators.detections import FRAME_SCHEMA, THRESHOLD, shape_detections


def read_frames(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Frames arriving as Parquet files in ``path``."""
    reader = spark.readStream.schema(FRAME_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def shape_stream(
    spark: SparkSession,
    frames_path: str,
    classes: DataFrame | Mapping[int, str],
    out_path: str,
    checkpoint: str,
    threshold: float = THRESHOLD,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Shape all frames that are there, stop at the end of the source, and return the result."""
    shaped = shape_detections(read_frames(spark, frames_path, files_per_batch), classes, threshold)
    query = (
        shaped.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(shaped.schema).parquet(out_path)
