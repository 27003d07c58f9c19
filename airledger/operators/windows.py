"""Tumbling event-time windows per sensor and place.

On a stream, set a watermark first and write in append mode: each window is emitted once, after
the watermark passes its end. Partial aggregation runs before the shuffle, so a sensor that sends
a third of all readings still shuffles one row per window and input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import times


def tumbling(readings: DataFrame, size: str, *measures: Column) -> DataFrame:
    grouped = readings.groupBy(
        "sensor_id", "location", F.window("measurement_time", size).alias("bucket")
    ).agg(*measures)
    names = [c for c in grouped.columns if c not in ("sensor_id", "location", "bucket")]
    return grouped.select(
        "sensor_id", "location", times.window_end("bucket").alias("window_end"), *names
    )


def minute_averages(readings: DataFrame) -> DataFrame:
    return tumbling(readings, "1 minute", F.avg("co2_level").alias("avg_co2"))


def hourly_aggregates(readings: DataFrame) -> DataFrame:
    return tumbling(
        readings,
        "1 hour",
        F.avg("co2_level").alias("avg_co2"),
        F.min("co2_level").alias("min_co2"),
        F.max("co2_level").alias("max_co2"),
    )
