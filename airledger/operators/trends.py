"""Trend queries over the base table, the alerts and the hourly aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import Rules
from ..functions import rules as R, times

DAY_MICROS = 24 * 60 * 60 * 1_000_000


def daily_patterns(measurements: DataFrame) -> DataFrame:
    """Average level by hour of day and place."""
    return measurements.groupBy(
        times.hour_of_day("measurement_time").alias("hour_of_day"), "location"
    ).agg(F.avg("co2_level").alias("avg_co2"))


def daily_summary(measurements: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Average, peak and number of readings above the warning threshold by day and place."""
    level = F.col("co2_level")
    return measurements.groupBy(
        times.day_of("measurement_time").alias("measurement_date"), "location"
    ).agg(
        F.avg(level).alias("avg_co2"),
        F.max(level).alias("max_co2"),
        F.count_if(R.is_alert(level, rules)).alias("alerts_count"),
    )


def trend_partials(measurements: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """What both daily views need, by day, hour and place. Partials of different days or hours add up, so a day can
    be computed apart from the others."""
    at, level = "measurement_time", F.col("co2_level")
    return measurements.groupBy(
        times.day_of(at).alias("measurement_date"), times.hour_of_day(at).alias("hour_of_day"), "location"
    ).agg(
        F.sum(level).alias("total"),
        F.count(level).alias("levels"),
        F.count(F.lit(1)).alias("readings"),
        F.max(level).alias("max_co2"),
        F.count_if(R.is_alert(level, rules)).alias("alerts_count"),
    )


def _average() -> Column:
    return F.try_divide(F.sum("total"), F.sum("levels")).alias("avg_co2")


def patterns_of(partials: DataFrame) -> DataFrame:
    """``daily_patterns`` from the partials."""
    return partials.groupBy("hour_of_day", "location").agg(_average())


def summary_of(partials: DataFrame) -> DataFrame:
    """``daily_summary`` from the partials."""
    return partials.groupBy("measurement_date", "location").agg(
        _average(), F.max("max_co2").alias("max_co2"), F.sum("alerts_count").alias("alerts_count")
    )


def alert_summary_hourly(alerts: DataFrame) -> DataFrame:
    """Number of alerts by hour and place."""
    return alerts.groupBy(times.hour_start("alert_time").alias("alert_hour"), "location").agg(
        F.count(F.lit(1)).alias("alert_count")
    )


def sensor_stats_24h(hourly: DataFrame) -> DataFrame:
    """Each hourly average beside the mean of its sensor's hourly averages of the last 24 hours.

    The mean is unweighted, spans all places of the sensor and includes both ends of the range.

    A range frame over the hourly rows themselves would gather every place of a busy sensor in one
    task and buffer them all. The rows first shrink to one (sum, count) per sensor and hour, partly
    before the shuffle, so a window partition holds one small row per hour of history and its frame
    at most 25, however many readings or places the sensor has.
    """
    totals = (
        hourly.groupBy("sensor_id", "window_end")
        .agg(F.sum("avg_co2").alias("total"), F.count("avg_co2").alias("n"))
        .withColumn("micros", F.unix_micros(times.instant("window_end")))
    )
    last_day = Window.partitionBy("sensor_id").orderBy("micros").rangeBetween(-DAY_MICROS, 0)
    rolling = totals.select(
        F.col("sensor_id").alias("rolled_sensor"),
        F.col("window_end").alias("rolled_end"),
        F.try_divide(F.sum("total").over(last_day), F.sum("n").over(last_day)).alias(
            "rolling_24h_avg"
        ),
    )
    # Null-safe and left: no null filter is inferred for one side only, so both sides keep the same
    # scan and aggregation and Spark runs it once (ReusedExchange).
    same_hour = F.col("sensor_id").eqNullSafe(F.col("rolled_sensor")) & F.col(
        "window_end"
    ).eqNullSafe(F.col("rolled_end"))
    return hourly.join(rolling, same_hour, "left").select(
        "sensor_id",
        "location",
        F.col("window_end").alias("time_bucket"),
        F.col("avg_co2").alias("hourly_avg"),
        "rolling_24h_avg",
    )
