"""Stateless outputs of the readings: alerts and the labelled feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import Rules
from ..functions import rules as R, times


def alerts(readings: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per reading above the warning threshold, however late it arrives."""
    level = F.col("co2_level")
    return readings.where(R.is_alert(level, rules)).select(
        "sensor_id",
        "location",
        "co2_level",
        times.local_time("measurement_time").alias("alert_time"),
        R.alert_message(level, rules).alias("message"),
    )


def status_feed(readings: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Every snapshot, create and update with its label, for watching the feed live."""
    return readings.where(F.col("op").isin("r", "c", "u")).select(
        "sensor_id",
        "co2_level",
        "location",
        times.local_time("measurement_time").alias("measurement_time"),
        R.feed_label(F.col("co2_level"), rules).alias("status"),
    )
