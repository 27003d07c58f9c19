"""Result tables and trend views under their SQL names, for users who query with spark.sql."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import config, schemas
from ..config import Rules
from ..operators import alerts as A, changes as C, latest as L, trends as V, windows as W
from ..streaming import days, files, queries as Q, sinks


def register_functions(spark: SparkSession, rules: Rules = Rules()) -> list[str]:
    """The threshold rules as temporary SQL functions of a level. Spark replaces a call by the expression, so filters
    on it reach the scan like any other."""

    def graded(critical: str, warning: str, normal: str) -> str:
        return (
            f"CASE WHEN level > {rules.critical}D THEN '{critical}' WHEN level > {rules.warning}D THEN '{warning}' "
            f"ELSE '{normal}' END"
        )

    bodies = {
        "co2_status": ("STRING", graded(config.STATUS_CRITICAL, config.STATUS_WARNING, config.STATUS_NORMAL)),
        "co2_feed_label": ("STRING", graded(config.FEED_CRITICAL, config.FEED_WARNING, config.FEED_NORMAL)),
        "is_co2_alert": ("BOOLEAN", f"level > {rules.warning}D"),
        "co2_alert_message": (
            "STRING",
            f"CASE WHEN level > {rules.critical}D THEN '{config.MESSAGE_CRITICAL}' ELSE '{config.MESSAGE_WARNING}' END",
        ),
    }
    for name, (kind, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(level DOUBLE) RETURNS {kind} RETURN {body}")
    return list(bodies)


def register_stored_views(
    spark: SparkSession, root: str, *, seq_type: str = "bigint", rules: Rules = Rules()
) -> list[str]:
    """The same views over what the pipeline wrote below ``root``.

    The base table is rebuilt from the changes in bronze, the result tables are read as stored, and
    ``alert_summary_hourly``, ``daily_patterns`` and ``daily_summary`` are as last refreshed, where they were.
    """
    alerts = sinks.read_appended(spark, schemas.ALERTS, f"{root}/alerts")
    hourly = sinks.read_appended(spark, schemas.HOURLY_AGGREGATES, f"{root}/hourly")
    measurements = C.state_of(Q.read_history(spark, root, seq_type))
    if files.exists(spark, days.ALERT_SUMMARY.path(root)):
        summary = days.read_alert_summary(spark, root)
    else:
        summary = V.alert_summary_hourly(alerts)
    if files.exists(spark, days.TREND_PARTIALS.path(root)):
        partials = days.TREND_PARTIALS.read(spark, root)
        patterns, daily = V.patterns_of(partials), V.summary_of(partials)
    else:
        patterns, daily = V.daily_patterns(measurements), V.daily_summary(measurements, rules)
    views = {
        "co2_measurements": measurements,
        "co2_processed": Q.read_bronze(spark, root, seq_type),
        "co2_aggregated": sinks.read_appended(spark, schemas.MINUTE_AVERAGES, f"{root}/minute"),
        "co2_hourly_aggregates": hourly,
        "co2_alerts": alerts,
        "current_co2_status": days.read_status(spark, root, seq_type),
        "daily_patterns": patterns,
        "daily_summary": daily,
        "alert_summary_hourly": summary,
        "sensor_stats_24h": V.sensor_stats_24h(hourly),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    register_functions(spark, rules)
    return list(views)


def register_views(
    measurements: DataFrame,
    changes: DataFrame,
    *,
    hourly: DataFrame | None = None,
    alerts: DataFrame | None = None,
    rules: Rules = Rules(),
) -> list[str]:
    """Create the temporary views and functions and return the views' names; nothing runs until one is queried.

    Pass stored ``hourly`` and ``alerts`` tables to read those instead of deriving them from the
    feed on every query.
    """
    readings = C.readings(changes)
    hourly = W.hourly_aggregates(readings) if hourly is None else hourly
    alerts = A.alerts(readings, rules) if alerts is None else alerts
    views = {
        "co2_measurements": measurements,
        "co2_processed": readings,
        "co2_aggregated": W.minute_averages(readings),
        "co2_hourly_aggregates": hourly,
        "co2_alerts": alerts,
        "current_co2_status": L.current_status(readings, rules),
        "daily_patterns": V.daily_patterns(measurements),
        "daily_summary": V.daily_summary(measurements, rules),
        "alert_summary_hourly": V.alert_summary_hourly(alerts),
        "sensor_stats_24h": V.sensor_stats_24h(hourly),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    register_functions(changes.sparkSession, rules)
    return list(views)
