"""Derived tables kept by day. When rows arrive, only the days they touch are built again.

A table of this kind is a stream over its source. Each batch says which days it touches; those days are computed anew
from the whole source, pruned to them, and replace their partitions (dynamic partition overwrite). What a day
holds depends on the source alone, so a repeated batch, a lost executor or a fresh checkpoint gives the same
table, and nothing else is kept to recover from. A touched day without rows leaves an empty mark, or its old
partition would stay.

- ``trend_partials``: sums, counts and maxima by day, hour and place of the current base table, for the daily views;
- ``status_days``: the newest valid reading of each sensor and day, for the latest status;
- ``alert_summary``: alerts by hour and place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..config import DRAIN, Rules, StreamSettings
from ..operators import changes as C, latest as L, trends as V
from ..sources import changes as feeds
from . import files, queries as Q, sinks

Build = Callable[[SparkSession, list[date]], DataFrame]
Touched = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class DayTable:
    """``name`` below the root, partitioned by the date column ``day``; ``columns`` without it."""

    name: str
    day: str
    columns: str

    def path(self, root: str) -> str:
        return f"{root}/{self.name}"

    def read(self, spark: SparkSession, root: str) -> DataFrame:
        """The table as last refreshed; empty before."""
        schema = f"{self.columns}, filled boolean, {self.day} date"
        if not files.exists(spark, self.path(root)):
            return spark.createDataFrame([], schema).drop("filled")
        return spark.read.schema(schema).parquet(self.path(root)).where("filled").drop("filled")

    def replace(self, root: str, days: list[date], rows: DataFrame) -> None:
        """Give the days new rows; other days stay as they are."""
        spark = rows.sparkSession
        marks = spark.createDataFrame([(d, False) for d in days], f"{self.day} date, filled boolean")
        whole = rows.withColumn("filled", F.lit(True)).unionByName(marks, allowMissingColumns=True)
        # Few files a day, and several for a day of many rows.
        writer = whole.hint("rebalance", self.day).write.mode("overwrite").partitionBy(self.day)
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path(root))


def _day() -> Column:
    """The day of a streamed reading. A stream that began over an empty bronze table knows no partition columns and
    reads ``event_date`` as null, so the time itself is asked."""
    return F.to_date("measurement_time").alias("day")


def _follow(
    rows: DataFrame, table: DayTable, touched: Touched, build: Build, root: str, settings: StreamSettings
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        days = sorted(r.day for r in touched(batch).where("day IS NOT NULL").distinct().collect())
        if days:
            table.replace(root, days, build(batch.sparkSession, days))

    return sinks.for_each_batch(rows, write, table.name, f"{root}/_checkpoints/{table.name}", settings)


TREND_PARTIALS = DayTable(
    "trend_partials",
    "measurement_date",
    "hour_of_day int, location string, total double, levels bigint, readings bigint, max_co2 double, alerts_count bigint",
)
ALERT_SUMMARY = DayTable("alert_summary", "alert_date", "alert_hour timestamp_ntz, location string, alert_count bigint")


def status_days(seq_type: str = "bigint") -> DayTable:
    columns = ", ".join(f"{c.name} {c.type}" for c in schemas.CURRENT_STATUS.columns)
    return DayTable("status_days", "status_date", f"{columns}, seq {seq_type}, id bigint")


def start_trends(
    spark: SparkSession, root: str, settings: StreamSettings, rules: Rules = Rules(), seq_type: str = "bigint"
) -> StreamingQuery:
    """Keep the partials of the daily views beside the bronze table.

    A create touches the day of its reading. Any other change also touches the days its row had a reading on before.
    To rebuild a day, its own readings are read and, of the other days, only the changes that are no creates: one of
    them may have moved or deleted a row of this day. A create names a row that does not exist, so it
    cannot have.
    """
    no_create = ~F.col("op").eqNullSafe("c")

    def touched(batch: DataFrame) -> DataFrame:
        readings = batch.where("id IS NOT NULL").select(_day())
        changed = batch.where(no_create).select("feed", F.coalesce("id", "before_id").alias("id")).distinct()
        before = Q.read_history(batch.sparkSession, root, seq_type).where("id IS NOT NULL")
        return readings.unionByName(
            before.select("feed", "id", F.col("event_date").alias("day")).join(changed, ["feed", "id"], "left_semi").select("day")
        )

    def build(session: SparkSession, days: list[date]) -> DataFrame:
        history = Q.read_history(session, root, seq_type)
        own = history.where(F.col("event_date").isin(days))
        others = history.where(~F.col("event_date").isin(days) & no_create)
        state = C.state_of(own.unionByName(others))
        return V.trend_partials(state.where(F.to_date("measurement_time").isin(days)), rules)

    changes = Q.stream_history(spark, root, seq_type)
    return _follow(changes, TREND_PARTIALS, touched, build, root, settings)


def start_status(
    spark: SparkSession,
    root: str,
    settings: StreamSettings,
    rules: Rules = Rules(),
    seq_type: str = "bigint",
) -> StreamingQuery:
    """Keep the newest valid reading of each sensor and day."""

    def touched(batch: DataFrame) -> DataFrame:
        return batch.select(_day())

    def build(session: SparkSession, days: list[date]) -> DataFrame:
        readings = Q.read_bronze(session, root, seq_type).where(F.col("event_date").isin(days))
        rows = L.valid_status(readings, rules).withColumn("status_date", F.to_date("last_updated"))
        return L.newest(rows, ["status_date", "sensor_id"], L.recency(rows, "last_updated"))

    readings = Q.merged(Q.stream_bronze(spark, root, seq_type, settings.max_files_per_trigger))
    return _follow(readings, status_days(seq_type), touched, build, root, settings)


def read_status(spark: SparkSession, root: str, seq_type: str = "bigint") -> DataFrame:
    """The newest of the days' newest: one row per sensor and day is read, not the readings."""
    rows = status_days(seq_type).read(spark, root).drop("status_date")
    return L.newest(rows, "sensor_id", L.recency(rows, "last_updated")).select(*schemas.CURRENT_STATUS.names)


def start_alert_summary(spark: SparkSession, root: str, settings: StreamSettings) -> StreamingQuery:
    """Keep the alerts by hour and place beside the stored alerts."""

    def touched(batch: DataFrame) -> DataFrame:
        return batch.where("is_valid").select(F.to_date("alert_time").alias("day"))

    def build(session: SparkSession, days: list[date]) -> DataFrame:
        at = F.col("alert_time")
        alerts = sinks.read_appended(session, schemas.ALERTS, f"{root}/alerts")
        # The range reaches the files' statistics; the days inside it are picked after.
        span = alerts.where((at >= F.lit(days[0]).cast("timestamp_ntz")) & (at < F.lit(days[-1] + timedelta(1)).cast("timestamp_ntz")))
        hours = V.alert_summary_hourly(span.where(F.to_date(at).isin(days)))
        return hours.withColumn("alert_date", F.to_date("alert_hour"))

    reader = spark.readStream.schema(sinks.sink_schema(schemas.ALERTS)).options(**feeds.ANY_AGE)
    return _follow(reader.parquet(f"{root}/alerts"), ALERT_SUMMARY, touched, build, root, settings)


def read_alert_summary(spark: SparkSession, root: str) -> DataFrame:
    return ALERT_SUMMARY.read(spark, root).drop("alert_date")


def refresh_alert_summary(spark: SparkSession, root: str) -> None:
    """Bring the summary up to the stored alerts, then return."""
    if files.exists(spark, f"{root}/alerts"):
        start_alert_summary(spark, root, StreamSettings(trigger=DRAIN)).awaitTermination()


def refresh_trends(spark: SparkSession, root: str, rules: Rules = Rules(), seq_type: str = "bigint") -> None:
    """Bring the partials up to bronze, then return."""
    start_trends(spark, root, StreamSettings(trigger=DRAIN), rules, seq_type).awaitTermination()
